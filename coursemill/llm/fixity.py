"""Fixity audit of WARC files in two replicas, by Merkle trees.

Files are read as they are: a leaf is the digest of the bytes of a record with the true offset and
length that it has in its file, and bytes that are no record (stray ones, a record with a broken
header) are a leaf of their own. Leaves stand in the order of their offsets. A node is the digest of
its children and of the offset range that they cover. Above a file's own tree stands a tree over
the files, up to one root per replica. The audit compares the roots and descends only below nodes
that differ, down to the records.

Each level is one aggregation with groups of at most FANOUT children, for both replicas at once.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coursemill import session
from coursemill.llm.columns import table

FANOUT = 16
PAGES_A_FILE = 1000
END = "\r\n\r\n"
# Text files of records, compressed as such files are; offsets are those of the plain bytes.
FILE_OPTIONS = {"lineSep": END, "compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

_HEAD = re.compile(rb"WARC/1\.1\r\n((?:[A-Za-z-]+: [^\r\n]*\r\n)+)\r\n")
_BEGIN = b"WARC/1.1\r\n"
_LENGTH = re.compile(rb"(?:^|\n)Content-Length: ([0-9]{1,18})\r\n")
_ID = re.compile(rb"(?:^|\n)WARC-Record-ID: <urn:page:(-?[0-9]*)>\r\n")


def records(pages: DataFrame, pages_a_file: int = PAGES_A_FILE) -> DataFrame:
    """(file, record_id, record) of pages (page_id, url, html): WARC resource records.

    Pages go to files by ranges of their ids. Those without an id go to files -1, -2 and so on, by
    a hash of what they hold, as many as they need. Null urls and pages are empty ones. Other columns
    are left out.
    """
    payload = F.coalesce("html", F.lit(""))
    size = F.octet_length(payload).cast("string")
    lines = [F.lit("WARC/1.1"), F.lit("WARC-Type: resource"),
             F.concat(F.lit("WARC-Record-ID: <urn:page:"),
                      F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
             F.concat(F.lit("WARC-Target-URI: "), F.coalesce("url", F.lit(""))),
             F.lit("Content-Type: text/html"), F.concat(F.lit("Content-Length: "), size)]
    files = 1 + pages.where("page_id IS NULL").count() // pages_a_file
    dealt = -1 - F.conv(F.substring(F.md5(F.concat(
        F.coalesce("url", F.lit("")), payload)), 1, 7), 16, 10).cast("long") % files
    return pages.select(
        F.coalesce(F.floor(F.col("page_id") / pages_a_file), dealt).cast("long").alias("file"),
        F.col("page_id").cast("long").alias("record_id"),
        F.concat(F.concat_ws("\r\n", *lines), F.lit(END), payload).alias("record"))


def write(rows: DataFrame, folder: str) -> None:
    """WARC files of records (replica, file, record_id, record), one per replica and file, in order
    of ids; records of one id, and those without one, are in the order of their text.

    ``replica`` may be missing, and records may be any text. A file's records are one task's.
    """
    if "replica" not in rows.columns:
        rows = rows.withColumn("replica", F.lit(0))
    (rows.repartition("file").sortWithinPartitions("replica", "file", "record_id", "record")
     .select("replica", "file", "record").write.partitionBy("replica", "file")
     .options(**FILE_OPTIONS).text(folder))


def _cut(content: bytes) -> Iterator[tuple[int, int, int | None, bool]]:
    """(offset, length, record_id, is_record) of all stretches of a file's bytes, in order."""
    at = stray = 0
    while at < len(content):
        head = _HEAD.match(content, at)
        fields = head.group(1) if head else b""
        length, name = _LENGTH.search(fields), _ID.search(fields)
        stop = head.end() + int(length.group(1)) + len(END) if head and length and name else 0
        if stop and content[stop - len(END):stop] == END.encode():
            if stray < at:
                yield stray, at - stray, None, False
            yield at, stop - at, int(name.group(1)) if name.group(1) else None, True
            at = stray = stop
        else:  # no record here: on to where the next one may begin
            found = content.find(_BEGIN, at + 1)
            at = found if found >= 0 else len(content)
    if stray < at:
        yield stray, at - stray, None, False


def read(spark: SparkSession, folder: str, with_content: bool = False) -> DataFrame:
    """Stretches of the WARC files below a folder: (replica, file, offset, length, record_id,
    is_record, digest[, content]).

    A stretch is a record with its end, or what lies between two records; together they are all
    bytes of the file. A file is held in memory alone, and has a bounded number of records.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select(
        F.regexp_extract("path", r"replica=(\d+)", 1).cast("int").alias("replica"),
        F.regexp_extract("path", r"file=(-?\d+)", 1).cast("long").alias("file"),
        F.col("path").endswith(".gz").alias("packed"), "content")
    names = ["replica", "file", "offset", "length", "record_id", "is_record", "digest"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for replica, file, packed, content in zip(*batch.columns, strict=True):
                content = content.as_py()
                content = gzip.decompress(content) if packed.as_py() else content
                found = list(_cut(content))
                parts = [content[at:at + size] for at, size, _, _ in found]
                columns = [[replica.as_py()] * len(found), [file.as_py()] * len(found),
                           *[[row[k] for row in found] for k in range(4)],
                           [hashlib.sha256(part).hexdigest() for part in parts]]
                arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
                if with_content:
                    arrays.append(pa.array(parts, pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names=names + ["content"] * with_content)

    return files.mapInArrow(run, "replica int, file long, offset long, length long, record_id long, "
                                 "is_record boolean, digest string" + ", content binary" * with_content)


def leaves(rows: DataFrame) -> DataFrame:
    """Stretches with ``place``, by offset in their file, and ``repeat``, which counts records of
    one id, and stretches without an id that have the same bytes. Files are bounded."""
    order = Window.partitionBy("replica", "file").orderBy("offset")
    same = F.when(F.col("record_id").isNull(), F.col("digest"))
    own = Window.partitionBy("replica", "file", "record_id", same).orderBy("offset")
    return rows.select(
        "replica", "file", (F.row_number().over(order) - 1).cast("long").alias("place"),
        "record_id", same.alias("same"), F.row_number().over(own).alias("repeat"), "offset",
        "length", "is_record", "digest")


def _parents(nodes: DataFrame, of_files: bool, fanout: int) -> DataFrame:
    file = F.floor(F.col("file") / fanout) if of_files else F.col("file")
    place = F.lit(0) if of_files else F.floor(F.col("place") / fanout)
    child = F.col("file") if of_files else F.col("place")
    children = F.array_sort(F.collect_list(F.struct(
        child.alias("n"), "start", "stop", "hash")))
    text = F.concat_ws(",", F.transform(children, lambda c: F.concat_ws(
        ":", c["n"], c["start"], c["stop"], c["hash"])))
    return nodes.groupBy(
        "replica", file.cast("long").alias("file"), place.cast("long").alias("place")).agg(
        F.sha2(text, 256).alias("hash"), F.min("start").alias("start"),
        F.max("stop").alias("stop"))


def tree(rows: DataFrame, fanout: int = FANOUT) -> list[tuple[DataFrame, bool]]:
    """Levels of the trees of leaves with their ``replica``, from the leaves to the roots.

    Each level is a table in the shared folder, and says whether it is one of files.
    """
    first = rows.select("replica", "file", "place", "offset", "length", "digest").withColumn(
        "hash", F.sha2(F.concat_ws(":", "offset", "length", "digest"), 256))
    nodes = first.select("replica", "file", "place", "hash", F.col("offset").alias("start"),
                         (F.col("offset") + F.col("length")).alias("stop"))
    sizes = nodes.agg(F.max("place"), F.min("file"), F.max("file")).first()
    if sizes[0] is None:
        return []
    levels, places, low, high = [(nodes, False)], sizes[0], sizes[1], sizes[2]
    while places or low != high:
        of_files = not places
        nodes = session.stored(_parents(nodes, of_files, fanout), "tree")
        levels.append((nodes, of_files))
        if of_files:
            low, high = low // fanout, high // fanout
            if (low, high) == (-1, 0):  # file -1 and others meet here
                nodes = session.stored(_parents(
                    nodes.withColumn("file", F.col("file") + 1), True, fanout), "tree")
                levels.append((nodes, None))
                low = high = 0
        else:
            places //= fanout
    return levels


def differing(levels: list[tuple[DataFrame, bool]], fanout: int = FANOUT) -> DataFrame:
    """(file, place) of the leaves that differ, found from the roots down."""
    bad = None
    for k in range(len(levels) - 1, -1, -1):
        nodes = levels[k][0]
        if bad is not None:
            above = levels[k + 1][1]
            if above is None:
                file, place = F.lit(0), F.lit(0)
            elif above:
                file, place = F.floor(F.col("file") / fanout), F.lit(0)
            else:
                file, place = F.col("file"), F.floor(F.col("place") / fanout)
            nodes = nodes.join(bad, (file == F.col("bad_file")) & (place == F.col("bad_place")),
                               "left_semi")
        bad = nodes.groupBy("file", "place").agg(
            F.count("*").alias("n"), F.min("hash").alias("a"), F.max("hash").alias("b")).where(
            "n < 2 OR a != b").select(
            F.col("file").alias("bad_file"), F.col("place").alias("bad_place"))
    return bad


def audit(rows: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Every stretch of two replicas (:func:`read`, replica 0 and 1) with what became of it.

    (file, record_id, is_record, offset, length, digest, state), as in replica 0 where it has the
    stretch. States: ``intact``, ``moved`` (same bytes at another offset), ``changed`` (another
    content under the same id), ``missing`` and ``extra`` (in replica 0 or 1 only). Records are told
    apart by id and, where ids repeat, by their order; all else by its bytes. So a broken header
    shows as a record that is missing and a stretch that is extra. Empty replicas give the other's
    stretches as missing or extra.
    """
    both = session.stored(leaves(rows), "leaves")
    levels = tree(both, fanout)
    columns = ["file", "record_id", "is_record", "offset", "length", "digest"]
    if not levels:
        return both.select(*columns, F.lit("intact").alias("state"))
    bad = differing(levels, fanout)
    here = (F.col("file") == F.col("bad_file")) & (F.col("place") == F.col("bad_place"))
    intact = both.where("replica = 0").join(bad, here, "left_anti").select(
        *columns, F.lit("intact").alias("state"))
    suspects = both.join(bad, here, "left_semi")
    # A record that has moved is at another place of the same file.
    told = suspects.groupBy("file", "record_id", "same", "repeat").agg(
        *[F.coalesce(F.max(F.when(F.col("replica") == 0, F.col(c))),
                     F.max(F.when(F.col("replica") == 1, F.col(c)))).alias(c)
          for c in columns[2:]],
        F.min("replica").alias("low"), F.max("replica").alias("high"),
        (F.min("digest") == F.max("digest")).alias("alike"))
    state = (F.when(F.col("low") == 1, "extra").when(F.col("high") == 0, "missing")
             .when(F.col("alike"), "moved").otherwise("changed"))
    return intact.union(told.select(*columns, state.alias("state")))


STRAY = "stray bytes"


def _damaged(rows: DataFrame) -> DataFrame:
    """Both replicas of records: in the second a fixed choice of pages is damaged. Of 256, one has
    a byte too many, one is lost, one has stray bytes ahead of it, and one a broken header."""
    chance = F.substring(F.md5(F.coalesce(F.col("record_id").cast("string"), F.col("record"))), 1, 2)
    broken = F.concat(F.lit("WARC/x"), F.substr("record", F.lit(9)))
    head = F.regexp_extract("record", "^(?s)(.*?Content-Length: )", 1)
    size = F.regexp_extract("record", "^(?s).*?Content-Length: ([0-9]+)", 1)
    rest = F.substr("record", F.length(head) + F.length(size) + 1)
    longer = F.concat(head, (size.cast("long") + 1).cast("string"), F.lit(END), F.lit("?"),
                      F.substr(rest, F.lit(len(END) + 1)))
    copy = (F.when(chance == "00", longer)
            .when(chance == "02", F.concat(F.lit(STRAY + END), F.col("record")))
            .when(chance == "03", broken).otherwise(F.col("record")))
    twice = F.when(chance == "01", F.array(F.struct(F.lit(0).alias("replica"), "record"))).otherwise(
        F.array(F.struct(F.lit(0).alias("replica"), "record"),
                F.struct(F.lit(1).alias("replica"), copy.alias("record"))))
    return rows.select("file", "record_id", F.col("record").alias("own"), F.explode(twice).alias("r")
                       ).select("r.replica", "file", "record_id", "own", "r.record")


def query(spark, folder):
    """All pages as records in WARC files, audited against a damaged replica of the files."""
    place = session.work_folder(spark, "warc")
    rows = records(table(spark, folder, "pages"))
    # Both replicas come out of one shuffle of the pages.
    (_damaged(rows.repartition("file"))
     .sortWithinPartitions("replica", "file", "record_id", "own")
     .select("replica", "file", "record").write.partitionBy("replica", "file")
     .options(**FILE_OPTIONS).text(place))
    return audit(read(spark, place))


SQL = r"""
WITH dealt AS (
  SELECT page_id, url, html, (SELECT 1 + count(*) // 1000 FROM pages WHERE page_id IS NULL) AS files
  FROM pages),
built AS (
  SELECT coalesce(CAST(floor(page_id / 1000) AS BIGINT), -1 - ('0x' || substr(md5(
           coalesce(url, '') || coalesce(html, '')), 1, 7))::BIGINT % files) AS file,
         page_id AS record_id,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
         || 'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), '') || '>'
         || chr(13) || chr(10)
         || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
         || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' AS head,
         strlen(coalesce(html, '')) AS size,
         chr(13) || chr(10) || chr(13) || chr(10) AS gap, coalesce(html, '') AS html
  FROM dealt),
chosen AS (
  SELECT *, head || size || gap || html AS own, substr(md5(coalesce(
    CAST(record_id AS VARCHAR), head || size || gap || html)), 1, 2) AS chance FROM built),
stretches AS (
  SELECT 0 AS replica, file, record_id, own, 1 AS part, true AS is_record, own || gap AS bytes
  FROM chosen
  UNION ALL
  SELECT 1, file, record_id, own, 1, chance <> '03',
         CASE chance WHEN '00' THEN head || (size + 1) || gap || '?' || html
           WHEN '03' THEN 'WARC/x' || substr(own, 9) ELSE own END || gap
  FROM chosen WHERE chance <> '01'
  UNION ALL
  SELECT 1, file, record_id, own, 0, false, 'stray bytes' || gap FROM chosen WHERE chance = '02'),
numbered AS (
  SELECT *, row_number() OVER w AS n, row_number() OVER w - row_number() OVER (
      PARTITION BY replica, file, is_record ORDER BY record_id NULLS FIRST, own, part) AS island
  FROM stretches WINDOW w AS (PARTITION BY replica, file ORDER BY record_id NULLS FIRST, own, part)),
joined AS (
  SELECT replica, file, CASE WHEN is_record THEN record_id END AS record_id, is_record, min(n) AS n,
         string_agg(bytes, '' ORDER BY n) AS bytes
  FROM numbered
  GROUP BY replica, file, CASE WHEN is_record THEN record_id END, is_record,
           CASE WHEN is_record THEN -n ELSE island END),
placed AS (
  SELECT replica, file, record_id, is_record, sha256(bytes) AS digest, strlen(bytes) AS length,
         row_number() OVER w AS place,
         CAST(sum(strlen(bytes)) OVER w - strlen(bytes) AS BIGINT) AS start
  FROM joined WINDOW w AS (PARTITION BY replica, file ORDER BY n)),
named AS (
  SELECT *, CASE WHEN record_id IS NULL THEN digest END AS same,
         row_number() OVER (PARTITION BY replica, file, record_id,
           CASE WHEN record_id IS NULL THEN digest END ORDER BY start) AS repeat
  FROM placed),
intact AS (
  SELECT a.file, a.place FROM named a JOIN named b ON a.file = b.file AND a.place = b.place
    AND a.digest = b.digest AND a.start = b.start AND a.replica = 0 AND b.replica = 1),
suspects AS (SELECT * FROM named ANTI JOIN intact USING (file, place))
SELECT file, record_id, is_record, start AS "offset", length, digest, 'intact' AS state
FROM named SEMI JOIN intact USING (file, place) WHERE replica = 0
UNION ALL
SELECT coalesce(a.file, b.file), coalesce(a.record_id, b.record_id),
       coalesce(a.is_record, b.is_record), coalesce(a.start, b.start),
       coalesce(a.length, b.length), coalesce(a.digest, b.digest),
       CASE WHEN a.file IS NULL THEN 'extra' WHEN b.file IS NULL THEN 'missing'
            WHEN a.digest = b.digest THEN 'moved' ELSE 'changed' END
FROM (SELECT * FROM suspects WHERE replica = 0) a
FULL JOIN (SELECT * FROM suspects WHERE replica = 1) b
  ON a.file = b.file AND a.record_id IS NOT DISTINCT FROM b.record_id
  AND a.same IS NOT DISTINCT FROM b.same AND a.repeat = b.repeat
"""
