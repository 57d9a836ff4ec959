"""Personal data in texts: patterns propose spans, checksums confirm them, context weighs them.

DataFrame functions only. The patterns for Java's matcher are written so that it neither
recurses nor starts over along a long run of fitting characters: a long text costs its length.

The base kinds (email, ip, card, phone) always stay once their test passes. The others (iban,
ssn) stay if their score reaches a threshold; words close ahead of a span raise it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemill.llm.columns import aside, table

THRESHOLD = 0.5
NEAR = 40  # code points ahead of a span in which context words count
RAISE = 0.4  # what a context word adds to the score

_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str  # for Java
    plain: str  # the same matches, for engines without look-around
    score: float
    context: str
    base: bool


# The kinds in the order that spans of one start have.
KINDS = (
    Kind("email",
         r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?=\.[A-Za-z0-9-])"
         r"(?:[A-Za-z0-9.-](?<!\.\.))+(?<=[A-Za-z0-9-])",
         r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 0.9, "mail|contact|write", True),
    Kind("ip",
         r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 0.6, "ip|host|server|addr", True),
    Kind("card",
         r"[0-9](?:[0-9\x20-](?<![\x20-]{2}))+(?<=[0-9])",
         r"[0-9]([\x20-]?[0-9])+", 0.9, "card|visa|credit|pay|karte|tarjeta|carte", True),
    Kind("phone",
         r"\+[0-9][\x20().0-9-]+[0-9]",
         r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, "phone|call|tel|mobile|fax", True),
    Kind("iban",
         r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,4})?)",
         r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,4})?)",
         0.9, "iban|account|bank|konto|cuenta|compte", False),
    Kind("ssn",
         r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
         r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.2, "ssn|social|security|tax", False),
)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _mod_97(text: Column) -> Column:
    """Remainder of an IBAN whose first four characters go to its end, letters being 10 to 35."""
    plain = F.replace(text, F.lit(" "), F.lit(""))
    turned = F.concat(F.expr("''"), F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    code = lambda c: F.ascii(c) - F.when(F.ascii(c) < 65, 48).otherwise(55)
    return F.aggregate(
        F.split(turned, ""), F.lit(0),
        lambda rest, c: F.when(c == "", rest).otherwise(
            (rest * F.when(code(c) > 9, 100).otherwise(10) + code(c)) % 97))


def _confirmed(kind: str, hit: Column, ahead: Column, after: Column) -> Column:
    if kind == "ip":
        return hit.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$")
    if kind == "card":
        return F.length(_digits(hit)).between(14, 19) & F.call_function("luhn_check", _digits(hit))
    if kind == "phone":
        return F.length(_digits(hit)).between(10, 15)
    if kind == "iban":
        return _mod_97(hit) == 1
    if kind == "ssn":
        return ~(ahead.rlike("[0-9-]$") | after.rlike("^[0-9-]")
                 | hit.rlike("^(?:000|666|9)|-00-|-0000$"))
    return F.lit(True)


_SPAN = "struct<start:int,place:int,kind:string,end:int,hit:string,score:double>"


def _spans(kind: Kind, place: int, text: Column, hits: Column) -> Column:
    """Confirmed spans of one kind. ``hits``: all matches; what lies between gives positions."""
    gaps = F.split(text, kind.pattern, -1)

    def step(state: Column, i: Column) -> Column:
        hit, ahead = F.get(hits, i), F.get(state["gaps"], i)
        start = state["at"] + F.length(ahead)
        end = start + F.length(hit)
        near = F.lower(F.substr(ahead, F.greatest(F.length(ahead) - NEAR + 1, F.lit(1))))
        score = F.lit(kind.score) + F.when(near.rlike(kind.context), RAISE).otherwise(0.0)
        stays = _confirmed(kind.name, hit, ahead, F.get(state["gaps"], i + 1))
        if not kind.base:
            stays = stays & (score >= THRESHOLD)
        span = F.struct(
            start.alias("start"), F.lit(place).alias("place"), F.lit(kind.name).alias("kind"),
            end.alias("end"), hit.alias("hit"),
            F.least(score, F.lit(1.0)).alias("score")).cast(_SPAN)
        return F.struct(
            end.alias("at"), state["gaps"].alias("gaps"),
            F.when(stays, F.concat(state["out"], F.array(span))).otherwise(state["out"])
            .alias("out"))

    none = F.array().cast(f"array<{_SPAN}>")
    start = F.struct(F.lit(0).alias("at"), gaps.alias("gaps"), none.alias("out"))
    return F.when(F.size(hits) > 0, F.aggregate(
        F.sequence(F.lit(0), F.size(hits) - 1), start, step, lambda s: s["out"])).otherwise(none)


def find(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """The rows with an array of spans, sorted by start, then kind.

    A span has ``start`` and ``end`` (code points, end exclusive), ``kind``, ``place`` (the
    kind's place in KINDS), ``hit`` and ``score``. Matches of one kind do not overlap, spans of
    several kinds may. A null or empty text has none. Each row stands for itself, so repeated
    rows, ties and null columns change nothing. A column named like ``out`` is replaced.
    """
    docs, back = aside(docs, "_pii_text", "_pii_all",
                       *[f"_pii_{kind.name}" for kind in KINDS])
    rows = docs.withColumn("_pii_text", F.coalesce(F.col(text), F.lit("")))
    whole = F.col("_pii_text")
    for kind in KINDS:
        rows = rows.withColumn(
            f"_pii_{kind.name}", F.regexp_extract_all(whole, F.lit(kind.pattern), F.lit(0)))
    spans = [_spans(kind, place, whole, F.col(f"_pii_{kind.name}"))
             for place, kind in enumerate(KINDS)]
    rows = rows.withColumn("_pii_all", F.array_sort(F.concat(*spans)))
    return back(rows.withColumn(out, F.col("_pii_all")).drop(
        "_pii_text", "_pii_all", *[f"_pii_{kind.name}" for kind in KINDS]))


def masked(text: Column, spans: Column) -> Column:
    """The text with each span, or overlapping spans, replaced by its kind in angle brackets."""

    def step(state: Column, span: Column) -> Column:
        inside = span["start"] < state["at"]
        between = F.substr(text, state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(inside, state["out"]).otherwise(F.concat(
                state["out"], F.array(between, F.concat(F.lit("<"), span["kind"], F.lit(">")))))
            .alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.when(F.size(spans) > 0, F.aggregate(
        spans, start, step,
        lambda s: F.concat(F.array_join(s["out"], ""), F.substr(text, s["at"] + 1)))
    ).otherwise(text)


def mask(docs: DataFrame) -> DataFrame:
    """Documents with their spans masked; ``n_chars`` follows. Null texts stay null."""
    names = docs.columns
    docs, back = aside(docs, "_pii_spans")
    rows = find(docs, out="_pii_spans")
    rows = rows.withColumn("text", masked(F.col("text"), F.col("_pii_spans")))
    if "n_chars" in docs.columns:
        changed = F.size("_pii_spans") > 0
        rows = rows.withColumn("n_chars", F.when(
            changed, F.length("text").cast(docs.schema["n_chars"].dataType))
            .otherwise(F.col("n_chars")))
    return back(rows.drop("_pii_spans")).select(*names)


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def query(spark, folder):
    rows = find(table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    base = F.filter(spans, lambda s: s["place"] < 4)
    return rows.select(
        "doc_id", *[count(kind.name).alias(f"n_{kind.name}") for kind in KINDS if kind.base],
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(spans).alias("spans"))


def _sql_kind(place: int, kind: Kind) -> str:
    return f"""
  SELECT doc_id, {place} AS place, '{kind.name}' AS kind, {kind.score} AS score,
         '{kind.context}' AS context, unnest(hits) AS hit, generate_subscripts(hits, 1) AS i, gaps
  FROM (SELECT doc_id, regexp_extract_all(text, '{kind.plain}') AS hits,
               string_split_regex(text, '{kind.plain}') AS gaps FROM docs)"""


SQL = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
hits AS ({" UNION ALL ".join(_sql_kind(p, k) for p, k in enumerate(KINDS))}),
placed AS (
  SELECT *, gaps[i] AS ahead, gaps[i + 1] AS after,
         CAST(sum(length(gaps[i]) + length(hit)) OVER
              (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS stop,
         regexp_replace(hit, '[^0-9]', '', 'g') AS digits,
         list_transform(string_split(substr(replace(hit, ' ', ''), 5)
             || substr(replace(hit, ' ', ''), 1, 4), ''),
             lambda c: CASE WHEN ascii(c) < 65 THEN ascii(c) - 48 ELSE ascii(c) - 55 END) AS codes
  FROM hits),
judged AS (
  SELECT *, stop - length(hit) AS start, CASE kind
    WHEN 'ip' THEN regexp_full_match(hit, '{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}')
    WHEN 'card' THEN length(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(
      range(1, length(digits) + 1), lambda k: CASE WHEN k % 2 = 1
        THEN CAST(digits[length(digits) + 1 - k] AS INT)
        ELSE CAST(digits[length(digits) + 1 - k] AS INT) * 2
             - CASE WHEN CAST(digits[length(digits) + 1 - k] AS INT) > 4 THEN 9 ELSE 0 END
        END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 10 AND 15
    WHEN 'iban' THEN list_reduce(list_prepend(0, codes),
      lambda r, c: (r * CASE WHEN c > 9 THEN 100 ELSE 10 END + c) % 97) = 1
    WHEN 'ssn' THEN NOT regexp_matches(ahead, '[0-9-]$') AND NOT regexp_matches(after, '^[0-9-]')
      AND NOT regexp_matches(hit, '^(?:000|666|9)|-00-|-0000$')
    ELSE true END AND (place < 4 OR score + CASE WHEN
      regexp_matches(lower(right(ahead, {NEAR})), context) THEN {RAISE} ELSE 0 END >= {THRESHOLD})
    AS stays
  FROM placed),
listed AS (
  SELECT doc_id,
         count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place)
           FILTER (place < 4) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans
  FROM judged WHERE stays GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip,
       coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (doc_id)
"""
