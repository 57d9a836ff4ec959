"""Repair of conversation structure by branch and bound.

The roles of a conversation have to read ``(s?(ua)+)?``: at most a system turn first, then user and
assistant in turn, or nothing. A row is kept (0), given another role (3) or deleted (4, which blank
and repeated rows have to be); a turn without text is inserted for 3; a truncated row that is not
deleted costs 3 more. The cheapest edits are searched depth first over an explicit stack. A
prefix of edits is given up when its cost and the lower bound of the rows behind it exceed the
incumbent (cost, audit), or when the table of its node, which is a row and the role before it, holds
a prefix that is no dearer. The search ends when the stack is empty, which proves the incumbent.

Rows are range-partitioned by conversation and turn, so a conversation lies in one task or in
some neighbouring ones. Where it lies in one, that task repairs it. One that may go on in the next
task, or that is long, is cut into chunks of at most 64 rows: each chunk is searched from every role
before it to every role after it, only these costs and audits are brought together per
conversation, and each chunk then takes its share of the best audit. Two audits of a chunk with
one cost are never prefixes of each other, since inserting costs, so the best parts make the best
whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemill import session
from coursemill.llm.columns import table

ROWS = 64  # rows of a chunk
CHARS = 8_000_000  # characters after which a chunk ends
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
NEVER = 1 << 60

# Roles before a row: none yet, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
# The role that a kept row leads to, by its initial.
KEPT = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER}]
# The role that an inserted or changed row gets.
MADE = [USER, USER, ASSISTANT, USER]
NAMES = {USER: "user", ASSISTANT: "assistant"}
ENDS = (START, ASSISTANT)
# Pairs of roles before and after a chunk that some edits lead over.
WAYS = [(START, START), *[(q, r) for q in range(4) for r in (SYSTEM, USER, ASSISTANT)
                          if not (r == SYSTEM and q in (USER, ASSISTANT))]]

EDITS = "array<struct<edit: string, turn: bigint, role: string, text: string>>"
FACTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


@lru_cache(1024)
def _row_bound(row: str) -> int:
    """The least that a row costs, whatever is around it. A row is its initial and its mark."""
    if row[1] in "bd":
        return DELETE
    extra = TRUNCATED if row[1] == "t" else 0
    return min(DELETE, (0 if row[0] in "sua" else REROLE) + extra)


def _choices(row: str) -> list[tuple[int, str]]:
    """What can become of a row: (cost, role), the role empty if it is deleted."""
    if row[1] in "bd":
        return [(DELETE, "")]
    extra = TRUNCATED if row[1] == "t" else 0
    return [(DELETE, ""), (REROLE + extra, "u"), (REROLE + extra, "a"),
            *([(extra, row[0])] if row[0] in "sua" else [])]


@lru_cache(4096)
def _pair_bound(one: str, two: str) -> int:
    """The least that two neighbouring rows cost, with what has to be inserted between them."""
    least = NEVER
    for cost, role in _choices(one):
        for more, other in _choices(two):
            if role and other:
                if other == "s":
                    continue
                more += 0 if role + other in ("su", "ua", "au") else INSERT
            least = min(least, cost + more)
    return least


def _bounds(rows: list[str]) -> list[int]:
    """Lower bounds of the cost of the rows from each on."""
    lower = [0] * (len(rows) + 2)
    for k in range(len(rows) - 1, -1, -1):
        lower[k] = _row_bound(rows[k]) + lower[k + 1]
        if k + 1 < len(rows):
            lower[k] = max(lower[k], _pair_bound(rows[k], rows[k + 1]) + lower[k + 2])
    return lower


def search(rows: list[str], before: int, after: tuple[int, ...],
           lower: list[int] | None = None) -> tuple[int, str, int] | None:
    """The cheapest edits (cost, audit, role at the end) that lead from one role to one of others.

    Of equal costs the audit that is least as ASCII text counts.
    """
    lower = lower or _bounds(rows)
    best_cost, best_audit, end = NEVER, "", -1
    tables: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, before, 0, "")]
    while stack:
        at, role, cost, audit = stack.pop()
        bound = cost + lower[at]
        if bound > best_cost or (bound == best_cost and audit > best_audit):
            continue
        known = tables.get((at, role))
        if known is not None and known <= (cost, audit):
            continue
        tables[at, role] = cost, audit
        if at == len(rows):
            if role in after and (cost, audit) < (best_cost, best_audit):
                best_cost, best_audit, end = cost, audit, role
            if cost + INSERT <= best_cost:
                stack.append((at, MADE[role], cost + INSERT, audit + "I"))
            continue
        row = rows[at]
        children = [(at + 1, role, cost + DELETE, audit + "D"),
                    (at, MADE[role], cost + INSERT, audit + "I")]
        if row[1] not in "bd":
            extra = cost + (TRUNCATED if row[1] == "t" else 0)
            kept = KEPT[role].get(row[0])
            if kept is not None:
                children.append((at + 1, kept, extra, audit + "K"))
            children.append((at + 1, MADE[role], extra + REROLE, audit + "R"))
        # The most promising one is searched first.
        children.sort(key=lambda c: (c[2] + lower[c[0]], c[3]), reverse=True)
        stack += children
    return None if end < 0 else (best_cost, best_audit, end)


@lru_cache(1 << 16)
def repaired(rows: str) -> tuple[int, str]:
    """(cost, audit) of a whole conversation, given as two characters a row."""
    found = search([rows[k:k + 2] for k in range(0, len(rows), 2)], START, ENDS)
    return found[0], found[1]


@lru_cache(1 << 12)
def ways(rows: str) -> list[tuple[int, str] | None]:
    """(cost, audit) of a chunk for each of WAYS, or None."""
    parts = [rows[k:k + 2] for k in range(0, len(rows), 2)]
    lower, out = _bounds(parts), []
    for before, after in WAYS:
        found = search(parts, before, (after,), lower)
        out.append(found[:2] if found else None)
    return out


def applied(audit: str, before: int, turns: list, roles: list, texts: list) -> tuple[list, int]:
    """The edits of an audit as (edit, turn, role, text), and the role after them."""
    out, at, now = [], 0, before
    for edit in audit:
        if edit == "I":
            now = MADE[now]
            out.append(("I", None, NAMES[now], ""))
            continue
        role = roles[at]
        if edit == "K":
            now = KEPT[now][role[:1]]
        elif edit == "R":
            now = MADE[now]
            role = NAMES[now]
        out.append((edit, turns[at], role, texts[at]))
        at += 1
    return out, now


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults by the checksum of conv_id and turn, modulo 20.

    0 drops a row, 1 empties its text, 2 removes ends of sentences, 3 repeats it, 4 makes it a
    user's. Nulls of role and text, and in the checksum, are one space.
    """
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return (
        rows.select(F.col("conv_id").cast("long").alias("conv_id"),
                    F.col("turn").cast("long").alias("turn"),
                    F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"),
                    kind.alias("kind"))
        .where("kind != 0")
        .select("conv_id", "turn",
                F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                F.when(F.col("kind") == 1, "")
                .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                .otherwise(F.col("text")).alias("text"),
                F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1)))
                          .otherwise(F.array(F.lit(0)))).alias("copy"))
        .drop("copy"))


def _mark(text: Column) -> Column:
    """b: no word; t: the last character of a word ends no sentence; else a point."""
    return (F.when(~text.rlike(r"[^\x20\x09-\x0D]"), "b")
            .when(text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), ".").otherwise("t"))


class _Rows:
    """Rows of one conversation, in order."""

    def __init__(self):
        self.turns, self.roles, self.texts, self.marks = [], [], [], []
        self.chars = 0

    def add(self, turn, role, text, mark):
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.marks.append(mark)
        self.chars += len(text)

    def mark_copies(self):
        seen = set()
        for k, (role, text, mark) in enumerate(
                zip(self.roles, self.texts, self.marks, strict=True)):
            if mark != "b":
                key = (role, text)
                if key in seen:
                    self.marks[k] = "d"
                seen.add(key)

    def coded(self) -> str:
        """Two characters a row: its initial, if it is one of the known, and its mark."""
        return "".join([(r[:1] if r[:1] in ("s", "u", "a") else "x") + m
                        for r, m in zip(self.roles, self.marks, strict=True)])


def _illegal(roles: list) -> int:
    return sum(a[:1] + b[:1] not in ("su", "ua", "au")
               for a, b in zip(roles, roles[1:], strict=False))


STORED = ("conv_id long, chunk long, gaps long, blank long, duplicate long, truncated long, "
          f"illegal long, cost long, marks string, edits {EDITS}")
_EDIT = pa.struct([("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()),
                   ("text", pa.string())])
_SCHEMA = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()),
                     *[(name, pa.int64()) for name in FACTS], ("marks", pa.string()),
                     ("edits", pa.list_(_EDIT))])


def _batch(out: list[tuple]) -> pa.RecordBatch:
    """Rows of STORED."""
    heads = list(zip(*[row[:-1] for row in out], strict=True)) or [()] * (len(_SCHEMA) - 1)
    flat = [edit for row in out for edit in row[-1]]
    parts = list(zip(*flat, strict=True)) or [()] * 4
    edits = pa.StructArray.from_arrays(
        [pa.array(part, field.type) for part, field in zip(parts, _EDIT, strict=True)],
        fields=list(_EDIT))
    bounds = np.cumsum([0, *[len(row[-1]) for row in out]]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [*[pa.array(head, field.type) for head, field in zip(heads, _SCHEMA, strict=False)],
         pa.ListArray.from_arrays(pa.array(bounds), edits)], schema=_SCHEMA)


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repairs conversations that lie within a sorted partition; others come out as chunks."""
    chunk = TaskContext.get().partitionId() << 32
    nothing = (None,) * len(FACTS)
    now, rows, open_, any_ = None, _Rows(), True, False
    out: list[tuple] = []

    def cut():
        nonlocal chunk, rows
        rows.mark_copies()
        out.append((now, chunk, *nothing, "".join(rows.marks), [
            ("", *row) for row in zip(rows.turns, rows.roles, rows.texts, strict=True)]))
        chunk += 1
        rows = _Rows()

    def close():
        nonlocal rows
        rows.mark_copies()
        cost, audit = repaired(rows.coded())
        known = [t for t in rows.turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        marks = rows.marks
        out.append((now, None, gaps, marks.count("b"), marks.count("d"), marks.count("t"),
                    _illegal(rows.roles), cost, None,
                    applied(audit, START, rows.turns, rows.roles, rows.texts)[0]))
        rows = _Rows()

    for batch in batches:
        columns = [column.to_pylist() for column in batch.columns]
        for conv, turn, role, text, mark in zip(*columns, strict=True):
            if any_ and conv != now:
                if open_:
                    cut()
                else:
                    close()
                open_ = False
                if len(out) >= 1000:
                    yield _batch(out)
                    out.clear()
            elif len(rows.turns) >= ROWS or rows.chars > CHARS:
                open_ = True
                cut()
            now, any_ = conv, True
            rows.add(turn, role, text, mark)
    if rows.turns:
        cut()  # it may go on in the next partition
    if out:
        yield _batch(out)


SUMMARY = ("conv string, chunk long, n_blank long, n_copies long, n_truncated long, n_illegal long, "
           "first string, last string, turns long, low long, high long, costs array<long>, "
           "audits array<string>")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for conv, chunk, marks, again, roles, turns in zip(
                *[c.to_pylist() for c in batch.columns], strict=True):
            marks = list(marks)
            for k in again or []:
                marks[k] = "d"
            known = [t for t in turns if t is not None]
            found = ways("".join((r if r in ("s", "u", "a") else "x") + m
                                 for r, m in zip(roles, marks, strict=True)))
            out.append((conv, chunk, marks.count("b"), marks.count("d"), marks.count("t"),
                        _illegal(roles), roles[0], roles[-1], len(set(known)),
                        min(known, default=None), max(known, default=None),
                        [w[0] if w else None for w in found], [w[1] if w else None for w in found]))
        columns = list(zip(*out, strict=True)) or [()] * 13
        kinds = [pa.string(), *[pa.int64()] * 5, pa.string(), pa.string(), *[pa.int64()] * 3,
                 pa.list_(pa.int64()), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=[part.split()[0] for part in SUMMARY.split(", ")])


CHOSEN = ("chunk long, before int, audit string, " + ", ".join(f"{name} long" for name in FACTS))


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Brings the chunks of each conversation together, sorted by conversation and chunk."""
    now, chunks = None, []

    def solved():
        # Per role: the cheapest way to it, and its steps as (way, link to the step before).
        best = {START: (0, "", None)}
        for _, _, _, _, _, _, _, _, _, _, costs, audits in chunks:
            after = {}
            for k, (p, q) in enumerate(WAYS):
                if p in best and costs[k] is not None:
                    cost, audit, steps = best[p]
                    option = (cost + costs[k], audit + audits[k], (k, steps))
                    if q not in after or option[:2] < after[q][:2]:
                        after[q] = option
            best = after
        # A chunk may also end with the insert that completes the conversation.
        ends = [best[q] for q in ENDS if q in best]
        cost, _, steps = min(ends, key=lambda e: e[:2])
        path = []
        while steps:
            path.append(steps[0])
            steps = steps[1]
        path.reverse()
        lows = [c[8] for c in chunks if c[8] is not None]
        highs = [c[9] for c in chunks if c[9] is not None]
        # Turns are in order, so one that is in several chunks is at their borders.
        shared = sum(a[9] is not None and a[9] == b[8]
                     for a, b in zip(chunks, chunks[1:], strict=False))
        gaps = max(highs) - min(lows) + 1 - (sum(c[7] for c in chunks) - shared) if lows else 0
        borders = sum(a[6] + b[5] not in ("su", "ua", "au")
                      for a, b in zip(chunks, chunks[1:], strict=False))
        facts = (gaps, *[sum(c[k] for c in chunks) for k in (1, 2, 3)],
                 sum(c[4] for c in chunks) + borders, cost)
        return [(c[0], WAYS[k][0], c[11][k], *facts) for c, k in zip(chunks, path, strict=True)]

    def out():
        rows = list(zip(*solved(), strict=True))
        kinds = [pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * len(FACTS)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)],
            names=[part.split()[0] for part in CHOSEN.split(", ")])

    for batch in batches:
        for conv, *rest in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if chunks and conv != now:
                yield out()
                chunks = []
            now = conv
            chunks.append(rest)
    if chunks:
        yield out()


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with the audits that were chosen for them, as STORED rows."""
    for batch in batches:
        out = []
        for conv, chunk, edits, before, audit, *facts in zip(
                *[c.to_pylist() for c in batch.columns], strict=True):
            done, _ = applied(audit, before, *[[e[k] for e in edits] for k in (
                "turn", "role", "text")])
            out.append((conv, chunk, *facts, None, done))
        yield _batch(out)


def repair(rows: DataFrame) -> DataFrame:
    """Conversations with their edits: (conv_id, chunk, gaps, blank, duplicate, truncated, illegal,
    cost, edits).

    ``edits`` are the structs (edit, turn, role, text) in order: K keeps a row, R gives it the role
    shown, D deletes it, I inserts one. A conversation is one row with a null ``chunk``, or some
    rows with rising chunks, each with the facts of the whole.

    Rows (conv_id, turn, role, text) are taken by turn, nulls first; rows of one turn by role and
    text. Null roles and texts are one space; a null conv_id is a conversation like any other.
    Other columns are left out. An empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(" "))
    plain = rows.select(F.col("conv_id").cast("long").alias("conv_id"),
                        F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"),
                        _mark(text).alias("mark"))
    folder = session.work_folder(rows.sparkSession, "conversations")
    (plain.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64))
     .sortWithinPartitions("conv_id", "turn", "role", "text")
     .mapInArrow(_first_pass, STORED).write.parquet(folder))
    stored = rows.sparkSession.read.schema(STORED).parquet(folder)
    open_ = stored.where("chunk IS NOT NULL").select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv"), "chunk", "marks",
        "edits")
    # Rows whose role and text an earlier chunk of the conversation has.
    keys = open_.select("conv", "chunk", "marks", F.posexplode("edits").alias("place", "edit")).where(
        ~F.substring(F.col("marks"), F.col("place") + 1, F.lit(1)).isin("b", "d")).select(
        "conv", "chunk", "place",
        F.md5(F.concat_ws(":", F.length("edit.role"), "edit.role", "edit.text")).alias("key"))
    first = keys.groupBy(F.col("conv").alias("of"), F.col("key").alias("same")).agg(
        F.min("chunk").alias("first"), F.max("chunk").alias("last")).where("first < last")
    again = keys.join(first, (F.col("conv") == F.col("of")) & (F.col("key") == F.col("same"))).where(
        F.col("chunk") > F.col("first")).groupBy(F.col("chunk").alias("in_chunk")).agg(
        F.collect_list("place").alias("again"))
    summaries = (
        open_.select("conv", "chunk", "marks", F.transform(
            "edits", lambda e: F.substring(e["role"], 1, 1)).alias("roles"),
            F.transform("edits", lambda e: e["turn"]).alias("turns"))
        .join(again, F.col("chunk") == F.col("in_chunk"), "left")
        .select("conv", "chunk", "marks", "again", "roles", "turns")
        .mapInArrow(_summaries, SUMMARY))
    chosen = (summaries.repartition("conv").sortWithinPartitions("conv", "chunk")
              .mapInArrow(_chosen, CHOSEN).withColumnRenamed("chunk", "of"))
    long_ = (stored.where("chunk IS NOT NULL").select("conv_id", "chunk", "edits")
             .join(chosen, F.col("chunk") == F.col("of"))
             .select("conv_id", "chunk", "edits", "before", "audit", *FACTS)
             .mapInArrow(_rewritten, STORED))
    return stored.where("chunk IS NULL").unionByName(long_).drop("marks")


def _text_of(edits: Column) -> Column:
    """The repaired rows of edits, a line each."""
    left = F.filter(edits, lambda e: e["edit"] != "D")
    return F.array_join(F.transform(left, lambda e: F.concat(e["role"], F.lit(":"), e["text"])), "\n")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations in several rows, sorted by conversation and chunk."""
    now, facts, audit, made, empty = None, None, [], hashlib.sha256(), True

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([x], k) for x, k in zip(
                [facts[0], *facts[1:], "".join(audit), made.hexdigest()],
                [*[pa.int64()] * 7, pa.string(), pa.string()], strict=True)],
            names=["conv_id", *FACTS, "audit", "repaired_sha256"])

    for batch in batches:
        for conv, conv_id, *own, letters, kept, text in zip(
                *[c.to_pylist() for c in batch.columns], strict=True):
            if facts is not None and conv != now:
                yield out()
                audit, made, empty = [], hashlib.sha256(), True
            now, facts = conv, (conv_id, *own)
            audit.append(letters)
            if kept:
                made.update((text if empty else "\n" + text).encode())
                empty = False
    if facts is not None:
        yield out()


def digests(repaired_rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, ..., cost, audit, repaired_sha256) of :func:`repair`'s rows.

    The digest of one conversation is a stream over its text, chunk by chunk.
    """
    letters = F.array_join(F.transform("edits", lambda e: e["edit"]), "")
    names = ["conv_id", *FACTS]
    short = repaired_rows.where("chunk IS NULL").select(
        *names, letters.alias("audit"), F.sha2(_text_of(F.col("edits")), 256).alias("repaired_sha256"))
    long_ = (
        repaired_rows.where("chunk IS NOT NULL")
        .withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
        .repartition("conv").sortWithinPartitions("conv", "chunk")
        .select("conv", *names, letters.alias("audit"),
                F.exists("edits", lambda e: e["edit"] != "D").alias("kept"),
                _text_of(F.col("edits")).alias("text"))
        .mapInArrow(_digests, ", ".join(f"{n} long" for n in names)
                    + ", audit string, repaired_sha256 string"))
    return short.unionByName(long_)


def query(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    found = digests(repair(damage(rows))).withColumnRenamed("conv_id", "of")
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id", *[F.coalesce(name, F.lit(0)).alias(name) for name in FACTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


# What can be done before the next row: roles before and after, cost, audit and lines.
_INSERTS = [(q, q, 0, "", "") for q in range(4)] + [
    (START, USER, 3, "I", "\nuser:"), (START, ASSISTANT, 6, "II", "\nuser:\nassistant:"),
    (SYSTEM, USER, 3, "I", "\nuser:"), (SYSTEM, ASSISTANT, 6, "II", "\nuser:\nassistant:"),
    (USER, ASSISTANT, 3, "I", "\nassistant:"), (ASSISTANT, USER, 3, "I", "\nuser:")]
# What can be done to a row: role before, its initial for K, edit, cost, role after, its new name.
_MOVES = ([(q, None, "D", DELETE, q, None) for q in range(4)]
          + [(q, initial, "K", 0, after, None) for q in range(4)
             for initial, after in KEPT[q].items()]
          + [(q, None, "R", REROLE, MADE[q], NAMES[MADE[q]]) for q in range(4)])


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(
        "NULL" if x is None else str(x) if isinstance(x, int) else
        "'" + x.replace("\n", "' || chr(10) || '") + "'" for x in row) + ")" for row in rows)


SQL = f"""
WITH RECURSIVE inserts(before, after, cost, audit, lines) AS (VALUES {_values(_INSERTS)}),
moves(before, initial, edit, cost, after, name) AS (VALUES {_values(_MOVES)}),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations),
summed AS (
  SELECT *, xor(list_reduce(
    list_prepend(4294967295::BIGINT,
      list_transform(range(length(k)), lambda i: ascii(k[i + 1])::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295) % 20 AS kind
  FROM keyed),
damaged AS (
  SELECT conv_id, coalesce(conv_id::VARCHAR, ' ') AS conv, turn,
    CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
      ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM summed WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (
    PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS place FROM damaged),
marked AS (
  SELECT *, left(role, 1) AS initial,
    CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b'
      WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY place) > 1 THEN 'd'
      WHEN regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN '.' ELSE 't' END AS mark,
    lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY place) AS ahead
  FROM placed),
facts AS (
  SELECT conv, count(*) AS n,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (mark = 'b') AS blank, count(*) FILTER (mark = 'd') AS duplicate,
    count(*) FILTER (mark = 't') AS truncated,
    count(*) FILTER (place > 1 AND ahead || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv),
ways(conv, place, role, best) AS (
  SELECT conv, 0::BIGINT, after, {{'cost': cost::BIGINT, 'audit': audit, 'lines': lines}}
  FROM facts, inserts WHERE before = {START}
  UNION ALL
  SELECT w.conv, w.place + 1, i.after, min({{
    'cost': (w.best.cost + e.cost + i.cost
      + CASE WHEN e.edit <> 'D' AND m.mark = 't' THEN {TRUNCATED} ELSE 0 END)::BIGINT,
    'audit': w.best.audit || e.edit || i.audit,
    'lines': w.best.lines || CASE WHEN e.edit = 'D' THEN ''
      ELSE chr(10) || coalesce(e.name, m.role) || ':' || m.text END || i.lines}})
  FROM ways w JOIN marked m ON m.conv = w.conv AND m.place = w.place + 1
  JOIN moves e ON e.before = w.role AND (e.edit <> 'K' OR e.initial = m.initial)
    AND (e.edit = 'D' OR m.mark IN ('.', 't'))
  JOIN inserts i ON i.before = e.after
  GROUP BY w.conv, w.place, i.after),
solved AS (
  SELECT conv, min(best) AS best FROM ways JOIN facts USING (conv)
  WHERE place = n AND role IN {ENDS} GROUP BY conv),
every AS (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, ' ') AS conv FROM conversations)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(best.lines[2:], '')) AS repaired_sha256
FROM every LEFT JOIN facts USING (conv) LEFT JOIN solved USING (conv)
"""
