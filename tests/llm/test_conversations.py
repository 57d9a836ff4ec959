import hashlib
import heapq
import random
import zlib

import duckdb
import pytest

from check import canonical
from coursemill.llm import conversations as conv

LEADS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
MADE = {0: 2, 1: 2, 2: 3, 3: 2}


def cheapest(rows, before=0, after=(0, 3)):
    """(cost, audit) by trying edits in the order of what they cost. Rows: initial and mark."""
    heap, seen = [(0, "", 0, before)], set()
    while heap:
        cost, audit, at, role = heapq.heappop(heap)
        if (at, role) in seen or cost > 3000:
            continue
        seen.add((at, role))
        if at == len(rows) and role in after:
            return cost, audit
        heapq.heappush(heap, (cost + 3, audit + "I", at, MADE[role]))
        if at < len(rows):
            initial, mark = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, role))
            if mark not in "bd":
                more = cost + 3 * (mark == "t")
                heapq.heappush(heap, (more + 3, audit + "R", at + 1, MADE[role]))
                if (role, initial) in LEADS:
                    heapq.heappush(heap, (more, audit + "K", at + 1, LEADS[role, initial]))
    return None


def random_rows(rng, size, marks="...tbd", roles="uauasx"):
    return [rng.choice(roles) + rng.choice(marks) for _ in range(size)]


def test_search_finds_the_cheapest_edits():
    rng = random.Random(4)
    for _ in range(2500):
        rows = random_rows(rng, rng.randrange(14))
        assert conv.repaired("".join(rows)) == cheapest(rows)
    for size in (40, 120):
        rows = random_rows(rng, size, "......tbd", "uauauauas")
        assert conv.repaired("".join(rows)) == cheapest(rows)


def test_bounds_never_exceed_the_cost():
    rng = random.Random(5)
    for _ in range(400):
        rows = random_rows(rng, rng.randrange(9))
        lower = conv._bounds(rows)
        for at in range(len(rows) + 1):
            for before in range(4):
                costs = [cheapest(rows[at:], before, (after,)) for after in range(4)]
                assert lower[at] <= min(c[0] for c in costs if c)


def test_chunks_lead_over_every_way():
    rng = random.Random(6)
    for _ in range(200):
        rows = random_rows(rng, rng.randrange(1, 8))
        assert list(conv.ways("".join(rows))) == [
            cheapest(rows, before, (after,)) for before, after in conv.WAYS]
    # No other way exists.
    for before in range(4):
        for after in range(4):
            if (before, after) not in conv.WAYS:
                assert all(cheapest(random_rows(rng, 5), before, (after,)) is None
                           for _ in range(20))


def damaged(rows):
    out = []
    for conv_id, turn, role, text in rows:
        number = zlib.crc32(f"{' ' if conv_id is None else conv_id}:"
                            f"{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if number == 0:
            continue
        text = "" if number == 1 else text
        if number == 2:
            text = "".join(c for c in text if c not in ".!?")
        out += [(conv_id, turn, "user" if number == 4 else role, text)] * (1 + (number == 3))
    return out


def brute(rows):
    after = damaged(rows)
    for conv_id in {r[0] for r in rows}:
        own = sorted([r[1:] for r in after if r[0] == conv_id], key=lambda r: (
            r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marks = set(), []
        for _, role, text in own:
            words = text.encode().split()
            marks.append("b" if not words else "d" if (role, text) in seen else
                         "." if words[-1][-1:] in (b".", b"!", b"?") else "t")
            seen.add((role, text))
        roles = [(r[:1] if r[:1] in ("s", "u", "a") else "x") for _, r, _ in own]
        cost, audit = cheapest([a + b for a, b in zip(roles, marks, strict=True)])
        lines, state, at = [], 0, 0
        for edit in audit:
            if edit == "I":
                state = MADE[state]
                lines.append({2: "user:", 3: "assistant:"}[state])
                continue
            if edit != "D":
                state = LEADS[state, roles[at]] if edit == "K" else MADE[state]
                name = own[at][1] if edit == "K" else {2: "user", 3: "assistant"}[state]
                lines.append(f"{name}:{own[at][2]}")
            at += 1
        turns = [t for t, _, _ in own if t is not None]
        yield (conv_id, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
               marks.count("b"), marks.count("d"), marks.count("t"),
               sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au")
                   for a, b in zip(own, own[1:], strict=False)),
               cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def odd_rows():
    rng = random.Random(7)
    rows = [(c, rng.choice([t, t, t, t, None, t + 5]),
             rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool"]),
             rng.choice([None, "", "a b.", "hello", " \n", "x!", "y? ", "long . text", "é same."]))
            for c in [None, *range(60)] for t in range(rng.randrange(1, 12))]
    # Long ones: of many chunks, with copies far apart, in one turn, and without a turn.
    rows += [(77, t // 2, rng.choice(["user", "assistant"]), rng.choice([f"q{t % 300}.", "z"]))
             for t in range(900)]
    rows += [(78, 5, "user", f"{t}.") for t in range(200)]
    rows += [(79, None, "assistant", rng.choice(["same.", "é"])) for _ in range(200)]
    rows += [(80, 1, "user", "long " * 100_000), (80, 2, "assistant", "end.")]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, chunk string, edits int, marks int"


@pytest.mark.parametrize("parts", [1, 5])
def test_odd_conversations(spark, folder, parts):
    rows = odd_rows()
    spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(parts).write.parquet(
        f"{folder}/conversations.parquet")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    got = canonical(tuple(r) for r in conv.query(spark, folder).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == canonical(brute(rows))
    db = duckdb.connect()
    db.execute("CREATE VIEW conversations AS SELECT * FROM "
               f"'{folder}/conversations.parquet/*.parquet'")
    assert got == canonical(db.sql(conv.SQL).fetchall())


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "user", "And?"), (1, 2, "tool", "It ends"),
            (1, 3, "assistant", " ")]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    found = conv.repair(df).collect()
    assert [(e.edit, e.turn, e.role, e.text) for r in sorted(found, key=lambda r: r.chunk or 0)
            for e in r.edits] == [
        ("K", 0, "user", "Hello."), ("R", 1, "assistant", "And?"), ("D", 2, "tool", "It ends"),
        ("D", 3, "assistant", " ")]
    assert {(r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost) for r in found} == {
        (0, 1, 0, 1, 3, 11)}
    assert conv.repair(df.where("false")).count() == 0
