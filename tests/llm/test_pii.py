import random
import re

from pyspark.sql import functions as F

from coursemill.llm import pii


def luhn(digits):
    total = 0
    for place, c in enumerate(reversed(digits)):
        n = int(c) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def brute(text):
    found = []
    for place, kind in enumerate(pii.KINDS[:4]):
        for m in re.finditer(kind.plain, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind.name == "email"
                    or kind.name == "ip" and all(int(p) < 256 for p in m[0].split("."))
                    or kind.name == "card" and 14 <= len(digits) <= 19 and luhn(digits)
                    or kind.name == "phone" and 10 <= len(digits) <= 15):
                found.append((m.start(), place, m.end()))
    return sorted(found)


def odd_texts():
    rng = random.Random(5)
    texts = [None, "", " ", "é+1 (988) 555-2485é a@b.c_d@e.f..g x@y x@y. 1.2.3.4.5.6.7.8",
             "4041894974608795 4041-8949 7460  8795 0000000000000000",
             "000255.1.1.1 256.1.1.1 1.1.1", "a" * 3_000, "1 " * 3_000, "1" * 3_000,
             "a@" + "b." * 3_000 + "c", "+1" + "(" * 3_000, "1." * 3_000, "a.b@c" * 500,
             "😀 x.y@z.w 😀 +49 (0) 30 1234567-8 4111 1111 1111 1111"]
    for _ in range(400):
        texts.append("".join(rng.choice("ab@.-_+ ()0123459\né") for _ in range(60)))
        texts.append("".join(rng.choice("+0123 -.") for _ in range(40)))
    return texts


def test_base_kinds_match_python(spark):
    texts = odd_texts()
    rows = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: [(s.start, s.place, s.end) for s in r.spans if s.place < 4]
           for r in rows.collect()}
    for i, text in enumerate(texts):
        assert got[i] == brute(text), repr(text)[:200]


def test_long_runs_cost_their_length(spark):
    texts = ["a" * 200_000, "1 " * 100_000, "1" * 200_000, "a@" + "b." * 100_000 + "c",
             "+1" + "(" * 200_000, "1-" * 100_000, "A1" * 100_000, "a." * 100_000 + "@b.c"]
    rows = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: [(s.kind, s.end - s.start) for s in r.spans] for r in rows.collect()}
    assert got[3] == [("email", 200_003)] and got[7] == [("email", 200_004)]
    assert not any(got[i] for i in (0, 1, 2, 4, 5, 6))


def test_checksums_and_context_confirm_the_other_kinds(spark):
    texts = ["DE89370400440532013000 and GB82 WEST 1234 5698 7654 32.", "DE88370400440532013000",
             "my ssn is 123-45-6789", "ref 123-45-6789", "ssn 000-45-6789", "ssn 1123-45-67890"]
    rows = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: [(s.kind, s.hit) for s in r.spans if s.place >= 4] for r in rows.collect()}
    assert got[0] == [("iban", "DE89370400440532013000"), ("iban", "GB82 WEST 1234 5698 7654 32")]
    assert got[2] == [("ssn", "123-45-6789")]
    assert not (got[1] or got[3] or got[4] or got[5])


def test_masking_keeps_the_columns(spark):
    rows = spark.createDataFrame(
        [(1, "é mail x.y@z.org, 10.0.0.1!", "s", 0, "k"), (2, None, None, None, None),
         (3, "plain", "s", 5, "k")],
        "doc_id long, text string, source string, n_chars long, spans string")
    masked = pii.mask(rows)
    assert masked.columns == rows.columns
    got = {r.doc_id: r for r in masked.collect()}
    assert got[1].text == "é mail <email>, <ip>!" and got[1].n_chars == len(got[1].text)
    assert got[1].spans == "k" and got[2].text is None and got[3] == rows.collect()[2]
    assert pii.mask(rows.where("false")).count() == 0


def test_query_columns(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a@b.c", "x")], "doc_id long, text string, spans string")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    row = pii.query(spark, str(tmp_path)).where(F.col("n_email") == 1).collect()[0]
    assert row.spans == "email:0:5"
