"""From documents to packed training sequences.

Each stage is a function of (spark, docs, sf_dir) and works on all that its predecessor kept. Its
rows are written as Parquet in the shared folder and read again as the next stage's documents,
so a lost executor costs the work of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from coursemill import session
from coursemill.llm import mixing, packing, pii, simhash, toxicity
from coursemill.llm.columns import aside, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine trained on the labels does not reject."""
    model = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    rows, back = aside(docs, "score", "predicted")
    return back(toxicity.score(rows, model).where("predicted = 0").drop("score", "predicted"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id.

    Documents are linked if the SimHash fingerprints of their three-word shingles differ in at
    most three bits.
    """
    return simhash.representatives(docs, shingle=3, distance=3)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data give way to the names of their kinds."""
    return pii.mask(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in their sequences, a row per piece."""
    import public_tokenizers

    return packing.pack(packing.pieces(
        docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False))


STAGES = [
    ("toxicity", without_toxic),
    ("near_copies", without_near_copies),
    ("personal_data", without_personal_data),
    ("mixing", mixed_sources),
    ("packing", packed),
]

# The fingerprints, the classifier and the tokenizer have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = session.stored(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return rows
