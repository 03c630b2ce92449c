"""Training corpus from documents: five stages, each over all rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import exact_dedup, langid, minhash, packing, suffix_dedup
from tidewatch.llm.common import Steps, table, tune

LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters or in no learned language (operator 8).

    A document goes if its language is ``und`` or its mean probability is below
    LEAST_SCORE. Learned from the documents that are not held out.
    """
    tune(spark)
    model = langid.train(docs.where(~langid.held_out()))
    found = langid.predict(docs, model)
    clean = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return clean.select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest one stays (operator 10)."""
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (five words, 0.8 or more) one of each group stays (operator 5)."""
    tune(spark)
    found = minhash.near_duplicates(docs)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated strings of 200 bytes out of the texts (operator 3).

    A cut inside a character leaves U+FFFD in its place. ``n_chars`` follows the new
    text; a document that loses everything stays with an empty text.
    """
    tune(spark)
    found = suffix_dedup.remove_repeats(docs, carry=tuple(docs.columns))
    text = F.make_valid_utf8(F.col("left").cast("string"))
    changed = found.where("n_removed > 0").withColumn("text", text)
    same = found.where("n_removed = 0").withColumn("text", F.col("rest.text"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return changed.unionByName(same).select(
        *[new.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns]
    )


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 tokens (operator 2)."""
    tune(spark)
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("exact copies", exact_copies),
    ("near copies", near_copies),
    ("repeated strings", repeated_strings),
    ("packing", windows),
]

#: SQL has no tokens and no trained labels; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(tune(spark), sf_dir, "documents")
    steps = Steps(spark, "pipeline")
    before = None
    for name, stage in STAGES:
        docs = steps.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            steps.drop(before)
        before = docs
    return docs
