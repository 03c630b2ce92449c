"""Exact duplicates by salted digest groups.

Texts are equal when their contents, the texts without white space, are equal. The
work goes through three combining stages, and each groups by digest and by the whole
content, so equal digests of different contents stay apart:

1. rows of one input partition, before anything is shuffled (partial aggregate);
2. rows of one digest and salt: a digest that a third of all rows share is spread
   over ``salts`` tasks;
3. the winners of the salts, at most ``salts`` rows for each digest.

Only digests come back to the single documents. Digests with more than one content
are found by a count; only their documents are matched by content.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import SPACES, Steps, text_column

SALTS = 64
MOST_CHARS = 2**31 - 1
SPAN = 2**65  # ids shifted to 0 .. 2^64 - 1, a missing id ranks last as 2^64


def content(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def digest_of(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def _rank() -> Column:
    """One number, smallest for the longest text and then for the smallest id."""
    chars = (F.lit(MOST_CHARS) - F.length("text")).cast("decimal(10,0)")
    doc = F.coalesce(
        F.col("doc_id").cast("decimal(20,0)") + F.lit(Decimal(2**63)), F.lit(Decimal(2**64))
    )
    return (chars * F.lit(Decimal(SPAN)) + doc).cast("decimal(38,0)")


def _doc_of(rank: Column) -> Column:
    doc = rank % F.lit(Decimal(SPAN))
    return F.when(doc < Decimal(2**64), (doc - Decimal(2**63)).cast("long"))


def exact_dedup(
    docs: DataFrame,
    salts: int = SALTS,
    digest: Callable[[Column], Column] = digest_of,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest, n_chars.

    Of equal texts the one with the most code points stays, then the smallest id; a
    missing id ranks last. A null text is an empty one, and all texts of white space
    only are equal. Rows that repeat both id and text form one document that was
    listed twice: the first of them is kept. Other columns are ignored. No rows give
    no rows.
    """
    steps = Steps(docs.sparkSession, "exact")
    base = docs.select("doc_id", text_column().alias("text")).withColumns(
        {"content": content(F.col("text"))}
    )
    base = base.withColumns({"digest": digest(F.col("content")), "rank": _rank()})
    salted = base.groupBy(
        "digest", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"), "content"
    ).agg(F.min("rank").alias("rank"), F.count("*").alias("rows"))
    groups = steps.save(
        salted.groupBy("digest", "content")
        .agg(F.min("rank").alias("rank"), F.sum("rows").alias("group_size"))
        .select("digest", F.xxhash64("content").alias("tag"), "rank", "group_size"),
        "groups",
    )
    shared = steps.save(
        groups.groupBy("digest").count().where("count > 1").select("digest"), "collisions"
    )
    rows = base.select("doc_id", "digest", "rank", F.length("text").alias("n_chars"))
    if shared.isEmpty():
        matched = rows.join(
            groups.select("digest", "group_size", F.col("rank").alias("best")), "digest"
        )
    else:
        matched = _match_contents(base, groups, shared, rows)
    picked = matched.withColumn("keep_id", _doc_of(F.col("best")))
    winners = picked.where("rank = best")
    others = picked.where("rank <> best").withColumn("kept", F.lit(False))
    return _first_of_repeats(winners).unionByName(others).select(
        "doc_id", "keep_id", "group_size", "kept", "digest", "n_chars"
    )


def _match_contents(
    base: DataFrame, groups: DataFrame, shared: DataFrame, rows: DataFrame
) -> DataFrame:
    """Rows with their group where some digests belong to several contents."""
    plain = rows.join(shared, "digest", "left_anti").join(
        groups.select("digest", "group_size", F.col("rank").alias("best")), "digest"
    )
    texts = base.join(shared, "digest", "left_semi")
    by_content = texts.groupBy("digest", "content").agg(
        F.min("rank").alias("best"), F.count("*").alias("group_size")
    )
    exact = (
        texts.withColumn("n_chars", F.length("text"))
        .join(by_content, ["digest", "content"])
        .select("digest", "doc_id", "rank", "n_chars", "group_size", "best")
    )
    return plain.unionByName(exact)


def _first_of_repeats(winners: DataFrame) -> DataFrame:
    """Mark one of the rows that repeat the winner's id and text.

    Equal rows can not be told apart, so they are counted and given out again: one
    row kept, the others not.
    """
    counted = winners.groupBy(*winners.columns).agg(F.count("*").alias("rows"))
    copies = F.explode(F.transform(F.sequence(F.lit(1), F.col("rows")), lambda i: i == 1))
    return counted.select(*winners.columns, copies.alias("kept"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns.

    The kept row is found by its id and digest, null ids included, and rows that
    repeat both are reduced to one.
    """
    kept = exact_dedup(docs).where("kept").select(*_key(F.col("doc_id"), F.col("digest")))
    own = digest_of(content(text_column()))
    keys = ["__id", "__missing", "__digest"]
    marked = docs.select("*", *_key(F.col("doc_id"), own), F.length("text").alias("__chars"))
    window = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("__chars"))
    return (
        marked.join(kept, keys)
        .withColumn("__n", F.row_number().over(window))
        .where("__n = 1")
        .select(*docs.columns)
    )


def _key(doc: Column, digest: Column) -> list[Column]:
    """Join columns in which a missing id equals a missing id."""
    return [
        F.coalesce(doc, F.lit(0)).alias("__id"),
        doc.isNull().alias("__missing"),
        digest.alias("__digest"),
    ]
