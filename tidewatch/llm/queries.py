"""The numbered queries of this folder, each over its whole table, with SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import byte_bpe, html_text, langid, license_scan, piece_sampler, vector_codes
from tidewatch.llm.common import table
from tidewatch.llm.embedding_graph import near_vectors
from tidewatch.llm.exact_dedup import exact_dedup
from tidewatch.llm.minhash import near_duplicates
from tidewatch.llm.packing import pack
from tidewatch.llm.passage_chains import repeated_passages
from tidewatch.llm.spelling import spelling_groups
from tidewatch.llm.suffix_dedup import remove_repeats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query(
    "op10_exact_dedup",
    r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       first_value(doc_id) OVER w = doc_id AS kept,
       sha256(content) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY content ORDER BY n DESC, doc_id)
""",
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query("op5_near_dedup")
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    doc_id = F.col("row.doc_id")
    return langid.predict(docs.select("doc_id", "text"), model).select(
        doc_id, langid.held_out(doc_id).alias("held_out"), "lang_pred", "score"
    )


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("left", 256).alias("kept_sha256")
    )


@query("op4_embedding_dedup")
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), similarity=0.98)


@query("op7_piece_sampling")
def op7_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampler.encode(table(spark, sf_dir, "documents"))


@query("op9_html_text")
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), "page_id", "url")


@query("op6_license_scan")
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return license_scan.scan(docs, license_scan.train(docs))


@query("op1_passage_chains")
def op1_passage_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


@query("op11_byte_bpe")
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents")))
    text = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(text, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _vector_codes_sql() -> str:
    """Rounds as chained tables. The smallest distance * 256 + index gives entry and distance."""
    rounds = "".join(
        f"""
a{k} AS MATERIALIZED (
  SELECT p.vec_id, p.label, p.part, p.v,
         min(CAST(list_dot_product(p.v, p.v) - 2 * list_dot_product(p.v, b.v)
                  + list_dot_product(b.v, b.v) AS BIGINT) * 256 + b.entry) AS best
  FROM parts AS p JOIN b{k} AS b ON b.part = p.part
  GROUP BY p.vec_id, p.label, p.part, p.v),
b{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v
  FROM b{k} AS b LEFT JOIN (
    SELECT part, entry, list(floor(total / n) ORDER BY place) AS v
    FROM (SELECT part, best % 256 AS entry, place, sum(v[place]) AS total, count(*) AS n
          FROM a{k}, range(1, len(v) + 1) AS t(place) GROUP BY ALL)
    GROUP BY part, entry) AS m ON m.part = b.part AND m.entry = b.entry),"""
        for k in range(vector_codes.ROUNDS)
    )
    last = vector_codes.ROUNDS
    return f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS nth,
         list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, label, nth, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] AS v
  FROM kept, range(4) AS t(part)),
b0 AS MATERIALIZED (SELECT part, nth - 1 AS entry, v FROM parts WHERE nth <= 256),{rounds}
found AS MATERIALIZED (
  SELECT p.vec_id, p.label, p.part,
         min(CAST(list_dot_product(p.v, p.v) - 2 * list_dot_product(p.v, b.v)
                  + list_dot_product(b.v, b.v) AS BIGINT) * 256 + b.entry) AS best
  FROM parts AS p JOIN b{last} AS b ON b.part = p.part
  GROUP BY p.vec_id, p.label, p.part),
codes AS (
  SELECT vec_id, label, string_agg(printf('%02x', best % 256), '' ORDER BY part) AS code,
         CAST(sum(best // 256) AS BIGINT) AS error
  FROM found GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(CAST(v[place] AS BIGINT) AS VARCHAR), ','
                                 ORDER BY part, entry, place))
        FROM b{last}, range(1, len(v) + 1) AS t(place)) AS codebooks_sha256
FROM codes"""


@query("op12_vector_codes", _vector_codes_sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return coded.select(
        "vec_id", code.alias("code"), "error", "label_error",
        F.lit(vector_codes.codebook_digest(books)).alias("codebooks_sha256"),
    )


@query("op13_spelling_groups")
def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"))
