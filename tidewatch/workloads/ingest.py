"""Queries for the jobs that run from payloads to stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators.filters import default_cutoff
from tidewatch.plans.jobs import backfill_job, feature_job, feature_summary, ingest_job
from tidewatch.schemas import ENRICHMENT_EXPORT_COLUMNS
from tidewatch.session import shared_path
from tidewatch.sinks.upsert import PARTITION, read_table
from tidewatch.workloads.features import FEATURES_SQL, REQUIRED_SQL, features_sql
from tidewatch.workloads.inputs import (
    DAILY_SQL,
    ENRICHMENT_SQL,
    HOURLY_SQL,
    SERIES,
    SLOTS_SQL,
    condition_sql,
    daily_payloads,
    enrichment_payloads,
    raw_hourly,
)
from tidewatch.workloads.registry import query, rounded

_PERIOD = {"start_date": "2024-01-01", "end_date": "2024-01-28"}
_HOUR_KEY = (
    "CAST(round_even(epoch(observed_at - TIMESTAMP '2010-01-01 00:00:00') / 3600.0, 0) AS BIGINT) + 1"
)
_DENSE_SQL = f"""{HOURLY_SQL}, {DAILY_SQL}, {ENRICHMENT_SQL}, {SLOTS_SQL},
dense AS (
  SELECT s.*, e.cape, e.freezing_level_height, e.uv_index
  FROM slots AS s
  LEFT JOIN enrichment AS e
    ON e.series_id = s.series_id AND e.observed_at = s.observed_at
   AND e.observed_at < TIMESTAMP '2024-01-29 00:00:00')"""


def _ingest(spark, sf_dir, table):
    root = shared_path(spark, "ingest")
    ingest_job(
        spark,
        daily_payloads(spark, sf_dir),
        enrichment_payloads(spark, sf_dir),
        SERIES,
        raw_path=f"{root}/raw",
        feature_path=f"{root}/features",
        **_PERIOD,
    )
    return read_table(spark, f"{root}/{table}").drop(PARTITION)


@query(
    "ingest_features",
    f"""WITH {_DENSE_SQL}, {features_sql("dense", _HOUR_KEY)}
SELECT * FROM features
WHERE {REQUIRED_SQL} AND observed_at <= TIMESTAMP '2024-01-27 23:00:00'""",
)
def ingested_features(spark, sf_dir):
    return rounded(_ingest(spark, sf_dir, "features"))


@query(
    "ingest_raw",
    f"""WITH {_DENSE_SQL}
SELECT {_HOUR_KEY} AS id, s.*, {condition_sql("weather_code")} AS weather_condition
FROM slots AS s WHERE observed_at <= TIMESTAMP '2024-01-27 23:00:00'""",
)
def ingested_raw(spark, sf_dir):
    return _ingest(spark, sf_dir, "raw")


@query(
    "feature_summary",
    f"""WITH {FEATURES_SQL},
written AS (
  SELECT * FROM features
  WHERE {REQUIRED_SQL} AND observed_at <= TIMESTAMP '2024-01-27 23:00:00')
SELECT (SELECT count(*) FROM raw_hourly) AS raw_rows,
       (SELECT count(*) FROM features) AS feature_rows_before_cleaning,
       count(*) AS feature_rows_written,
       (SELECT count(*) FROM features) - count(*) AS dropped_rows,
       false AS keep_incomplete_rows, '2024-01-27 23:00:00' AS max_observed_at,
       min(observed_at) AS first_observed_at, max(observed_at) AS last_observed_at,
       57 AS n_columns
FROM written""",
)
def summary(spark, sf_dir):
    raw, cutoff = raw_hourly(spark, sf_dir), default_cutoff("2024-01-28")
    written = feature_job(raw, SERIES, cutoff=cutoff)
    return (
        feature_summary(raw, written, cutoff=cutoff)
        .withColumn("n_columns", F.size("columns"))
        .drop("columns")
    )


@query(
    "backfill_export",
    f"WITH {_DENSE_SQL} SELECT series_id, {', '.join(ENRICHMENT_EXPORT_COLUMNS)} FROM dense",
)
def backfilled(spark, sf_dir):
    return backfill_job(
        daily_payloads(spark, sf_dir), enrichment_payloads(spark, sf_dir), SERIES, **_PERIOD
    )
