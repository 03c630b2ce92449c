from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import hour
from pyspark.sql import functions as F

from tidewatch.operators.contracts import ContractError
from tidewatch.operators.joins import assert_unique, join_daily, join_enrichment
from tidewatch.schemas import (
    DAILY_VARIABLES,
    ENRICHMENT_PAYLOAD_SCHEMA,
    FEATURE_SCHEMA,
    HOURLY_VARIABLES,
    PAYLOAD_SCHEMA,
    RAW_SCHEMA,
)
from tidewatch.sinks.files import write_csv, write_snapshot
from tidewatch.sources.files import create_table, first_rows, last_rows, read_csv, read_ordered
from tidewatch.sources.payload import archive_hourly, clamp_range, enrichment_hourly

START, END = 1_767_225_600, 1_767_232_800


def payload(spark):
    row = {
        "series_id": "a",
        "latitude": 41.0,
        "longitude": 29.0,
        "elevation": 32.0,
        "utc_offset_seconds": 0,
        "hourly_start": START,
        "hourly_end": END,
        "hourly_interval": 3600,
        "daily_start": START,
        "daily_end": START + 86_400,
        "daily_interval": 86_400,
        "temperature_2m_max": [9.5],
        "temperature_2m_min": [2.5],
    } | {name: [float(i), float(i)] for i, name in enumerate(HOURLY_VARIABLES)}
    return spark.createDataFrame([row], PAYLOAD_SCHEMA)


def test_payload_rows_carry_the_extremes_of_their_day(spark):
    rows = archive_hourly(payload(spark), ["series_id"]).orderBy("observed_at").collect()
    assert [r.observed_at for r in rows] == [hour(0, "2026-01-01"), hour(1, "2026-01-01")]
    assert [r.temperature_2m_max for r in rows] == [9.5, 9.5]
    assert [r.temperature_2m_min for r in rows] == [2.5, 2.5]
    assert [r.cloud_cover_low for r in rows] == [9.0, 9.0]


def test_payload_with_an_empty_grid_has_no_rows(spark):
    empty = payload(spark).withColumn("hourly_end", F.col("hourly_start"))
    assert archive_hourly(empty, ["series_id"]).count() == 0


def feed(spark):
    row = ("a", START, END, 3600, [12.0, float("nan")], [1250.0, float("nan")], [1.4, None])
    return spark.createDataFrame([row], ENRICHMENT_PAYLOAD_SCHEMA)


def test_missing_feed_values_stay_aligned_and_null(spark):
    rows = enrichment_hourly(feed(spark), [], "2026-01-01", "2026-01-01").orderBy("observed_at")
    assert [tuple(r) for r in rows.collect()] == [
        (hour(0, "2026-01-01"), 12.0, 1250.0, 1.4),
        (hour(1, "2026-01-01"), None, None, None),
    ]


def test_range_before_the_minimum_is_empty_but_typed(spark):
    rows = enrichment_hourly(feed(spark), [], "2015-01-01", "2015-12-31")
    assert rows.count() == 0
    assert rows.columns == ["observed_at", "cape", "freezing_level_height", "uv_index"]


def test_range_is_clamped_and_includes_its_last_day(spark):
    times = [("2015-12-31 23:00:00",), ("2016-01-01 00:00:00",), ("2016-01-02 23:30:00",),
             ("2016-01-03 00:00:00",)]
    rows = spark.createDataFrame(times, "t string").select(
        F.col("t").cast("timestamp_ntz").alias("observed_at")
    )
    assert clamp_range(rows, "2010-01-01", "2016-01-02").count() == 2


def test_join_enrichment_leaves_other_hours_null(spark):
    raw = spark.createDataFrame([(hour(0), 0), (hour(1), 61)], "observed_at timestamp_ntz, code int")
    context = spark.createDataFrame(
        [(hour(1), 30.0, 920.0, 2.5)],
        "observed_at timestamp_ntz, cape double, freezing_level_height double, uv_index double",
    )
    rows = join_enrichment(raw, context, [], validate=True).orderBy("observed_at").collect()
    assert rows[0].cape is None and rows[0].uv_index is None
    assert tuple(rows[1])[2:] == (30.0, 920.0, 2.5)


def test_joins_refuse_duplicate_keys(spark):
    twice = spark.createDataFrame([(hour(0), 1.0), (hour(0), 2.0)], "observed_at timestamp_ntz, cape double")
    with pytest.raises(ContractError, match="not unique"):
        join_enrichment(twice, twice, [], columns=["cape"], validate=True)
    daily = spark.createDataFrame([(dt.date(2026, 5, 1), 1.0, 2.0)] * 2,
                                  "obs_date date, temperature_2m_max double, temperature_2m_min double")
    with pytest.raises(ContractError):
        join_daily(twice.drop("cape"), daily, [], validate=True)
    assert assert_unique(daily.distinct(), ["obs_date"]).count() == 1


def test_csv_round_trip_keeps_values(spark, tmp_path):
    rows = [(1, 'quoted "text", comma', None, dt.datetime(2026, 1, 1, 1, 2, 3, 4)),
            (2, "", 0.1, dt.datetime(2026, 1, 1))]
    schema = "id long, t string, x double, at timestamp_ntz"
    df = spark.createDataFrame(rows, schema)
    write_csv(df, str(tmp_path / "csv"))
    back = read_csv(spark, str(tmp_path / "csv"), df.schema).orderBy("id").collect()
    assert [tuple(r) for r in back][0] == rows[0]
    assert back[1].x == 0.1 and back[1].at == rows[1][3]


def test_snapshot_writes_run_and_latest(spark, tmp_path):
    now = dt.datetime(2026, 5, 1, 2, 3, 4, tzinfo=dt.UTC)
    paths = write_snapshot(spark.range(3), str(tmp_path), now)
    assert paths["run"].endswith("run=1777600984")
    for path in paths.values():
        assert spark.read.option("header", True).csv(path).count() == 3
    write_snapshot(spark.range(2), str(tmp_path), now + dt.timedelta(hours=1))
    assert sorted(os.listdir(tmp_path)) == [
        "latest", "run=1777600984", "run=1777604584"
    ]
    assert spark.read.option("header", True).csv(paths["latest"]).count() == 2


def test_ordered_reads(spark):
    df = spark.range(100).select((F.lit(99) - F.col("id")).alias("k"))
    assert [r.k for r in read_ordered(df, ["k"], 3).collect()] == [0, 1, 2]
    assert [r.k for r in read_ordered(df, ["k"]).collect()] == list(range(100))
    assert [r.k for r in first_rows(df, ["k"], 2).collect()] == [0, 1]
    assert sorted(r.k for r in last_rows(df, ["k"], 2).collect()) == [98, 99]


def test_capped_read_needs_no_full_sort(spark):
    df = spark.range(1000)
    plan = read_ordered(df, ["id"], 10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_tables_have_the_declared_columns(spark):
    for name, schema, size in (("raw_hours", RAW_SCHEMA, 24), ("feature_hours", FEATURE_SCHEMA, 56)):
        assert len(schema) == size
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        create_table(spark, name, schema)
        create_table(spark, name, schema)
        assert spark.table(name).columns == [*schema.names, "observed_date"]
        spark.sql(f"DROP TABLE {name}")
    assert RAW_SCHEMA.names[18:20] == DAILY_VARIABLES
