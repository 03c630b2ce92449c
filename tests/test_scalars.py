from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import scalars as S
from tidewatch.schemas import CONDITION_LABELS


def values(spark, rows, schema, column):
    df = spark.createDataFrame(rows, schema)
    return [row[0] for row in df.select(column(F.col(schema.split()[0]))).collect()]


def test_number_or_null_refuses_what_is_not_a_number(spark):
    text = ["1.5", " 2 ", "n/a", "", "NaN", "1d", "2.5f", None, "-3e2", "Infinity"]
    got = values(spark, [(t,) for t in text], "t string", S.number_or_null)
    assert got == [1.5, 2.0, None, None, None, None, None, None, -300.0, float("inf")]


def test_codes_round_half_to_even(spark):
    got = values(spark, [(0.5,), (1.5,), (2.5,), (-0.5,), (None,)], "x double", S.round_half_even)
    assert got == [0, 2, 2, 0, None]


def test_condition_of_code(spark):
    codes = [(0.0,), (2.5,), (4.0,), (61.4,), (99.0,), (None,)]
    got = values(spark, codes, "x double", S.condition_of)
    assert got == ["clear", "cloudy", None, "rain", "thunderstorm", None]


def test_condition_ordinal_is_list_position(spark):
    got = values(
        spark, [(c,) for c in [*CONDITION_LABELS, "unknown"]], "c string", S.condition_ordinal
    )
    assert got == [*range(9), None]


def test_timestamps_lose_their_zone_after_conversion(spark):
    got = values(
        spark,
        [("2026-05-01 00:00:00+00:00",), ("2026-05-01T02:00:00+02:00",), ("2026-05-01 00:00:00",)],
        "t string",
        S.utc_timestamp,
    )
    assert got == [dt.datetime(2026, 5, 1)] * 3


def test_unreadable_timestamp_is_an_error_or_null(spark):
    df = spark.createDataFrame([("yesterday",)], "t string")
    assert df.select(S.utc_timestamp_or_null(F.col("t"))).first()[0] is None
    with pytest.raises(Exception, match="CAST|PARSE|parse"):
        df.select(S.utc_timestamp(F.col("t"))).collect()


def test_hour_key_counts_from_one(spark):
    rows = [("2010-01-01 00:00:00",), ("2010-01-01 01:30:00",), ("2010-01-02 00:00:00",)]
    got = values(spark, rows, "t string", lambda c: S.hour_key(c.cast("timestamp_ntz")))
    assert got == [1, 3, 25]


def test_calendar_starts_the_week_on_monday(spark):
    ts = spark.createDataFrame([("2026-05-02 13:00:00",)], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("t")
    )
    row = ts.select(*[c.alias(n) for n, c in S.calendar_columns(F.col("t")).items()]).first()
    assert row.asDict() == {
        "hour_of_day": 13,
        "day_of_week": 5,
        "month": 5,
        "day_of_year": 122,
        "is_weekend": True,
    }


def test_json_record_keeps_nulls(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), dt.datetime(2026, 1, 1, 5), None)],
        "id int, x double, at timestamp_ntz, note string",
    )
    assert json.loads(S.json_record(df).first()[0]) == {
        "id": 1,
        "x": None,
        "at": "2026-01-01T05:00:00",
        "note": None,
    }


def test_stamp_puts_constants_in_front(spark):
    df = S.stamp(spark.range(1), source="a", latitude=41.0)
    assert df.columns == ["source", "latitude", "id"]


def test_optional_number_is_a_typed_null(spark):
    df = spark.range(1)
    assert df.select(S.optional_number(df, "cape").alias("c")).dtypes == [("c", "double")]


def test_listed_columns_become_numbers(spark):
    df = spark.createDataFrame([("7", float("nan"), True, 2)], "a string, b double, c boolean, d int")
    got = S.coerce_numbers(df, ["a", "b", "c", "d"])
    assert {kind for _, kind in got.dtypes} == {"double"}
    assert tuple(got.first()) == (7.0, None, 1.0, 2.0)
