from __future__ import annotations

import math

import pytest
from conftest import hour
from pyspark.sql import functions as F

from tidewatch.operators.contracts import ContractError, check_training_contract
from tidewatch.operators.filters import (
    default_cutoff,
    profile_rows,
    trailing_window,
    training_rows,
    until,
)
from tidewatch.operators.splits import (
    check_holdout,
    class_weights,
    encode_labels,
    expanding_folds,
    holdout_split,
    label_index,
    training_part,
)
from tidewatch.plans.scaling import window_scaler


def series(spark, n=240, name="a", start="2026-01-01"):
    return spark.createDataFrame(
        [(name, hour(h, start)) for h in range(n)], "series_id string, observed_at timestamp_ntz"
    )


def test_holdout_leaves_an_exact_gap(spark):
    split = holdout_split(series(spark)).collect()
    by = {s: [r.row_index for r in split if r.split == s] for s in ("train", "gap", "test")}
    assert (len(by["train"]), len(by["gap"]), len(by["test"])) == (168, 24, 48)
    assert min(by["test"]) - max(by["train"]) - 1 == 24


def test_folds_expand_behind_a_gap(spark):
    train = training_part(holdout_split(series(spark)))
    rows = expanding_folds(train).collect()
    for fold, start, end in ((1, 42, 18), (2, 84, 60), (3, 126, 102)):
        part = [r for r in rows if r.fold == fold]
        validation = sorted(r.row_index for r in part if r.role == "validation")
        assert validation == list(range(start, start + 42))
        assert sorted(r.row_index for r in part if r.role == "train") == list(range(end))


def test_every_series_is_split_on_its_own(spark):
    both = series(spark, 240).unionByName(series(spark, 300, "b"))
    sizes = {
        (r.series_id, r.split): r["count"]
        for r in holdout_split(both, ["series_id"]).groupBy("series_id", "split").count().collect()
    }
    assert sizes["a", "train"] == 168 and sizes["b", "train"] == 216
    assert sizes["a", "test"] == 48 and sizes["b", "test"] == 60


@pytest.mark.parametrize("n", [5, 24, 100, 121])
def test_split_sizes_truncate(spark, n):
    counts = {r.split: r["count"] for r in holdout_split(series(spark, n)).groupBy("split").count().collect()}
    start = int(n * (1 - 0.2))
    assert counts.get("test", 0) == n - start
    assert counts.get("train", 0) == max(start - 24, 0)


def test_bad_split_arguments(spark):
    df = series(spark, 30)
    for fraction in (0, 1, -1):
        with pytest.raises(ContractError):
            holdout_split(df, test_fraction=fraction)
    with pytest.raises(ContractError, match="too few"):
        check_holdout(holdout_split(df))
    with pytest.raises(ContractError):
        check_holdout(holdout_split(df), cv_splits=1)
    with pytest.raises(ContractError):
        expanding_folds(df, folds=1)
    check_holdout(holdout_split(series(spark)))


def test_class_weights_and_their_power(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate("aaab")], "i int, c string")
    for power in (1.0, 0.5, 0.0):
        got = [r.class_weight for r in class_weights(df, "c", power).orderBy("i").collect()]
        want = [(2 / 3) ** power] * 3 + [2.0**power]
        assert all(math.isclose(a, b) for a, b in zip(got, want))
    with pytest.raises(ContractError):
        class_weights(df, "c", -1)


def test_labels_are_indexed_alphabetically(spark):
    df = spark.createDataFrame([(c,) for c in ["rain", "clear", "fog", "clear"]], "c string")
    index = label_index(df, "c")
    assert {r.label: r.label_index for r in index.collect()} == {"clear": 0, "fog": 1, "rain": 2}
    assert sorted(r.label_index for r in encode_labels(df, index, "c").collect()) == [0, 0, 1, 2]


def test_training_contract():
    check_training_contract(["temp_lag_1h"])
    with pytest.raises(ContractError, match="weather_code"):
        check_training_contract(["temp_lag_1h", "weather_code"])
    with pytest.raises(ContractError):
        check_training_contract(["temp_lag_1h"], "target_rain_24h")


def test_training_rows_are_complete_and_typed(spark):
    df = spark.createDataFrame(
        [(hour(0), 1.0, True, 3.0, "rain"), (hour(1), None, False, 1.0, "rain"),
         (hour(2), 1.0, False, 1.0, None)],
        "observed_at timestamp_ntz, x double, is_weekend boolean, "
        "weather_condition_lag_4h_code double, target_weather_condition_24h string",
    )
    got = training_rows(df, ["x", "is_weekend", "weather_condition_lag_4h_code"]).collect()
    assert [(r.is_weekend, r.weather_condition_lag_4h_code) for r in got] == [(1, 3)]
    with pytest.raises(ContractError, match="cape"):
        training_rows(df, ["cape"])


def test_cutoff_and_profile_are_inclusive(spark):
    df = series(spark, 49, start="2021-03-22")
    assert default_cutoff("2026-05-22") == "2026-05-21 23:00:00" and default_cutoff(None) is None
    assert until(df, "2021-03-22 05:00:00").count() == 6
    assert until(df, None).count() == 49
    assert profile_rows(df).count() == 25
    text = df.select(F.col("observed_at").cast("string").alias("observed_at")).unionByName(
        spark.createDataFrame([("broken",)], "observed_at string")
    )
    assert profile_rows(text).count() == 25


def test_trailing_window_per_series_and_overall(spark):
    both = series(spark, 100).unionByName(series(spark, 30, "b"))
    assert trailing_window(both, 1).count() == 25
    per_series = trailing_window(both, 1, ["series_id"]).groupBy("series_id").count()
    assert {r.series_id: r["count"] for r in per_series.collect()} == {"a": 25, "b": 25}
    assert trailing_window(both.limit(0), 1).count() == 0


def test_scaler_counts_rows_once_per_training_window(spark):
    n, length, fraction = 40, 5, 0.25
    xs = [1000 + (h * 7 % 11) / 8 for h in range(n)]
    df = spark.createDataFrame([(hour(h), x, 4.0) for h, x in enumerate(xs)],
                               "observed_at timestamp_ntz, x double, c double")
    windows = [xs[t - length : t] for t in range(length, n)]
    train = [v for w in windows[: int(len(windows) * (1 - fraction))] for v in w]
    mean = sum(train) / len(train)
    std = math.sqrt(sum((v - mean) ** 2 for v in train) / len(train))
    got = {r.feature: r for r in window_scaler(df, [], ["x", "c"], length=length,
                                               test_fraction=fraction).collect()}
    assert math.isclose(got["x"].mean, mean) and math.isclose(got["x"].scale, std, rel_tol=1e-9)
    assert got["c"].scale == 1.0 and got["c"].mean == 4.0
