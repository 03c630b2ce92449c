from __future__ import annotations

import random

import pytest
from conftest import hour
from pyspark.sql import functions as F

from tidewatch.operators.prefix import running_totals, value_bucket, with_row_index
from tidewatch.operators.sizing import at_most, broadcast_if_small


def test_row_index_counts_each_series_in_time_order(spark):
    rng = random.Random(3)
    rows = [(s, hour(h)) for s in "ab" for h in rng.sample(range(24 * 400), 300)]
    df = spark.createDataFrame(rows, "series_id string, observed_at timestamp_ntz")
    got = with_row_index(df, ["series_id"], count="n").collect()
    for s in "ab":
        mine = sorted((r.observed_at, r.row_index, r.n) for r in got if r.series_id == s)
        assert [m[1] for m in mine] == list(range(300))
        assert {m[2] for m in mine} == {300}


def test_row_index_before_the_epoch(spark):
    rows = [(hour(h, "1969-11-01"),) for h in range(0, 24 * 120, 7)]
    df = spark.createDataFrame(rows, "observed_at timestamp_ntz")
    got = with_row_index(df, []).orderBy("observed_at").collect()
    assert [r.row_index for r in got] == list(range(len(rows)))


@pytest.mark.parametrize("task_rows", [10_000, 37])
def test_row_index_over_any_order_with_a_hot_time(spark, task_rows):
    rng = random.Random(9)
    rows = [("a" if rng.random() < 0.7 else "b", 5 if rng.random() < 0.4 else rng.randint(0, 99), i)
            for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t int, i int")
    got = with_row_index(df, ["k"], ["t", "i"], count="n", task_rows=task_rows).collect()
    for k in "ab":
        mine = sorted((r.t, r.i, r.row_index) for r in got if r.k == k)
        assert [m[2] for m in mine] == list(range(len(mine)))
        assert {r.n for r in got if r.k == k} == {len(mine)}


@pytest.mark.parametrize("task_rows", [10_000, 40, 3])
def test_running_totals_are_exact_for_any_bucket_size(spark, task_rows):
    rng = random.Random(5)
    # One value holds a third of all rows.
    raw = [(rng.choice("xy"), 1.5 if rng.random() < 0.34 else round(rng.uniform(-3, 3), 1))
           for _ in range(600)]
    source = spark.createDataFrame(raw, "k string, v double")
    merged = source.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    cut = value_bucket(merged, "v", source, ["k"], task_rows=task_rows)
    got = running_totals(cut, ["k"], ["v"], {"below": F.col("n")}, totals={"below": "all"})
    for row in got.collect():
        assert row.below == sum(k == row.k and v < row.v for k, v in raw)
        assert row["all"] == sum(k == row.k for k, _ in raw)


def test_broadcast_only_below_the_proven_size(spark):
    df = spark.range(10)
    assert at_most(df, 10) and not at_most(df, 9)

    def hinted(d):
        return "broadcast" in d._jdf.queryExecution().logical().toString().lower()

    assert hinted(broadcast_if_small(df, 10))
    assert not hinted(broadcast_if_small(df, 9))


def test_rows_without_key_or_time_stay_at_every_size(spark):
    from tidewatch.operators.prefix import with_row_index

    rows = [("a", 3), ("a", 1), (None, 2), (None, 5), ("b", None), (None, None)]
    df = spark.createDataFrame(rows, "series string, place long")
    small = with_row_index(df, ["series"], ["place"])
    cut = with_row_index(df, ["series"], ["place"], task_rows=2)
    assert sorted(map(str, small.collect())) == sorted(map(str, cut.collect()))
    assert small.count() == 6
