from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from conftest import hour
from pyspark.sql import functions as F

from tidewatch.operators import daily_sketches as D
from tidewatch.operators.drift import drift_baseline, psi_by_feature


@pytest.fixture(scope="module")
def rows(spark):
    base = spark.range(20_000).select(
        (F.lit(hour(0)) + F.make_dt_interval(hours=(F.col("id") % 480).cast("int"))).cast("timestamp_ntz").alias("observed_at"),
        F.randn(1).alias("a"), (F.rand(2) * 5 + F.col("id") % 480 / 100).alias("b"),
        F.when(F.col("id") % 3 > 0, F.rand(3)).alias("c"), F.lit(4.0).alias("d"), F.lit(None).cast("double").alias("e"),
    )
    return base.cache()


FEATURES = ["a", "b", "c", "d", "e"]


def test_ranks_are_near_the_exact_ones(spark, rows, tmp_path):
    D.store_days(D.sketch_days(rows, FEATURES), str(tmp_path))
    merged = D.merge_days(D.stored_days(spark, str(tmp_path)))
    values = rows.toPandas()
    found = {r.feature: r for r in D.sketched_baseline(merged).collect()}
    assert set(found) == {"a", "b", "c", "d"}
    for name in "abc":
        exact = np.sort(values[name].dropna().to_numpy())
        assert found[name].total == len(exact)
        assert abs(sum(found[name].counts) - len(exact)) <= len(found[name].counts)
        ranks = np.searchsorted(exact, found[name].edges[1:-1], side="right") / len(exact)
        assert np.abs(ranks - np.arange(1, 10) / 10).max() < 0.01
    assert found["d"].counts == [20_000]


def test_psi_is_near_the_exact_one(spark, rows, tmp_path):
    D.store_days(D.sketch_days(rows, FEATURES), str(tmp_path))
    split = dt.date(2026, 5, 11)
    early, late = (rows.where(F.to_date("observed_at") <= split), rows.where(F.to_date("observed_at") > split))
    exact = {r.feature: r.psi for r in psi_by_feature(drift_baseline(early, FEATURES), late, FEATURES).collect()}
    baseline = D.sketched_baseline(D.merge_days(D.stored_days(spark, str(tmp_path), last=split)))
    current = D.merge_days(D.stored_days(spark, str(tmp_path), first=split + dt.timedelta(days=1)))
    for r in D.sketched_psi(baseline, current).collect():
        assert r.psi == pytest.approx(exact[r.feature], abs=0.02 + 0.3 * exact[r.feature])
    assert exact["b"] > 0.2


def test_a_day_sent_again_is_replaced_alone(spark, rows, tmp_path):
    D.store_days(D.sketch_days(rows, FEATURES), str(tmp_path))
    later = rows.select((F.col("observed_at") + F.expr("INTERVAL 60 DAYS")).alias("observed_at"), *FEATURES)
    D.store_days(D.sketch_days(later, FEATURES), str(tmp_path))

    def files():
        return {p.parent.name: p.name for p in tmp_path.glob(f"{D.MONTH}=*/*.parquet")}

    before = files()
    assert set(before) == {"month=2026-05-01", "month=2026-06-01", "month=2026-07-01"}
    day = dt.date(2026, 5, 4)
    D.store_days(D.sketch_days(rows.where(F.to_date("observed_at") == day).limit(10), FEATURES), str(tmp_path))
    assert {d for d, name in files().items() if before[d] != name} == {"month=2026-05-01"}
    counts = {(r.day, r.feature): r.n for r in D.stored_days(spark, str(tmp_path)).collect()}
    assert counts[day, "a"] == 10 and len({d for d, _ in counts}) == 40
    assert sum(n for (d, f), n in counts.items() if f == "a" and d != day) == 40_000 - 1008
    window = D.stored_days(spark, str(tmp_path), dt.date(2026, 5, 3), dt.date(2026, 5, 5))
    assert {r.day.day for r in window.collect()} == {3, 4, 5}
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_no_days(spark, rows):
    none = D.sketch_days(rows.limit(0), FEATURES)
    assert D.sketched_baseline(D.merge_days(none)).collect() == []
