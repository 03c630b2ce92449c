from __future__ import annotations

import pytest

from tidewatch.operators import registry as R
from tidewatch.sinks.upsert import merge_replace

CANDIDATE = "model_name string, candidate_version string, candidate_metric double, accepted boolean"
SNAPSHOT = (
    "model_name string, alias string, version string, run_id string, "
    "metrics map<string,double>, baseline string"
)


def decide(spark, candidate, live=None):
    snapshot = [] if live is None else [("m", "production", "3", "r3", live, None)]
    return R.promotion_decision(
        spark.createDataFrame([("m", *candidate)], CANDIDATE),
        spark.createDataFrame(snapshot, SNAPSHOT),
    )


@pytest.mark.parametrize(
    "candidate,live,reason,promoted,live_metric",
    [
        ((None, 0.6, True), {"f1_macro": 0.5}, "missing_candidate_version", False, None),
        (("4", None, True), {"f1_macro": 0.5}, "missing_candidate_metric", False, None),
        (("4", 0.6, False), None, "candidate_not_accepted", False, None),
        (("4", 0.6, None), None, "candidate_not_accepted", False, None),
        (("4", 0.6, True), None, "bootstrap_no_production_alias", True, None),
        (("4", 0.6, True), {"accuracy": 0.5}, "missing_production_metric", False, None),
        (("4", 0.52, True), {"f1_macro": 0.5}, "metric_improved", True, 0.5),
        (("4", 0.519, True), {"f1_macro": 0.5}, "insufficient_improvement", False, 0.5),
    ],
)
def test_first_rule_that_applies_decides(spark, candidate, live, reason, promoted, live_metric):
    row = decide(spark, candidate, live).first()
    assert (row.reason, row.should_promote, row.production_metric) == (reason, promoted, live_metric)
    assert row.production_version == (None if live is None else "3")
    assert row.promoted_alias == "production" and row.min_improvement == 0.02


def test_dry_run_moves_no_alias(spark):
    decision = decide(spark, ("4", 0.6, True))
    dry = R.as_dry_run(decision)
    assert dry.first().reason == "dry_run_bootstrap_no_production_alias"
    assert R.promoted_aliases(dry).count() == 0
    aliases = spark.createDataFrame(
        [("m", "production", "3"), ("n", "production", "1")],
        "model_name string, alias string, version string",
    )
    moved = merge_replace(aliases, R.promoted_aliases(decision), ["model_name", "alias"])
    assert {r.model_name: r.version for r in moved.collect()} == {"m": "4", "n": "1"}


def test_versions_compare_as_numbers(spark):
    versions = spark.createDataFrame(
        [("m", "1", "r1"), ("m", "12", "r12"), ("m", "9", "r9")],
        "model_name string, version string, run_id string",
    )
    assert R.latest_version(versions).first().version == "12"
    assert R.latest_version(versions.limit(0)).count() == 0


def test_snapshot_resolves_alias_run_and_baseline(spark):
    versions = spark.createDataFrame(
        [("m", "1", "r1"), ("m", "2", "r2"), ("n", "1", "r9")],
        "model_name string, version string, run_id string",
    )
    aliases = spark.createDataFrame(
        [("m", "production", "2"), ("n", "staging", "1")],
        "model_name string, alias string, version string",
    )
    metrics = spark.createDataFrame(
        [("r2", "f1_macro", 0.5), ("r2", "accuracy", 0.7)], "run_id string, metric string, value double"
    )
    baselines = spark.createDataFrame([("r1", "b1")], "run_id string, baseline string")
    (row,) = R.production_snapshot(aliases, versions, metrics, baselines).collect()
    assert (row.model_name, row.version, row.run_id, row.baseline) == ("m", "2", "r2", None)
    assert row.metrics == {"f1_macro": 0.5, "accuracy": 0.7}


def test_the_alias_log_keeps_the_last_change(spark, tmp_path):
    path, kind = str(tmp_path / "log"), "model_name string, alias string, version string"
    assert R.stored_aliases(spark, path).collect() == []
    assert R.record_aliases(spark, path, spark.createDataFrame([], kind)) == 0
    R.record_aliases(spark, path, spark.createDataFrame([("m", "production", "12"), ("n", "production", "1")], kind))
    R.record_aliases(spark, path, spark.createDataFrame([("m", "production", "9")], kind))
    found = sorted(map(tuple, R.stored_aliases(spark, path).collect()))
    assert found == [("m", "production", "9"), ("n", "production", "1")]
