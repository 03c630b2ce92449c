"""Queries for model fits.

All inputs, folds, depths and checkpoints are those of the profiles, and the sequence
profile runs with its defaults. Only the number of trees is smaller (TREES rounds, one
tree a class each); README lists measured times of more.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators.drift import drift_baseline
from tidewatch.operators.features import feature_frame
from tidewatch.plans.jobs import Registry, retrain_job, train_job
from tidewatch.plans.profiles import FOREST, BoostedParams, ForestParams, SequenceParams
from tidewatch.plans.training import train_sequence, train_trees
from tidewatch.schemas import ENRICHED_MODEL_FEATURES
from tidewatch.session import materialize
from tidewatch.workloads.inputs import SERIES, raw_hourly
from tidewatch.workloads.registry import query

TREES = 5
_BOOSTED = BoostedParams(trees=TREES)
_FOREST = ForestParams(trees=TREES)


def _features(spark, sf_dir):
    return materialize(feature_frame(raw_hourly(spark, sf_dir), SERIES), "features")


@query("train_boosted")
def boosted(spark, sf_dir):
    result = train_job(
        _features(spark, sf_dir), SERIES, "boosted", _BOOSTED, with_folds=False,
        with_history=False,
    )
    return result.predictions.drop("labels", "shares")


@query("train_forest")
def forest(spark, sf_dir):
    result = train_job(
        _features(spark, sf_dir), SERIES, "forest", _FOREST, with_folds=False,
        with_history=False,
    )
    return result.predictions.drop("labels", "shares")


@query("train_enriched")
def enriched(spark, sf_dir):
    result = train_job(
        _features(spark, sf_dir), SERIES, "enriched", _BOOSTED, with_folds=False,
        with_history=False,
    )
    return result.predictions.drop("labels", "shares")


@query("train_sequence")
def sequence(spark, sf_dir):
    result = train_sequence(_features(spark, sf_dir), SERIES, SequenceParams())
    return result.predictions.drop("labels", "shares")


@query("cv_metrics")
def folds(spark, sf_dir):
    return train_trees(
        _features(spark, sf_dir), SERIES, FOREST, _FOREST, with_history=False
    ).folds


@query("metrics_history")
def history(spark, sf_dir):
    return train_trees(
        _features(spark, sf_dir), SERIES, FOREST, _FOREST, with_folds=False
    ).history


@query("importance_rank")
def importance(spark, sf_dir):
    return train_trees(
        _features(spark, sf_dir), SERIES, FOREST, _FOREST, with_folds=False,
        with_history=False,
    ).importance


@query("retrain_decision")
def retrain(spark, sf_dir):
    """A full retraining run. One registered run per series; the live one has a
    baseline over the first weeks."""
    rows = _features(spark, sf_dir)
    name = F.lit("enriched-condition").alias("model_name")
    runs = rows.groupBy(F.col("series_id").alias("run_id")).agg(
        F.count(F.lit(1)).cast("string").alias("version"),
        (F.avg("cloud_cover") / 1000).alias("value"),
    )
    early = rows.where("observed_at < TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    baseline = drift_baseline(early, ENRICHED_MODEL_FEATURES).agg(
        F.collect_list(F.struct("feature", "edges", "counts", "total", "status"))
    )
    live = runs.agg(F.min_by(F.struct("run_id", "version"), "run_id").alias("live"))
    registry = Registry(
        versions=runs.select(name, "version", "run_id"),
        aliases=live.select(name, F.lit("production").alias("alias"), "live.version"),
        run_metrics=runs.select("run_id", F.lit("f1_macro").alias("metric"), "value"),
        baselines=live.select("live.run_id").withColumn("baseline", baseline.scalar()),
    )
    return retrain_job(
        rows,
        SERIES,
        registry,
        model_name="enriched-condition",
        params=_BOOSTED,
        with_folds=False,
        with_history=False,
    ).decision
