from __future__ import annotations

import os

import numpy as np
import pytest
from conftest import hour
from pyspark.sql import functions as F

from tidewatch.operators.contracts import ContractError
from tidewatch.operators.metrics import confusion_cells, label_metrics
from tidewatch.operators.registry import stored_aliases
from tidewatch.plans.jobs import Registry, backfill_job, ingest_job, retrain_job, tracked_metrics, train_job
from tidewatch.plans.classifiers import Fitted
from tidewatch.plans.profiles import BoostedParams, ForestParams, SequenceParams
from tidewatch.plans.softmax_trees import SoftmaxTrees, checkpoints
from tidewatch.plans.training import train_boosted, train_enriched, train_forest, train_sequence
from tidewatch.schemas import (
    BASE_MODEL_FEATURES,
    ENRICHED_MODEL_FEATURES,
    ENRICHMENT_PAYLOAD_SCHEMA,
    HISTORY_METRICS,
    HOURLY_VARIABLES,
    PAYLOAD_SCHEMA,
    SUMMARY_METRICS,
    TARGET_COLUMN,
)
from tidewatch.session import materialize
from tidewatch.sinks.upsert import read_table

BOOSTED = BoostedParams(trees=2, max_depth=2)
FOREST = ForestParams(trees=3, max_depth=3)


def training_frame(spark, n=240, start="2026-01-01", features=BASE_MODEL_FEATURES):
    """Label cycles through three classes; one input reveals it in part."""
    base = spark.range(n).select(F.col("id"), (F.col("id") / n).alias("x"))
    known = {
        "is_weekend": F.lit(False),
        "weather_condition_lag_4h_code": F.lit(0),
        "weather_condition_lag_12h_code": F.lit(0),
        "hour_of_day": (F.col("id") % 3).cast("int"),
    }
    return materialize(
        base.select(
            (F.lit(hour(0, start)) + F.make_dt_interval(hours=F.col("id").cast("int")))
            .cast("timestamp_ntz")
            .alias("observed_at"),
            *[known.get(f, F.col("x")).alias(f) for f in features],
            F.element_at(
                F.array(F.lit("clear"), F.lit("rain"), F.lit("cloudy")),
                (F.col("id") % 3 + 1).cast("int"),
            ).alias(TARGET_COLUMN),
        ),
        "training-input",
    )


@pytest.fixture(scope="module")
def boosted(spark):
    return train_boosted(training_frame(spark), [], BOOSTED)


def test_boosted_run_leaves_every_part(spark, boosted, tmp_path):
    row = boosted.metrics.first()
    assert (row.rows_train, row.rows_test, row.rows_total) == (168, 48, 216)
    assert row.feature_columns.split(",") == BASE_MODEL_FEATURES
    assert row.cv_mean_metrics.f1_weighted is not None
    assert row.train_end < row.test_start
    importance = boosted.importance.collect()
    assert {r.feature for r in importance} == set(BASE_MODEL_FEATURES)
    values = [r.importance for r in importance]
    assert values == sorted(values, reverse=True)
    folds = boosted.folds.collect()
    assert [(r.fold, r.rows_train, r.rows_validation) for r in folds] == [
        (1, 18, 42), (2, 60, 42), (3, 102, 42)
    ]
    assert boosted.baseline.count() == len(BASE_MODEL_FEATURES)
    boosted.write(str(tmp_path / "run"))
    assert {"metrics", "test_predictions", "metrics_history", "time_series_cv_metrics",
            "feature_importance", "feature_distribution_baseline", "model"} <= set(
        os.listdir(tmp_path / "run")
    )


def test_predictions_follow_the_scoring_contract(boosted):
    for row in boosted.predictions.collect():
        assert abs(sum(row.shares) - 1) < 1e-9
        assert row.confidence == max(row.shares)
        assert row.predicted == row.labels[row.shares.index(row.confidence)]
        assert row.labels == ["clear", "cloudy", "rain"]


def test_metrics_come_from_the_predictions(boosted):
    own = label_metrics(confusion_cells(boosted.predictions)).first()
    row = boosted.metrics.first()
    for name in ("accuracy", "balanced_accuracy", "f1_macro", "precision_weighted"):
        assert row[name] == pytest.approx(own[name])
    assert row.accepted == (row.f1_macro >= 0.4)


def test_training_is_repeatable(spark, boosted):
    again = train_boosted(
        training_frame(spark), [], BOOSTED, with_folds=False, with_history=False
    )

    def shares(result):
        return [r.shares for r in result.predictions.orderBy("observed_at").collect()]

    np.testing.assert_allclose(shares(boosted), shares(again))


def test_history_ends_at_the_final_model(boosted):
    last = boosted.history.where("iteration = 2 AND split = 'test'").first()
    row = boosted.metrics.first()
    for name in HISTORY_METRICS:
        assert last[name] == pytest.approx(row[name]), name
    assert boosted.history.count() == 4


def test_run_metrics_in_long_form(boosted):
    rows = tracked_metrics(boosted).collect()
    keys = {(r.key, r.step) for r in rows}
    assert ("cv_validation_f1_macro", 3) in keys and ("train_accuracy", 1) in keys
    assert len(rows) <= 4 * len(HISTORY_METRICS) + 3 * len(SUMMARY_METRICS)


def test_a_stored_model_scores_alike(spark, boosted, tmp_path):
    boosted.model.save(spark, str(tmp_path / "model"))
    again = Fitted.load(spark, str(tmp_path / "model"))
    assert isinstance(again.model, SoftmaxTrees) and again.inputs == boosted.model.inputs
    rows = training_frame(spark, 30).drop(TARGET_COLUMN)
    one, two = (m.score(rows).select("observed_at", "predicted", "shares").orderBy("observed_at").collect()
                for m in (boosted.model, again))
    assert one == two


def test_scoring_needs_no_label(spark, boosted):
    rows = training_frame(spark, 5).drop(TARGET_COLUMN)
    scored = boosted.model.score(rows)
    assert "actual" not in scored.columns
    assert scored.select("predicted", "confidence").count() == 5


def test_checkpoints():
    assert checkpoints(3) == [1, 2, 3]
    assert checkpoints(500)[:2] == [5, 10] and len(checkpoints(500)) == 100
    assert checkpoints(250)[:3] == [3, 5, 8] and checkpoints(250)[-1] == 250
    assert len(checkpoints(305)) == 100 and checkpoints(305)[-2:] == [302, 305]


def test_forest_history_ends_at_its_own_metrics(spark):
    result = train_forest(training_frame(spark), [], FOREST, with_folds=False)
    assert result.baseline is None
    assert result.history.count() == 6
    last = result.history.where("iteration = 3 AND split = 'test'").first()
    row = result.metrics.first()
    for name in HISTORY_METRICS:
        assert last[name] == pytest.approx(row[name]), name


def test_one_class_holdout_has_no_auc(spark):
    frame = training_frame(spark).withColumn(
        TARGET_COLUMN,
        F.when(F.col("observed_at") >= F.lit(hour(192, "2026-01-01")), "clear").otherwise(
            F.col(TARGET_COLUMN)
        ),
    )
    result = train_forest(frame, [], FOREST, with_folds=False, with_history=False)
    row = result.metrics.first()
    assert row.roc_auc_ovr_weighted is None and row.log_loss is not None
    assert row.actual_class_distribution == {"clear": 48, "cloudy": 0, "rain": 0}


def test_enriched_profile_starts_late_and_uses_the_feed(spark):
    frame = training_frame(spark, 360, "2021-03-20", ENRICHED_MODEL_FEATURES)
    result = train_enriched(frame, [], BOOSTED, with_folds=False, with_history=False)
    assert {"cape", "uv_index"} <= {r.feature for r in result.importance.collect()}
    row = result.metrics.first()
    assert row.train_start >= hour(0, "2021-03-23") and row.rows_total + 24 == 288
    with pytest.raises(ContractError, match="2021-03-23"):
        train_enriched(training_frame(spark, 10, "2020-01-01", ENRICHED_MODEL_FEATURES), [])


def test_sequence_profile(spark):
    frame = training_frame(spark, 180, "2021-03-23", ENRICHED_MODEL_FEATURES)
    params = SequenceParams(length=4, hidden=4, epochs=2)
    result = train_sequence(frame, [], params)
    row = result.metrics.first()
    assert row.rows_train + row.rows_test == 176 and row.rows_train == int(176 * 0.8)
    history = result.history.collect()
    assert [(r.iteration, r.split) for r in history] == [
        (1, "test"), (1, "train"), (2, "test"), (2, "train")
    ]
    assert all(r.roc_auc_ovr_weighted is None and r.log_loss is not None for r in history)
    assert result.folds is None and result.importance is None
    last = next(r for r in history if (r.iteration, r.split) == (2, "test"))
    assert last.accuracy == pytest.approx(row.accuracy)
    with pytest.raises(ContractError):
        train_sequence(frame.limit(3), [], params)


def test_row_caps_take_the_right_end(spark):
    frame = training_frame(spark)
    first = train_job(frame, [], "forest", FOREST, max_rows=200, with_folds=False,
                      with_history=False).metrics.first()
    assert first.train_start == hour(0, "2026-01-01")
    late = training_frame(spark, 360, "2021-03-20", ENRICHED_MODEL_FEATURES)
    last = train_job(late, [], "enriched", BOOSTED, max_rows=200, with_folds=False,
                     with_history=False).metrics.first()
    assert last.train_start == hour(160, "2021-03-20")


def test_too_few_rows_and_leaks_are_refused(spark):
    with pytest.raises(ContractError, match="too few"):
        train_forest(training_frame(spark, 40), [], FOREST)
    with pytest.raises(ContractError, match="empty"):
        train_forest(training_frame(spark, 40).limit(0), [], FOREST)


def payloads(spark, hours=120):
    start = 1_767_225_600
    end = start + hours * 3600
    days = hours // 24
    grid = {name: [float((h * (i + 3)) % 17) for h in range(hours)]
            for i, name in enumerate(HOURLY_VARIABLES)}
    grid["weather_code"] = [float([0, 61, 3][h % 3]) for h in range(hours)]
    row = {
        "series_id": "s", "latitude": 41.0, "longitude": 29.0, "elevation": 32.0,
        "utc_offset_seconds": 0, "hourly_start": start, "hourly_end": end,
        "hourly_interval": 3600, "daily_start": start, "daily_end": end,
        "daily_interval": 86_400, "temperature_2m_max": [20.0 + d for d in range(days)],
        "temperature_2m_min": [1.0 + d for d in range(days)],
    } | grid
    feed = ("s", start, end, 3600, [1.0] * hours, [2.0] * hours, [float("nan")] * hours)
    return (
        spark.createDataFrame([row], PAYLOAD_SCHEMA),
        spark.createDataFrame([feed], ENRICHMENT_PAYLOAD_SCHEMA),
    )


def test_ingest_stores_raw_and_feature_rows(spark, tmp_path):
    archive, feed = payloads(spark)
    keys = ["series_id"]
    options = dict(start_date="2026-01-01", end_date="2026-01-05",
                   raw_path=str(tmp_path / "raw"), feature_path=str(tmp_path / "features"))
    for _ in range(2):
        done = ingest_job(spark, archive, feed, keys, **options)
        raw, features = (read_table(spark, options[k]) for k in ("raw_path", "feature_path"))
        assert (done.raw_rows, raw.count()) == (96, 96)
        assert done.feature_rows == features.count() == 72
    row = features.where("observed_at = TIMESTAMP_NTZ '2026-01-04 23:00:00'").first()
    assert row[TARGET_COLUMN] == "cloudy" and row.cape == 1.0 and row.uv_index is None
    assert row.temperature_2m_max_lag_1d == 22.0
    assert raw.where("weather_condition = 'rain'").count() == 32


def test_overlapping_deliveries_keep_the_last(spark, tmp_path):
    archive, feed = payloads(spark)
    later = archive.withColumns({
        "temperature_2m": F.transform("temperature_2m", lambda x: x + 100),
        "temperature_2m_max": F.transform("temperature_2m_max", lambda x: x + 100),
    })
    archives = archive.withColumn("n", F.lit(1)).unionByName(later.withColumn("n", F.lit(2)))
    feeds = feed.withColumn("n", F.lit(1)).unionByName(
        feed.withColumn("n", F.lit(2)).withColumn("cape", F.transform("cape", lambda x: x + 7))
    )
    options = dict(start_date="2026-01-01", end_date="2026-01-05",
                   raw_path=str(tmp_path / "raw"), feature_path=str(tmp_path / "features"))
    done = ingest_job(spark, archives, feeds, ["series_id"], sequence="n", **options)
    assert (done.raw_rows, done.feature_rows) == (96, 72)
    rows = read_table(spark, options["feature_path"]).collect()
    assert all(r.temperature_2m >= 100 and r.temperature_2m_max >= 120 for r in rows)
    assert {r.cape for r in rows} == {8.0}
    with pytest.raises(ContractError, match="not unique"):
        ingest_job(spark, archives.drop("n"), feed, ["series_id"], **options)


def test_backfill_exports_in_order(spark, tmp_path):
    archive, feed = payloads(spark, 48)
    export = backfill_job(archive, feed, [], start_date="2026-01-01", end_date="2026-01-01",
                          path=str(tmp_path / "export"))
    assert export.columns[0] == "observed_at" and export.columns[-1] == "uv_index"
    assert export.count() == 48
    assert export.where("cape IS NOT NULL").count() == 24


def registry(spark, baseline=None, metric=0.01):
    kind = ("array<struct<feature:string,edges:array<double>,counts:array<bigint>,"
            "total:bigint,status:string>>")
    live = [] if baseline is None else [("m", "production", "1")]
    return Registry(
        spark.createDataFrame([("m", "1", "r1"), ("m", "12", "r12")],
                              "model_name string, version string, run_id string"),
        spark.createDataFrame(live, "model_name string, alias string, version string"),
        spark.createDataFrame([("r1", "f1_macro", metric)], "run_id string, metric string, value double"),
        spark.createDataFrame([("r1", baseline)], f"run_id string, baseline {kind}"),
    )


def test_retraining_reports_drift_and_promotes(spark, tmp_path):
    frame = training_frame(spark, 360, "2021-03-20", ENRICHED_MODEL_FEATURES)
    options = dict(model_name="m", params=BOOSTED, with_folds=False, with_history=False)
    first = retrain_job(frame, [], registry(spark), window_days=2, path=str(tmp_path),
                        alias_path=str(tmp_path / "aliases"), **options)
    assert first.drift.first().status == "no_baseline" and first.drift_features is None
    decision = first.decision.first()
    assert decision.candidate_version == "12"
    if decision.should_promote:
        assert [tuple(r) for r in first.aliases.collect()] == [("m", "production", "12")]
        stored = stored_aliases(spark, str(tmp_path / "aliases")).collect()
        assert [tuple(r) for r in stored] == [("m", "production", "12")]
    document = spark.read.json(str(tmp_path / "drift_report")).first()
    assert document.status == "no_baseline" and document.features == []
    assert (document.thresholds.warning, document.current_window_days) == (0.1, 2)
    header = spark.read.json(str(tmp_path / "training" / "feature_distribution_baseline")).first()
    assert (header.bins, header.feature_count) == (10, len(ENRICHED_MODEL_FEATURES))
    assert header.row_count == first.training.metrics.first().rows_train == 206
    assert {"drift_report", "promotion_decision", "training"} <= set(os.listdir(tmp_path))

    baseline = [tuple(r) for r in first.training.baseline.collect()]
    second = retrain_job(frame, [], registry(spark, baseline, 0.9), window_days=2, promote=False,
                         path=str(tmp_path / "second"), **options)
    document = spark.read.json(str(tmp_path / "second" / "drift_report")).first()
    assert [f.feature for f in document.features] == sorted(ENRICHED_MODEL_FEATURES)
    assert document.production_model.asDict() == {
        "name": "m", "version": "1", "alias": "production", "run_id": "r1"
    }
    assert document.summary.current_row_count == 49
    report = second.drift.first()
    assert report.status == "stable" and report.current_row_count == 49
    # Values beyond the baseline are outside all bins, so they do not move the index.
    row = second.drift_features.where("feature = 'cape'").first()
    assert (row.current_total, row.current_out_of_range) == (0, 49)
    assert second.decision.first().should_promote is False
    assert [r.version for r in second.aliases.collect()] == ["1"]
