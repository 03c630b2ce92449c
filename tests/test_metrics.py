from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import hour
from pyspark.sql import functions as F

from tidewatch.operators import metrics as M
from tidewatch.schemas import HISTORY_METRICS, SUMMARY_METRICS

CLASSES = ["a", "b", "c", "d"]


def brute_labels(pairs):
    """Label metrics from their definitions."""
    seen = sorted({x for pair in pairs for x in pair})
    n = len(pairs)
    per = {}
    for c in seen:
        hits = sum(a == p == c for a, p in pairs)
        support = sum(a == c for a, _ in pairs)
        said = sum(p == c for _, p in pairs)
        precision = hits / said if said else 0.0
        recall = hits / support if support else 0.0
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        per[c] = (precision, recall, f1, support)
    present = [v for v in per.values() if v[3]]
    return {
        "accuracy": sum(a == p for a, p in pairs) / n,
        "balanced_accuracy": sum(v[1] for v in present) / len(present),
        "precision_weighted": sum(v[0] * v[3] for v in per.values()) / n,
        "recall_macro": sum(v[1] for v in per.values()) / len(per),
        "recall_weighted": sum(v[1] * v[3] for v in per.values()) / n,
        "f1_macro": sum(v[2] for v in per.values()) / len(per),
        "f1_weighted": sum(v[2] * v[3] for v in per.values()) / n,
    }


def pair_auc(positive, negative):
    wins = sum((p > q) + (p == q) / 2 for p in positive for q in negative)
    return wins / (len(positive) * len(negative))


def scored_rows(seed, actual_classes=CLASSES[:3], n=60):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        raw = [rng.choice([1, 1, 2, 3, 5]) for _ in CLASSES]
        shares = [x / sum(raw) for x in raw]
        best = CLASSES[shares.index(max(shares))]
        rows.append((i, hour(i), rng.choice(actual_classes), best, CLASSES, shares))
    return rows


SCORED = (
    "i int, observed_at timestamp_ntz, actual string, predicted string, "
    "labels array<string>, shares array<double>"
)


@pytest.mark.parametrize("seed", range(3))
def test_all_metrics_match_brute_force(spark, seed):
    rows = scored_rows(seed)
    got = M.evaluate(spark.createDataFrame(rows, SCORED)).first()
    for name, value in brute_labels([(r[2], r[3]) for r in rows]).items():
        assert math.isclose(got[name], value), name
    loss = sum(-math.log(r[5][CLASSES.index(r[2])]) for r in rows) / len(rows)
    assert math.isclose(got.log_loss, loss)
    auc = support = 0
    for k, c in enumerate(CLASSES):
        positive = [r[5][k] for r in rows if r[2] == c]
        negative = [r[5][k] for r in rows if r[2] != c]
        if positive:
            auc += pair_auc(positive, negative) * len(positive)
            support += len(positive)
    assert math.isclose(got.roc_auc_ovr_weighted, auc / support)


def test_groups_are_measured_apart(spark):
    rows = scored_rows(1)
    df = spark.createDataFrame(rows, SCORED).withColumn("fold", F.col("i") % 2)
    got = {r.fold: r for r in M.evaluate(df, ["fold"]).collect()}
    for fold in (0, 1):
        want = brute_labels([(r[2], r[3]) for r in rows if r[0] % 2 == fold])
        assert all(math.isclose(got[fold][k], v) for k, v in want.items())
        own = M.evaluate(df.where(F.col("fold") == fold)).first()
        assert math.isclose(own.roc_auc_ovr_weighted, got[fold].roc_auc_ovr_weighted)
        assert math.isclose(own.log_loss, got[fold].log_loss)


@pytest.mark.parametrize("present,defined", [(["a"], False), (["a", "b"], False),
                                             (["a", "b", "c"], True)])
def test_auc_needs_three_present_classes(spark, present, defined):
    df = spark.createDataFrame(scored_rows(2, present), SCORED)
    steps = M.score_steps(M.long_scores(df))
    value = M.roc_auc_ovr(steps).first()[0]
    assert (value is not None) == defined
    if present == ["a", "b"]:
        assert M.roc_auc_ovr(steps, two_class_null=False).first()[0] is not None
    if present == ["a"]:
        assert M.roc_points(steps).count() == 0


def test_auc_is_the_same_in_value_ranges(spark, monkeypatch):
    from tidewatch.operators import prefix

    df = spark.createDataFrame(scored_rows(4), SCORED)
    whole = M.roc_auc_ovr(M.score_steps(M.long_scores(df))).first()[0]
    real = prefix.value_bucket
    monkeypatch.setattr(M, "value_bucket", lambda *a: real(*a[:4], task_rows=5))
    cut = M.score_steps(M.long_scores(df))
    assert math.isclose(whole, M.roc_auc_ovr(cut).first()[0])


def test_curve_ends_in_both_corners(spark):
    df = spark.createDataFrame(scored_rows(3), SCORED)
    points = M.roc_points(M.score_steps(M.long_scores(df))).collect()
    for c in ("a", "b", "c"):
        mine = sorted((p.fpr, p.tpr) for p in points if p.label == c)
        assert mine[0] == (0.0, 0.0) and mine[-1] == (1.0, 1.0)
    assert not any(p.label == "d" for p in points)


def test_report_covers_classes_that_never_occur(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "actual string, predicted string")
    classes = spark.createDataFrame([(c,) for c in CLASSES], "label string")
    report = {r.label: r for r in M.classification_report(M.confusion_cells(df), classes).collect()}
    assert report["d"].support == 0 and report["d"].f1_score == 0.0
    assert math.isclose(report["accuracy"].f1_score, 2 / 3)
    assert math.isclose(report["macro avg"].recall, (0.5 + 1.0) / 4)
    assert math.isclose(report["weighted avg"].precision, (1.0 * 2 + 0.5) / 3)
    matrix = M.confusion_matrix(M.confusion_cells(df), classes).collect()
    assert len(matrix) == 16 and sum(r.n for r in matrix) == 3
    counts = {r.label: r.n for r in M.class_distribution(df, classes, "predicted").collect()}
    assert counts == {"a": 1, "b": 2, "c": 0, "d": 0}


def test_grouped_matrix_is_dense_in_each_group(spark):
    df = spark.createDataFrame([(1, "a", "a"), (2, "a", "b")], "fold int, actual string, predicted string")
    classes = spark.createDataFrame([("a",), ("b",)], "label string")
    matrix = M.confusion_matrix(M.confusion_cells(df, by=["fold"]), classes, ["fold"]).collect()
    assert sorted((r.fold, r.actual, r.predicted, r.n) for r in matrix) == [
        (1, "a", "a", 1), (1, "a", "b", 0), (1, "b", "a", 0), (1, "b", "b", 0),
        (2, "a", "a", 0), (2, "a", "b", 1), (2, "b", "a", 0), (2, "b", "b", 0),
    ]


def test_log_loss_clips_and_needs_two_classes(spark):
    df = spark.createDataFrame([(0.0,), (1.0,)], "probability double")
    value = M.log_loss(df, floor=1e-15).first()[0]
    assert math.isclose(value, -math.log(1e-15) / 2, rel_tol=1e-6)
    assert M.log_loss(df, class_count=1).first()[0] is None


def test_first_class_wins_ties(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2], ["x", "y", "z"])], "s array<double>, l array<string>")
    label, top = M.argmax_label(F.col("s"), F.col("l"))
    assert tuple(df.select(label, top).first()) == ("x", 0.4)


def history(spark, n):
    rows = [
        (i + 1, "train" if i % 2 == 0 else "test", 0.9, 0.8, 0.7, 0.65, 0.75, 0.85, 0.2)
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows, "iteration int, split string, " + ", ".join(f"{m} double" for m in HISTORY_METRICS)
    )


def test_long_metrics_skip_missing_values(spark):
    table = history(spark, 2)
    table = table.withColumn(
        "roc_auc_ovr_weighted",
        F.when(F.col("iteration") == 1, float("nan")).otherwise(F.col("roc_auc_ovr_weighted")),
    ).withColumn("log_loss", F.when(F.col("iteration") == 1, F.col("log_loss")))
    rows = M.long_metrics(table, "iteration", HISTORY_METRICS, F.col("split")).collect()
    keys = {(r.key, r.step) for r in rows}
    assert len(rows) == 12
    assert {("train_accuracy", 1), ("test_f1_macro", 2), ("test_f1_weighted", 2)} <= keys
    assert ("train_roc_auc_ovr_weighted", 1) not in keys and ("test_log_loss", 2) not in keys


def test_metric_batches_hold_500_rows(spark):
    from tidewatch.operators.prefix import with_row_index

    rows = M.long_metrics(history(spark, 200), "iteration", HISTORY_METRICS, F.col("split"))
    indexed = with_row_index(rows, [], ["step", "key"], task_rows=300)
    sizes = M.batch_numbers(indexed, "row_index").groupBy("batch").count().orderBy("batch")
    assert [r["count"] for r in sizes.collect()] == [500, 500, 400]


def test_fold_means_skip_nulls(spark):
    folds = spark.createDataFrame([(1, 0.5, None), (2, 1.0, None)], "fold int, accuracy double, log_loss double")
    assert tuple(M.fold_means(folds, ["accuracy", "log_loss"]).first()) == (0.75, None)


def test_document_holds_every_part(spark):
    df = spark.createDataFrame(scored_rows(5), SCORED)
    classes = spark.createDataFrame([(c,) for c in CLASSES], "label string")
    row = M.metrics_document(df, M.long_scores(df), classes, {"target_column": "t"}).first()
    assert row.rows_test == 60 and row.target_column == "t"
    assert row.test_start == hour(0) and row.test_end == hour(59)
    assert all(row[name] is not None for name in SUMMARY_METRICS)
    assert row.accepted == (row.f1_macro >= 0.4)
    assert sum(row.actual_class_distribution.values()) == 60
    assert row.actual_class_distribution["d"] == 0
    assert np.array(row.confusion_matrix).shape == (4, 4)
    assert len(row.classification_report) == 7


def test_roc_corners_are_the_turns_of_the_curve(spark):
    import random

    maker = random.Random(8)
    rows = [(maker.choice("abc"), maker.randrange(40) / 40) for _ in range(300)]
    rows += [("a", 2.0 + i) for i in range(20)] + [("b", 30.0 + i) for i in range(20)]
    scores = [(actual, label, score) for actual, score in rows for label in "abc"]
    df = spark.createDataFrame(scores, "actual string, label string, score double")
    steps = M.score_steps(df)
    got = {}
    for r in M.roc_corners(steps).collect():
        got.setdefault(r.label, []).append((r.fpr, r.tpr))
    for label in "abc":
        points = sorted((r.fpr, r.tpr) for r in M.roc_points(steps).where(f"label = '{label}'").collect())
        kept = points[:1]
        for before, at, after in zip(points, points[1:], points[2:]):
            cross = (at[0] - before[0]) * (after[1] - at[1]) - (at[1] - before[1]) * (after[0] - at[0])
            if abs(cross) > 1e-12:
                kept.append(at)
        kept.append(points[-1])
        assert sorted(got[label]) == kept and len(kept) < len(points)
