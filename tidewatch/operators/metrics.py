"""Classification metrics as aggregations.

Everything label-based derives from the confusion cells, at most one row per
pair of classes, so rows are reduced in the map phase whatever the class skew.
``by`` names optional grouping columns (fold, iteration, split).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.prefix import running_totals, value_bucket
from tidewatch.schemas import ACCEPTANCE_THRESHOLD, METRIC_BATCH_SIZE
from tidewatch.session import materialize

# Smallest probability that log loss tells from zero for double scores.
PROBABILITY_FLOOR = 2.220446049250313e-16


def confusion_cells(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", by: list[str] | None = None
) -> DataFrame:
    """Non-empty cells: ``actual``, ``predicted``, ``n``."""
    return df.groupBy(
        *(by or []), F.col(actual).alias("actual"), F.col(predicted).alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(
    cells: DataFrame, classes: DataFrame, by: list[str] | None = None
) -> DataFrame:
    """Dense matrix in long form: every pair of ``classes.label``, zero filled.

    The grid grows with the class list only: each class row carries the list.
    """
    by = by or []
    listed = classes.select("label").groupBy().agg(F.sort_array(F.collect_set("label")).alias("l"))
    groups = cells.select(*by, F.lit(True).alias("__any")).distinct() if by else None
    grid = listed.select(F.explode("l").alias("actual"), "l").select(
        "actual", F.explode("l").alias("predicted")
    )
    if groups is not None:
        lists = grid.groupBy().agg(F.collect_list(F.struct("actual", "predicted")).alias("g"))
        grid = groups.withColumn("g", lists.scalar()).select(*by, F.inline("g"))
    return grid.join(cells, [*by, "actual", "predicted"], "left").select(
        *by, "actual", "predicted", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def class_scores(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1, support and predicted count per class that occurs."""
    by = by or []
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(
            F.col("actual").alias("label"),
            F.col("n").alias("support"),
            F.lit(0).cast("bigint").alias("predicted_rows"),
            hit.cast("bigint").alias("hits"),
        ),
        F.struct(
            F.col("predicted").alias("label"),
            F.lit(0).cast("bigint").alias("support"),
            F.col("n").alias("predicted_rows"),
            F.lit(0).cast("bigint").alias("hits"),
        ),
    )
    counts = (
        cells.select(*by, F.inline(sides))
        .groupBy(*by, "label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted_rows", "hits")])
    )
    return with_scores(counts)


def with_scores(counts: DataFrame) -> DataFrame:
    """Scores from counts; 0 wherever a ratio has no denominator."""
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("hits", "predicted_rows"), zero)
    recall = F.coalesce(F.try_divide("hits", "support"), zero)
    f1 = F.coalesce(
        F.try_divide(F.col("hits") * 2, F.col("support") + F.col("predicted_rows")), zero
    )
    return counts.withColumns({"precision": precision, "recall": recall, "f1_score": f1})


def label_metrics(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy, balanced accuracy, weighted and macro scores, one row per group.

    Balanced accuracy averages over classes that occur in ``actual``, macro
    scores over classes that occur on either side.
    """
    return class_scores(cells, by).groupBy(*(by or [])).agg(*_label_aggregates())


def _label_aggregates() -> list[Column]:
    support = F.col("support")
    total = F.sum("support")
    return [
        total.alias("rows"),
        (F.sum("hits") / total).alias("accuracy"),
        F.avg(F.when(support > 0, F.col("recall"))).alias("balanced_accuracy"),
        (F.sum(support * F.col("precision")) / total).alias("precision_weighted"),
        F.avg("recall").alias("recall_macro"),
        (F.sum(support * F.col("recall")) / total).alias("recall_weighted"),
        F.avg("f1_score").alias("f1_macro"),
        (F.sum(support * F.col("f1_score")) / total).alias("f1_weighted"),
    ]


def classification_report(cells: DataFrame, classes: DataFrame) -> DataFrame:
    """Per-class rows over all of ``classes`` plus accuracy, macro and weighted rows."""
    scores = ["precision", "recall", "f1_score"]
    per_class = with_scores(
        classes.select("label")
        .join(
            class_scores(cells).select("label", "support", "predicted_rows", "hits"),
            "label",
            "left",
        )
        .select(
            F.col("label").cast("string").alias("label"),
            *[
                F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                for c in ("support", "predicted_rows", "hits")
            ],
        )
    )
    total = F.sum("support")
    summary = per_class.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("label"),
                F.lit(None).cast("double").alias("precision"),
                F.lit(None).cast("double").alias("recall"),
                (F.sum("hits") / total).alias("f1_score"),
                total.alias("support"),
            ),
            F.struct(
                F.lit("macro avg").alias("label"),
                *[F.avg(c).alias(c) for c in scores],
                total.alias("support"),
            ),
            F.struct(
                F.lit("weighted avg").alias("label"),
                *[(F.sum(F.col(c) * F.col("support")) / total).alias(c) for c in scores],
                total.alias("support"),
            ),
        ).alias("rows")
    ).select(F.inline("rows"))
    return per_class.select("label", *scores, "support").unionByName(summary)


def class_distribution(df: DataFrame, classes: DataFrame, column: str) -> DataFrame:
    """Rows per class of ``classes``, zero for absent ones."""
    counts = df.groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return classes.select("label").join(counts, "label", "left").select(
        "label", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def log_loss(
    df: DataFrame,
    probability: str = "probability",
    by: list[str] | None = None,
    *,
    floor: float = PROBABILITY_FLOOR,
    class_count: int | None = None,
) -> DataFrame:
    """Mean of -ln(p) over one row per observation, p of its actual class.

    NULL with fewer than two known classes.
    """
    clipped = F.least(F.greatest(F.col(probability), F.lit(floor)), F.lit(1 - floor))
    loss = F.avg(-F.log(clipped))
    if class_count is not None and class_count < 2:
        loss = F.lit(None).cast("double")
    return df.groupBy(*(by or [])).agg(loss.alias("log_loss"))


def score_steps(
    scores: DataFrame,
    by: list[str] | None = None,
    *,
    label: str = "label",
    actual: str = "actual",
    score: str = "score",
    most: int | None = None,
) -> DataFrame:
    """Per class and distinct score: positives, negatives, and those scored lower.

    ``scores`` has one row per observation and class. Equal scores are merged
    first; what is left is ordered in value ranges, so a class is never sorted
    in one task. NULL classes or scores are not allowed. ``most`` is an upper bound
    of the observations per group, if known.
    """
    keys = [*(by or []), "label"]
    rows = scores.select(
        *(by or []),
        F.col(label).alias("label"),
        F.col(score).cast("double").alias("score"),
        (F.col(actual) == F.col(label)).alias("hit"),
    )
    counted = rows.select(
        *keys, "score", F.col("hit").cast("bigint").alias("pos"), (~F.col("hit")).cast("bigint").alias("neg")
    )
    return merged_steps(counted, by, most=most)


def merged_steps(
    counts: DataFrame, by: list[str] | None = None, *, most: int | None = None
) -> DataFrame:
    """:func:`score_steps` of counts ``pos`` and ``neg`` of label and score, in part merged."""
    keys = [*(by or []), "label"]
    merged = counts.groupBy(*keys, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return running_totals(
        value_bucket(merged, "score", counts, keys, most),
        keys,
        ["score"],
        {"pos_below": F.col("pos"), "neg_below": F.col("neg")},
        totals={"pos_below": "pos_total", "neg_below": "neg_total"},
    )


def roc_auc_ovr(
    steps: DataFrame, by: list[str] | None = None, *, two_class_null: bool = True
) -> DataFrame:
    """One-vs-rest ROC AUC, weighted by class support, over classes that occur.

    Ties count half. NULL with fewer than two present classes; with exactly two
    the binarised target has a single column and the usual call has no result,
    so that is NULL as well unless ``two_class_null`` is off.
    """
    by = by or []
    wins = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2))
    per_class = (
        steps.where("pos_total > 0")
        .groupBy(*by, "label", "pos_total", "neg_total")
        .agg(wins.alias("wins"))
        .withColumn(
            "auc", F.try_divide(F.col("wins"), F.col("pos_total") * F.col("neg_total").cast("double"))
        )
    )
    needed = 3 if two_class_null else 2
    weighted = F.sum(F.col("auc") * F.col("pos_total")) / F.sum("pos_total")
    return per_class.groupBy(*by).agg(
        F.when(F.count(F.lit(1)) >= needed, weighted).alias("roc_auc_ovr_weighted")
    )


def probability_metrics(
    steps: DataFrame,
    by: list[str] | None = None,
    *,
    floor: float = PROBABILITY_FLOOR,
    two_class_null: bool = True,
) -> DataFrame:
    """ROC AUC and log loss together from the merged score steps.

    Each observation is a positive exactly once, at the score of its own class,
    so the loss is a sum over the positives.
    """
    by = by or []
    clipped = F.least(F.greatest(F.col("score"), F.lit(floor)), F.lit(1 - floor))
    loss = (F.sum(-F.log(clipped) * F.col("pos")) / F.sum("pos")).alias("log_loss")
    return side_by_side(
        [roc_auc_ovr(steps, by, two_class_null=two_class_null), steps.groupBy(*by).agg(loss)], by
    )


def roc_points(steps: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Curve points per present class: one per distinct score, and the origin.

    Classes without positives or without negatives have no curve, so a group with
    a single present class has none at all.
    """
    by = by or []
    keys = [*by, "label"]
    usable = steps.where("pos_total > 0 AND neg_total > 0")
    return usable.select(
        *keys,
        F.col("score").alias("threshold"),
        ((F.col("neg_total") - F.col("neg_below")) / F.col("neg_total")).alias("fpr"),
        ((F.col("pos_total") - F.col("pos_below")) / F.col("pos_total")).alias("tpr"),
    ).unionByName(
        usable.select(
            *keys,
            F.lit(None).cast("double").alias("threshold"),
            F.lit(0.0).alias("fpr"),
            F.lit(0.0).alias("tpr"),
        ).distinct()
    )


def roc_corners(steps: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The points of :func:`roc_points` where the curve turns, and its two ends.

    A point lies on a straight line if the step to it and the step after it are
    parallel. The step after a score is that of the next lower one, whose observations
    end where this score's begin, so neighbours meet in an equi-join on that count:
    no task sees a class in order, and nothing is carried over the border of a bucket.
    """
    by = by or []
    keys = [*by, "label"]
    placed = steps.where("pos_total > 0 AND neg_total > 0").withColumn(
        "__from", F.col("pos_below") + F.col("neg_below")
    )
    lower = placed.select(
        *keys, (F.col("__from") + F.col("pos") + F.col("neg")).alias("__from"),
        F.col("pos").alias("__pos"), F.col("neg").alias("__neg"),
    )

    def product(a: str, b: str) -> Column:
        return F.col(a).cast("decimal(19,0)") * F.col(b).cast("decimal(19,0)")

    turns = F.col("__pos").isNull() | (product("pos", "__neg") != product("neg", "__pos"))
    kept = placed.join(lower, [*keys, "__from"], "left").where(turns)
    return roc_points(kept.select(*steps.columns), by)


def argmax_label(probabilities: Column, labels: Column) -> tuple[Column, Column]:
    """Label of the highest probability (first on ties) and that probability."""
    top = F.array_max(probabilities)
    return F.element_at(labels, F.array_position(probabilities, top).cast("int")), top


def acceptance(metrics: DataFrame, threshold: float = ACCEPTANCE_THRESHOLD) -> DataFrame:
    return metrics.withColumns(
        {
            "accepted": F.col("f1_macro") >= F.lit(threshold),
            "acceptance_metric": F.lit("f1_macro"),
            "acceptance_threshold": F.lit(threshold),
        }
    )


def fold_means(folds: DataFrame, names: list[str]) -> DataFrame:
    """Mean of each metric over folds; NULLs skipped, NULL if all are."""
    return folds.agg(*[F.avg(name).alias(name) for name in names])


def long_metrics(
    table: DataFrame, step: str, names: list[str], prefix: Column | str
) -> DataFrame:
    """Long form ``(key, step, value)``; missing values are left out."""
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return (
        table.withColumn("__prefix", prefix)
        .unpivot([step, "__prefix"], names, "metric", "value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .select(
            F.concat("__prefix", F.lit("_"), F.col("metric")).alias("key"),
            F.col(step).cast("int").alias("step"),
            F.col("value").cast("double").alias("value"),
        )
    )


def history_and_fold_metrics(
    history: DataFrame, folds: DataFrame, history_names: list[str], fold_names: list[str]
) -> DataFrame:
    return long_metrics(history, "iteration", history_names, F.col("split")).unionByName(
        long_metrics(folds, "fold", fold_names, "cv_validation")
    )


def batch_numbers(df: DataFrame, index: str, size: int = METRIC_BATCH_SIZE) -> DataFrame:
    """Number the batches of ``size`` rows along a row position, from 0."""
    return df.withColumn("batch", F.floor(F.col(index) / size))


def side_by_side(frames: list[DataFrame], by: list[str] | None = None) -> DataFrame:
    """Put one-row-per-group results next to each other.

    Without groups every frame is one row, read as a scalar subquery.
    """
    first, *rest = frames
    if by:
        return reduce(lambda a, b: a.join(b, by, "left"), rest, first)
    named = {
        f"__{i}": f.select(F.struct("*").alias("row")).scalar() for i, f in enumerate(rest)
    }
    return first.withColumns(named).select(*first.columns, *[f"{name}.*" for name in named])


def long_scores(
    scored: DataFrame, by: list[str] | None = None, labels: str = "labels", shares: str = "shares"
) -> DataFrame:
    """One row per observation and class from aligned label and score arrays."""
    pairs = F.arrays_zip(F.col(labels).alias("label"), F.col(shares).alias("score"))
    return scored.select(*(by or []), "actual", F.inline(pairs).alias("label", "score"))


def evaluate(
    scored: DataFrame, by: list[str] | None = None, most: int | None = None
) -> DataFrame:
    """All summary metrics per group of ``actual, predicted, labels, shares`` rows."""
    cells = confusion_cells(scored, by=by)
    steps = score_steps(long_scores(scored, by), by, most=most)
    return side_by_side([label_metrics(cells, by), probability_metrics(steps, by)], by)


def metrics_document(
    predictions: DataFrame,
    scores: DataFrame,
    classes: DataFrame,
    parameters: dict[str, object] | None = None,
    *,
    time: str = "observed_at",
    threshold: float = ACCEPTANCE_THRESHOLD,
) -> DataFrame:
    """The full evaluation of one holdout as a single row.

    ``predictions`` has ``actual``, ``predicted`` and a time; ``scores`` has one row
    per observation and class (``label``, ``actual``, ``score``). Predictions are
    read once: the confusion cells are written as a small table that everything
    label-based uses.
    """
    cells = materialize(
        predictions.groupBy("actual", "predicted").agg(
            F.count(F.lit(1)).alias("n"),
            F.min(time).alias("test_start"),
            F.max(time).alias("test_end"),
        ),
        "cells",
    )
    observations = cells.agg(F.sum("n")).first()[0]
    bounds = cells.agg(F.min("test_start").alias("test_start"), F.max("test_end").alias("test_end"))
    cells = cells.select("actual", "predicted", "n")
    entry = F.struct("label", "n")

    def distribution(column: str) -> DataFrame:
        counts = cells.groupBy(F.col(column).alias("label")).agg(F.sum("n").alias("n"))
        return (
            classes.select("label")
            .join(counts, "label", "left")
            .select("label", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))
            .agg(
                F.map_from_entries(F.sort_array(F.collect_list(entry))).alias(
                    f"{column}_class_distribution"
                )
            )
        )

    report = classification_report(cells, classes).agg(
        F.sort_array(
            F.collect_list(F.struct("label", "precision", "recall", "f1_score", "support"))
        ).alias("classification_report")
    )
    matrix = (
        confusion_matrix(cells, classes)
        .groupBy("actual")
        .agg(F.sort_array(F.collect_list(F.struct("predicted", "n")))["n"].alias("row"))
        .agg(F.sort_array(F.collect_list(F.struct("actual", "row")))["row"].alias("confusion_matrix"))
    )
    document = acceptance(
        side_by_side(
            [
                label_metrics(cells).withColumnRenamed("rows", "rows_test"),
                probability_metrics(score_steps(scores, most=observations)),
                bounds,
                distribution("actual"),
                distribution("predicted"),
                report,
                matrix,
            ]
        ),
        threshold,
    )
    return document.withColumns({k: F.lit(v) for k, v in (parameters or {}).items()})
