"""Training: time-ordered validation, final fit, evaluation and artifacts."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.contracts import ContractError, check_training_contract, require_rows
from tidewatch.operators.drift import baseline_document, drift_baseline
from tidewatch.operators.filters import profile_rows, training_rows
from tidewatch.operators.metrics import (
    confusion_cells,
    evaluate,
    fold_means,
    label_metrics,
    log_loss,
    long_scores,
    merged_steps,
    metrics_document,
    probability_metrics,
    side_by_side,
)
from tidewatch.operators.splits import (
    check_holdout,
    class_weights,
    expanding_folds,
    holdout_split,
    training_part,
)
from tidewatch.operators.windows import sequence_windows
from tidewatch.plans.classifiers import (
    Fitted,
    Inputs,
    feature_importance,
    fit_sequence,
    fit_trees,
    ordered_labels,
    sequence_vector,
)
from tidewatch.plans.profiles import (
    BOOSTED,
    ENRICHED,
    FOREST,
    SEQUENCE,
    BoostedParams,
    ForestParams,
    Profile,
    SequenceParams,
)
from tidewatch.plans.scaling import weighted_moments, window_weights
from tidewatch.plans.softmax_trees import checkpoints, feature_array, staged_counts
from tidewatch.schemas import HISTORY_METRICS, SUMMARY_METRICS, TARGET_COLUMN, VALIDATION_GAP_ROWS
from tidewatch.session import materialize
from tidewatch.sinks.files import write_csv, write_json_document


@dataclass(frozen=True)
class TrainingResult:
    """What a training run leaves behind. Absent parts are ``None``."""

    model: Fitted
    metrics: DataFrame
    predictions: DataFrame
    history: DataFrame | None = None
    folds: DataFrame | None = None
    importance: DataFrame | None = None
    baseline: DataFrame | None = None

    def write(self, path: str) -> None:
        """Write all parts below ``path``; ``Fitted.load`` reads the model back."""
        write_json_document(self.metrics, f"{path}/metrics")
        shown = ["actual", "predicted", "confidence"]
        keys = [c for c in self.predictions.columns if c not in ("labels", "shares", *shown)]
        write_csv(self.predictions.select(*keys, *shown), f"{path}/test_predictions")
        tables = {
            "metrics_history": self.history,
            "time_series_cv_metrics": self.folds,
            "feature_importance": self.importance,
        }
        for name, frame in tables.items():
            if frame is not None:
                write_csv(frame, f"{path}/{name}")
        if self.baseline is not None:
            rows = self.metrics.first()["rows_train"]
            document = baseline_document(self.baseline, rows)
            write_json_document(document, f"{path}/feature_distribution_baseline")
        self.model.save(self.metrics.sparkSession, f"{path}/model")


def eligible_rows(frame: DataFrame, profile: Profile) -> DataFrame:
    """Rows of the profile's period, with an error if there are none."""
    if profile.start is None:
        return require_rows(frame, "the feature table is empty")
    rows = profile_rows(frame, profile.start)
    return require_rows(rows, f"no rows on or after {profile.start}")


def train_boosted(frame: DataFrame, keys: list[str], params: BoostedParams | None = None,
                  **options) -> TrainingResult:
    return train_trees(frame, keys, BOOSTED, params or BoostedParams(), **options)


def train_forest(frame: DataFrame, keys: list[str], params: ForestParams | None = None,
                 **options) -> TrainingResult:
    return train_trees(frame, keys, FOREST, params or ForestParams(), **options)


def train_enriched(frame: DataFrame, keys: list[str], params: BoostedParams | None = None,
                   **options) -> TrainingResult:
    return train_trees(frame, keys, ENRICHED, params or BoostedParams(), **options)


def train_trees(
    frame: DataFrame,
    keys: list[str],
    profile: Profile,
    params: BoostedParams | ForestParams,
    *,
    test_fraction: float = 0.2,
    cv_splits: int = 3,
    target: str = TARGET_COLUMN,
    with_folds: bool = True,
    with_history: bool = True,
) -> TrainingResult:
    """Fit a tree profile on the training part of every series and judge it.

    The split rows are written once: each fit and each evaluation reads them from
    the shared folder instead of computing the windows again.
    """
    check_training_contract(profile.features, target)
    rows = training_rows(eligible_rows(frame, profile), profile.features, target)
    split = materialize(
        holdout_split(
            rows.select(*keys, "observed_at", *profile.features, target),
            keys,
            test_fraction=test_fraction,
        ),
        "split",
    )
    check_holdout(split, keys, cv_splits=cv_splits)
    used = split.where("split <> 'gap'")
    inputs = Inputs(profile.features, ordered_labels(used, target), target)
    train = training_part(split, keys, test_fraction=test_fraction)
    test = split.where("split = 'test'")

    model = _fit(train, keys, inputs, params)
    shown = [*keys, "observed_at", "actual", "predicted", "confidence", "labels", "shares"]
    predictions = materialize(model.score(test).select(*shown), "predictions")
    folds = _fold_metrics(train, keys, inputs, params, cv_splits) if with_folds else None
    return TrainingResult(
        model=model,
        metrics=_document(predictions, used, inputs, params, test_fraction, profile, folds),
        predictions=predictions,
        history=_tree_history(model, used, params.trees) if with_history else None,
        folds=folds,
        importance=feature_importance(model),
        baseline=drift_baseline(train, profile.features) if profile.writes_baseline else None,
    )


def _fit(train: DataFrame, keys: list[str], inputs: Inputs, params) -> Fitted:
    weighted = class_weights(train, inputs.target, params.class_weight_power)
    row_key = F.xxhash64(*keys, "observed_at").alias("row_key")
    columns = ["features", "label_index", "class_weight", row_key]
    return fit_trees(inputs.prepare(weighted).select(*columns), inputs, params)


def _fold_metrics(train, keys, inputs, params, cv_splits) -> DataFrame:
    """One fit per fold; the folds' scores are then measured together.

    The loop runs over the few folds, and each pass is a distributed fit.
    """
    assigned = expanding_folds(train, keys, folds=cv_splits)
    scored = None
    for fold in range(1, cv_splits + 1):
        rows = assigned.where(F.col("fold") == fold)
        model = _fit(rows.where("role = 'train'"), keys, inputs, params)
        part = model.score(rows.where("role = 'validation'")).select(
            "fold", "actual", "predicted", "labels", "shares"
        )
        scored = part if scored is None else scored.unionByName(part)
    measured = evaluate(materialize(scored, "folds"), ["fold"])

    def edge(bound, role, name):
        return bound(F.when(F.col("role") == role, F.col("observed_at"))).alias(name)

    bounds = assigned.groupBy("fold").agg(
        edge(F.min, "train", "train_start"),
        edge(F.max, "train", "train_end"),
        edge(F.min, "validation", "validation_start"),
        edge(F.max, "validation", "validation_end"),
        F.count_if(F.col("role") == "train").alias("rows_train"),
        F.count_if(F.col("role") == "validation").alias("rows_validation"),
        F.lit(VALIDATION_GAP_ROWS).alias("gap_hours"),
    )
    result = bounds.join(measured.drop("rows"), "fold")
    return materialize(
        result.select(*bounds.columns, *SUMMARY_METRICS), "fold-metrics"
    ).orderBy("fold")


def _tree_history(model: Fitted, used: DataFrame, total: int) -> DataFrame:
    """Metrics at every checkpoint. The scores of all ensemble sizes, a hundred times
    the rows, are reduced to counts as they are produced and never stored."""
    prepared = model.inputs.prepare(used)
    rows = prepared.select(
        "split", F.col(model.inputs.target).alias("actual"), feature_array(prepared).alias("x")
    )
    points, labels, by = checkpoints(total), model.inputs.labels, ["iteration", "split"]
    cells = staged_counts(model.model, rows, ["split"], labels, points, scores=False)
    cells = cells.groupBy(*by, "actual", "predicted").agg(F.sum("n").alias("n"))
    scores = staged_counts(model.model, rows, ["split"], labels, points, scores=True)
    steps = merged_steps(scores, by, most=used.count())
    measured = side_by_side([label_metrics(cells, by), probability_metrics(steps, by)], by)
    return materialize(measured.select(*by, *HISTORY_METRICS), "history").orderBy(*by)


def _document(predictions, used, inputs, params, test_fraction, profile, folds) -> DataFrame:
    classes = predictions.select(F.explode("labels").alias("label")).distinct()
    document = metrics_document(
        predictions,
        long_scores(predictions),
        classes,
        {
            "target_column": inputs.target,
            "test_fraction": test_fraction,
            "profile": profile.name,
            "parameters": str(asdict(params)),
            "feature_columns": ",".join(inputs.features),
            "validation_strategy": "time_series_split" if folds is not None else "temporal_holdout",
            "validation_gap_hours": VALIDATION_GAP_ROWS,
        },
        threshold=params.acceptance_threshold,
    )
    train = F.col("split") == "train"
    sizes = used.agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count_if(train).alias("rows_train"),
        F.min(F.when(train, F.col("observed_at"))).alias("train_start"),
        F.max(F.when(train, F.col("observed_at"))).alias("train_end"),
    )
    extra = {"__sizes": sizes.select(F.struct("*")).scalar()}
    if folds is not None:
        means = fold_means(folds, SUMMARY_METRICS)
        extra["cv_mean_metrics"] = means.select(F.struct("*")).scalar()
    return (
        document.withColumns(extra)
        .select("*", "__sizes.*")
        .drop("__sizes")
    )


def _epoch_history(scored: DataFrame, by: list[str]) -> DataFrame:
    """Label metrics and log loss; a sequence history reports no ROC AUC."""
    own = F.element_at("shares", F.array_position("labels", F.col("actual")).cast("int"))
    losses = log_loss(scored.select(*by, own.alias("probability")), by=by)
    measured = side_by_side([label_metrics(confusion_cells(scored, by=by), by), losses], by)
    return measured.withColumn("roc_auc_ovr_weighted", F.lit(None).cast("double")).select(
        *by, *HISTORY_METRICS
    )


def train_sequence(
    frame: DataFrame,
    keys: list[str],
    params: SequenceParams | None = None,
    *,
    test_fraction: float = 0.2,
    target: str = TARGET_COLUMN,
    profile: Profile = SEQUENCE,
) -> TrainingResult:
    """Fit the sequence network on the windows of each series.

    Windows are split in time order without a gap. The network scales its inputs with
    moments of the training windows. Training goes epoch by epoch, and every epoch is
    measured.
    """
    params = params or SequenceParams()
    check_training_contract(profile.features, target)
    rows = training_rows(eligible_rows(frame, profile), profile.features, target).select(
        *keys, "observed_at", *profile.features, target
    )
    weighted = materialize(
        window_weights(rows, keys, length=params.length, test_fraction=test_fraction), "rows"
    )
    if weighted.where("weight > 0").isEmpty():
        raise ContractError("too few rows for a sequence holdout")
    moments = {
        row.feature: row
        for row in weighted_moments(weighted.where("weight > 0"), profile.features).collect()
    }
    own = weighted.select(
        *keys, "observed_at", *[F.col(n).cast("double").alias(n) for n in profile.features],
        F.struct(target, "row_index", "n_rows").alias("own"),
    )
    size = F.col("n_rows") - params.length
    is_test = F.col("row_index") - params.length >= F.floor(size * F.lit(1 - test_fraction))
    windows = materialize(
        sequence_windows(own, keys, profile.features, "own", params.length)
        .select(*keys, "observed_at", "own.*", "sequence")
        .withColumn("split", F.when(is_test, "test").otherwise("train"))
        .drop("row_index", "n_rows"),
        "windows",
    )
    inputs = Inputs(profile.features, ordered_labels(windows, target), target)
    prepared = inputs.index(windows.withColumn("features", sequence_vector(F.col("sequence"))))
    row_key = F.xxhash64(*keys, "observed_at").alias("row_key")
    train = prepared.where("split = 'train'").select("features", "label_index", row_key)
    scales = [[moments[n][part] for n in profile.features] for part in ("mean", "scale")]
    fitted, scored = None, None
    for epoch, fitted in enumerate(fit_sequence(train, inputs, params, *scales), start=1):
        part = fitted.score(prepared).select(
            F.lit(epoch).alias("iteration"), "split", "actual", "predicted", "labels", "shares"
        )
        scored = part if scored is None else scored.unionByName(part)
    by = ["iteration", "split"]
    history = materialize(_epoch_history(scored, by), "history").orderBy(*by)
    shown = [*keys, "observed_at", "actual", "predicted", "confidence", "labels", "shares"]
    predictions = materialize(
        fitted.score(prepared.where("split = 'test'")).select(*shown), "predictions"
    )
    return TrainingResult(
        model=fitted,
        metrics=_document(predictions, windows, inputs, params, test_fraction, profile, None),
        predictions=predictions,
        history=history,
    )
