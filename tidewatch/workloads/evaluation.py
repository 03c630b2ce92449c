"""Queries for validation splits, class weights and classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators.metrics import (
    acceptance,
    argmax_label,
    batch_numbers,
    class_distribution,
    classification_report,
    confusion_cells,
    confusion_matrix,
    fold_means,
    history_and_fold_metrics,
    label_metrics,
    log_loss,
    metrics_document,
    roc_auc_ovr,
    roc_corners,
    roc_points,
    score_steps,
)
from tidewatch.operators.prefix import with_row_index
from tidewatch.operators.splits import (
    class_weights,
    expanding_folds,
    holdout_split,
    training_part,
)
from tidewatch.plans.scaling import window_scaler
from tidewatch.workloads.inputs import (
    CLASSES_SQL,
    HOURLY_SQL,
    PREDICTIONS_SQL,
    PROBABILITIES_SQL,
    SERIES,
    code_classes,
    hourly_obs,
    long_probabilities,
    predictions,
    probabilities,
    table,
)
from tidewatch.workloads.registry import query, r6, rounded

KEY = [*SERIES, "observed_at"]

_INDEXED_SQL = f"""{HOURLY_SQL},
indexed AS (
  SELECT series_id, observed_at, weather_code,
         row_number() OVER (PARTITION BY series_id ORDER BY observed_at) - 1 AS row_index,
         count(*) OVER (PARTITION BY series_id) AS n_rows
  FROM hourly_obs),
split AS (
  SELECT *, CASE WHEN row_index >= floor(n_rows * (1 - CAST(0.2 AS DOUBLE))) THEN 'test'
                 WHEN row_index < floor(n_rows * (1 - CAST(0.2 AS DOUBLE))) - 24 THEN 'train'
                 ELSE 'gap' END AS split
  FROM indexed)"""


# --- splits -----------------------------------------------------------------------


@query(
    "holdout_split",
    f"WITH {_INDEXED_SQL} SELECT series_id, observed_at, row_index, n_rows, split FROM split",
)
def holdout(spark, sf_dir):
    return holdout_split(hourly_obs(spark, sf_dir).select(*KEY), SERIES)


@query(
    "holdout_split_orders",
    """WITH indexed AS (
  SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1
         AS row_index, count(*) OVER () AS n_rows FROM orders)
SELECT o_orderkey, o_orderdate, row_index, n_rows,
       CASE WHEN row_index >= floor(n_rows * (1 - CAST(0.25 AS DOUBLE))) THEN 'test'
            WHEN row_index < floor(n_rows * (1 - CAST(0.25 AS DOUBLE))) - 24 THEN 'train'
            ELSE 'gap' END AS split
FROM indexed""",
)
def holdout_orders(spark, sf_dir):
    """All orders as one series."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return holdout_split(orders, test_fraction=0.25, order_by=["o_orderdate", "o_orderkey"])


@query(
    "expanding_folds",
    f"""WITH {_INDEXED_SQL},
train AS (
  SELECT series_id, observed_at, row_index, count(*) OVER (PARTITION BY series_id) AS m
  FROM split WHERE split = 'train'),
bounds AS (
  SELECT t.*, f.fold, m // 4 AS size, m - (4 - f.fold) * (m // 4) AS start
  FROM train AS t CROSS JOIN (VALUES (1), (2), (3)) AS f(fold)),
roles AS (
  SELECT series_id, observed_at, row_index, fold,
         CASE WHEN row_index >= start AND row_index < start + size THEN 'validation'
              WHEN row_index < start - 24 THEN 'train' END AS role
  FROM bounds)
SELECT * FROM roles WHERE role IS NOT NULL""",
)
def folds(spark, sf_dir):
    split = holdout_split(hourly_obs(spark, sf_dir).select(*KEY), SERIES)
    return expanding_folds(training_part(split), SERIES).select(
        *KEY, "row_index", "fold", "role"
    )


@query(
    "class_weights",
    f"""WITH {HOURLY_SQL},
counts AS (SELECT weather_code, count(*) AS n FROM hourly_obs GROUP BY weather_code),
total AS (SELECT CAST(sum(n) AS DOUBLE) AS n, count(*) AS k FROM counts)
SELECT h.series_id, h.observed_at, h.weather_code,
       {r6("pow(t.n / (t.k * c.n), 0.5)", "class_weight")}
FROM hourly_obs AS h
JOIN counts AS c ON c.weather_code = h.weather_code
JOIN total AS t ON true""",
)
def weights(spark, sf_dir):
    rows = hourly_obs(spark, sf_dir).select(*KEY, "weather_code")
    return rounded(class_weights(rows, "weather_code"))


_SCALED = ["temperature_2m", "wind_speed_10m", "pressure_msl"]


@query(
    "window_scaler",
    f"""WITH {HOURLY_SQL},
indexed AS (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY observed_at) - 1 AS pos,
         count(*) OVER (PARTITION BY series_id) AS n
  FROM hourly_obs),
windows AS (
  SELECT s.temperature_2m, s.wind_speed_10m, s.pressure_msl
  FROM indexed AS t
  JOIN indexed AS s ON s.series_id = t.series_id AND s.pos BETWEEN t.pos - 24 AND t.pos - 1
  WHERE t.pos >= 24 AND t.pos < 24 + floor((t.n - 24) * (1 - CAST(0.2 AS DOUBLE))))
{" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r6(f'avg({c})', 'mean')}, {r6(f'stddev_pop({c})', 'scale')} "
    "FROM windows" for c in _SCALED)}""",
)
def scaler(spark, sf_dir):
    return rounded(window_scaler(hourly_obs(spark, sf_dir), SERIES, _SCALED))


# --- metrics ------------------------------------------------------------------------

_CELLS_SQL = f"""{PREDICTIONS_SQL}, {CLASSES_SQL},
cells AS (SELECT actual, predicted, count(*) AS n FROM predictions GROUP BY actual, predicted),
counts AS (
  SELECT label, CAST(sum(support) AS BIGINT) AS support, CAST(sum(pred) AS BIGINT) AS pred,
         CAST(sum(hits) AS BIGINT) AS hits
  FROM (SELECT actual AS label, n AS support, 0 AS pred,
               CASE WHEN actual = predicted THEN n ELSE 0 END AS hits FROM cells
        UNION ALL
        SELECT predicted, 0, n, 0 FROM cells) AS s
  GROUP BY label),
scores AS (
  SELECT label, support, pred, hits,
         CASE WHEN pred = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / pred END AS precision,
         CASE WHEN support = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / support END AS recall,
         CASE WHEN support + pred = 0 THEN 0.0 ELSE CAST(2 * hits AS DOUBLE) / (support + pred) END
           AS f1_score
  FROM counts)"""
_SUMMARY_SQL = {
    "accuracy": "CAST(sum(hits) AS DOUBLE) / sum(support)",
    "balanced_accuracy": "avg(recall) FILTER (WHERE support > 0)",
    "precision_weighted": "sum(support * precision) / sum(support)",
    "recall_macro": "avg(recall)",
    "recall_weighted": "sum(support * recall) / sum(support)",
    "f1_macro": "avg(f1_score)",
    "f1_weighted": "sum(support * f1_score) / sum(support)",
}
_SUMMARY_COLUMNS = ", ".join(r6(sql, name) for name, sql in _SUMMARY_SQL.items())


@query(
    "class_distribution",
    f"""WITH {PREDICTIONS_SQL}, {CLASSES_SQL}
SELECT 'actual' AS side, c.label, count(p.actual) AS n
FROM classes AS c LEFT JOIN predictions AS p ON p.actual = c.label GROUP BY c.label
UNION ALL
SELECT 'predicted', c.label, count(p.predicted)
FROM classes AS c LEFT JOIN predictions AS p ON p.predicted = c.label GROUP BY c.label""",
)
def distributions(spark, sf_dir):
    rows, classes = predictions(spark, sf_dir), code_classes(spark, sf_dir)
    sides = [
        class_distribution(rows, classes, side).select(F.lit(side).alias("side"), "label", "n")
        for side in ("actual", "predicted")
    ]
    return sides[0].unionByName(sides[1])


@query(
    "confusion_matrix",
    f"""WITH {_CELLS_SQL}
SELECT a.label AS actual, p.label AS predicted, coalesce(c.n, 0) AS n
FROM classes AS a CROSS JOIN classes AS p
LEFT JOIN cells AS c ON c.actual = a.label AND c.predicted = p.label""",
)
def matrix(spark, sf_dir):
    cells = confusion_cells(predictions(spark, sf_dir))
    return confusion_matrix(cells, code_classes(spark, sf_dir))


@query(
    "classification_metrics",
    f"WITH {_CELLS_SQL} SELECT CAST(sum(support) AS BIGINT) AS rows, {_SUMMARY_COLUMNS} FROM scores",
)
def summary_metrics(spark, sf_dir):
    return rounded(label_metrics(confusion_cells(predictions(spark, sf_dir))))


@query(
    "classification_report",
    f"""WITH {_CELLS_SQL},
per_class AS (
  SELECT CAST(c.label AS VARCHAR) AS label, coalesce(s.precision, 0) AS precision,
         coalesce(s.recall, 0) AS recall, coalesce(s.f1_score, 0) AS f1_score,
         coalesce(s.support, 0) AS support, coalesce(s.hits, 0) AS hits
  FROM classes AS c LEFT JOIN scores AS s ON s.label = c.label),
report AS (
  SELECT label, precision, recall, f1_score, support FROM per_class
  UNION ALL
  SELECT 'accuracy', NULL, NULL, CAST(sum(hits) AS DOUBLE) / sum(support), sum(support)
  FROM per_class
  UNION ALL
  SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM per_class
  UNION ALL
  SELECT 'weighted avg', sum(precision * support) / sum(support),
         sum(recall * support) / sum(support), sum(f1_score * support) / sum(support),
         sum(support)
  FROM per_class)
SELECT label, {r6("precision")}, {r6("recall")}, {r6("f1_score")},
       CAST(support AS BIGINT) AS support FROM report""",
)
def report(spark, sf_dir):
    cells = confusion_cells(predictions(spark, sf_dir))
    return rounded(classification_report(cells, code_classes(spark, sf_dir)))


@query(
    "acceptance_gate",
    f"""WITH {_CELLS_SQL}
SELECT {r6(_SUMMARY_SQL["f1_macro"], "f1_macro")}, avg(f1_score) >= 0.40 AS accepted,
       'f1_macro' AS acceptance_metric, CAST(0.4 AS DOUBLE) AS acceptance_threshold FROM scores""",
)
def gate(spark, sf_dir):
    metrics = label_metrics(confusion_cells(predictions(spark, sf_dir)))
    return rounded(
        acceptance(metrics).select(
            "f1_macro", "accepted", "acceptance_metric", "acceptance_threshold"
        )
    )


@query(
    "log_loss",
    f"WITH {PROBABILITIES_SQL} SELECT series_id, {r6('avg(-ln(score))', 'log_loss')} "
    "FROM probabilities WHERE label = actual GROUP BY series_id",
)
def loss(spark, sf_dir):
    own = long_probabilities(spark, sf_dir).where("label = actual")
    return rounded(log_loss(own, "score", SERIES))


_AUC_SQL = f"""{PROBABILITIES_SQL},
merged AS (
  SELECT label, score, count(*) FILTER (WHERE actual = label) AS pos,
         count(*) FILTER (WHERE actual <> label) AS neg
  FROM probabilities GROUP BY label, score),
steps AS (
  SELECT *, coalesce(sum(neg) OVER b, 0) AS neg_below, coalesce(sum(pos) OVER b, 0) AS pos_below,
         sum(pos) OVER (PARTITION BY label) AS pos_total,
         sum(neg) OVER (PARTITION BY label) AS neg_total
  FROM merged
  WINDOW b AS (PARTITION BY label ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
auc AS (
  SELECT label, pos_total,
         CAST(sum(pos * (neg_below + neg / 2.0)) AS DOUBLE) / (pos_total * neg_total) AS auc
  FROM steps WHERE pos_total > 0 GROUP BY label, pos_total, neg_total)"""


@query(
    "roc_auc_ovr",
    f"WITH {_AUC_SQL} SELECT {r6('sum(auc * pos_total) / sum(pos_total)', 'roc_auc_ovr_weighted')} "
    "FROM auc",
)
def auc(spark, sf_dir):
    return rounded(roc_auc_ovr(score_steps(long_probabilities(spark, sf_dir))))


@query(
    "roc_points",
    f"""WITH {_AUC_SQL}
SELECT label, {r6("score", "threshold")},
       {r6("CAST(neg_total - neg_below AS DOUBLE) / neg_total", "fpr")},
       {r6("CAST(pos_total - pos_below AS DOUBLE) / pos_total", "tpr")}
FROM steps WHERE pos_total > 0 AND neg_total > 0
UNION ALL
SELECT DISTINCT label, CAST(NULL AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)
FROM steps WHERE pos_total > 0 AND neg_total > 0""",
)
def curve(spark, sf_dir):
    return rounded(roc_points(score_steps(long_probabilities(spark, sf_dir))))


@query(
    "roc_corners",
    f"""WITH {_AUC_SQL},
neighbours AS (
  SELECT *, lag(pos) OVER w AS low_pos, lag(neg) OVER w AS low_neg
  FROM steps WHERE pos_total > 0 AND neg_total > 0
  WINDOW w AS (PARTITION BY label ORDER BY score))
SELECT label, {r6("score", "threshold")},
       {r6("CAST(neg_total - neg_below AS DOUBLE) / neg_total", "fpr")},
       {r6("CAST(pos_total - pos_below AS DOUBLE) / pos_total", "tpr")}
FROM neighbours WHERE low_pos IS NULL OR pos * low_neg <> neg * low_pos
UNION ALL
SELECT DISTINCT label, CAST(NULL AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)
FROM neighbours""",
)
def curve_corners(spark, sf_dir):
    return rounded(roc_corners(score_steps(long_probabilities(spark, sf_dir))))


@query(
    "argmax_confidence",
    f"""WITH {PROBABILITIES_SQL}
SELECT series_id, observed_at, label AS predicted, {r6("score", "confidence")}
FROM probabilities
QUALIFY row_number() OVER (PARTITION BY series_id, observed_at ORDER BY score DESC, label) = 1""",
)
def most_likely(spark, sf_dir):
    label, top = argmax_label(F.col("shares"), F.col("labels"))
    return rounded(
        probabilities(spark, sf_dir).select(
            *KEY, label.alias("predicted"), top.alias("confidence")
        )
    )



@query(
    "metrics_document",
    f"""WITH {_AUC_SQL}, {_CELLS_SQL.split(CLASSES_SQL + ",", 1)[1]}
SELECT CAST(sum(support) AS BIGINT) AS rows_test, {_SUMMARY_COLUMNS},
       (SELECT {r6("sum(auc * pos_total) / sum(pos_total)", "v")} FROM auc)
         AS roc_auc_ovr_weighted,
       (SELECT {r6("avg(-ln(score))", "v")} FROM probabilities WHERE label = actual) AS log_loss,
       avg(f1_score) >= 0.40 AS accepted,
       (SELECT min(observed_at) FROM predictions) AS test_start,
       (SELECT max(observed_at) FROM predictions) AS test_end,
       (SELECT count(*) FROM classes) AS n_classes,
       (SELECT count(*) FROM predictions) AS matrix_total
FROM scores""",
)
def document(spark, sf_dir):
    full = metrics_document(
        predictions(spark, sf_dir),
        long_probabilities(spark, sf_dir),
        code_classes(spark, sf_dir),
    )
    total = F.aggregate(
        F.flatten("confusion_matrix"), F.lit(0).cast("bigint"), lambda a, x: a + x
    )
    return rounded(
        full.select(
            "rows_test",
            *_SUMMARY_SQL,
            "roc_auc_ovr_weighted",
            "log_loss",
            "accepted",
            "test_start",
            "test_end",
            F.size("actual_class_distribution").cast("bigint").alias("n_classes"),
            total.alias("matrix_total"),
        )
    )


def _daily_metrics(spark, sf_dir):
    """Metrics of each forecast day: a fold per day of month, a split per series."""
    rows = predictions(spark, sf_dir).withColumn("fold", F.dayofmonth("observed_at"))
    return label_metrics(confusion_cells(rows, by=["fold"]), ["fold"])


_FOLD_SQL = f"""{PREDICTIONS_SQL},
fold_cells AS (
  SELECT CAST(extract(day FROM observed_at) AS INT) AS fold, actual, predicted, count(*) AS n
  FROM predictions GROUP BY ALL),
fold_counts AS (
  SELECT fold, label, sum(support) AS support, sum(pred) AS pred, sum(hits) AS hits
  FROM (SELECT fold, actual AS label, n AS support, 0 AS pred,
               CASE WHEN actual = predicted THEN n ELSE 0 END AS hits FROM fold_cells
        UNION ALL
        SELECT fold, predicted, 0, n, 0 FROM fold_cells) AS s
  GROUP BY fold, label),
fold_scores AS (
  SELECT fold, label, support, pred, hits,
         CASE WHEN pred = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / pred END AS precision,
         CASE WHEN support = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / support END AS recall,
         CASE WHEN support + pred = 0 THEN 0.0 ELSE CAST(2 * hits AS DOUBLE) / (support + pred) END
           AS f1_score
  FROM fold_counts),
fold_metrics AS (
  SELECT fold, {", ".join(f"{sql} AS {name}" for name, sql in _SUMMARY_SQL.items())}
  FROM fold_scores GROUP BY fold)"""


@query(
    "cv_mean",
    f"WITH {_FOLD_SQL} SELECT {', '.join(r6(f'avg({n})', n) for n in _SUMMARY_SQL)} "
    "FROM fold_metrics",
)
def cv_mean(spark, sf_dir):
    return rounded(fold_means(_daily_metrics(spark, sf_dir), list(_SUMMARY_SQL)))


_HISTORY = ["accuracy", "f1_macro", "f1_weighted"]
_FOLDS = ["accuracy", "balanced_accuracy", "recall_macro"]
_LONG_SQL = f"""{_FOLD_SQL},
long_metrics AS (
  {" UNION ALL ".join(
      f"SELECT 'test_{n}' AS key, fold AS step, CASE WHEN {n} = 0 THEN NULL ELSE {n} END AS value "
      "FROM fold_metrics" for n in _HISTORY)}
  UNION ALL
  {" UNION ALL ".join(
      f"SELECT 'cv_validation_{n}', fold, {n} FROM fold_metrics" for n in _FOLDS)})"""


def _long(spark, sf_dir):
    """Long form of two metric tables; a zero stands for a missing value in one."""
    folds_table = _daily_metrics(spark, sf_dir)
    history = folds_table.select(
        F.col("fold").alias("iteration"),
        F.lit("test").alias("split"),
        *[F.when(F.col(n) != 0, F.col(n)).alias(n) for n in _HISTORY],
    )
    return history_and_fold_metrics(history, folds_table, _HISTORY, _FOLDS)


@query(
    "metrics_long",
    f"WITH {_LONG_SQL} SELECT key, step, {r6('value')} FROM long_metrics WHERE value IS NOT NULL",
)
def metrics_long(spark, sf_dir):
    return rounded(_long(spark, sf_dir))


@query(
    "batch_number",
    """SELECT event_id, row_index, CAST(row_index // 500 AS BIGINT) AS batch
FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_index
      FROM events) AS e""",
)
def batches(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    indexed = with_row_index(events, [], ["ts", "event_id"])
    return batch_numbers(indexed.select("event_id", "row_index"), "row_index")


