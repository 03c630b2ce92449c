"""Drift from quantile sketches of single days.

A day's rows are read once, into one sketch a feature. Sketches merge, so the baseline and
the current window of any length come from a few small rows a day and not from the
observations. Ranks are approximate; :mod:`tidewatch.operators.drift` has the exact way.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.drift import (
    BINS,
    DRIFT,
    WARNING,
    population_stability_index,
    quantile_shares,
)

#: Size of a sketch: ranks are off by about 1 % at 200, 0.35 % at 800.
SIZE = 800
#: Quantiles of a sketch that a rank is read from.
GRID = 500
DAY, MONTH = "day", "month"


def sketch_days(df: DataFrame, features: list[str], time: str = "observed_at") -> DataFrame:
    """day, feature, n, low, high, sketch of all values that are there.

    Sketches are combined in the map phase, so a day may hold any share of the rows.
    Rows without a time belong to no day.
    """
    pairs = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features
    ])
    long = df.select(F.to_date(time).alias(DAY), F.inline(pairs))
    return (
        long.where(F.col(DAY).isNotNull() & F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(DAY, "feature")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"),
            F.kll_sketch_agg_double("value", F.lit(SIZE)).alias("sketch"),
        )
    )


def store_days(sketches: DataFrame, path: str) -> None:
    """Write the days' sketches; days that are stored already are replaced, others stay.

    Days lie in folders of a month. Only the months that were sent are read and written.
    """
    spark = sketches.sparkSession
    sent = sketches.withColumn(MONTH, F.trunc(DAY, "month")).persist()
    try:
        rows, months = sent, [r[0] for r in sent.select(MONTH).distinct().collect()]
        try:
            stored = spark.read.schema(sent.schema).parquet(path).where(F.col(MONTH).isin(months))
            rows = sent.unionByName(stored.join(sent.select(DAY).distinct(), DAY, "left_anti").select(*sent.columns))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        (
            rows.repartition(MONTH).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
        )
    finally:
        sent.unpersist()
    spark.catalog.refreshByPath(path)


def stored_days(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """Sketches of the days from ``first`` to ``last``; other months are not read."""
    days = spark.read.parquet(path)
    if first is not None:
        days = days.where((F.col(MONTH) >= F.trunc(F.lit(first), "month")) & (F.col(DAY) >= F.lit(first)))
    if last is not None:
        days = days.where((F.col(MONTH) <= F.lit(last)) & (F.col(DAY) <= F.lit(last)))
    return days.drop(MONTH)


def merge_days(days: DataFrame) -> DataFrame:
    """feature, n, low, high, sketch over all days; empty without days."""
    return days.groupBy("feature").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch", F.lit(SIZE)).alias("sketch"),
    )


def _counts(sketch: Column, edges: Column, n: Column, low: Column, high: Column) -> Column:
    """Values between neighbouring edges, from the ranks of the edges.

    A rank is the share of the sketch's GRID quantiles that do not exceed the edge.
    """
    grid = F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit((i + 0.5) / GRID) for i in range(GRID)]))

    def below(edge: Column) -> Column:
        inside = F.size(F.filter(grid, lambda g: g <= edge)) / GRID * n
        return F.when(edge < low, 0.0).when(edge >= high, n.cast("double")).otherwise(inside)

    ranks = F.transform(edges, below)
    return F.zip_with(
        F.slice(ranks, 1, F.size(ranks) - 1), F.slice(ranks, 2, F.size(ranks) - 1),
        lambda a, b: F.round(b - a).cast("bigint"),
    )


def sketched_baseline(merged: DataFrame, bins: int = BINS) -> DataFrame:
    """feature, edges, counts, total, status as :func:`tidewatch.operators.drift.drift_baseline`.

    The outer edges are the smallest and largest value, the inner ones quantiles of
    the sketch. A constant feature gets one bin around its value.
    """
    cuts = F.array(*[
        F.kll_sketch_get_quantile_double("sketch", F.lit(q)) for q in quantile_shares(bins)[1:-1]
    ])
    edges = F.array_sort(F.array_distinct(F.concat(F.array("low"), cuts, F.array("high"))))
    wide = F.when(F.size(edges) > 1, edges).otherwise(F.array(F.col("low") - 0.5, F.col("high") + 0.5))
    # The first edge belongs to the first bin, so it is taken just below its value.
    opened = F.concat(F.array(F.get(wide, F.lit(0)) - F.lit(1e-9)), F.slice(wide, 2, F.size(wide) - 1))
    rows = merged.withColumn("edges", opened)
    counts = _counts(F.col("sketch"), F.col("edges"), F.col("n"), F.col("low"), F.col("high"))
    return rows.select("feature", "edges", counts.alias("counts"), F.col("n").alias("total"), F.lit("ready").alias("status"))


def sketched_psi(
    baseline: DataFrame, merged: DataFrame, *, warning: float = WARNING, drift: float = DRIFT
) -> DataFrame:
    """feature, status, psi of the merged current days against a baseline of either kind."""
    current = merged.select("feature", "n", "low", "high", "sketch")
    joined = baseline.join(current, "feature", "left")
    ready = (F.col("status") == "ready") & (F.size("edges") >= 2)
    counts = _counts(F.col("sketch"), F.col("edges"), F.col("n"), F.col("low"), F.col("high"))
    psi = F.when(ready & F.col("n").isNotNull(), population_stability_index(F.col("counts"), counts))
    return joined.withColumn("psi", psi).select(
        "feature",
        F.when(~ready, "missing_baseline").when(F.col("n").isNull(), "no_current_values")
        .when(F.col("psi") >= drift, "drifted").when(F.col("psi") >= warning, "warning")
        .otherwise("stable").alias("status"),
        "psi",
    )
