"""Distribution baselines and the population stability index."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalars import as_number
from tidewatch.operators.prefix import running_totals, value_bucket
from tidewatch.session import materialize

BINS = 10
WARNING = 0.10
DRIFT = 0.20
SHARE_FLOOR = 1e-6


def numeric_long(df: DataFrame, features: list[str]) -> DataFrame:
    """Long form ``(feature, value)`` of all non-missing numeric values."""
    numbers = df.select(*[as_number(df, name).alias(name) for name in features])
    return numbers.unpivot([], features, "feature", "value").where(F.col("value").isNotNull())


def quantile_shares(bins: int) -> list[float]:
    step = 1.0 / bins
    return [i * step for i in range(bins)] + [1.0]


def quantile_edges(long: DataFrame, bins: int = BINS, most: int | None = None) -> DataFrame:
    """Distinct linear quantiles per feature, the outer two widened by one ulp.

    Equal values are merged, their ranks come from running totals over value
    ranges, and only the values next to a quantile are kept. This is exact and
    no task ever holds all values of a long feature. A constant feature gets one
    bin around its value. ``most`` is an upper bound of the rows, if known.
    """
    merged = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("rows"))
    ranked = running_totals(
        value_bucket(merged, "value", long, ["feature"], most),
        ["feature"],
        ["value"],
        {"below": F.col("rows")},
        totals={"below": "n"},
    )
    # A row can only touch cuts whose position lies next to its own ranks; the
    # candidates are one wider on both sides and checked exactly below.
    last = F.col("below") + F.col("rows") - 1
    per_row = F.lit(float(bins)) / F.greatest(F.col("n") - 1, F.lit(1))
    first_cut = F.greatest(F.floor((F.col("below") - 1) * per_row), F.lit(0))
    last_cut = F.least(F.ceil((last + 1) * per_row), F.lit(bins))
    shares = F.array(*[F.lit(q) for q in quantile_shares(bins)])
    touched = (
        ranked.select(
            "feature",
            "value",
            "below",
            "n",
            last.alias("last"),
            F.explode(F.sequence(first_cut, last_cut)).alias("cut"),
        )
        .withColumn("at", F.get(shares, F.col("cut").cast("int")) * (F.col("n") - 1))
        .where((F.ceil("at") >= F.col("below")) & (F.floor("at") <= F.col("last")))
    )
    low = F.floor("at").between(F.col("below"), F.col("last"))
    high = F.ceil("at").between(F.col("below"), F.col("last"))
    points = (
        touched.groupBy("feature", "cut", "at")
        .agg(
            F.max(F.when(low, F.col("value"))).alias("lo"),
            F.max(F.when(high, F.col("value"))).alias("hi"),
        )
        .withColumn("edge", _between(F.col("lo"), F.col("hi"), F.col("at") - F.floor("at")))
    )
    edges = points.groupBy("feature").agg(F.sort_array(F.collect_set("edge")).alias("edges"))
    return edges.select("feature", widen(F.when(F.size("edges") > 1, F.col("edges")).otherwise(
        _around(F.get("edges", F.lit(0)))
    )).alias("edges"))


def _between(lo: Column, hi: Column, part: Column) -> Column:
    """Linear interpolation, taken from the nearer end."""
    return F.when(part < 0.5, lo + (hi - lo) * part).otherwise(hi - (hi - lo) * (1 - part))


def _around(value: Column) -> Column:
    width = F.when(value == 0, F.lit(0.5)).otherwise(
        F.greatest(F.abs(value) * 0.01, F.lit(0.5))
    )
    return F.array(value - width, value + width)


def widen(edges: Column) -> Column:
    """Move the first edge down and the last edge up by one unit in last place."""
    size = F.size(edges)
    return F.transform(
        edges,
        lambda e, i: F.when(i == 0, e - _gap(e, down=True))
        .when(i == size - 1, e + _gap(e, down=False))
        .otherwise(e),
    )


def _gap(x: Column, *, down: bool) -> Column:
    """Distance from ``x`` to the next double below or above it.

    Inside a power of two the spacing is 2**(exponent - 52). The exponent from a
    logarithm can be off by one next to a power of two, so it is corrected. When
    the step crosses such a power towards zero, the spacing halves.
    """
    size = F.abs(x)
    guess = F.floor(F.log2(size))
    exponent = guess + F.when(F.pow(F.lit(2.0), guess + 1) <= size, 1).when(
        F.pow(F.lit(2.0), guess) > size, -1
    ).otherwise(0)
    towards_zero = x > 0 if down else x < 0
    crosses = towards_zero & (F.pow(F.lit(2.0), exponent) == size)
    spacing = F.pow(F.lit(2.0), exponent - 52 - F.when(crosses, 1).otherwise(0))
    tiny = math.ulp(0.0)
    return F.when(size == 0, F.lit(tiny)).otherwise(F.greatest(spacing, F.lit(tiny)))


def feature_histogram(long: DataFrame, edges: DataFrame, bins: int = BINS) -> DataFrame:
    """Counts per (feature, bin) of values inside the edges; bins are half open,
    the last one is closed."""
    return binned_counts(long, edges, bins).where(F.col("bin").isNotNull())


def binned_counts(long: DataFrame, edges: DataFrame, bins: int = BINS) -> DataFrame:
    """As :func:`feature_histogram`, plus a NULL bin for values that have no bin.

    ``edges`` has one short array per listed feature, a proven bound that makes
    the broadcast safe. Counts are reduced to (feature, bin) before the shuffle.
    """
    value, cuts = F.col("value"), F.col("edges")
    inside = (value >= F.get(cuts, F.lit(0))) & (value <= F.get(cuts, F.size(cuts) - 1))
    return (
        long.join(F.broadcast(edges.select("feature", "edges")), "feature", "left")
        .groupBy("feature", F.when(inside, _bin(value, cuts, bins)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _bin(value: Column, edges: Column, bins: int) -> Column:
    """Number of inner edges at or below the value."""
    inner = [
        F.when((F.size(edges) - 1 > i) & (F.get(edges, F.lit(i)) <= value), 1).otherwise(0)
        for i in range(1, bins)
    ]
    return sum(inner, F.lit(0))


def dense_counts(cells: Column, edges: Column) -> Column:
    """Count array aligned with the bins of ``edges`` from a (bin -> count) map."""
    zero = F.lit(0).cast("bigint")
    return F.when(
        F.size(edges) > 1,
        F.transform(
            F.sequence(F.lit(0), F.size(edges) - 2),
            lambda b: F.coalesce(F.try_element_at(cells, b), zero),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _cells(counts: DataFrame) -> DataFrame:
    """Per feature: the (bin -> count) map and the number of all its values."""
    in_bin = F.when(F.col("bin").isNotNull(), F.struct("bin", "n"))
    return counts.groupBy("feature").agg(
        F.map_from_entries(F.collect_list(in_bin)).alias("cells"), F.sum("n").alias("values")
    )


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x)


def drift_baseline(df: DataFrame, features: list[str], bins: int = BINS) -> DataFrame:
    """Baseline table: ``feature, edges, counts, total, status``.

    A feature without any value has empty arrays and the status ``empty``. The
    edges, one short row per feature, are written once and then used to count.
    """
    long = numeric_long(df, features)
    edges = materialize(quantile_edges(long, bins, df.count()), "edges")
    joined = (
        _feature_list(df, features)
        .join(edges, "feature", "left")
        .join(_cells(feature_histogram(long, edges, bins)), "feature", "left")
    )
    counts = dense_counts(F.col("cells"), F.col("edges"))
    return joined.select(
        "feature",
        F.coalesce("edges", F.array().cast("array<double>")).alias("edges"),
        counts.alias("counts"),
        F.coalesce("values", F.lit(0).cast("bigint")).alias("total"),
        F.when(F.col("edges").isNull(), "empty").otherwise("ready").alias("status"),
    )


def _feature_list(df: DataFrame, features: list[str]) -> DataFrame:
    rows = df.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(f) for f in features])).alias("position", "feature")
    )
    return rows.select("feature")


def shares(counts: Column) -> Column:
    """Shares of a count array, at least ``SHARE_FLOOR`` each and not rescaled;
    uniform when there is nothing to share."""
    total = _total(counts)
    return F.transform(
        counts,
        lambda n: F.when(total <= 0, F.lit(1.0) / F.size(counts)).otherwise(
            F.greatest(F.try_divide(n, total), F.lit(SHARE_FLOOR))
        ),
    )


def population_stability_index(expected: Column, actual: Column) -> Column:
    """Sum of (a - e) * ln(a / e) over two aligned count arrays."""
    terms = F.zip_with(shares(expected), shares(actual), lambda e, a: (a - e) * F.log(a / e))
    return F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)


def psi_by_feature(
    baseline: DataFrame,
    current: DataFrame,
    features: list[str],
    *,
    bins: int = BINS,
    warning: float = WARNING,
    drift: float = DRIFT,
) -> DataFrame:
    """Status, PSI and totals per feature of the current rows against a baseline.

    ``baseline`` is a stored table and read twice; the current rows are read once.
    """
    long = numeric_long(current, features)
    baseline = baseline.where(F.col("feature").isin(features))
    usable = (
        (F.col("status") == "ready")
        & (F.size("edges") >= 2)
        & (F.size("counts") == F.size("edges") - 1)
    )
    joined = (
        _feature_list(current, features)
        .join(baseline.select("feature", "status", "edges", "counts"), "feature", "left")
        .join(_cells(binned_counts(long, baseline.where(usable), bins)), "feature", "left")
        .withColumn("current_counts", F.when(usable, dense_counts(F.col("cells"), F.col("edges"))))
    )
    state = (
        F.when(F.col("status").isNull() | (F.col("status") != "ready"), "missing_baseline")
        .when(F.col("current_counts").isNull(), "invalid_baseline")
        .when(F.col("values").isNull(), "no_current_values")
    )
    scored = joined.withColumn("state", state).withColumn(
        "psi",
        F.when(
            F.col("state").isNull(),
            population_stability_index(F.col("counts"), F.col("current_counts")),
        ),
    )
    current_total = _total(F.col("current_counts"))
    valid = F.col("state").isNull()
    return scored.select(
        "feature",
        F.coalesce(
            "state",
            F.when(F.col("psi") >= drift, "drifted")
            .when(F.col("psi") >= warning, "warning")
            .otherwise("stable"),
        ).alias("status"),
        "psi",
        F.when(valid, _total(F.col("counts"))).alias("baseline_total"),
        F.when(valid, current_total).alias("current_total"),
        F.when(valid, F.col("values") - current_total).alias("current_out_of_range"),
    )


def drift_report(rows: DataFrame, current: DataFrame) -> DataFrame:
    """One summary row: overall status, highest PSI, counts.

    Without current rows the short form ``no_current_rows`` is returned.
    """
    current_rows = current.groupBy().agg(F.count(F.lit(1)).alias("n")).scalar()
    valid = F.col("status").isin("stable", "warning", "drifted")
    summary = rows.agg(
        F.max(F.when(valid, F.col("psi"))).alias("max_psi"),
        F.count_if(F.col("status") == "drifted").alias("drifted_feature_count"),
        F.count_if(F.col("status") == "warning").alias("warning_feature_count"),
    ).withColumn("current_row_count", current_rows)
    empty = F.col("current_row_count") == 0
    return summary.select(
        F.when(empty, "no_current_rows")
        .when(F.col("drifted_feature_count") > 0, "drifted")
        .when(F.col("warning_feature_count") > 0, "warning")
        .otherwise("stable")
        .alias("status"),
        F.when(~empty, F.col("max_psi")).alias("max_psi"),
        F.when(empty, 0).otherwise(F.col("drifted_feature_count")).alias("drifted_feature_count"),
        F.when(empty, 0).otherwise(F.col("warning_feature_count")).alias("warning_feature_count"),
        "current_row_count",
    )


def no_baseline_report(current: DataFrame) -> DataFrame:
    """The short form used when no production model has a baseline."""
    return current.groupBy().agg(F.count(F.lit(1)).alias("current_row_count")).select(
        F.lit("no_baseline").alias("status"),
        F.lit(None).cast("double").alias("max_psi"),
        F.lit(0).cast("bigint").alias("drifted_feature_count"),
        F.lit(0).cast("bigint").alias("warning_feature_count"),
        "current_row_count",
    )


def drift_document(
    report: DataFrame,
    features: DataFrame | None,
    snapshot: DataFrame,
    *,
    window_days: int,
    warning: float = WARNING,
    drift: float = DRIFT,
) -> DataFrame:
    """The whole report as one row: summary, feature rows, thresholds, production model.

    ``snapshot`` has at most one row; without one the production model is NULL. The
    feature rows are as many as the features and are listed in the order of names.
    """
    row = F.struct(
        "feature", "status", "psi", "baseline_total", "current_total", "current_out_of_range"
    )
    live = snapshot.agg(
        F.max(F.struct(F.col("model_name").alias("name"), "version", "alias", "run_id"))
    )
    kind = (
        "array<struct<feature:string,status:string,psi:double,baseline_total:bigint,"
        "current_total:bigint,current_out_of_range:bigint>>"
    )
    listed = F.array().cast(kind)
    if features is not None:
        rows = features.agg(F.sort_array(F.collect_list(row)).cast(kind))
        listed = F.when(F.col("status") == "no_current_rows", listed).otherwise(rows.scalar())
    return report.select(
        "status",
        F.struct("max_psi", "drifted_feature_count", "warning_feature_count", "current_row_count").alias("summary"),
        listed.alias("features"),
        F.struct(F.lit(warning).alias("warning"), F.lit(drift).alias("drift")).alias("thresholds"),
        F.lit(window_days).alias("current_window_days"),
        live.scalar().alias("production_model"),
    )


def baseline_document(baseline: DataFrame, rows: int, bins: int = BINS) -> DataFrame:
    """A baseline as one row: number of bins, rows and features, then the features."""
    listed = F.collect_list(F.struct("feature", "edges", "counts", "total", "status"))
    return baseline.agg(
        F.lit(bins).alias("bins"), F.lit(rows).cast("bigint").alias("row_count"),
        F.count(F.lit(1)).alias("feature_count"), F.sort_array(listed).alias("features"),
    )
