"""Running totals and row positions without a one-task sort.

A window over a whole series sorts it in one task. Here the rows are cut into
ordered buckets first: bucket totals are summed up over the small bucket table,
and only the rest is counted inside each bucket. The result is exact.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.sizing import at_most
from tidewatch.session import materialize

BUCKET_DAYS = 30
TASK_ROWS = 1_000_000


def day_bucket(ts: str | Column, days: int = BUCKET_DAYS) -> Column:
    """Number of the ``days``-long calendar bucket that holds ``ts``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")) / days)


def value_bucket(
    df: DataFrame,
    column: str,
    source: DataFrame,
    keys: list[str],
    most: int | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add ``__bucket``: ordered value ranges of about ``task_rows`` rows each.

    ``df`` holds each value once per key, so no single value can fill a bucket.
    A sketch of ``source``, the rows it was merged from, gives the number of ranges
    without a shuffle. The bounds come from the merged values, which are written
    once for it: rows would give a hot value most of the bounds. Values that fit
    one task are left without buckets; ``most`` is a known upper bound of the
    values of a key that saves the first sketch.
    """
    if most is not None and most <= task_rows:
        return df
    distinct = F.approx_count_distinct(F.xxhash64(*keys, column))
    pieces = int(source.agg(distinct).first()[0] / task_rows) + 1
    if pieces == 1:
        return df
    shares = [i / pieces for i in range(1, pieces)]
    df = materialize(df, "values")
    cuts = sorted(set(df.approxQuantile(column, shares, 1 / (4 * pieces))))
    splits = [float("-inf"), *cuts, float("inf")]
    return Bucketizer(splits=splits, inputCol=column, outputCol="__bucket").transform(df)


def running_totals(
    df: DataFrame,
    keys: list[str],
    order_by: list[str],
    values: dict[str, Column],
    *,
    totals: dict[str, str] | None = None,
) -> DataFrame:
    """Add, per value, its sum over all earlier rows of the same key.

    ``df`` carries ``__bucket``, a non-decreasing function of ``order_by``. Keys
    and bucket must not be NULL. Without that column a key is summed in one task.
    ``totals`` names columns for whole-key sums.
    """
    totals = totals or {}
    if "__bucket" not in df.columns:
        by_key = Window.partitionBy(*(keys or [F.lit(0)]))
        earlier = by_key.orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
        return df.select(
            "*",
            *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(n) for n, v in values.items()],
            *[F.sum(values[n]).over(by_key).alias(total) for n, total in totals.items()],
        )
    rows = df.withColumns({f"__v_{name}": value for name, value in values.items()})
    per_bucket = rows.groupBy(*keys, "__bucket").agg(
        *[F.sum(f"__v_{name}").alias(f"__t_{name}") for name in values]
    )
    by_key = Window.partitionBy(*(keys or [F.lit(0)]))
    earlier = by_key.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *keys,
        "__bucket",
        *[F.coalesce(F.sum(f"__t_{n}").over(earlier), F.lit(0)).alias(f"__o_{n}") for n in values],
        *[F.sum(f"__t_{name}").over(by_key).alias(total) for name, total in totals.items()],
    )
    inside = (
        Window.partitionBy(*keys, "__bucket")
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # Rows without a key or bucket are a group of their own, so NULL must meet NULL.
    parts = [*keys, "__bucket"]
    offsets = offsets.withColumnsRenamed({name: f"__k_{name}" for name in parts})
    same = [F.col(name).eqNullSafe(F.col(f"__k_{name}")) for name in parts]
    return rows.join(offsets, same).select(
        *df.drop("__bucket").columns,
        *[
            (
                F.col(f"__o_{name}") + F.coalesce(F.sum(f"__v_{name}").over(inside), F.lit(0))
            ).alias(name)
            for name in values
        ],
        *totals.values(),
    )


def range_bucket(df: DataFrame, columns: list[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """Add ``__bucket``: the range partition of each row by all of ``columns``.

    Spark samples the composite key, so a hot leading key or a hot time is split
    by the columns behind it. The numbers are written out with the rows: partition
    bounds come from a sample and must not be drawn twice.
    """
    pieces = df.count() // task_rows + 1
    ranged = df.repartitionByRange(pieces, *columns)
    return materialize(ranged.withColumn("__bucket", F.spark_partition_id()), "ranges")


def with_row_index(
    df: DataFrame,
    keys: list[str],
    order_by: list[str] | None = None,
    *,
    index: str = "row_index",
    count: str | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add the row's position in order, from 0, and optionally the row count.

    By default rows are in time order. Observation times are unique to the second
    in a series, which bounds the calendar buckets. Nothing bounds other orders:
    if the rows do not fit one task they are cut into ranges of the whole key.
    """
    if order_by is None:
        order_by = ["observed_at"]
        bucketed = df.withColumn("__bucket", day_bucket(order_by[0]))
    elif at_most(df, task_rows):
        bucketed = df
    else:
        bucketed = range_bucket(df, [*keys, *order_by], task_rows)
    return running_totals(
        bucketed,
        keys,
        order_by,
        {index: F.lit(1).cast("bigint")},
        totals={index: count} if count else None,
    )
