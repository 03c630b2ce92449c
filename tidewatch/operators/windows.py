"""Row-frame windows over long series.

Frames count rows, not hours. A window by series alone would put a whole series
into one task, and one series may hold a large part of all rows. ``lay_out``
therefore cuts long series into chunks of whole time buckets and copies into
each chunk the neighbouring buckets its frames can reach. Frames then never
leave a chunk, and the copies are dropped afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewatch.functions.scalars import condition_of
from tidewatch.operators.contracts import ContractError
from tidewatch.operators.prefix import BUCKET_DAYS, day_bucket
from tidewatch.operators.sizing import broadcast_if_small

CHUNK_ROWS = 250_000
BUCKETS_PER_CHUNK = 8
REACH = 24


@dataclass(frozen=True)
class Layout:
    """Rows ready for windows, and the columns to partition them by."""

    rows: DataFrame
    partition: list[str]
    time: str
    chunked: bool

    def window(self) -> WindowSpec:
        return self.partitions().orderBy(self.time)

    def partitions(self) -> WindowSpec:
        return Window.partitionBy(*(self.partition or [F.lit(0)]))

    def back(self, rows: int) -> WindowSpec:
        """Frame of ``rows`` rows that ends with the current one."""
        return self.window().rowsBetween(1 - rows, 0)

    def select(self, *columns: Column | str) -> DataFrame:
        """Project columns and windows, then keep each row once."""
        if not self.chunked:
            return self.rows.select(*columns)
        return self.rows.select(*columns, "__home").where("__home").drop("__home")


def lay_out(
    df: DataFrame,
    keys: list[str],
    *,
    time: str = "observed_at",
    before: int = REACH,
    after: int = REACH,
    chunk_rows: int | None = CHUNK_ROWS,
    bucket_days: int | None = None,
) -> Layout:
    """Lay rows out for frames that reach ``before`` rows back and ``after`` ahead.

    A chunk also holds all rows of the calendar day before its first row. Series
    of at most ``chunk_rows`` rows stay whole; if no series is longer, one
    exchange by series is all there is. The check is one aggregate over the key
    columns; ``chunk_rows=None`` skips it.

    Buckets are whole days, at most 30 and fewer for dense series, so that they
    are small against a chunk. Times are unique to the second, so a day is bounded.
    """
    if chunk_rows is None:
        return Layout(df, keys, time, False)
    density = _density_of_long_series(df, keys, time, chunk_rows)
    if density is None:
        return Layout(df, keys, time, False)
    if bucket_days is None:
        bucket_days = int(max(1, min(BUCKET_DAYS, chunk_rows / BUCKETS_PER_CHUNK / density)))
    plan = _chunk_plan(df, keys, time, before, after, chunk_rows, bucket_days)
    cut = df.withColumn("__bucket", day_bucket(time, bucket_days)).join(
        broadcast_if_small(plan), [*keys, "__bucket"], "left"
    )
    home = F.coalesce("__home_chunk", F.lit(0).cast("bigint"))
    rows = (
        cut.withColumn(
            "__chunk", F.explode(F.coalesce("__chunks", F.array(F.lit(0).cast("bigint"))))
        )
        .withColumn("__home", F.col("__chunk") == home)
        .select(*df.columns, "__chunk", "__home")
    )
    return Layout(rows, [*keys, "__chunk"], time, True)


def _density_of_long_series(df, keys, time, chunk_rows) -> float | None:
    """Most rows per day of a series longer than a chunk, ``None`` without any."""
    days = F.datediff(F.max(F.to_date(time)), F.min(F.to_date(time))) + 1
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), days.alias("days"))
    long = sizes.where(F.col("n") > chunk_rows)
    return long.agg(F.max(F.col("n") / F.col("days"))).first()[0]


def _chunk_plan(df, keys, time, before, after, chunk_rows, bucket_days) -> DataFrame:
    """Buckets of long series: home chunk and all chunks that need their rows.

    Every bucket holds at least one row, so frames reach at most ``before``
    buckets back and ``after`` buckets ahead.
    """
    counts = df.groupBy(*keys, day_bucket(time, bucket_days).alias("__bucket")).agg(
        F.count(F.lit(1)).alias("__n")
    )
    series = Window.partitionBy(*(keys or [F.lit(0)]))
    ordered = series.orderBy("__bucket")
    placed = (
        counts.withColumn("__total", F.sum("__n").over(series))
        .where(F.col("__total") > chunk_rows)
        .withColumn(
            "__end", F.sum("__n").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
        )
        .withColumn("__start", F.col("__end") - F.col("__n"))
        .withColumn("__home_chunk", F.floor(F.col("__start") / chunk_rows))
    )
    neighbour = F.struct("__bucket", "__start", "__end", "__home_chunk")
    later = F.collect_list(neighbour).over(ordered.rowsBetween(1, max(before, 1)))
    earlier = F.collect_list(neighbour).over(ordered.rowsBetween(-max(after, 1), -1))
    return (
        placed.withColumn("__later", later)
        .withColumn("__earlier", earlier)
        .select(
            *keys,
            "__bucket",
            "__home_chunk",
            F.array_distinct(
                F.concat(
                    F.array("__home_chunk"),
                    F.transform(
                        F.filter(
                            "__later",
                            lambda b: (b["__start"] < F.col("__end") + before)
                            | (b["__bucket"] == F.col("__bucket") + 1),
                        ),
                        lambda b: b["__home_chunk"],
                    ),
                    F.transform(
                        F.filter("__earlier", lambda b: b["__end"] > F.col("__start") - after),
                        lambda b: b["__home_chunk"],
                    ),
                )
            ).alias("__chunks"),
        )
    )


def lags(layout: Layout) -> dict[str, Column]:
    """Row lags, changes, and the conditions of lagged codes."""
    w = layout.window()
    codes = {f"weather_code_lag_{n}h": F.lag("weather_code", n).over(w) for n in (4, 12)}
    return {
        **codes,
        **{
            name.replace("weather_code", "weather_condition"): condition_of(code)
            for name, code in codes.items()
        },
        **{f"temp_lag_{n}h": F.lag("temperature_2m", n).over(w) for n in (1, 3, 6, 24)},
        "humidity_lag_1h": F.lag("relative_humidity_2m", 1).over(w),
        "pressure_lag_1h": F.lag("pressure_msl", 1).over(w),
        "pressure_change_3h": F.col("pressure_msl") - F.lag("pressure_msl", 3).over(w),
        "wind_speed_lag_1h": F.lag("wind_speed_10m", 1).over(w),
    }


def rolling_means(layout: Layout) -> dict[str, Column]:
    """Means over the last rows; NULLs are skipped, one value is enough."""
    return {
        **{
            f"temp_rolling_mean_{n}h": F.avg("temperature_2m").over(layout.back(n))
            for n in (3, 6, 24)
        },
        "humidity_rolling_mean_6h": F.avg("relative_humidity_2m").over(layout.back(6)),
        "wind_speed_rolling_mean_6h": F.avg("wind_speed_10m").over(layout.back(6)),
    }


def rolling_std(layout: Layout) -> dict[str, Column]:
    """Sample deviation over 24 rows; NULL below two values."""
    return {"temp_rolling_std_24h": F.stddev_samp("temperature_2m").over(layout.back(24))}


def rain_sums(layout: Layout) -> dict[str, Column]:
    """Sums over the last rows, missing rain counted as none."""
    rain = F.coalesce("rain", F.lit(0.0))
    return {f"rain_rolling_sum_{n}h": F.sum(rain).over(layout.back(n)) for n in (6, 24)}


def target_lead(layout: Layout, rows: int = 24) -> Column:
    """Condition ``rows`` rows ahead."""
    return condition_of(F.lead("weather_code", rows).over(layout.window()))


def daily_lags(layout: Layout, columns: list[str]) -> dict[str, Column]:
    """First non-null value, in time order, of the calendar day before the row's.

    A range frame over the day number reads it inside the partition that the
    other windows use, so no join and no second exchange is needed.
    """
    day = F.datediff(F.to_date(layout.time), F.lit("1970-01-01").cast("date"))
    yesterday = layout.partitions().orderBy(day).rangeBetween(-1, -1)
    return {
        f"{name}_lag_1d": F.min_by(
            F.col(name), F.when(F.col(name).isNotNull(), F.col(layout.time))
        ).over(yesterday)
        for name in columns
    }


def sequence_windows(
    df: DataFrame,
    keys: list[str],
    features: list[str],
    label: str,
    length: int = 24,
    **layout_options,
) -> DataFrame:
    """The ``length`` rows before each row, with the row's own label and time.

    The first ``length`` rows of a series have no full window and drop out.
    """
    if length < 2:
        raise ContractError("a sequence needs at least 2 rows")
    layout = lay_out(df, keys, before=length, after=0, **layout_options)
    step = F.array(*[F.col(name).cast("double") for name in features])
    steps = F.collect_list(step).over(layout.window().rowsBetween(-length, -1))
    return layout.select(*keys, layout.time, F.col(label), steps.alias("sequence")).where(
        F.size("sequence") == length
    )


def keep_last(df: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """One row per key: the one that came last by ``sequence``.

    Spark keeps only the best row per key in each task before it shuffles, so a
    key with very many copies does not reach one task as a whole.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(sequence).desc())
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")
