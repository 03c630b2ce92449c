"""Joins of hourly rows with daily, secondary and shifted rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.contracts import ContractError
from tidewatch.schemas import DAILY_VARIABLES, ENRICHMENT_VARIABLES


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    sample = duplicate_keys(df, keys).limit(1).collect()
    if sample:
        raise ContractError(f"keys {', '.join(keys)} are not unique: {sample[0].asDict()}")
    return df


def join_daily(
    hourly: DataFrame,
    daily: DataFrame,
    keys: list[str],
    *,
    date_column: str = "obs_date",
    validate: bool = False,
) -> DataFrame:
    """Left join of the daily row of each hourly row's date, many to one.

    The daily side grows with the data, so it carries no broadcast hint: Spark
    broadcasts it only below its own size threshold.
    """
    if validate:
        assert_unique(daily, [*keys, date_column])
    values = [name for name in daily.columns if name not in (*keys, date_column)]
    return (
        hourly.withColumn(date_column, F.to_date("observed_at"))
        .join(daily, [*keys, date_column], "left")
        .select(*hourly.columns, *values)
    )


def join_enrichment(
    rows: DataFrame,
    feed: DataFrame,
    keys: list[str],
    *,
    columns: list[str] | None = None,
    validate: bool = False,
) -> DataFrame:
    """Left join of the second feed on the exact instant, one to one."""
    on = [*keys, "observed_at"]
    if validate:
        assert_unique(rows, on)
        assert_unique(feed, on)
    return rows.join(feed.select(*on, *(columns or ENRICHMENT_VARIABLES)), on, "left").select(
        *rows.columns, *(columns or ENRICHMENT_VARIABLES)
    )


def update_from(
    target: DataFrame,
    source: DataFrame,
    on: list[str],
    columns: list[str],
    derived: dict[str, Column] | None = None,
) -> DataFrame:
    """Overwrite ``columns`` (NULLs included) where ``source`` has the key.

    ``derived`` columns are recomputed from the target row for the same rows.
    Everything else, and every row without a match, stays as it is.
    """
    staged = source.select(
        *on, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in columns]
    )
    joined = target.join(staged, on, "left")
    hit = F.col("__hit").isNotNull()
    new = {c: F.col(f"__new_{c}") for c in columns} | (derived or {})
    absent = [c for c in new if c not in target.columns]
    if absent:
        raise ContractError(f"target lacks columns: {', '.join(absent)}")
    return joined.select(
        *[
            F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c)
            for c in target.columns
        ]
    )


def previous_day_update(
    df: DataFrame,
    keys: list[str],
    columns: list[str] | None = None,
    suffix: str = "_lag_1d",
) -> DataFrame:
    """Set the lag columns from the row of the same hour one day before.

    Rows without such a row keep their stored lag values.
    """
    columns = columns or DAILY_VARIABLES
    on = [*keys, "observed_at"]
    earlier = df.select(
        *keys,
        (F.col("observed_at") + F.expr("INTERVAL 1 DAY")).alias("observed_at"),
        *[F.col(c).alias(f"{c}{suffix}") for c in columns],
    )
    return update_from(df, earlier, on, [f"{c}{suffix}" for c in columns])
