"""Columnar series payloads: one row per location, one array per variable."""

from __future__ import annotations

import functools
import operator
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalars import nan_to_null
from tidewatch.operators.joins import join_daily
from tidewatch.operators.windows import keep_last
from tidewatch.schemas import (
    DAILY_VARIABLES,
    ENRICHMENT_MIN_DATE,
    ENRICHMENT_VARIABLES,
    HOURLY_VARIABLES,
    METADATA_VARIABLES,
)


def expand_payload(
    payload: DataFrame,
    variables: list[str],
    *,
    grid: str = "hourly",
    keep: list[str] | None = None,
    instant: str = "observed_at",
) -> DataFrame:
    """One row per instant of a regular grid, array values paired by position.

    ``{grid}_start`` and ``{grid}_end`` are epoch seconds, the end is exclusive;
    ``{grid}_interval`` is the step in seconds. NaN values become NULL.
    An array whose length is not that of the grid is an error; a NULL array is missing.
    """
    start, end, step = (F.col(f"{grid}_{part}") for part in ("start", "end", "interval"))
    instants = F.when(end > start, F.sequence(start, end - F.lit(1), step)).otherwise(
        F.array().cast("array<bigint>")
    )
    lengths = [F.size(name) != F.size(instants) for name in variables]
    uneven = functools.reduce(operator.or_, [F.coalesce(wrong, F.lit(False)) for wrong in lengths])
    zipped = F.arrays_zip(instants.alias("epoch"), *[F.col(name) for name in variables])
    checked = F.when(
        uneven & (F.size(instants) > 0), F.raise_error(F.lit(f"arrays and {grid} grid differ in length"))
    ).otherwise(zipped)
    return (
        payload.select(*(keep or []), F.inline(checked).alias("epoch", *variables))
        .where(F.col("epoch").isNotNull())
        .select(
            *(keep or []),
            _epoch_to_utc(F.col("epoch")).alias(instant),
            *[nan_to_null(F.col(name)).alias(name) for name in variables],
        )
    )


def _epoch_to_utc(seconds: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", seconds, epoch)


def archive_hourly(
    payload: DataFrame, keys: list[str], *, sequence: str | None = None
) -> DataFrame:
    """Hourly rows of the primary payload with the daily extremes of their date.

    ``sequence`` names a payload column that orders deliveries. Payloads may then
    overlap: extremes come from an hour's own payload, and the column is kept so
    that the last copy can be chosen. Without it a date must occur only once.
    """
    keys = [*keys, sequence] if sequence else keys
    hourly = expand_payload(payload, HOURLY_VARIABLES, keep=[*keys, *METADATA_VARIABLES])
    daily = expand_payload(
        payload, DAILY_VARIABLES, grid="daily", keep=keys, instant="day_start"
    ).select(*keys, F.to_date("day_start").alias("obs_date"), *DAILY_VARIABLES)
    return join_daily(hourly, daily, keys, validate=True)


def enrichment_hourly(
    payload: DataFrame,
    keys: list[str],
    start_date: str,
    end_date: str,
    *,
    sequence: str | None = None,
) -> DataFrame:
    """Rows of the second feed inside the requested, clamped date range.

    With ``sequence`` the last delivery of an hour is kept.
    """
    kept = [*keys, sequence] if sequence else keys
    rows = clamp_range(
        expand_payload(payload, ENRICHMENT_VARIABLES, keep=kept), start_date, end_date
    )
    if sequence is None:
        return rows
    return keep_last(rows, [*keys, "observed_at"], sequence).drop(sequence)


def clamp_range(
    rows: DataFrame,
    start_date: str,
    end_date: str,
    *,
    minimum: str = ENRICHMENT_MIN_DATE,
    instant: str = "observed_at",
) -> DataFrame:
    """Rows from ``max(start_date, minimum)`` through the whole of ``end_date``.

    An empty range gives an empty frame that keeps its schema.
    """
    first = max(date.fromisoformat(start_date), date.fromisoformat(minimum))
    last = date.fromisoformat(end_date)
    if last < first:
        return rows.limit(0)
    lower = F.lit(f"{first} 00:00:00").cast("timestamp_ntz")
    upper = F.lit(f"{last} 00:00:00").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    return rows.where((F.col(instant) >= lower) & (F.col(instant) < upper))
