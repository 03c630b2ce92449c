"""The feature frame: all derived columns of the hourly table in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalars import (
    as_number,
    calendar_columns,
    condition_of,
    condition_ordinal,
    dew_point_spread,
    optional_number,
    round_half_even,
    utc_timestamp,
    wind_u,
    wind_v,
)
from tidewatch.operators.contracts import require_columns
from tidewatch.operators.prefix import with_row_index
from tidewatch.operators.windows import (
    daily_lags,
    lags,
    lay_out,
    rain_sums,
    rolling_means,
    rolling_std,
    target_lead,
)
from tidewatch.schemas import (
    DAILY_VARIABLES,
    ENRICHMENT_VARIABLES,
    FEATURE_COLUMNS,
    REQUIRED_RAW_COLUMNS,
    TARGET_COLUMN,
)


def prepare_raw(df: DataFrame, keys: list[str]) -> DataFrame:
    """Typed, NaN-free input of the windows."""
    require_columns(df, REQUIRED_RAW_COLUMNS, "raw frame")
    numbers = [c for c in REQUIRED_RAW_COLUMNS if c not in ("observed_at", "weather_code")]
    observed_at = F.col("observed_at")
    if df.schema["observed_at"].dataType.typeName() == "string":
        observed_at = utc_timestamp(observed_at)
    return df.select(
        *keys,
        *([as_number(df, "id").cast("bigint").alias("id")] if "id" in df.columns else []),
        observed_at.cast("timestamp_ntz").alias("observed_at"),
        *[as_number(df, name).alias(name) for name in numbers],
        round_half_even(as_number(df, "weather_code")).alias("weather_code"),
        *[optional_number(df, name).alias(name) for name in ENRICHMENT_VARIABLES],
    )


def feature_frame(df: DataFrame, keys: list[str] | None = None, **layout_options) -> DataFrame:
    """All feature columns in contract order, the series keys in front.

    One exchange brings a series (or a chunk of a long one) together; row frames,
    the look-ahead label and the previous day's extremes are all read from it.
    Rows without an ``id`` are numbered from 1 in time order.
    """
    keys = keys or []
    rows = prepare_raw(df, keys)
    layout = lay_out(rows, keys, **layout_options)
    number = {}
    if "id" not in rows.columns:
        if layout.chunked:
            indexed = with_row_index(rows, keys, index="__position")
            layout = lay_out(indexed, keys, **layout_options)
            number = {"id": F.col("__position") + 1}
        else:
            number = {"id": F.row_number().over(layout.window()).cast("bigint")}
    derived = {
        **number,
        "dew_point_spread": dew_point_spread(F.col("temperature_2m"), F.col("dew_point_2m")),
        **daily_lags(layout, DAILY_VARIABLES),
        "rain": F.coalesce("rain", F.lit(0.0)),
        "wind_u_10m": wind_u(F.col("wind_speed_10m"), F.col("wind_direction_10m")),
        "wind_v_10m": wind_v(F.col("wind_speed_10m"), F.col("wind_direction_10m")),
        "weather_condition": condition_of(F.col("weather_code")),
        **lags(layout),
        **rolling_means(layout),
        **rolling_std(layout),
        **rain_sums(layout),
        **calendar_columns(F.col("observed_at")),
        TARGET_COLUMN: target_lead(layout),
    }
    for hours in (4, 12):
        name = f"weather_condition_lag_{hours}h"
        derived[f"{name}_code"] = condition_ordinal(derived[name])
    return layout.select(
        *keys,
        *[derived[c].alias(c) if c in derived else F.col(c) for c in FEATURE_COLUMNS],
    )
