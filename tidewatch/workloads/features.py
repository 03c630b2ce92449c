"""Queries for windows, calendar and the complete feature frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.scalars import (
    calendar_columns,
    condition_of,
    condition_ordinal,
    dew_point_spread,
    hour_key,
    wind_u,
    wind_v,
)
from tidewatch.operators.features import feature_frame
from tidewatch.operators.filters import clean_features, training_rows
from tidewatch.operators.prefix import with_row_index
from tidewatch.operators.splits import label_index
from tidewatch.operators.windows import (
    daily_lags,
    lags,
    lay_out,
    rain_sums,
    rolling_means,
    rolling_std,
    sequence_windows,
    target_lead,
)
from tidewatch.schemas import (
    BASE_MODEL_FEATURES,
    CONDITION_LABELS,
    FEATURE_COLUMNS,
    REQUIRED_MODEL_COLUMNS,
    TARGET_COLUMN,
)
from tidewatch.workloads.inputs import (
    HOURLY_SQL,
    RAW_SQL,
    SERIES,
    condition_sql,
    hourly_obs,
    raw_hourly,
)
from tidewatch.workloads.registry import query, r6, rounded

KEY = [*SERIES, "observed_at"]

_W = "(PARTITION BY series_id ORDER BY observed_at)"


def _frame(rows: int) -> str:
    return (
        f"(PARTITION BY series_id ORDER BY observed_at ROWS BETWEEN {rows - 1} "
        "PRECEDING AND CURRENT ROW)"
    )


def _ordinal_sql(label: str) -> str:
    cases = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(CONDITION_LABELS))
    return f"CAST(CASE {label} {cases} END AS INT)"


_LAG_SQL = {
    "weather_code_lag_4h": f"lag(weather_code, 4) OVER {_W}",
    "weather_code_lag_12h": f"lag(weather_code, 12) OVER {_W}",
    "weather_condition_lag_4h": condition_sql(f"lag(weather_code, 4) OVER {_W}"),
    "weather_condition_lag_12h": condition_sql(f"lag(weather_code, 12) OVER {_W}"),
    "temp_lag_1h": f"lag(temperature_2m, 1) OVER {_W}",
    "temp_lag_3h": f"lag(temperature_2m, 3) OVER {_W}",
    "temp_lag_6h": f"lag(temperature_2m, 6) OVER {_W}",
    "temp_lag_24h": f"lag(temperature_2m, 24) OVER {_W}",
    "humidity_lag_1h": f"lag(relative_humidity_2m, 1) OVER {_W}",
    "pressure_lag_1h": f"lag(pressure_msl, 1) OVER {_W}",
    "pressure_change_3h": f"pressure_msl - lag(pressure_msl, 3) OVER {_W}",
    "wind_speed_lag_1h": f"lag(wind_speed_10m, 1) OVER {_W}",
}
_MEAN_SQL = {
    "temp_rolling_mean_3h": f"avg(temperature_2m) OVER {_frame(3)}",
    "temp_rolling_mean_6h": f"avg(temperature_2m) OVER {_frame(6)}",
    "temp_rolling_mean_24h": f"avg(temperature_2m) OVER {_frame(24)}",
    "humidity_rolling_mean_6h": f"avg(relative_humidity_2m) OVER {_frame(6)}",
    "wind_speed_rolling_mean_6h": f"avg(wind_speed_10m) OVER {_frame(6)}",
}
_STD_SQL = {"temp_rolling_std_24h": f"stddev_samp(temperature_2m) OVER {_frame(24)}"}
_RAIN_SQL = {
    "rain_rolling_sum_6h": f"sum(coalesce(rain, 0)) OVER {_frame(6)}",
    "rain_rolling_sum_24h": f"sum(coalesce(rain, 0)) OVER {_frame(24)}",
}
_WIND_SQL = {
    "dew_point_spread": "temperature_2m - dew_point_2m",
    "wind_u_10m": "-wind_speed_10m * sin(radians(wind_direction_10m))",
    "wind_v_10m": "-wind_speed_10m * cos(radians(wind_direction_10m))",
}
_CALENDAR_SQL = {
    "hour_of_day": "CAST(extract(hour FROM observed_at) AS INT)",
    "day_of_week": "CAST(extract(isodow FROM observed_at) - 1 AS INT)",
    "month": "CAST(extract(month FROM observed_at) AS INT)",
    "day_of_year": "CAST(extract(doy FROM observed_at) AS INT)",
    "is_weekend": "extract(isodow FROM observed_at) IN (6, 7)",
}
_TARGET_SQL = {TARGET_COLUMN: condition_sql(f"lead(weather_code, 24) OVER {_W}")}
_NOT_NUMERIC = {"weather_condition_lag_4h", "weather_condition_lag_12h", TARGET_COLUMN}


def _select(columns: dict[str, str], source: str = "hourly_obs", key: str = "series_id, observed_at") -> str:
    integers = {"weather_code_lag_4h", "weather_code_lag_12h", *_CALENDAR_SQL}
    parts = [
        f"{sql} AS {name}" if name in _NOT_NUMERIC | integers else r6(sql, name)
        for name, sql in columns.items()
    ]
    return f"SELECT {key}, {', '.join(parts)} FROM {source}"


def _with_hourly(columns: dict[str, str]) -> str:
    return f"WITH {HOURLY_SQL} {_select(columns)}"


def _windowed(spark, sf_dir, build):
    layout = lay_out(hourly_obs(spark, sf_dir), SERIES)
    columns = build(layout)
    return rounded(layout.select(*KEY, *[c.alias(name) for name, c in columns.items()]))


@query("lags", _with_hourly(_LAG_SQL))
def lag_columns(spark, sf_dir):
    return _windowed(spark, sf_dir, lags)


@query("target_lead", _with_hourly(_TARGET_SQL))
def target(spark, sf_dir):
    return _windowed(spark, sf_dir, lambda layout: {TARGET_COLUMN: target_lead(layout)})


@query("rolling_mean", _with_hourly(_MEAN_SQL))
def means(spark, sf_dir):
    return _windowed(spark, sf_dir, rolling_means)


@query("rolling_std", _with_hourly(_STD_SQL))
def deviation(spark, sf_dir):
    return _windowed(spark, sf_dir, rolling_std)


@query("rain_roll", _with_hourly({"rain": "coalesce(rain, 0)", **_RAIN_SQL}))
def rain(spark, sf_dir):
    return _windowed(
        spark,
        sf_dir,
        lambda layout: {"rain": F.coalesce("rain", F.lit(0.0)), **rain_sums(layout)},
    )


@query("wind_spread", _with_hourly(_WIND_SQL))
def wind(spark, sf_dir):
    speed, direction = F.col("wind_speed_10m"), F.col("wind_direction_10m")
    return rounded(
        hourly_obs(spark, sf_dir).select(
            *KEY,
            dew_point_spread(F.col("temperature_2m"), F.col("dew_point_2m")).alias(
                "dew_point_spread"
            ),
            wind_u(speed, direction).alias("wind_u_10m"),
            wind_v(speed, direction).alias("wind_v_10m"),
        )
    )


@query("calendar", _with_hourly(_CALENDAR_SQL))
def calendar(spark, sf_dir):
    return hourly_obs(spark, sf_dir).select(
        *KEY, *[c.alias(n) for n, c in calendar_columns(F.col("observed_at")).items()]
    )


@query(
    "code_to_condition",
    f"WITH {HOURLY_SQL} SELECT series_id, observed_at, weather_code, "
    f"{condition_sql('weather_code')} AS weather_condition FROM hourly_obs",
)
def conditions(spark, sf_dir):
    return hourly_obs(spark, sf_dir).select(
        *KEY, "weather_code", condition_of(F.col("weather_code")).alias("weather_condition")
    )


@query(
    "condition_ordinal",
    f"WITH {HOURLY_SQL} SELECT series_id, observed_at, "
    f"{_ordinal_sql(condition_sql('weather_code'))} AS condition_code FROM hourly_obs",
)
def ordinals(spark, sf_dir):
    return hourly_obs(spark, sf_dir).select(
        *KEY, condition_ordinal(condition_of(F.col("weather_code"))).alias("condition_code")
    )


_FIRST_SQL = """firsts AS (
  SELECT series_id, CAST(observed_at AS DATE) AS obs_date,
         arg_min(temperature_2m, observed_at) AS temperature_2m_first,
         arg_min(rain, observed_at) FILTER (WHERE rain IS NOT NULL) AS rain_first
  FROM hourly_obs
  GROUP BY series_id, CAST(observed_at AS DATE))"""


@query(
    "daily_lag",
    f"""WITH {HOURLY_SQL}, {_FIRST_SQL}
SELECT h.series_id, h.observed_at, f.temperature_2m_first AS temperature_2m_lag_1d,
       f.rain_first AS rain_lag_1d
FROM hourly_obs AS h
LEFT JOIN firsts AS f
  ON f.series_id = h.series_id AND f.obs_date = CAST(h.observed_at AS DATE) - 1""",
)
def previous_day(spark, sf_dir):
    return _windowed(
        spark, sf_dir, lambda layout: daily_lags(layout, ["temperature_2m", "rain"])
    )


_DERIVED_SQL = {
    **{name: name for name in FEATURE_COLUMNS if name not in ("id", "observed_at")},
    "temperature_2m_max_lag_1d": "prev_max",
    "temperature_2m_min_lag_1d": "prev_min",
    "rain": "coalesce(rain, 0)",
    **_WIND_SQL,
    "weather_condition": condition_sql("weather_code"),
    **_LAG_SQL,
    "weather_condition_lag_4h_code": _ordinal_sql(_LAG_SQL["weather_condition_lag_4h"]),
    "weather_condition_lag_12h_code": _ordinal_sql(_LAG_SQL["weather_condition_lag_12h"]),
    **_MEAN_SQL,
    **_STD_SQL,
    **_RAIN_SQL,
    **_CALENDAR_SQL,
    **_TARGET_SQL,
}
_PLAIN = {
    "weather_code",
    "weather_condition",
    "weather_code_lag_4h",
    "weather_code_lag_12h",
    "weather_condition_lag_4h_code",
    "weather_condition_lag_12h_code",
    *_NOT_NUMERIC,
    *_CALENDAR_SQL,
}


def features_sql(source: str, row_id: str) -> str:
    """CTEs that turn the raw rows ``source`` into ``features``."""
    columns = [
        f"{sql} AS {name}" if name in _PLAIN else r6(sql, name)
        for name, sql in _DERIVED_SQL.items()
    ]
    return f"""with_previous AS (
  SELECT r.*, d.temperature_2m_max AS prev_max, d.temperature_2m_min AS prev_min
  FROM {source} AS r
  LEFT JOIN daily_obs AS d
    ON d.series_id = r.series_id AND d.obs_date = CAST(r.observed_at AS DATE) - 1),
features AS (
  SELECT series_id, {row_id} AS id, observed_at, {", ".join(columns)}
  FROM with_previous)"""


FEATURES_SQL = f"{RAW_SQL}, {features_sql('raw_hourly', f'row_number() OVER {_W}')}"
REQUIRED_SQL = " AND ".join(f"{name} IS NOT NULL" for name in REQUIRED_MODEL_COLUMNS)


def features(spark, sf_dir):
    return feature_frame(raw_hourly(spark, sf_dir), SERIES)


@query("feature_frame", f"WITH {FEATURES_SQL} SELECT * FROM features")
def all_features(spark, sf_dir):
    return rounded(features(spark, sf_dir))


@query("clean_features", f"WITH {FEATURES_SQL} SELECT * FROM features WHERE {REQUIRED_SQL}")
def cleaned(spark, sf_dir):
    return rounded(clean_features(features(spark, sf_dir), SERIES))


def _as_training(name: str) -> str:
    return "CAST(is_weekend AS INT) AS is_weekend" if name == "is_weekend" else name


TRAINING_SQL = f"""{FEATURES_SQL},
training AS (
  SELECT series_id, observed_at, {", ".join(_as_training(n) for n in BASE_MODEL_FEATURES)},
         {TARGET_COLUMN}
  FROM features
  WHERE {" AND ".join(f"{n} IS NOT NULL" for n in [*BASE_MODEL_FEATURES, TARGET_COLUMN])})"""


def training(spark, sf_dir):
    rows = training_rows(features(spark, sf_dir), BASE_MODEL_FEATURES)
    return rows.select(*KEY, *BASE_MODEL_FEATURES, TARGET_COLUMN)


@query("training_frame", f"WITH {TRAINING_SQL} SELECT * FROM training")
def training_frame(spark, sf_dir):
    return rounded(training(spark, sf_dir))


@query(
    "row_index",
    f"WITH {HOURLY_SQL} SELECT series_id, observed_at, row_number() OVER {_W} - 1 AS row_index, "
    "count(*) OVER (PARTITION BY series_id) AS n_rows FROM hourly_obs",
)
def row_positions(spark, sf_dir):
    return with_row_index(hourly_obs(spark, sf_dir).select(*KEY), SERIES, count="n_rows")


@query(
    "row_key",
    "SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS id FROM events",
)
def row_keys(spark, sf_dir):
    """Keys 1..n over all events as one series."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts")
    indexed = with_row_index(events, [], ["ts", "event_id"])
    return indexed.select("event_id", "ts", (F.col("row_index") + 1).alias("id"))


@query(
    "hour_key",
    f"WITH {HOURLY_SQL} SELECT series_id, observed_at, "
    "CAST(round_even(epoch(observed_at - TIMESTAMP '2010-01-01 00:00:00') / 3600.0, 0) AS BIGINT)"
    " + 1 AS id FROM hourly_obs",
)
def hour_keys(spark, sf_dir):
    return hourly_obs(spark, sf_dir).select(*KEY, hour_key(F.col("observed_at")).alias("id"))


_SEQUENCE_COLUMNS = ["temperature_2m", "wind_speed_10m", "pressure_msl"]


@query(
    "sequence_windows",
    f"""WITH {HOURLY_SQL},
indexed AS (
  SELECT *, row_number() OVER {_W} - 1 AS pos FROM hourly_obs)
SELECT t.series_id, t.observed_at, t.weather_code, CAST(s.pos - t.pos + 24 AS INT) AS step,
       {", ".join(f"s.{c} AS {c}" for c in _SEQUENCE_COLUMNS)}
FROM indexed AS t
JOIN indexed AS s
  ON s.series_id = t.series_id AND s.pos BETWEEN t.pos - 24 AND t.pos - 1
WHERE t.pos >= 24""",
)
def sequences(spark, sf_dir):
    windows = sequence_windows(
        hourly_obs(spark, sf_dir), SERIES, _SEQUENCE_COLUMNS, "weather_code"
    )
    return windows.select(*KEY, "weather_code", F.posexplode("sequence").alias("step", "v")).select(
        *KEY,
        "weather_code",
        "step",
        *[F.get("v", F.lit(i)).alias(c) for i, c in enumerate(_SEQUENCE_COLUMNS)],
    )


@query(
    "label_index",
    f"""WITH {FEATURES_SQL}
SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INT) AS label_index
FROM (SELECT DISTINCT {TARGET_COLUMN} AS label FROM features
      WHERE {TARGET_COLUMN} IS NOT NULL) AS l""",
)
def labels(spark, sf_dir):
    rows = features(spark, sf_dir).where(F.col(TARGET_COLUMN).isNotNull())
    return label_index(rows)


