"""Hourly tables derived from the given tables, in Spark and in SQL.

The given tables hold no hourly observations, so ``events`` is reduced to one row
per event type (the series) and hour. Values stay exact at two decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.operators.windows import lay_out
from tidewatch.schemas import CODE_CONDITIONS, ENRICHMENT_VARIABLES, HOURLY_VARIABLES

SERIES = ["series_id"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _share(total: str, size: int):
    return (F.expr(total) % size).cast("double")


def hourly_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per series and hour with events; hours without events are missing."""
    total = F.sum("event_id")
    code = (
        F.when(total % 10 == 0, 0)
        .when(total % 10 == 1, 2)
        .when(total % 10 == 2, 45)
        .when(total % 10 == 3, 53)
        .when(total % 10 == 4, 61)
        .when(total % 10 == 5, 66)
        .when(total % 10 == 6, 75)
        .when(total % 10 == 7, 80)
        .when(total % 10 == 8, 95)
        .otherwise(4)
    )
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("event_type").alias("series_id"),
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("observed_at"),
        )
        .agg(
            F.max("value").alias("temperature_2m"),
            F.min("user_id").cast("double").alias("relative_humidity_2m"),
            F.min("value").alias("dew_point_2m"),
            _share("max(event_id)", 45).alias("apparent_temperature"),
            F.when(total % 7 != 0, F.round(F.sum("value"), 2)).alias("rain"),
            code.cast("int").alias("weather_code"),
            F.max("user_id").cast("double").alias("pressure_msl"),
            _share("sum(user_id)", 90).alias("surface_pressure"),
            _share("sum(event_id)", 101).alias("cloud_cover"),
            _share("min(event_id)", 101).alias("cloud_cover_low"),
            _share("max(user_id)", 101).alias("cloud_cover_mid"),
            _share("min(user_id)", 101).alias("cloud_cover_high"),
            F.count(F.lit(1)).cast("double").alias("wind_speed_10m"),
            _share("sum(user_id)", 360).alias("wind_direction_10m"),
            (F.count(F.lit(1)) * 2).cast("double").alias("wind_gusts_10m"),
        )
    )


HOURLY_SQL = """hourly_obs AS (
  SELECT event_type AS series_id,
         CAST(date_trunc('hour', ts) AS TIMESTAMP) AS observed_at,
         max(value) AS temperature_2m,
         CAST(min(user_id) AS DOUBLE) AS relative_humidity_2m,
         min(value) AS dew_point_2m,
         CAST(max(event_id) % 45 AS DOUBLE) AS apparent_temperature,
         CASE WHEN sum(event_id) % 7 = 0 THEN NULL ELSE round(sum(value), 2) END AS rain,
         CAST(CASE sum(event_id) % 10 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 45
              WHEN 3 THEN 53 WHEN 4 THEN 61 WHEN 5 THEN 66 WHEN 6 THEN 75
              WHEN 7 THEN 80 WHEN 8 THEN 95 ELSE 4 END AS INT) AS weather_code,
         CAST(max(user_id) AS DOUBLE) AS pressure_msl,
         CAST(sum(user_id) % 90 AS DOUBLE) AS surface_pressure,
         CAST(sum(event_id) % 101 AS DOUBLE) AS cloud_cover,
         CAST(min(event_id) % 101 AS DOUBLE) AS cloud_cover_low,
         CAST(max(user_id) % 101 AS DOUBLE) AS cloud_cover_mid,
         CAST(min(user_id) % 101 AS DOUBLE) AS cloud_cover_high,
         CAST(count(*) AS DOUBLE) AS wind_speed_10m,
         CAST(sum(user_id) % 360 AS DOUBLE) AS wind_direction_10m,
         CAST(count(*) * 2 AS DOUBLE) AS wind_gusts_10m
  FROM events
  GROUP BY event_type, date_trunc('hour', ts))"""


def daily_obs(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy(*SERIES, F.to_date("observed_at").alias("obs_date")).agg(
        F.max("temperature_2m").alias("temperature_2m_max"),
        F.min("temperature_2m").alias("temperature_2m_min"),
    )


DAILY_SQL = """daily_obs AS (
  SELECT series_id, CAST(observed_at AS DATE) AS obs_date,
         max(temperature_2m) AS temperature_2m_max,
         min(temperature_2m) AS temperature_2m_min
  FROM hourly_obs
  GROUP BY series_id, CAST(observed_at AS DATE))"""


def enrichment_feed(hourly: DataFrame) -> DataFrame:
    """Second feed: daytime hours only, with gaps in its values."""
    return hourly.where(F.hour("observed_at").between(6, 18)).select(
        *SERIES,
        "observed_at",
        F.when(F.col("cloud_cover") < 80, F.col("cloud_cover") * 10).alias("cape"),
        F.when(F.col("cloud_cover_low") < 90, F.col("temperature_2m") * 30).alias(
            "freezing_level_height"
        ),
        (F.col("cloud_cover_high") / 16).alias("uv_index"),
    )


ENRICHMENT_SQL = """enrichment AS (
  SELECT series_id, observed_at,
         CASE WHEN cloud_cover < 80 THEN cloud_cover * 10 END AS cape,
         CASE WHEN cloud_cover_low < 90 THEN temperature_2m * 30 END AS freezing_level_height,
         cloud_cover_high / 16 AS uv_index
  FROM hourly_obs
  WHERE hour(observed_at) BETWEEN 6 AND 18)"""


def raw_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete raw frame: hourly rows, daily extremes and the second feed."""
    hourly = hourly_obs(spark, sf_dir)
    day = Window.partitionBy(*SERIES, F.to_date("observed_at"))
    return hourly.withColumns(
        {
            "temperature_2m_max": F.max("temperature_2m").over(day),
            "temperature_2m_min": F.min("temperature_2m").over(day),
        }
    ).withColumns(
        {
            name: F.when(F.hour("observed_at").between(6, 18), value)
            for name, value in {
                "cape": F.when(F.col("cloud_cover") < 80, F.col("cloud_cover") * 10),
                "freezing_level_height": F.when(
                    F.col("cloud_cover_low") < 90, F.col("temperature_2m") * 30
                ),
                "uv_index": F.col("cloud_cover_high") / 16,
            }.items()
        }
    )


RAW_SQL = f"""{HOURLY_SQL}, {DAILY_SQL}, {ENRICHMENT_SQL},
raw_hourly AS (
  SELECT h.*, d.temperature_2m_max, d.temperature_2m_min,
         e.cape, e.freezing_level_height, e.uv_index
  FROM hourly_obs AS h
  LEFT JOIN daily_obs AS d
    ON d.series_id = h.series_id AND d.obs_date = CAST(h.observed_at AS DATE)
  LEFT JOIN enrichment AS e
    ON e.series_id = h.series_id AND e.observed_at = h.observed_at)"""


def _day_slots(rows: DataFrame, variables: list[str], *extra) -> DataFrame:
    """One row per series and day with a 24-slot array per variable, NaN where an
    hour is missing."""
    numbers = [F.col(name).cast("double").alias(name) for name in variables]
    by_hour = F.map_from_entries(
        F.collect_list(F.struct(F.hour("observed_at"), F.struct(*numbers)))
    )
    grouped = rows.groupBy(*SERIES, F.to_date("observed_at").alias("day")).agg(
        by_hour.alias("by_hour"), *extra
    )
    start = F.unix_seconds(F.col("day").cast("timestamp"))

    def slots(name):
        return F.transform(
            F.sequence(F.lit(0), F.lit(23)),
            lambda h: F.coalesce(
                F.try_element_at("by_hour", h).getField(name), F.lit(float("nan"))
            ),
        )

    return grouped.withColumns(
        {
            "hourly_start": start,
            "hourly_end": start + 86_400,
            "hourly_interval": F.lit(3_600).cast("bigint"),
            **{name: slots(name) for name in variables},
        }
    ).drop("by_hour", "day")


def daily_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary payloads, one per series and day."""
    rows = _day_slots(
        hourly_obs(spark, sf_dir),
        HOURLY_VARIABLES,
        F.max("temperature_2m").alias("high"),
        F.min("temperature_2m").alias("low"),
    )
    return rows.withColumns(
        {
            "latitude": F.lit(41.0),
            "longitude": F.lit(29.0),
            "elevation": F.lit(32.0),
            "utc_offset_seconds": F.lit(0),
            "daily_start": F.col("hourly_start"),
            "daily_end": F.col("hourly_end"),
            "daily_interval": F.lit(86_400).cast("bigint"),
            "temperature_2m_max": F.array("high"),
            "temperature_2m_min": F.array("low"),
        }
    ).drop("high", "low")


def enrichment_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of the second feed, one per series and day."""
    return _day_slots(enrichment_feed(hourly_obs(spark, sf_dir)), ENRICHMENT_VARIABLES)


# Hours of all days with observations, the missing ones included.
SLOTS_SQL = """slots AS (
  SELECT g.series_id, CAST(41 AS DOUBLE) AS latitude, CAST(29 AS DOUBLE) AS longitude,
         CAST(32 AS DOUBLE) AS elevation, 0 AS utc_offset_seconds, g.observed_at,
         h.* EXCLUDE (series_id, observed_at), g.temperature_2m_max, g.temperature_2m_min
  FROM (SELECT *, CAST(obs_date AS TIMESTAMP) + to_hours(CAST(unnest(range(24)) AS INT))
               AS observed_at FROM daily_obs) AS g
  LEFT JOIN hourly_obs AS h ON h.series_id = g.series_id AND h.observed_at = g.observed_at)"""


def condition_sql(code: str) -> str:
    """SQL CASE that maps a numeric code to its condition."""
    cases = " ".join(f"WHEN {c} THEN '{label}'" for c, label in CODE_CONDITIONS.items())
    return f"CASE {code} {cases} END"


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persistence forecast: the current code, judged by the code 24 rows ahead."""
    layout = lay_out(
        hourly_obs(spark, sf_dir).select(*SERIES, "observed_at", "weather_code"), SERIES
    )
    return layout.select(
        *SERIES,
        "observed_at",
        F.col("weather_code").alias("predicted"),
        F.lead("weather_code", 24).over(layout.window()).alias("actual"),
    ).where("actual IS NOT NULL")


PREDICTIONS_SQL = f"""{HOURLY_SQL},
predictions AS (
  SELECT * FROM (
    SELECT series_id, observed_at, weather_code AS predicted,
           lead(weather_code, 24) OVER (PARTITION BY series_id ORDER BY observed_at) AS actual
    FROM hourly_obs) AS p
  WHERE actual IS NOT NULL)"""


def code_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_obs(spark, sf_dir).select(F.col("weather_code").alias("label")).distinct()


CLASSES_SQL = "classes AS (SELECT DISTINCT weather_code AS label FROM hourly_obs)"


def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Climatology: smoothed share of each class in the last 24 rows.

    One row per forecast with aligned arrays ``labels`` and ``shares``; the list
    of labels is one short array, collected once as a scalar subquery.
    """
    layout = lay_out(
        hourly_obs(spark, sf_dir).select(*SERIES, "observed_at", "weather_code"), SERIES
    )
    labels = code_classes(spark, sf_dir).agg(F.sort_array(F.collect_set("label"))).scalar()
    return (
        layout.select(
            *SERIES,
            "observed_at",
            F.lead("weather_code", 24).over(layout.window()).alias("actual"),
            F.collect_list("weather_code").over(layout.back(24)).alias("recent"),
        )
        .where("actual IS NOT NULL")
        .withColumn("labels", labels)
        .withColumn(
            "shares",
            F.transform(
                "labels",
                lambda c: (F.size(F.filter("recent", lambda r: r == c)) + 1).cast("double")
                / (F.size("recent") + 10).cast("double"),
            ),
        )
        .drop("recent")
    )


def long_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per forecast and class."""
    return probabilities(spark, sf_dir).select(
        *SERIES,
        "observed_at",
        "actual",
        F.inline(F.arrays_zip(F.col("labels").alias("label"), F.col("shares").alias("score"))),
    )


PROBABILITIES_SQL = f"""{PREDICTIONS_SQL}, {CLASSES_SQL},
grid AS (
  SELECT o.series_id, o.observed_at, c.label,
         CASE WHEN o.weather_code = c.label THEN 1 ELSE 0 END AS hit
  FROM hourly_obs AS o CROSS JOIN classes AS c),
h AS (
  SELECT series_id, observed_at, label, sum(hit) OVER w AS n_class, count(*) OVER w AS n_rows
  FROM grid
  WINDOW w AS (PARTITION BY series_id, label ORDER BY observed_at
               ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)),
probabilities AS (
  SELECT p.series_id, p.observed_at, p.actual, h.label,
         CAST(h.n_class + 1 AS DOUBLE) / CAST(h.n_rows + 10 AS DOUBLE) AS score
  FROM predictions AS p
  JOIN h ON h.series_id = p.series_id AND h.observed_at = p.observed_at)"""
