"""Queries for sources, sinks, scalar functions, filters and joins."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.scalars import (
    dew_point_spread,
    json_record,
    number_or_null,
    optional_number,
    round_half_even,
    stamp,
    timestamp_text,
    utc_timestamp,
    utc_timestamp_or_null,
    wind_u,
    wind_v,
)
from tidewatch.operators.contracts import select_contract
from tidewatch.operators.filters import default_cutoff, profile_rows, trailing_window, until
from tidewatch.operators.joins import (
    duplicate_keys,
    join_daily,
    join_enrichment,
    previous_day_update,
    update_from,
)
from tidewatch.operators.windows import keep_last
from tidewatch.plans.jobs import run_summary
from tidewatch.schemas import (
    DAILY_VARIABLES,
    ENRICHMENT_EXPORT_COLUMNS,
    ENRICHMENT_SCHEMA,
    ENRICHMENT_VARIABLES,
    HOURLY_VARIABLES,
)
from tidewatch.session import shared_path
from tidewatch.sinks.files import write_csv, write_json_document
from tidewatch.sinks.upsert import PARTITION, add_missing_columns, read_table, upsert_table
from tidewatch.sources.files import (
    first_rows,
    last_rows,
    read_csv,
    read_json_document,
    read_ordered,
)
from tidewatch.sources.payload import archive_hourly, clamp_range
from tidewatch.streaming.upsert import landing_stream, stream_upsert
from tidewatch.streaming.winners import log_changes, newest_rows, use_state_store
from tidewatch.workloads.inputs import (
    DAILY_SQL,
    ENRICHMENT_SQL,
    HOURLY_SQL,
    RAW_SQL,
    SERIES,
    SLOTS_SQL,
    daily_obs,
    daily_payloads,
    enrichment_feed,
    hourly_obs,
    raw_hourly,
    table,
)
from tidewatch.workloads.registry import query, r6, rounded

KEY = [*SERIES, "observed_at"]


# --- sources and file sinks -------------------------------------------------


@query("scan_csv", "SELECT * FROM events")
def csv_round_trip(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = shared_path(spark, "events-csv")
    write_csv(events, path)
    return read_csv(spark, path, events.schema)


@query(
    "scan_ordered_capped",
    "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1000",
)
def ordered_scan(spark, sf_dir):
    return read_ordered(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], 1000)


@query("head_rows", "SELECT * FROM events ORDER BY ts, event_id LIMIT 500")
def head(spark, sf_dir):
    return first_rows(table(spark, sf_dir, "events"), ["ts", "event_id"], 500)


@query(
    "tail_rows",
    "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' "
    "ORDER BY ts DESC, event_id DESC LIMIT 500",
)
def tail(spark, sf_dir):
    rows = profile_rows(table(spark, sf_dir, "events"), "2024-01-10 00:00:00", "ts")
    return last_rows(rows, ["ts", "event_id"], 500)


@query(
    "payload_expand",
    f"""WITH {HOURLY_SQL}, {DAILY_SQL}, {SLOTS_SQL}
SELECT series_id, latitude, longitude, elevation, utc_offset_seconds, observed_at,
       {", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in HOURLY_VARIABLES)},
       temperature_2m_max, temperature_2m_min
FROM slots""",
)
def payload(spark, sf_dir):
    return archive_hourly(daily_payloads(spark, sf_dir), SERIES)


@query(
    "range_clamp",
    f"""WITH {HOURLY_SQL}, {ENRICHMENT_SQL}
SELECT * FROM enrichment
WHERE observed_at >= TIMESTAMP '2024-01-05 00:00:00'
  AND observed_at < TIMESTAMP '2024-01-21 00:00:00'""",
)
def clamped(spark, sf_dir):
    feed = enrichment_feed(hourly_obs(spark, sf_dir))
    return clamp_range(feed, "2015-06-01", "2024-01-20", minimum="2024-01-05")


@query(
    "json_roundtrip",
    """SELECT user_id, count(*) AS n_events, round(sum(value), 2) AS total,
       min(ts) AS first_ts, CAST(count(DISTINCT event_type) AS INT) AS n_types,
       min(event_type) AS first_type
FROM events GROUP BY user_id""",
)
def json_document(spark, sf_dir):
    documents = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(
            F.struct(
                F.count(F.lit(1)).alias("n_events"),
                F.round(F.sum("value"), 2).alias("total"),
                F.min("ts").alias("first_ts"),
            ).alias("summary"),
            F.sort_array(F.collect_set("event_type")).alias("types"),
        )
    )
    path = shared_path(spark, "user-json")
    write_json_document(documents, path)
    return read_json_document(spark, path, documents.schema).select(
        "user_id",
        "summary.*",
        F.size("types").alias("n_types"),
        F.get("types", F.lit(0)).alias("first_type"),
    )


@query(
    "records_json",
    """SELECT event_id, '{"event_id":' || event_id
    || ',"ts":"' || CASE WHEN date_trunc('second', ts) = ts
                         THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END
    || '","value":' || CASE WHEN event_type = 'view' THEN 'null' ELSE CAST(value AS VARCHAR) END
    || ',"event_type":"' || event_type || '","note":null}' AS record
FROM events""",
)
def records(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.when(F.col("event_type") == "view", F.lit(float("nan")))
        .otherwise(F.col("value"))
        .alias("value"),
        "event_type",
        F.lit(None).cast("string").alias("note"),
    )
    return json_record(events).select(
        F.get_json_object("record", "$.event_id").cast("bigint").alias("event_id"), "record"
    )


# --- scalar functions ---------------------------------------------------------


@query(
    "ts_normalize",
    """SELECT event_id, date_trunc('second', ts) - INTERVAL 3 HOUR AS utc_ts,
       strftime(date_trunc('second', ts) - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS utc_text,
       CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS lenient_ts
FROM events""",
)
def timestamps(spark, sf_dir):
    plain = timestamp_text(F.col("ts"))
    with_zone = F.concat(plain, F.lit("+03:00"))
    doubtful = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(plain)
    utc = utc_timestamp(with_zone)
    return table(spark, sf_dir, "events").select(
        "event_id",
        utc.alias("utc_ts"),
        timestamp_text(utc).alias("utc_text"),
        utc_timestamp_or_null(doubtful).alias("lenient_ts"),
    )


@query(
    "numeric_coerce",
    """SELECT event_id,
       CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN NULL WHEN 'click' THEN NULL
            ELSE value END AS number
FROM events""",
)
def numbers(spark, sf_dir):
    text = F.col("value").cast("string")
    kind = F.col("event_type")
    damaged = (
        F.when(kind == "error", F.lit("n/a"))
        .when(kind == "view", F.lit("NaN"))
        .when(kind == "click", F.concat(text, F.lit("d")))
        .otherwise(F.concat(F.lit(" "), text))
    )
    return table(spark, sf_dir, "events").select(
        "event_id", number_or_null(damaged).alias("number")
    )


@query(
    "code_round",
    "SELECT event_id, CAST(round_even(floor(value * 2) / 2, 0) AS INT) AS code FROM events",
)
def codes(spark, sf_dir):
    halves = F.floor(F.col("value") * 2) / 2
    return table(spark, sf_dir, "events").select(
        "event_id", round_half_even(halves).alias("code")
    )


@query(
    "optional_columns",
    f"WITH {HOURLY_SQL} SELECT series_id, observed_at, rain, CAST(NULL AS DOUBLE) AS cape, "
    "CAST(NULL AS DOUBLE) AS uv_index FROM hourly_obs",
)
def optional(spark, sf_dir):
    hourly = hourly_obs(spark, sf_dir)
    return hourly.select(
        *KEY, *[optional_number(hourly, c).alias(c) for c in ("rain", "cape", "uv_index")]
    )


@query(
    "stamp_metadata",
    f"""WITH {HOURLY_SQL}
SELECT 'archive' AS source, 'harbour' AS location_name, CAST(41.0 AS DOUBLE) AS latitude,
       CAST(29.0 AS DOUBLE) AS longitude, series_id, observed_at, temperature_2m FROM hourly_obs""",
)
def stamped(spark, sf_dir):
    rows = hourly_obs(spark, sf_dir).select(*KEY, "temperature_2m")
    return stamp(
        rows, source="archive", location_name="harbour", latitude=41.0, longitude=29.0
    )


@query(
    "contract_select",
    f"WITH {RAW_SQL} SELECT series_id, {', '.join(ENRICHMENT_EXPORT_COLUMNS)} FROM raw_hourly",
)
def contract(spark, sf_dir):
    return select_contract(raw_hourly(spark, sf_dir), ENRICHMENT_EXPORT_COLUMNS, SERIES)


@query(
    "schema_evolve",
    f"""WITH {HOURLY_SQL}
SELECT h.*, {", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in (*DAILY_VARIABLES, *ENRICHMENT_VARIABLES))}
FROM hourly_obs AS h""",
)
def evolved(spark, sf_dir):
    return add_missing_columns(hourly_obs(spark, sf_dir), ENRICHMENT_SCHEMA)


# --- filters --------------------------------------------------------------------


@query(
    "cutoff_filter",
    f"WITH {HOURLY_SQL} SELECT series_id, observed_at, temperature_2m FROM hourly_obs "
    "WHERE observed_at <= TIMESTAMP '2024-01-19 23:00:00'",
)
def cutoff(spark, sf_dir):
    rows = hourly_obs(spark, sf_dir).select(*KEY, "temperature_2m")
    return until(rows, default_cutoff("2024-01-20"))


@query(
    "profile_filter",
    f"""WITH {HOURLY_SQL}
SELECT series_id, strftime(observed_at, '%Y-%m-%d %H:%M:%S') AS observed_at, temperature_2m
FROM hourly_obs
WHERE observed_at >= TIMESTAMP '2024-01-10 00:00:00' AND hour(observed_at) <> 3""",
)
def profile(spark, sf_dir):
    text = F.when(F.hour("observed_at") == 3, F.lit("unreadable")).otherwise(
        timestamp_text(F.col("observed_at"))
    )
    rows = hourly_obs(spark, sf_dir).select(
        *SERIES, text.alias("observed_at"), "temperature_2m"
    )
    return profile_rows(rows, "2024-01-10 00:00:00")


@query(
    "trailing_window",
    f"""WITH {HOURLY_SQL},
edge AS (SELECT series_id, max(observed_at) - INTERVAL 7 DAY AS from_ts
         FROM hourly_obs GROUP BY series_id)
SELECT h.series_id, h.observed_at, h.temperature_2m
FROM hourly_obs AS h JOIN edge AS e ON e.series_id = h.series_id AND h.observed_at >= e.from_ts""",
)
def trailing(spark, sf_dir):
    rows = hourly_obs(spark, sf_dir).select(*KEY, "temperature_2m")
    return trailing_window(rows, 7, SERIES)


@query(
    "trailing_window_all",
    "SELECT event_id, ts FROM events "
    "WHERE ts >= (SELECT max(ts) - INTERVAL 7 DAY FROM events)",
)
def trailing_all(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "ts")
    return trailing_window(rows, 7, column="ts")


@query(
    "run_summary",
    f"""WITH {HOURLY_SQL}, {ENRICHMENT_SQL}
SELECT count(*) AS raw_rows, count(h.rain) AS complete_rows, count(*) - count(h.rain) AS dropped_rows,
       count(*) FILTER (WHERE coalesce(e.cape, e.freezing_level_height, e.uv_index) IS NOT NULL)
         AS enriched_rows,
       min(h.observed_at) AS first_observed_at, max(h.observed_at) AS last_observed_at
FROM hourly_obs AS h
LEFT JOIN enrichment AS e ON e.series_id = h.series_id AND e.observed_at = h.observed_at""",
)
def summary(spark, sf_dir):
    return run_summary(raw_hourly(spark, sf_dir), complete="rain")


# --- joins ------------------------------------------------------------------------


@query(
    "join_daily",
    f"""WITH {HOURLY_SQL}, {DAILY_SQL}
SELECT h.series_id, h.observed_at, h.temperature_2m, d.temperature_2m_max, d.temperature_2m_min
FROM hourly_obs AS h
LEFT JOIN daily_obs AS d
  ON d.series_id = h.series_id AND d.obs_date = CAST(h.observed_at AS DATE)""",
)
def daily_join(spark, sf_dir):
    hourly = hourly_obs(spark, sf_dir)
    rows = hourly.select(*KEY, "temperature_2m")
    return join_daily(rows, daily_obs(hourly), SERIES, validate=True)


@query(
    "join_enrichment",
    f"""WITH {HOURLY_SQL}, {ENRICHMENT_SQL}
SELECT h.series_id, h.observed_at, h.temperature_2m, e.cape, e.freezing_level_height, e.uv_index
FROM hourly_obs AS h
LEFT JOIN enrichment AS e ON e.series_id = h.series_id AND e.observed_at = h.observed_at""",
)
def enrichment_join(spark, sf_dir):
    hourly = hourly_obs(spark, sf_dir)
    rows = hourly.select(*KEY, "temperature_2m")
    return join_enrichment(rows, enrichment_feed(hourly), SERIES, validate=True)


@query(
    "dup_keys",
    "SELECT user_id, event_type, count(*) AS n_rows FROM events "
    "GROUP BY user_id, event_type HAVING count(*) > 1",
)
def duplicates(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "events"), ["user_id", "event_type"])


_STORED_SQL = f"""{HOURLY_SQL}, {DAILY_SQL}, {ENRICHMENT_SQL},
stored AS (
  SELECT series_id, observed_at, temperature_2m, dew_point_2m, wind_speed_10m,
         wind_direction_10m, cloud_cover AS cape, rain AS uv_index,
         CAST(-1 AS DOUBLE) AS dew_point_spread, CAST(-1 AS DOUBLE) AS wind_u_10m,
         CAST(-1 AS DOUBLE) AS wind_v_10m
  FROM hourly_obs)"""


@query(
    "update_from_staging",
    f"""WITH {_STORED_SQL}
SELECT t.series_id, t.observed_at, t.temperature_2m, t.dew_point_2m, t.wind_speed_10m,
       t.wind_direction_10m,
       CASE WHEN e.series_id IS NULL THEN t.cape ELSE e.cape END AS cape,
       CASE WHEN e.series_id IS NULL THEN t.uv_index ELSE e.uv_index END AS uv_index,
       {r6("CASE WHEN e.series_id IS NULL THEN t.dew_point_spread "
           "ELSE t.temperature_2m - t.dew_point_2m END", "dew_point_spread")},
       {r6("CASE WHEN e.series_id IS NULL THEN t.wind_u_10m "
           "ELSE -t.wind_speed_10m * sin(radians(t.wind_direction_10m)) END", "wind_u_10m")},
       {r6("CASE WHEN e.series_id IS NULL THEN t.wind_v_10m "
           "ELSE -t.wind_speed_10m * cos(radians(t.wind_direction_10m)) END", "wind_v_10m")}
FROM stored AS t
LEFT JOIN enrichment AS e ON e.series_id = t.series_id AND e.observed_at = t.observed_at""",
)
def staged_update(spark, sf_dir):
    hourly = hourly_obs(spark, sf_dir)
    stored = hourly.select(
        *KEY,
        "temperature_2m",
        "dew_point_2m",
        "wind_speed_10m",
        "wind_direction_10m",
        F.col("cloud_cover").alias("cape"),
        F.col("rain").alias("uv_index"),
        *[F.lit(-1.0).alias(c) for c in ("dew_point_spread", "wind_u_10m", "wind_v_10m")],
    )
    speed, direction = F.col("wind_speed_10m"), F.col("wind_direction_10m")
    updated = update_from(
        stored,
        enrichment_feed(hourly),
        KEY,
        ["cape", "uv_index"],
        {
            "dew_point_spread": dew_point_spread(F.col("temperature_2m"), F.col("dew_point_2m")),
            "wind_u_10m": wind_u(speed, direction),
            "wind_v_10m": wind_v(speed, direction),
        },
    )
    return rounded(updated)


@query(
    "shift_self_join",
    f"""WITH {HOURLY_SQL}
SELECT f.series_id, f.observed_at, f.temperature_2m,
       CASE WHEN p.series_id IS NULL THEN f.dew_point_2m ELSE p.temperature_2m END
         AS temperature_2m_lag_1d
FROM hourly_obs AS f
LEFT JOIN hourly_obs AS p
  ON p.series_id = f.series_id AND p.observed_at = f.observed_at - INTERVAL 1 DAY""",
)
def shifted(spark, sf_dir):
    rows = hourly_obs(spark, sf_dir).select(
        *KEY, "temperature_2m", F.col("dew_point_2m").alias("temperature_2m_lag_1d")
    )
    return previous_day_update(rows, SERIES, ["temperature_2m"])


# --- keyed tables -------------------------------------------------------------------


@query(
    "dedup_keep_last",
    """SELECT event_type AS series_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS observed_at,
       event_id, value, user_id
FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts)
                           ORDER BY event_id DESC) = 1""",
)
def deduplicated(spark, sf_dir):
    return keep_last(_hour_events(spark, sf_dir), KEY, "event_id")


def _hour_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series_id"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("observed_at"),
        "event_id",
        "value",
        "user_id",
    )


_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("series_id", T.StringType()),
        T.StructField("observed_at", T.TimestampNTZType()),
        T.StructField("temperature_2m", T.DoubleType()),
        T.StructField("rain", T.DoubleType()),
    ]
)
_BATCHES_SQL = f"""{HOURLY_SQL},
first_batch AS (
  SELECT CAST(wind_speed_10m AS BIGINT) AS id, series_id, observed_at, temperature_2m, rain
  FROM hourly_obs WHERE observed_at < TIMESTAMP '2024-01-20 00:00:00'),
second_batch AS (
  SELECT CAST(pressure_msl AS BIGINT) AS id, series_id, observed_at,
         round(temperature_2m + 1, 2) AS temperature_2m
  FROM hourly_obs WHERE observed_at >= TIMESTAMP '2024-01-10 00:00:00')"""


def _batches(spark, sf_dir):
    """Stored rows, and an overlapping later batch with new values and no rain."""
    hourly = hourly_obs(spark, sf_dir)
    first = hourly.where("observed_at < TIMESTAMP_NTZ '2024-01-20 00:00:00'").select(
        F.col("wind_speed_10m").cast("bigint").alias("id"), *KEY, "temperature_2m", "rain"
    )
    second = hourly.where("observed_at >= TIMESTAMP_NTZ '2024-01-10 00:00:00'").select(
        F.col("pressure_msl").cast("bigint").alias("id"),
        *KEY,
        F.round(F.col("temperature_2m") + 1, 2).alias("temperature_2m"),
    )
    return first, second


def _upserted(spark, sf_dir, mode):
    path = shared_path(spark, f"upsert-{mode}")
    for batch in _batches(spark, sf_dir):
        upsert_table(spark, path, batch, KEY, mode=mode, schema=_TABLE_SCHEMA)
    return read_table(spark, path).select(*_TABLE_SCHEMA.names)


def _upsert_sql(row_id: str, rain: str) -> str:
    return f"""WITH {_BATCHES_SQL}
SELECT {row_id} AS id, coalesce(t.series_id, s.series_id) AS series_id,
       coalesce(t.observed_at, s.observed_at) AS observed_at,
       CASE WHEN s.series_id IS NULL THEN t.temperature_2m ELSE s.temperature_2m END
         AS temperature_2m,
       {rain} AS rain
FROM first_batch AS t
FULL OUTER JOIN second_batch AS s
  ON s.series_id = t.series_id AND s.observed_at = t.observed_at"""


@query(
    "upsert_keep_id",
    _upsert_sql(
        "CASE WHEN t.series_id IS NULL THEN s.id ELSE t.id END",
        "CASE WHEN s.series_id IS NULL THEN t.rain END",
    ),
)
def upsert_keeping_ids(spark, sf_dir):
    return _upserted(spark, sf_dir, "keep_id")


@query(
    "upsert_replace",
    _upsert_sql("CASE WHEN s.series_id IS NULL THEN t.id ELSE s.id END", "t.rain"),
)
def upsert_replacing(spark, sf_dir):
    return _upserted(spark, sf_dir, "replace")


@query(
    "stream_upsert",
    """WITH landed AS (
  SELECT event_type AS series_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS observed_at,
         event_id, value, 1 AS part FROM events
  UNION ALL
  SELECT event_type, CAST(date_trunc('hour', ts) AS TIMESTAMP), event_id,
         round(value + 100, 2), 2
  FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00')
SELECT series_id, observed_at, value
FROM landed
QUALIFY row_number() OVER (PARTITION BY series_id, observed_at
                           ORDER BY part DESC, event_id DESC) = 1""",
)
def streamed(spark, sf_dir):
    """Two deliveries through one stream: all hours, then corrected late hours."""
    events = _hour_events(spark, sf_dir).select(*KEY, "event_id", "value")
    corrected = events.where("observed_at >= TIMESTAMP_NTZ '2024-01-15 00:00:00'").withColumn(
        "value", F.round(F.col("value") + 100, 2)
    )
    root = shared_path(spark, "stream")
    for delivery in (events, corrected):
        delivery.write.mode("append").parquet(f"{root}/landing")
        stream_upsert(
            landing_stream(spark, f"{root}/landing", events.schema),
            f"{root}/table",
            KEY,
            sequence="event_id",
            checkpoint=f"{root}/checkpoint",
        ).awaitTermination()
    return read_table(spark, f"{root}/table").drop(PARTITION)




@query(
    "stream_newest",
    """WITH landed AS (
  SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS observed_at, event_id AS n, value, 1 AS part
  FROM events
  UNION ALL
  SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP), event_id + 1000000000000, round(value + 100, 2), 2
  FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND event_id % 3 = 0)
SELECT user_id, observed_at, n, value,
       count(DISTINCT part) OVER (PARTITION BY user_id, observed_at) AS changes
FROM landed
QUALIFY row_number() OVER (PARTITION BY user_id, observed_at ORDER BY n DESC) = 1""",
)
def streamed_winners(spark, sf_dir):
    """The newest row of each user and hour, kept as state of the stream.

    Two deliveries and a repeated one. What the stream emits is logged; the last change
    of a key is in force, and the repeated delivery changes nothing.
    """
    use_state_store(spark)
    events = table(spark, sf_dir, "events").select(
        "user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("observed_at"),
        F.col("event_id").alias("n"), "value",
    )
    late = (F.col("observed_at") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")) & (F.col("n") % 3 == 0)
    corrected = events.where(late).select(
        "user_id", "observed_at", F.col("n") + F.lit(10**12).alias("n"), F.round(F.col("value") + 100, 2).alias("value")
    ).toDF(*events.columns)
    root = shared_path(spark, "newest")
    for delivery in (events, corrected, corrected):
        delivery.write.mode("append").parquet(f"{root}/landing")
        changes = newest_rows(
            landing_stream(spark, f"{root}/landing", events.schema), ["user_id", "observed_at"], sequence="n"
        )
        log_changes(changes, f"{root}/changes", f"{root}/checkpoint").awaitTermination()
    keys = ["user_id", "observed_at"]
    return spark.read.schema(events.schema).parquet(f"{root}/changes").groupBy(*keys).agg(
        F.max("n").alias("n"), F.max_by("value", "n").alias("value"), F.count(F.lit(1)).alias("changes")
    )
