"""Jobs: driver programs over the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.scalars import (
    as_number,
    condition_of,
    hour_key,
    round_half_even,
    stamp,
    utc_timestamp,
)
from tidewatch.operators.contracts import check_feature_frame, select_contract
from tidewatch.operators.drift import (
    BINS,
    DRIFT,
    WARNING,
    drift_document,
    drift_report,
    no_baseline_report,
    psi_by_feature,
)
from tidewatch.operators.features import feature_frame
from tidewatch.operators.filters import clean_features, default_cutoff, trailing_window, until
from tidewatch.operators.joins import assert_unique, join_enrichment
from tidewatch.operators.metrics import history_and_fold_metrics, side_by_side
from tidewatch.operators.registry import (
    PRODUCTION,
    as_dry_run,
    latest_version,
    production_snapshot,
    promoted_aliases,
    promotion_decision,
    record_aliases,
)
from tidewatch.operators.windows import keep_last
from tidewatch.plans.profiles import (
    ENRICHED,
    PROFILES,
    BoostedParams,
    ForestParams,
    Profile,
)
from tidewatch.plans.training import (
    TrainingResult,
    eligible_rows,
    train_sequence,
    train_trees,
)
from tidewatch.schemas import (
    ENRICHMENT_EXPORT_COLUMNS,
    ENRICHMENT_VARIABLES,
    HISTORY_METRICS,
    SUMMARY_METRICS,
)
from tidewatch.session import materialize
from tidewatch.sinks.files import write_csv, write_json_document
from tidewatch.sinks.upsert import MODES, merge_replace, upsert_table
from tidewatch.sources.files import first_rows, last_rows
from tidewatch.sources.payload import archive_hourly, enrichment_hourly


def run_summary(rows: DataFrame, *, complete: str, time: str = "observed_at") -> DataFrame:
    """Counts before and after cleaning, enriched rows, and time bounds in one pass.

    ``complete`` is the column whose presence marks a row that cleaning keeps.
    """
    enriched = F.coalesce(*[F.col(name) for name in ENRICHMENT_VARIABLES]).isNotNull()
    return rows.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count(complete).alias("complete_rows"),
        (F.count(F.lit(1)) - F.count(complete)).alias("dropped_rows"),
        F.count_if(enriched).alias("enriched_rows"),
        F.min(time).alias("first_observed_at"),
        F.max(time).alias("last_observed_at"),
    )


def prepare_raw_rows(
    rows: DataFrame, keys: list[str], sequence: str, cutoff: str | None = None
) -> DataFrame:
    """Raw table rows: UTC time, hour key, whole codes, condition, last copy kept.

    ``sequence`` orders the copies of an hour by arrival. ``source`` and
    ``location_name`` are dropped, as the raw table does not hold them.
    """
    frame = rows.drop("source", "location_name")
    if frame.schema["observed_at"].dataType.typeName() == "string":
        frame = frame.withColumn("observed_at", utc_timestamp(F.col("observed_at")))
    frame = until(frame, cutoff)
    columns = {"id": hour_key(F.col("observed_at"))}
    if "weather_code" in frame.columns:
        code = round_half_even(as_number(frame, "weather_code"))
        columns |= {"weather_code": code, "weather_condition": condition_of(code)}
    latest = keep_last(frame, [*keys, "observed_at"], sequence).drop(sequence)
    rest = [c for c in latest.columns if c not in ("id", *keys)]
    return latest.withColumns(columns).select(
        "id", *keys, *dict.fromkeys([*rest, *[c for c in columns if c != "id"]])
    )


def feature_job(
    raw: DataFrame,
    keys: list[str],
    *,
    keep_incomplete: bool = False,
    cutoff: str | None = None,
    **layout_options,
) -> DataFrame:
    """Feature rows that may be stored. The cutoff comes after the windows, so
    labels of the last kept hours still see the hours behind it."""
    features = feature_frame(raw, keys, **layout_options)
    rows = features if keep_incomplete else clean_features(features, keys)
    rows = until(rows, cutoff)
    check_feature_frame(rows, keys)
    return rows


def feature_summary(
    raw: DataFrame,
    written: DataFrame,
    *,
    keep_incomplete: bool = False,
    cutoff: str | None = None,
) -> DataFrame:
    """One row about a feature run: rows read, written and dropped, time bounds, columns.

    Features have one row per raw row before cleaning, so the raw count serves both.
    """
    counts = raw.agg(F.count(F.lit(1)).alias("raw_rows"))
    output = written.agg(
        F.count(F.lit(1)).alias("feature_rows_written"),
        F.min("observed_at").alias("first_observed_at"),
        F.max("observed_at").alias("last_observed_at"),
    )
    return side_by_side([counts, output]).select(
        "raw_rows",
        F.col("raw_rows").alias("feature_rows_before_cleaning"),
        "feature_rows_written",
        (F.col("raw_rows") - F.col("feature_rows_written")).alias("dropped_rows"),
        F.lit(keep_incomplete).alias("keep_incomplete_rows"),
        F.lit(cutoff).cast("string").alias("max_observed_at"),
        "first_observed_at",
        "last_observed_at",
        F.array(*[F.lit(name) for name in written.columns]).alias("columns"),
    )


@dataclass(frozen=True)
class Ingested:
    raw_rows: int
    feature_rows: int


def ingest_job(
    spark: SparkSession,
    archive: DataFrame,
    enrichment: DataFrame,
    keys: list[str],
    *,
    start_date: str,
    end_date: str,
    raw_path: str,
    feature_path: str,
    mode: str = "replace",
    location_name: str = "",
    sequence: str | None = None,
    cutoff: str | None = None,
) -> Ingested:
    """Payloads to upserted raw and feature tables.

    The hourly rows and the feature rows are written once each, since an upsert
    reads its input twice. ``sequence`` names the payload column that orders
    deliveries, where they may overlap.
    """
    cutoff = cutoff or default_cutoff(end_date)
    rows = archive_hourly(archive, keys, sequence=sequence)
    if sequence is None:
        sequence, rows = "__arrival", rows.withColumn("__arrival", F.lit(0))
        feed = enrichment_hourly(enrichment, keys, start_date, end_date)
        assert_unique(feed, [*keys, "observed_at"])
    else:
        feed = enrichment_hourly(enrichment, keys, start_date, end_date, sequence=sequence)
    stamped = stamp(rows, source="archive", location_name=location_name)
    hourly = materialize(prepare_raw_rows(stamped, keys, sequence), "hourly")
    context = join_enrichment(hourly, feed, keys)
    sent_raw = load_job(spark, raw_path, until(hourly, cutoff), keys, mode=mode)
    features = materialize(feature_job(context, keys, cutoff=cutoff), "features")
    sent_features = load_job(spark, feature_path, features, keys, mode=mode)
    return Ingested(sent_raw, sent_features)


def load_job(
    spark: SparkSession, path: str, rows: DataFrame, keys: list[str], *, mode: str = "replace"
) -> int:
    """Upsert rows by series and time; ``mode`` is one of the upsert modes.

    ``rows`` is read twice (for its dates and for the merge), so it should be a
    written table or cheap to compute.
    """
    if mode not in MODES:
        raise ValueError(f"unknown upsert mode {mode!r}; use one of {', '.join(MODES)}")
    return upsert_table(spark, path, rows, [*keys, "observed_at"], mode=mode)


def backfill_job(
    archive: DataFrame,
    enrichment: DataFrame,
    keys: list[str],
    *,
    start_date: str,
    end_date: str,
    path: str | None = None,
) -> DataFrame:
    """Extremes, cloud layers and second feed per hour, in export order."""
    wanted = [c for c in ENRICHMENT_EXPORT_COLUMNS if c not in ENRICHMENT_VARIABLES]
    rows = archive_hourly(archive, keys).select(*keys, *wanted)
    feed = enrichment_hourly(enrichment, keys, start_date, end_date)
    export = select_contract(
        join_enrichment(rows, feed, keys, validate=True), ENRICHMENT_EXPORT_COLUMNS, keys
    )
    if path is not None:
        write_csv(export, path)
    return export


def train_job(
    table: DataFrame,
    keys: list[str],
    profile: str,
    params=None,
    *,
    max_rows: int | None = None,
    path: str | None = None,
    **options,
) -> TrainingResult:
    """Read, cap and train one profile.

    ``max_rows`` takes the first rows for full-history profiles and the last rows
    of the period for the enriched and sequence profiles.
    """
    chosen = PROFILES[profile]
    rows = eligible_rows(table, chosen)
    if max_rows is not None:
        pick = last_rows if chosen.newest_first else first_rows
        rows = pick(rows, ["observed_at", *keys], max_rows)
    result = _train(rows, keys, chosen, params, options)
    if path is not None:
        result.write(path)
    return result


def _train(rows, keys, profile: Profile, params, options) -> TrainingResult:
    if profile.name == "sequence":
        return train_sequence(rows, keys, params, **options)
    default = ForestParams() if profile.name == "forest" else BoostedParams()
    return train_trees(rows, keys, profile, params or default, **options)


def tracked_metrics(result: TrainingResult) -> DataFrame:
    """History and fold metrics of a run in long form."""
    return history_and_fold_metrics(
        result.history, result.folds, HISTORY_METRICS, SUMMARY_METRICS
    )


@dataclass(frozen=True)
class Registry:
    """The registry tables (see :mod:`tidewatch.operators.registry`)."""

    versions: DataFrame
    aliases: DataFrame
    run_metrics: DataFrame
    baselines: DataFrame


@dataclass(frozen=True)
class Retrained:
    drift: DataFrame
    drift_features: DataFrame | None
    training: TrainingResult
    decision: DataFrame
    aliases: DataFrame


def retrain_job(
    table: DataFrame,
    keys: list[str],
    registry: Registry,
    *,
    model_name: str,
    window_days: int = 30,
    metric: str = "f1_macro",
    min_improvement: float = 0.02,
    warning: float = WARNING,
    drift: float = DRIFT,
    promote: bool = True,
    params: BoostedParams | None = None,
    path: str | None = None,
    alias_path: str | None = None,
    **options,
) -> Retrained:
    """Drift of the newest rows, a new enriched fit, and the promotion decision.

    Drift is reported and does not stop the training. The registry must already
    list the version that this run registers; its newest version is the candidate.
    A promotion is recorded in the alias log at ``alias_path`` (see
    :func:`tidewatch.operators.registry.stored_aliases`).
    """
    rows = eligible_rows(table, ENRICHED)
    current = trailing_window(rows, window_days)
    own = F.col("model_name") == model_name
    snapshot = materialize(
        production_snapshot(
            registry.aliases.where(own),
            registry.versions.where(own),
            registry.run_metrics,
            registry.baselines,
        ),
        "snapshot",
    )
    live = snapshot.where(F.col("baseline").isNotNull()).select(F.inline("baseline"))
    features = None
    if live.isEmpty():
        report = no_baseline_report(current)
    else:
        features = psi_by_feature(
            live, current, ENRICHED.features, bins=BINS, warning=warning, drift=drift
        )
        report = drift_report(features, current)
    trained = train_trees(
        rows, keys, ENRICHED, params or BoostedParams(class_weight_power=1.0), **options
    )
    newest = latest_version(registry.versions.where(own)).select(
        F.col("version").alias("candidate_version")
    )
    candidate = trained.metrics.select(
        F.lit(model_name).alias("model_name"),
        newest.scalar().alias("candidate_version"),
        F.col(metric).alias("candidate_metric"),
        "accepted",
    )
    decision = promotion_decision(
        candidate, snapshot, metric=metric, min_improvement=min_improvement, alias=PRODUCTION
    )
    if not promote:
        decision = as_dry_run(decision)
    decision = materialize(decision, "decision")
    aliases = merge_replace(
        registry.aliases, promoted_aliases(decision), ["model_name", "alias"]
    )
    if alias_path is not None:
        record_aliases(table.sparkSession, alias_path, promoted_aliases(decision))
    if path is not None:
        document = drift_document(
            report, features, snapshot, window_days=window_days, warning=warning, drift=drift
        )
        write_json_document(document, f"{path}/drift_report")
        write_json_document(decision, f"{path}/promotion_decision")
        trained.write(f"{path}/training")
    return Retrained(report, features, trained, decision, aliases)
