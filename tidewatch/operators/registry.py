"""Model registry as tables: versions, aliases, metrics, promotion.

``versions``: model_name, version (text), run_id.
``aliases``: model_name, alias, version.
``run_metrics``: run_id, metric, value, and optionally step.
``baselines``: run_id, baseline (any type).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PRODUCTION = "production"


def latest_version(versions: DataFrame) -> DataFrame:
    """Highest version per model, compared as a number."""
    return versions.groupBy("model_name").agg(
        F.max(F.col("version").cast("bigint")).cast("string").alias("version")
    )


def production_snapshot(
    aliases: DataFrame,
    versions: DataFrame,
    run_metrics: DataFrame,
    baselines: DataFrame,
    alias: str = PRODUCTION,
) -> DataFrame:
    """Version, run, metrics map and baseline behind an alias, one row per model.

    A metric that a run logged several times has the value of its largest step, or
    without steps the largest value.
    """
    current = aliases.where(F.col("alias") == alias).join(versions, ["model_name", "version"])
    order = F.struct("step", "value") if "step" in run_metrics.columns else F.col("value")
    newest = run_metrics.groupBy("run_id", "metric").agg(F.max_by("value", order).alias("value"))
    metrics = newest.groupBy("run_id").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("metrics")
    )
    return (
        current.join(metrics, "run_id", "left")
        .join(baselines, "run_id", "left")
        .select("model_name", "alias", "version", "run_id", "metrics", "baseline")
    )


def promotion_decision(
    candidates: DataFrame,
    snapshot: DataFrame,
    *,
    metric: str = "f1_macro",
    min_improvement: float = 0.02,
    alias: str = PRODUCTION,
) -> DataFrame:
    """Whether each candidate replaces its production model, and why.

    ``candidates``: model_name, candidate_version, candidate_metric, accepted.
    The first rule that applies decides; the production metric is reported only
    where the comparison takes place.
    """
    live = snapshot.where(F.col("alias") == alias).select(
        "model_name",
        F.col("version").alias("production_version"),
        F.try_element_at("metrics", F.lit(metric)).alias("__live"),
        F.lit(True).alias("__has_live"),
    )
    joined = candidates.join(live, "model_name", "left")
    candidate, live_metric = F.col("candidate_metric"), F.col("__live")
    reason = (
        F.when(F.col("candidate_version").isNull(), "missing_candidate_version")
        .when(candidate.isNull(), "missing_candidate_metric")
        .when(~F.coalesce("accepted", F.lit(False)), "candidate_not_accepted")
        .when(F.col("__has_live").isNull(), "bootstrap_no_production_alias")
        .when(live_metric.isNull(), "missing_production_metric")
        .when(candidate >= live_metric + F.lit(min_improvement), "metric_improved")
        .otherwise("insufficient_improvement")
    )
    compared = F.col("reason").isin("metric_improved", "insufficient_improvement")
    return joined.withColumn("reason", reason).select(
        "model_name",
        F.col("reason").isin("bootstrap_no_production_alias", "metric_improved").alias(
            "should_promote"
        ),
        "reason",
        "candidate_version",
        "production_version",
        candidate.alias("candidate_metric"),
        F.when(compared, live_metric).alias("production_metric"),
        F.lit(min_improvement).alias("min_improvement"),
        F.lit(alias).alias("promoted_alias"),
    )


def as_dry_run(decisions: DataFrame) -> DataFrame:
    """Turn promotions off and mark their reason."""
    promoted = F.col("should_promote")
    return decisions.withColumns(
        {
            "reason": F.when(promoted, F.concat(F.lit("dry_run_"), "reason")).otherwise(
                F.col("reason")
            ),
            "should_promote": F.lit(False),
        }
    )


def promoted_aliases(decisions: DataFrame) -> DataFrame:
    """Alias rows to upsert for the decisions that promote."""
    return decisions.where("should_promote AND candidate_version IS NOT NULL").select(
        "model_name",
        F.col("promoted_alias").alias("alias"),
        F.col("candidate_version").alias("version"),
    )


ALIAS_LOG = "model_name string, alias string, version string, change bigint"


def stored_aliases(spark: SparkSession, path: str) -> DataFrame:
    """The aliases in force: the last change of each one in the log at ``path``.

    A log that does not exist yet holds none.
    """
    try:
        log = spark.read.schema(ALIAS_LOG).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], ALIAS_LOG)
    return log.groupBy("model_name", "alias").agg(F.max_by("version", "change").alias("version"))


def record_aliases(spark: SparkSession, path: str, changes: DataFrame) -> int:
    """Append alias rows to the log, so that they are in force; returns their number.

    Nothing stored is rewritten: a failed append leaves the aliases as they were, and
    the log keeps who was in production when.
    """
    rows = changes.select("model_name", "alias", "version").collect()  # one per model and alias
    if not rows:
        return 0
    spark.createDataFrame([], ALIAS_LOG).write.mode("ignore").parquet(path)
    last = spark.read.schema(ALIAS_LOG).parquet(path).agg(F.max("change")).first()[0] or 0
    numbered = spark.createDataFrame([(*r, last + 1) for r in rows], ALIAS_LOG)
    numbered.coalesce(1).write.mode("append").parquet(path)
    return len(rows)
