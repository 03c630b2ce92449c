"""Queries for drift and for the model registry."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidewatch.operators.daily_sketches import (
    merge_days,
    sketch_days,
    sketched_baseline,
    sketched_psi,
    store_days,
    stored_days,
)
from tidewatch.operators.drift import (
    drift_baseline,
    drift_report,
    feature_histogram,
    no_baseline_report,
    numeric_long,
    psi_by_feature,
    quantile_edges,
    quantile_shares,
)
from tidewatch.operators.registry import (
    as_dry_run,
    latest_version,
    production_snapshot,
    promoted_aliases,
    promotion_decision,
)
from tidewatch.session import materialize, shared_path
from tidewatch.sinks.upsert import merge_replace
from tidewatch.workloads.inputs import table
from tidewatch.workloads.registry import query, r6, rounded

_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "constant", "missing"]


def _items(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_shipdate",
        *_FEATURES[:4],
        F.lit(7.0).alias("constant"),
        F.lit(None).cast("double").alias("missing"),
    )


def _before(spark, sf_dir):
    return _items(spark, sf_dir).where("l_shipdate < TIMESTAMP_NTZ '1998-01-01 00:00:00'")


def _after(spark, sf_dir):
    return _items(spark, sf_dir).where("l_shipdate >= TIMESTAMP_NTZ '1998-01-01 00:00:00'")


def _long_sql(name: str, condition: str) -> str:
    parts = [f"SELECT '{c}' AS feature, {c} AS value FROM lineitem WHERE {condition}"
             for c in _FEATURES[:4]]
    parts.append(f"SELECT 'constant', CAST(7 AS DOUBLE) FROM lineitem WHERE {condition}")
    return f"{name} AS (\n  {' UNION ALL '.join(parts)})"


_OLD = _long_sql("old", "l_shipdate < TIMESTAMP '1998-01-01 00:00:00'")
_NEW = _long_sql("new", "l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'")
_SHARES = ", ".join(f"{q!r}e0" for q in quantile_shares(10))
_EDGES_SQL = f"""{_OLD},
cuts AS (
  SELECT feature, list_sort(list_distinct(quantile_cont(value, [{_SHARES}]))) AS e
  FROM old GROUP BY feature),
open_edges AS (
  SELECT feature, CASE WHEN len(e) > 1 THEN e
         WHEN e[1] = 0 THEN [e[1] - 0.5, e[1] + 0.5]
         ELSE [e[1] - greatest(abs(e[1]) * 0.01, 0.5), e[1] + greatest(abs(e[1]) * 0.01, 0.5)]
         END AS e
  FROM cuts),
edges AS (
  SELECT feature, list_concat(
           [nextafter(e[1], CAST('-inf' AS DOUBLE))], e[2:len(e) - 1],
           [nextafter(e[len(e)], CAST('inf' AS DOUBLE))]) AS e
  FROM open_edges)"""


def _binned(name: str, source: str) -> str:
    return f"""{name} AS (
  SELECT v.feature, CAST(len(list_filter(e.e[2:len(e.e) - 1], lambda x: x <= v.value)) AS INT)
         AS bin, count(*) AS n
  FROM {source} AS v JOIN edges AS e ON e.feature = v.feature
  WHERE v.value >= e.e[1] AND v.value <= e.e[len(e.e)]
  GROUP BY ALL)"""


@query(
    "quantile_edges",
    f"""WITH {_EDGES_SQL},
numbered AS (SELECT feature, e, unnest(range(len(e))) AS i FROM edges)
SELECT feature, CAST(i AS INT) AS position, {r6("e[i + 1]", "edge")} FROM numbered""",
)
def edges(spark, sf_dir):
    rows = quantile_edges(numeric_long(_before(spark, sf_dir), _FEATURES))
    return rounded(rows.select("feature", F.posexplode("edges").alias("position", "edge")))


@query(
    "feature_histogram",
    f"WITH {_EDGES_SQL}, {_NEW}, {_binned('hist', 'new')} SELECT feature, bin, n FROM hist",
)
def histogram(spark, sf_dir):
    cuts = quantile_edges(numeric_long(_before(spark, sf_dir), _FEATURES))
    return feature_histogram(numeric_long(_after(spark, sf_dir), _FEATURES), cuts)


@query(
    "drift_baseline",
    f"""WITH {_EDGES_SQL}, {_binned("hist", "old")},
bins AS (SELECT feature, e, unnest(range(len(e) - 1)) AS bin FROM edges),
totals AS (SELECT feature, CAST(sum(n) AS BIGINT) AS total FROM hist GROUP BY feature)
SELECT b.feature, CAST(b.bin AS INT) AS bin, {r6("b.e[b.bin + 1]", "lower_edge")},
       {r6("b.e[b.bin + 2]", "upper_edge")}, coalesce(h.n, 0) AS n, t.total, 'ready' AS status
FROM bins AS b
LEFT JOIN hist AS h ON h.feature = b.feature AND h.bin = b.bin
JOIN totals AS t ON t.feature = b.feature
UNION ALL
SELECT 'missing', NULL, NULL, NULL, NULL, 0, 'empty'""",
)
def baseline(spark, sf_dir):
    rows = drift_baseline(_before(spark, sf_dir), _FEATURES)
    return rounded(
        rows.select(
            "feature", "edges", "total", "status", F.posexplode_outer("counts").alias("bin", "n")
        ).select(
            "feature",
            "bin",
            F.get("edges", F.col("bin")).alias("lower_edge"),
            F.get("edges", F.col("bin") + 1).alias("upper_edge"),
            "n",
            "total",
            "status",
        )
    )


_PSI_SQL = f"""{_EDGES_SQL}, {_NEW}, {_binned("old_hist", "old")}, {_binned("new_hist", "new")},
bins AS (SELECT feature, unnest(range(len(e) - 1)) AS bin, len(e) - 1 AS k FROM edges),
counts AS (
  SELECT b.feature, b.bin, b.k, coalesce(o.n, 0) AS old_n, coalesce(w.n, 0) AS new_n,
         sum(coalesce(o.n, 0)) OVER f AS old_total, sum(coalesce(w.n, 0)) OVER f AS new_total
  FROM bins AS b
  LEFT JOIN old_hist AS o ON o.feature = b.feature AND o.bin = b.bin
  LEFT JOIN new_hist AS w ON w.feature = b.feature AND w.bin = b.bin
  WINDOW f AS (PARTITION BY b.feature)),
shares AS (
  SELECT *, CASE WHEN old_total = 0 THEN 1.0 / k
                 ELSE greatest(CAST(old_n AS DOUBLE) / old_total, 1e-6) END AS e,
         CASE WHEN new_total = 0 THEN 1.0 / k
              ELSE greatest(CAST(new_n AS DOUBLE) / new_total, 1e-6) END AS a
  FROM counts),
present AS (SELECT feature, count(*) AS n FROM new GROUP BY feature),
psi AS (
  SELECT s.feature, sum((a - e) * ln(a / e)) AS psi, CAST(max(old_total) AS BIGINT) AS old_total,
         CAST(max(new_total) AS BIGINT) AS new_total,
         max(p.n) - CAST(max(new_total) AS BIGINT) AS outside
  FROM shares AS s JOIN present AS p ON p.feature = s.feature GROUP BY s.feature),
rows AS (
  SELECT feature, CASE WHEN psi >= 0.20 THEN 'drifted' WHEN psi >= 0.10 THEN 'warning'
                       ELSE 'stable' END AS status, psi, old_total AS baseline_total,
         new_total AS current_total, outside AS current_out_of_range FROM psi
  UNION ALL
  SELECT 'missing', 'missing_baseline', NULL, NULL, NULL, NULL)"""


def _psi(spark, sf_dir):
    base = materialize(drift_baseline(_before(spark, sf_dir), _FEATURES), "baseline")
    return psi_by_feature(base, _after(spark, sf_dir), _FEATURES)


@query(
    "psi_by_feature",
    f"""WITH {_PSI_SQL}
SELECT feature, status, {r6("psi")}, baseline_total, current_total, current_out_of_range FROM rows""",
)
def psi(spark, sf_dir):
    return rounded(_psi(spark, sf_dir))


@query(
    "drift_from_days",
    f"""WITH {_PSI_SQL}
SELECT r.feature, r.status, count(*) AS n, min(v.value) AS low, max(v.value) AS high
FROM rows AS r JOIN new AS v ON v.feature = r.feature
GROUP BY r.feature, r.status""",
)
def from_days(spark, sf_dir):
    """Status from stored sketches of single days; counts and ranges are exact, ranks are not."""
    path = shared_path(spark, "days")
    store_days(sketch_days(_items(spark, sf_dir), _FEATURES, "l_shipdate"), path)
    split = datetime.date(1998, 1, 1)
    baseline = sketched_baseline(merge_days(stored_days(spark, path, last=split - datetime.timedelta(days=1))))
    current = merge_days(stored_days(spark, path, first=split))
    return sketched_psi(baseline, current).join(current, "feature").select("feature", "status", "n", "low", "high")


@query(
    "drift_report",
    f"""WITH {_PSI_SQL}
SELECT CASE WHEN count(*) FILTER (WHERE status = 'drifted') > 0 THEN 'drifted'
            WHEN count(*) FILTER (WHERE status = 'warning') > 0 THEN 'warning'
            ELSE 'stable' END AS status,
       {r6("max(psi)", "max_psi")},
       count(*) FILTER (WHERE status = 'drifted') AS drifted_feature_count,
       count(*) FILTER (WHERE status = 'warning') AS warning_feature_count,
       (SELECT count(*) FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00')
         AS current_row_count
FROM rows""",
)
def report(spark, sf_dir):
    return rounded(drift_report(_psi(spark, sf_dir), _after(spark, sf_dir)))


@query(
    "drift_no_baseline",
    """SELECT 'no_baseline' AS status, CAST(NULL AS DOUBLE) AS max_psi,
       CAST(0 AS BIGINT) AS drifted_feature_count, CAST(0 AS BIGINT) AS warning_feature_count,
       count(*) AS current_row_count
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'""",
)
def report_without_baseline(spark, sf_dir):
    return no_baseline_report(_after(spark, sf_dir))


# --- registry ---------------------------------------------------------------------
# A model per customer and a version per order; the version number is text.


def _model(column):
    return F.concat(F.lit("model_"), column.cast("string"))


def _run(column):
    return F.concat(F.lit("run_"), column.cast("string"))


def _versions(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        _model(F.col("o_custkey")).alias("model_name"),
        F.col("o_orderkey").cast("string").alias("version"),
        _run(F.col("o_orderkey")).alias("run_id"),
    )


def _run_metrics(spark, sf_dir):
    """Two metrics per run; runs of pending orders have no F1."""
    rows = table(spark, sf_dir, "orders").select(
        _run(F.col("o_orderkey")).alias("run_id"),
        F.when(
            F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice")) % 1000 / 1000.0
        ).alias("f1_macro"),
        (F.floor(F.col("o_totalprice")) % 500 / 500.0).alias("accuracy"),
    )
    return rows.unpivot(["run_id"], ["f1_macro", "accuracy"], "metric", "value").where(
        "value IS NOT NULL"
    )


def _aliases(spark, sf_dir):
    """The oldest version is live, except for models of one market segment."""
    oldest = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderkey").alias("oldest")
    )
    customers = table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'")
    return customers.join(oldest, F.col("c_custkey") == F.col("o_custkey")).select(
        _model(F.col("c_custkey")).alias("model_name"),
        F.lit("production").alias("alias"),
        F.col("oldest").cast("string").alias("version"),
    )


def _baselines(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderpriority <> '5-LOW'").select(
        _run(F.col("o_orderkey")).alias("run_id"), F.col("o_orderpriority").alias("baseline")
    )


def _snapshot(spark, sf_dir):
    return production_snapshot(
        _aliases(spark, sf_dir),
        _versions(spark, sf_dir),
        _run_metrics(spark, sf_dir),
        _baselines(spark, sf_dir),
    )


def _candidates(spark, sf_dir):
    """Newest version per customer; customers without orders have none."""
    newest = latest_version(_versions(spark, sf_dir)).withColumnRenamed(
        "version", "candidate_version"
    )
    f1 = _run_metrics(spark, sf_dir).where("metric = 'f1_macro'").select(
        "run_id", F.col("value").alias("candidate_metric")
    )
    return (
        table(spark, sf_dir, "customer")
        .select(_model(F.col("c_custkey")).alias("model_name"))
        .join(newest, "model_name", "left")
        .withColumn("run_id", _run(F.col("candidate_version")))
        .join(f1, "run_id", "left")
        .select(
            "model_name",
            "candidate_version",
            "candidate_metric",
            (F.col("candidate_metric") >= 0.4).alias("accepted"),
        )
    )


_REGISTRY_SQL = """versions AS (
  SELECT 'model_' || o_custkey AS model_name, CAST(o_orderkey AS VARCHAR) AS version,
         'run_' || o_orderkey AS run_id FROM orders),
latest AS (
  SELECT model_name, CAST(max(CAST(version AS BIGINT)) AS VARCHAR) AS version
  FROM versions GROUP BY model_name),
f1 AS (
  SELECT 'run_' || o_orderkey AS run_id,
         CAST(floor(o_totalprice) AS BIGINT) % 1000 / CAST(1000 AS DOUBLE) AS value
  FROM orders WHERE o_orderstatus <> 'P'),
aliases AS (
  SELECT 'model_' || c_custkey AS model_name, 'production' AS alias,
         CAST(min(o_orderkey) AS VARCHAR) AS version
  FROM customer JOIN orders ON o_custkey = c_custkey
  WHERE c_mktsegment <> 'BUILDING' GROUP BY c_custkey),
snapshot AS (
  SELECT a.model_name, a.alias, a.version, v.run_id, f.value AS f1_macro,
         CASE WHEN o.o_orderpriority <> '5-LOW' THEN o.o_orderpriority END AS baseline
  FROM aliases AS a
  JOIN versions AS v ON v.model_name = a.model_name AND v.version = a.version
  JOIN orders AS o ON 'run_' || o.o_orderkey = v.run_id
  LEFT JOIN f1 AS f ON f.run_id = v.run_id),
candidates AS (
  SELECT 'model_' || c.c_custkey AS model_name, l.version AS candidate_version,
         f.value AS candidate_metric
  FROM customer AS c
  LEFT JOIN latest AS l ON l.model_name = 'model_' || c.c_custkey
  LEFT JOIN f1 AS f ON f.run_id = 'run_' || l.version),
reasons AS (
  SELECT c.*, s.version AS production_version, s.f1_macro AS live,
         CASE WHEN c.candidate_version IS NULL THEN 'missing_candidate_version'
              WHEN c.candidate_metric IS NULL THEN 'missing_candidate_metric'
              WHEN c.candidate_metric < 0.4 THEN 'candidate_not_accepted'
              WHEN s.model_name IS NULL THEN 'bootstrap_no_production_alias'
              WHEN s.f1_macro IS NULL THEN 'missing_production_metric'
              WHEN c.candidate_metric >= s.f1_macro + CAST(0.02 AS DOUBLE) THEN 'metric_improved'
              ELSE 'insufficient_improvement' END AS reason
  FROM candidates AS c LEFT JOIN snapshot AS s ON s.model_name = c.model_name),
decisions AS (
  SELECT model_name, reason IN ('bootstrap_no_production_alias', 'metric_improved')
           AS should_promote,
         reason, candidate_version, production_version, candidate_metric,
         CASE WHEN reason IN ('metric_improved', 'insufficient_improvement') THEN live END
           AS production_metric,
         CAST(0.02 AS DOUBLE) AS min_improvement, 'production' AS promoted_alias
  FROM reasons)"""


@query("latest_version", f"WITH {_REGISTRY_SQL} SELECT * FROM latest")
def latest(spark, sf_dir):
    return latest_version(_versions(spark, sf_dir))


@query(
    "production_snapshot",
    f"WITH {_REGISTRY_SQL} SELECT model_name, alias, version, run_id, {r6('f1_macro')}, baseline "
    "FROM snapshot",
)
def snapshot(spark, sf_dir):
    return rounded(
        _snapshot(spark, sf_dir).select(
            "model_name",
            "alias",
            "version",
            "run_id",
            F.try_element_at("metrics", F.lit("f1_macro")).alias("f1_macro"),
            "baseline",
        )
    )


@query("promotion_decision", f"WITH {_REGISTRY_SQL} SELECT * FROM decisions")
def decision(spark, sf_dir):
    return promotion_decision(_candidates(spark, sf_dir), _snapshot(spark, sf_dir))


@query(
    "promotion_dry_run",
    f"""WITH {_REGISTRY_SQL}
SELECT model_name, false AS should_promote,
       CASE WHEN should_promote THEN 'dry_run_' || reason ELSE reason END AS reason
FROM decisions""",
)
def dry_run(spark, sf_dir):
    decisions = promotion_decision(_candidates(spark, sf_dir), _snapshot(spark, sf_dir))
    return as_dry_run(decisions).select("model_name", "should_promote", "reason")


@query(
    "alias_update",
    f"""WITH {_REGISTRY_SQL}
SELECT coalesce(a.model_name, d.model_name) AS model_name, 'production' AS alias,
       coalesce(d.candidate_version, a.version) AS version
FROM aliases AS a
FULL OUTER JOIN (SELECT * FROM decisions WHERE should_promote) AS d
  ON d.model_name = a.model_name""",
)
def alias_update(spark, sf_dir):
    decisions = promotion_decision(_candidates(spark, sf_dir), _snapshot(spark, sf_dir))
    return merge_replace(
        _aliases(spark, sf_dir), promoted_aliases(decisions), ["model_name", "alias"]
    )
