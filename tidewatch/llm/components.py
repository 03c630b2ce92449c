"""Connected components of a link table, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import Steps


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    ).first()
    return tuple(row)


def connected_components(links: DataFrame, steps: Steps) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for nodes with links.

    ``links`` has the columns a and b; their order and repeats do not matter. Every
    round ties all larger neighbours of a node to its smallest one, then all smaller
    ones likewise. Stars grow until nothing changes, which takes about log(n) rounds.
    Minima are combined before the shuffle, and the joins on a hot node are ordinary
    joins whose partitions Spark splits.
    """
    edges = steps.save(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = steps.save(
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")),
            "large",
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = steps.save(
            small.unionByName(least.withColumnRenamed("m", "b")).distinct(), "edges"
        )
        steps.drop(edges, large)
        edges, before, state = after, state, _state(after)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
