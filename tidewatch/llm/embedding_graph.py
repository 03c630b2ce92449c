"""Near-equal vectors by a robust-pruned flat graph.

1. Equal vectors of one label are one class; one node stands for them.
2. The nodes of a label are split into cluster shards around centres drawn from
   them, again and again until a shard fits into a task. A node goes to its nearest
   centre and, if that is hardly farther, to the second one: the shards overlap.
3. In every shard each node takes its closest candidates and prunes those that an
   already chosen neighbour is closer to by the factor ALPHA. Adjacency lists of the
   shards are united.
4. Each node searches from its home shard's medoid: greedily with a beam, and from
   there over all neighbours within the radius until the range stops growing. United
   lists reach nodes of other shards. Hits are verified in double precision.
5. A sample of nodes is compared with all rows; if the share of their links that was
   found is below the target, the shards and the beam are doubled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import Steps
from tidewatch.llm.components import connected_components

SHARD = 2_000
CENTRES = 16
OVERLAP = 0.2
CANDIDATES = 48
DEGREE = 16
ALPHA = 1.2
BEAM = 32
QUERIES = 256
AUDITED = 512
RECALL = 0.95
TRIES = 4


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors of the usable rows; the others get none."""
    for batch in batches:
        units = []
        for label, values in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            unit = None
            if label is not None and values and None not in values:
                vector = np.array(values, np.float64)
                top = np.abs(vector).max()
                if np.isfinite(top) and top > 0:
                    vector = vector / top
                    unit = (vector / np.sqrt(vector @ vector)).tobytes()
            units.append(unit)
        yield pa.record_batch(
            [batch.column(0), batch.column(1).cast(pa.int64()), pa.array(units, pa.binary())],
            ["vec_id", "label", "unit"],
        )


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node under its nearest centre and a second one that is about as near."""
    for batch in batches:
        rows = {"shard": [], "node": [], "home": [], "unit": []}
        for shard, node, home, unit, centres in zip(*(c.to_pylist() for c in batch.columns)):
            table = np.frombuffer(b"".join(centres), np.float64).reshape(len(centres), -1)
            distance = np.sqrt(np.maximum(2 - 2 * table @ np.frombuffer(unit, np.float64), 0))
            order = np.argsort(distance, kind="stable")[:2]
            for rank, c in enumerate(order):
                if rank == 0 or distance[c] <= distance[order[0]] + OVERLAP:
                    rows["shard"].append(f"{shard}.{c}")
                    rows["node"].append(node)
                    rows["home"].append(home and rank == 0)
                    rows["unit"].append(unit)
        if rows["shard"]:
            yield pa.record_batch(
                [pa.array(rows["shard"]), pa.array(rows["node"], pa.int64()),
                 pa.array(rows["home"], pa.bool_()), pa.array(rows["unit"], pa.binary())],
                list(rows),
            )


def shards(nodes: DataFrame, size: int, steps: Steps) -> DataFrame:
    """shard, node, home and unit; every shard of at most ``size`` nodes unless it can't be split."""
    state = nodes.select(
        F.col("label").cast("string").alias("shard"), F.col("rep").alias("node"),
        F.lit(True).alias("home"), "unit",
    )
    done = None
    for _ in range(40):
        sizes = steps.save(state.groupBy("shard").agg(F.count("*").alias("size")), "sizes")
        sized = state.join(sizes, "shard")
        small = sized.where(F.col("size") <= size).select("shard", "node", "home", "unit")
        small = steps.save(small, "shards")
        done = small if done is None else done.unionByName(small)
        large = sized.where(F.col("size") > size).select("shard", "node", "home", "unit")
        if sizes.where(F.col("size") > size).isEmpty():
            return done
        draw = Window.partitionBy("shard").orderBy(F.xxhash64("node", "shard"), "node")
        centres = (
            large.withColumn("n", F.row_number().over(draw))
            .where(F.col("n") <= CENTRES)
            .groupBy("shard")
            .agg(F.collect_list("unit").alias("centres"))
        )
        state = steps.save(
            large.join(centres, "shard")
            .select("shard", "node", "home", "unit", "centres")
            .mapInArrow(_nearest, "shard string, node long, home boolean, unit binary"),
            "state",
        )
    return done.unionByName(large)


def robust_prune(points: np.ndarray) -> np.ndarray:
    """Neighbours (-1: none) of each point, at most DEGREE of its own choice and as many back."""
    n = len(points)
    most = min(CANDIDATES, n - 1)
    chosen = np.full((n, 2 * DEGREE), -1, np.int64)
    if most < 1:
        return chosen
    back: list[list[tuple[float, int]]] = [[] for _ in range(n)]
    for start in range(0, n, QUERIES):
        own = np.arange(start, min(start + QUERIES, n))
        near = points[own] @ points.T
        near[np.arange(len(own)), own] = -2
        close = np.argpartition(-near, most - 1, axis=1)[:, :most]
        gap = np.sqrt(np.maximum(2 - 2 * np.take_along_axis(near, close, 1), 0))
        order = np.argsort(gap, axis=1, kind="stable")
        close, gap = np.take_along_axis(close, order, 1), np.take_along_axis(gap, order, 1)
        alive = np.ones(close.shape, bool)
        rows = np.arange(len(own))
        for slot in range(min(DEGREE, most)):
            some = rows[alive.any(axis=1)]
            if not len(some):
                break
            pick = alive[some].argmax(axis=1)
            node = close[some, pick]
            chosen[own[some], slot] = node
            for i, v, g in zip(own[some].tolist(), node.tolist(), gap[some, pick].tolist()):
                back[v].append((g, i))
            between = np.einsum("nd,ncd->nc", points[node], points[close[some]])
            between = np.sqrt(np.maximum(2 - 2 * between, 0))
            alive[some] &= ALPHA * between > gap[some]
            alive[some, pick] = False
    for i, found in enumerate(back):
        more = [v for _, v in sorted(found) if v not in chosen[i, :DEGREE]][:DEGREE]
        chosen[i, DEGREE : DEGREE + len(more)] = more
    return chosen


def _build(shard: pd.DataFrame) -> pd.DataFrame:
    shard = shard.sort_values("node").drop_duplicates("node")
    points = np.frombuffer(b"".join(shard["unit"]), np.float64).reshape(len(shard), -1)
    nodes = shard["node"].to_numpy()
    edges = robust_prune(points.astype(np.float32))
    at, slot = np.nonzero(edges >= 0)
    return pd.DataFrame({"node": nodes[at], "next": nodes[edges[at, slot]]})


def range_search(
    points: np.ndarray, edges: np.ndarray, queries: np.ndarray, entry: int, least: float, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, point) with a product of at least ``least``."""
    n, q = len(points), len(queries)
    rows = np.arange(q)
    seen = np.zeros((q, n), bool)
    seen[:, entry] = True
    ids = np.full((q, beam), -1, np.int64)
    score = np.full((q, beam), -3.0, points.dtype)
    open_ = np.zeros((q, beam), bool)
    ids[:, 0], score[:, 0], open_[:, 0] = entry, points[queries] @ points[entry], True
    while True:
        active = rows[open_.any(axis=1)]
        if not len(active):
            break
        pick = np.where(open_[active], score[active], -4).argmax(axis=1)
        open_[active, pick] = False
        more = edges[ids[active, pick]]
        new = (more >= 0) & ~seen[active[:, None], more]
        seen[active[:, None], np.where(new, more, ids[active, pick][:, None])] = True
        gain = np.einsum("ad,amd->am", points[queries[active]], points[np.maximum(more, 0)])
        gain = np.where(new, gain, -3)
        all_ids = np.hstack([ids[active], more])
        all_score = np.hstack([score[active], gain])
        all_open = np.hstack([open_[active], new])
        top = np.argpartition(-all_score, beam - 1, axis=1)[:, :beam]
        ids[active] = np.take_along_axis(all_ids, top, 1)
        score[active] = np.take_along_axis(all_score, top, 1)
        open_[active] = np.take_along_axis(all_open, top, 1) & (score[active] > -3)
    hit = np.zeros((q, n), bool)
    at, slot = np.nonzero(score >= least)
    hit[at, ids[at, slot]] = True
    front = hit.copy()
    tried = np.zeros((q, n), bool)
    while front.any():
        at, node = np.nonzero(front)
        asked = np.zeros((q, n), bool)
        for start in range(0, len(at), 65536):
            more = edges[node[start : start + 65536]]
            who, slot = np.nonzero(more >= 0)
            asked[at[start : start + 65536][who], more[who, slot]] = True
        asked &= ~(tried | hit)
        tried |= asked
        front = np.zeros((q, n), bool)
        at, node = np.nonzero(asked)
        for start in range(0, len(at), 65536):
            a, b = at[start : start + 65536], node[start : start + 65536]
            good = np.einsum("nd,nd->n", points[queries[a]], points[b]) >= least
            front[a[good], b[good]] = True
        hit |= front
    return np.nonzero(hit)


def _search(least: float, beam: int):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["node", "member", "home"], ascending=[True, False, False])
        shard = shard.drop_duplicates("node")
        nodes = shard["node"].to_numpy()
        exact = np.frombuffer(b"".join(shard["unit"]), np.float64).reshape(len(nodes), -1)
        points = exact.astype(np.float32)
        lists = [np.unique(v) if m else v[:0] for v, m in zip(shard["next"], shard["member"])]
        edges = np.full((len(nodes), max(map(len, lists), default=0) or 1), -1, np.int64)
        for i, found in enumerate(lists):
            at = np.minimum(np.searchsorted(nodes, found), len(nodes) - 1)
            at = at[nodes[at] == found]
            edges[i, : len(at)] = at
        members = np.flatnonzero(shard["member"].to_numpy())
        middle = points[members].mean(axis=0)
        entry = int(members[np.argmax(points[members] @ middle)])
        homes = np.flatnonzero((shard["home"] & shard["member"]).to_numpy())
        first, second = [], []
        for start in range(0, len(homes), QUERIES):
            own = homes[start : start + QUERIES]
            at, node = range_search(points, edges, own, entry, least - 1e-4, beam)
            at = own[at]
            good = (at != node) & (np.einsum("nd,nd->n", exact[at], exact[node]) >= least)
            first.append(nodes[at[good]])
            second.append(nodes[node[good]])
        a = np.concatenate(first) if first else np.zeros(0, np.int64)
        b = np.concatenate(second) if second else np.zeros(0, np.int64)
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

    return run


def graph_links(nodes: DataFrame, least: float, size: int, beam: int, steps: Steps) -> DataFrame:
    """Links a < b between the nodes (label, rep, unit)."""
    placed = steps.save(shards(nodes, size, steps), "placed")
    lists = steps.save(
        placed.groupBy("shard")
        .applyInPandas(_build, "node long, next long")
        .groupBy("node")
        .agg(F.collect_set("next").alias("next")),
        "lists",
    )
    inside = placed.join(lists, "node").select(
        "shard", "node", "home", "unit", F.lit(True).alias("member"), "next"
    )
    edge = (
        placed.join(lists, "node").select("shard", F.explode("next").alias("node")).distinct()
    )
    outside = (
        edge.join(placed.select("shard", "node"), ["shard", "node"], "left_anti")
        .join(nodes.select(F.col("rep").alias("node"), "unit"), "node")
        .select("shard", "node", F.lit(False).alias("home"), "unit", F.lit(False).alias("member"),
                F.array().cast("array<long>").alias("next"))
    )
    found = (
        inside.unionByName(outside)
        .groupBy("shard")
        .applyInPandas(_search(least, beam), "a long, b long")
        .distinct()
    )
    return steps.save(found, "links")


def _compare(sample: list, least: float):
    """Links of the sample with the rows of a batch; only vectors of one length are compared."""
    by_length: dict[int, list] = {}
    for row in sample:
        by_length.setdefault(len(row.unit), []).append(row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column(2).to_pylist()
            sizes = np.array([len(u) for u in units])
            for length, rows in by_length.items():
                at = np.flatnonzero(sizes == length)
                if not len(at):
                    continue
                reps, labels = (np.array([getattr(r, k) for r in rows]) for k in ("rep", "label"))
                asked = np.frombuffer(b"".join(r.unit for r in rows), np.float64).reshape(len(rows), -1)
                other = np.frombuffer(b"".join(units[i] for i in at), np.float64).reshape(len(at), -1)
                own, label = batch.column(0).to_numpy()[at], batch.column(1).to_numpy()[at]
                near = (asked @ other.T >= least) & (labels[:, None] == label[None, :])
                i, j = np.nonzero(near & (reps[:, None] != own[None, :]))
                yield pa.record_batch(
                    [pa.array(np.minimum(reps[i], own[j])), pa.array(np.maximum(reps[i], own[j]))],
                    ["a", "b"],
                )

    return run


def audit(nodes: DataFrame, links: DataFrame, least: float, rows: int = AUDITED) -> float:
    """Share of a sample's links, found by comparing it with all nodes, that ``links`` has.

    The sample is the ``rows`` nodes with the smallest hashes.
    """
    sample = nodes.orderBy(F.xxhash64("rep"), "rep").limit(rows).collect()
    if not sample:
        return 1.0
    true = (
        nodes.select("rep", "label", "unit")
        .mapInArrow(_compare(sample, least), "a long, b long")
        .distinct()
    )
    row = true.join(links.withColumn("hit", F.lit(1)), ["a", "b"], "left").agg(
        F.count("*").alias("n"), F.count("hit").alias("hits")
    ).first()
    return row.hits / row.n if row.n else 1.0


def near_vectors(
    vectors: DataFrame, similarity: float = 0.98, size: int = SHARD, beam: int = BEAM
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of one label are linked when their cosine in double precision is at least
    ``similarity``. Null, empty, zero or non-finite vectors, rows without a label and
    rows without an id link with nothing and are their own component. Rows that repeat
    an id and vector count as rows of their own and get equal answers. No rows give no
    rows.
    """
    steps = Steps(vectors.sparkSession, "vectors")
    units = steps.save(
        vectors.select("vec_id", "label", "embedding").mapInArrow(
            _units, "vec_id long, label long, unit binary"
        ),
        "units",
    )
    usable = "unit IS NOT NULL AND vec_id IS NOT NULL"
    classes = steps.save(
        units.where(usable)
        .groupBy("label", "unit")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")),
        "classes",
    )
    # Vectors of different lengths have no cosine: they never share a shard.
    nodes = classes.select(
        F.xxhash64("label", F.length("unit")).alias("label"), "rep", "unit"
    )
    for attempt in range(TRIES):
        links = graph_links(nodes, similarity, size << attempt, beam << attempt, steps)
        if (recall := audit(nodes, links, similarity)) >= RECALL:
            break
    else:
        raise RuntimeError(f"recall {recall:.3f} is below {RECALL} after {TRIES} tries")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = (
        both.join(classes.select(F.col("rep").alias("b"), "n"), "b")
        .groupBy(F.col("a").alias("rep"))
        .agg(F.sum("n").alias("linked"))
    )
    parts = connected_components(links, steps).withColumnRenamed("node", "rep")
    answer = (
        classes.join(counts, "rep", "left")
        .join(parts, "rep", "left")
        .select(
            "label", "unit",
            (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    linked = units.where(usable).join(answer, ["label", "unit"]).select(
        "vec_id", "n_links", "component_id"
    )
    alone = units.where(f"NOT ({usable})").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
