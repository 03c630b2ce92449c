"""Gradient-boosted softmax trees whose histograms are summed by Spark.

Each round adds one tree a class. The rows stay where they are: a task bins its rows'
gradients into sums per (tree, node, feature, bin), Spark adds the tasks' sums up by
``groupBy`` and searches the best split of each node in windows over the bins, and only
that split, one row a node, comes to the driver. So what is collected and broadcast
depends on the number of trees, their depth and the features, never on the rows.

Gradients are whole numbers (multiples of 2^-24), so their sums are exact: a fit does
not depend on the partitioning of the rows or the order of tasks, a recomputed task
changes nothing, and the histogram of a node's larger child is the parent's less that of
the smaller one, to the last bit.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.sizing import at_most
from tidewatch.session import drop_materialized, materialize

UNIT = 1 << 24
#: The diagonal of the softmax' second derivatives, doubled, bounds the whole matrix.
CURVATURE = 2.0
QUANTILE_ACCURACY = 10_000
#: Rounds after which the rows' margins are stored anew.
STORE_EVERY = 20
BATCH_ROWS = 2_000
#: Rows from which a node's histogram is taken from its parent's and its sibling's. The
#: difference is exact, so only the time depends on it.
SUBTRACT_ROWS = 1_000_000


@dataclass
class Tree:
    """Arrays over nodes. A leaf has feature -1. Rows at or below the threshold go left."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    g: list[int] = field(default_factory=list)
    h: list[int] = field(default_factory=list)
    n: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, g: int, h: int, n: int) -> int:
        for name, x in (("feature", -1), ("bin", 0), ("left", -1), ("right", -1), ("gain", 0.0),
                        ("g", g), ("h", h), ("n", n), ("value", 0.0)):
            getattr(self, name).append(x)
        return len(self.feature) - 1

    def split(self, node: int, best) -> tuple[int, int]:
        """Children of ``node`` after the split ``best``."""
        self.feature[node], self.bin[node], self.gain[node] = best.feature, best.bin, best.gain
        left = self.add(best.gl, best.hl, best.nl)
        right = self.add(self.g[node] - best.gl, self.h[node] - best.hl, self.n[node] - best.nl)
        self.left[node], self.right[node] = left, right
        return left, right


def _walk(tree: Tree, codes: np.ndarray) -> np.ndarray:
    """Node that each row of bin codes ends in."""
    feature, bins = np.array(tree.feature), np.array(tree.bin)
    left, right = np.array(tree.left), np.array(tree.right)
    at, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
    while True:
        inner = feature[at] >= 0
        if not inner.any():
            return at
        below = codes[rows, np.maximum(feature[at], 0)] <= bins[at]
        at = np.where(inner, np.where(below, left[at], right[at]), at)


def _softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def bin_codes(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin of each value: the number of cuts below it; missing values come last."""
    codes = np.empty(values.shape, np.uint8)
    for f, edges in enumerate(cuts):
        codes[:, f] = np.searchsorted(edges, values[:, f], side="left")
    return codes


@dataclass
class SoftmaxTrees:
    """A fitted ensemble: ``rounds`` holds one tree a class, ``cuts`` the bins' upper bounds."""

    classes: int
    cuts: list[np.ndarray]
    rounds: list[list[Tree]]

    def margins(self, values: np.ndarray, first: int = 0, end: int | None = None) -> np.ndarray:
        return _margins(self.rounds[first:end], bin_codes(values, self.cuts), self.classes)

    def shares(self, features: Column) -> Column:
        """Probabilities of all classes from an array of features."""
        shared = SparkSession.active().sparkContext.broadcast(self)

        @F.pandas_udf("array<double>")
        def score(batch):
            import pandas as pd

            parts = []
            for start in range(0, len(batch), BATCH_ROWS):
                rows = np.stack(batch.iloc[start : start + BATCH_ROWS].to_numpy()).astype(float)
                parts += list(_softmax(shared.value.margins(rows)))
            return pd.Series(parts)

        return score(features)

    def importance(self) -> np.ndarray:
        """Share of the total gain that the splits on each feature have."""
        total = np.zeros(len(self.cuts))
        for trees in self.rounds:
            for tree in trees:
                for f, gain in zip(tree.feature, tree.gain):
                    if f >= 0:
                        total[f] += gain
        return total / (total.sum() or 1.0)

    def save(self, spark: SparkSession, path: str) -> None:
        """Nodes as a table, cuts and sizes as one JSON row."""
        nodes = [
            (r, k, i, tree.feature[i], tree.bin[i], tree.left[i], tree.right[i], tree.gain[i], tree.value[i])
            for r, trees in enumerate(self.rounds) for k, tree in enumerate(trees) for i in range(len(tree.feature))
        ]
        spark.createDataFrame(
            nodes, "round int, class int, node int, feature int, bin int, left int, right int, gain double, value double"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        head = json.dumps({"classes": self.classes, "cuts": [c.tolist() for c in self.cuts], "rounds": len(self.rounds)})
        spark.createDataFrame([(head,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/head")

    @staticmethod
    def load(spark: SparkSession, path: str) -> SoftmaxTrees:
        head = json.loads(spark.read.text(f"{path}/head").first()[0])
        rounds = [[Tree() for _ in range(head["classes"])] for _ in range(head["rounds"])]
        for r in spark.read.parquet(f"{path}/nodes").orderBy("round", "class", "node").collect():
            tree = rounds[r["round"]][r["class"]]
            tree.add(0, 0, 0)
            for name in ("feature", "bin", "left", "right", "gain", "value"):
                getattr(tree, name)[-1] = r[name]
        return SoftmaxTrees(head["classes"], [np.array(c) for c in head["cuts"]], rounds)


def _margins(rounds: list[list[Tree]], codes: np.ndarray, classes: int) -> np.ndarray:
    out = np.zeros((len(codes), classes))
    for trees in rounds:
        for k, tree in enumerate(trees):
            out[:, k] += np.array(tree.value)[_walk(tree, codes)]
    return out


def quantile_cuts(rows: DataFrame, size: int, bins: int) -> list[np.ndarray]:
    """At most ``bins - 1`` different cuts a feature, from one aggregate over all rows."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    found = rows.agg(*[
        F.percentile_approx(F.when(~F.isnan(F.col("x")[f]), F.col("x")[f]), shares, QUANTILE_ACCURACY).alias(f"f{f}")
        for f in range(size)
    ]).first()
    return [np.unique(np.array(q or [], float)) for q in found]


def _uniform(keys: np.ndarray, salt: int) -> np.ndarray:
    """Number in [0, 1) for each row key, the same whenever a row is read."""
    x = keys.astype(np.int64).view(np.uint64) + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / 2**53


def gradients(margins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the weighted log loss, in whole UNITs."""
    p = _softmax(margins)
    hit = np.zeros_like(p)
    hit[np.arange(len(p)), y] = 1.0
    g = np.rint((p - hit) * weight[:, None] * UNIT).astype(np.int64)
    h = np.rint(CURVATURE * p * (1 - p) * weight[:, None] * UNIT).astype(np.int64)
    return g, h


class Batch:
    """Columns of stored rows as matrices."""

    def __init__(self, batch: pa.RecordBatch, features: int, classes: int):
        n = batch.num_rows
        self.codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(n, features)
        self.y = batch.column("y").to_numpy()
        self.weight = batch.column("weight").to_numpy()
        self.key = batch.column("key").to_numpy()
        self.margins = batch.column("margins").flatten().to_numpy().reshape(n, classes)


def _histograms(batches, plan: dict) -> Iterator[pa.RecordBatch]:
    """Sums of one task for the wanted nodes of the round's unfinished trees."""
    features, classes, bins = plan["features"], plan["classes"], plan["bins"]
    slots = {(k, node): s for s, (k, node) in enumerate(plan["wanted"])}
    chosen = np.array(plan["chosen"])
    width = len(chosen) * bins
    sums = np.zeros((3, len(slots) * width))
    total = np.zeros((3, len(slots) * width), np.int64)
    pending = 0
    for raw in batches:
        if not raw.num_rows:
            continue
        rows = Batch(raw, features, classes)
        inside = _uniform(rows.key, plan["round"]) < plan["subsample"]
        margins = rows.margins + _margins(plan["since"], rows.codes, classes)
        g, h = gradients(margins, rows.y, rows.weight)
        base = np.arange(len(chosen)) * bins + rows.codes[:, chosen].astype(np.int64)
        for k, tree in enumerate(plan["growing"]):
            lookup = np.full(len(tree.feature), -1)
            for node in range(len(tree.feature)):
                lookup[node] = slots.get((k, node), -1)
            if (lookup < 0).all():
                continue
            slot = lookup[_walk(tree, rows.codes)]
            use = np.flatnonzero((slot >= 0) & inside)
            cell = (slot[use, None] * width + base[use]).ravel()
            for i, values in enumerate((g[use, k], h[use, k], np.ones(len(use)))):
                sums[i] += np.bincount(cell, np.repeat(values, len(chosen)).astype(float), sums.shape[1])
        pending += raw.num_rows
        if pending > 1 << 24:  # doubles hold the sums of so many rows exactly
            total += sums.astype(np.int64)
            sums[:], pending = 0, 0
    total += sums.astype(np.int64)
    full = np.flatnonzero(total[2])
    slot, rest = np.divmod(full, width)
    place, bin_ = np.divmod(rest, bins)
    yield pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (slot.astype("<i4"), chosen[place].astype("<i4"), bin_.astype("<i4"),
                               *(t[full] for t in total))],
        ["slot", "feature", "bin", "g", "h", "n"],
    )


CELLS = "slot int, feature int, bin int, g long, h long, n long"


def cells_of(state: DataFrame, plan: dict) -> DataFrame:
    shared = state.sparkSession.sparkContext.broadcast(plan)
    parts = state.mapInArrow(lambda batches: _histograms(batches, shared.value), CELLS)
    # A task sends a cell once, so one shuffle serves the sums and the windows over bins.
    return parts.repartition("slot", "feature").groupBy("slot", "feature", "bin").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")
    )


SEARCH = """
WITH sums AS (
  SELECT slot, feature, bin, sum(g) OVER u AS gl, sum(h) OVER u AS hl, sum(n) OVER u AS nl,
         sum(g) OVER w AS ga, sum(h) OVER w AS ha, sum(n) OVER w AS na
  FROM {cells}
  WINDOW u AS (PARTITION BY slot, feature ORDER BY bin), w AS (PARTITION BY slot, feature)),
scaled AS (
  SELECT *, gl / {unit} AS lg, hl / {unit} AS lh, (ga - gl) / {unit} AS rg, (ha - hl) / {unit} AS rh,
         ga / {unit} AS ag, ha / {unit} AS ah
  FROM sums),
ranked AS (
  SELECT *, CASE WHEN nl < na AND lh >= {least} AND rh >= {least}
                 THEN lg * lg / (lh + {l2}) + rg * rg / (rh + {l2}) - ag * ag / (ah + {l2})
                 ELSE -1.0D END AS gain
  FROM scaled),
best AS (
  SELECT slot, max(struct(gain, -feature AS f, -bin AS b, gl, hl, nl, ga, ha, na)) AS top
  FROM ranked GROUP BY slot)
SELECT slot, top.gain, -top.f AS feature, -top.b AS bin, top.gl, top.hl, top.nl, top.ga, top.ha, top.na
FROM best
"""


def best_splits(cells: DataFrame, l2: float, least_h: float) -> DataFrame:
    """The best split of each node: one row a slot, gain 0 or less where none is allowed.

    Of equal gains the first feature's first bin is taken.
    """
    return cells.sparkSession.sql(
        SEARCH, cells=cells, unit=float(UNIT), l2=float(l2), least=float(least_h)
    )


@dataclass(frozen=True)
class Growth:
    """How trees grow. ``leaves`` bounds them best-first by gain; without it, by depth alone."""

    trees: int
    max_depth: int
    learning_rate: float
    subsample: float = 1.0
    feature_share: float = 1.0
    l2: float = 1.0
    least_h: float = 1.0
    bins: int = 64
    leaves: int | None = None
    seed: int = 42


def fit(rows: DataFrame, features: int, classes: int, growth: Growth) -> SoftmaxTrees:
    """Fit ``x`` (array of doubles), ``y`` (class index), ``weight`` and ``key`` (long).

    ``key`` picks the rows of a round: rows of one key are in or out together. No rows
    give an ensemble of bare roots, whose shares are all equal.
    """
    cuts = quantile_cuts(rows, features, growth.bins)
    start = F.array_repeat(F.lit(0.0), classes)

    def code(batches):
        for batch in batches:
            values = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(float)
            codes = bin_codes(values.reshape(batch.num_rows, features), cuts)
            packed = pa.array([row.tobytes() for row in codes], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [packed, *(batch.column(c) for c in ("y", "weight", "key"))], ["codes", "y", "weight", "key"]
            )

    coded = rows.select(
        F.transform("x", lambda v: F.coalesce(v, F.lit(float("nan")))).alias("x"),
        F.col("y").cast("int").alias("y"), F.col("weight").cast("double").alias("weight"), F.col("key").cast("long").alias("key"),
    ).mapInArrow(code, "codes binary, y int, weight double, key long")
    state = materialize(coded.withColumn("margins", start), "boosting")
    model = SoftmaxTrees(classes, cuts, [])
    stored = 0
    subtract = growth.leaves is not None and not at_most(state, SUBTRACT_ROWS)
    picker = np.random.default_rng(growth.seed)
    for r in range(growth.trees):
        if r - stored >= STORE_EVERY:
            state, stored = _store_margins(state, model, stored, features), r
        chosen = sorted(picker.choice(features, max(1, round(growth.feature_share * features)), replace=False).tolist())
        plan = {
            "features": features, "classes": classes, "bins": growth.bins, "round": r,
            "chosen": chosen, "subsample": growth.subsample, "since": model.rounds[stored:],
        }
        model.rounds.append(_grow(state, plan, growth, subtract))
    drop_materialized(state)
    return model


def _store_margins(state: DataFrame, model: SoftmaxTrees, stored: int, features: int) -> DataFrame:
    shared = state.sparkSession.sparkContext.broadcast(model.rounds[stored:])
    classes = model.classes

    def advance(batches):
        for raw in batches:
            if not raw.num_rows:
                continue
            rows = Batch(raw, features, classes)
            margins = rows.margins + _margins(shared.value, rows.codes, classes)
            offsets = pa.array((np.arange(len(margins) + 1) * classes).astype("<i4"))
            yield pa.RecordBatch.from_arrays(
                [*(raw.column(c) for c in ("codes", "y", "weight", "key")),
                 pa.ListArray.from_arrays(offsets, pa.array(margins.ravel()))],
                ["codes", "y", "weight", "key", "margins"],
            )

    after = materialize(state.mapInArrow(advance, state.schema), "boosting")
    drop_materialized(state)
    return after


def _grow(state: DataFrame, plan: dict, growth: Growth, subtract: bool) -> list[Tree]:
    """One tree a class, level by level, all classes in one job a level.

    Best-first growth comes to the same trees: a node's best split depends on its rows
    alone, so the levels are searched first and the splits then taken in order of gain.
    """
    trees = [Tree() for _ in range(plan["classes"])]
    for tree in trees:
        tree.add(0, 0, 0)
    level = [(k, 0) for k in range(len(trees))]
    sibling: dict = {}
    held: DataFrame | None = None
    for depth in range(growth.max_depth):
        if not level:
            break
        now = plan | {"growing": trees}
        if subtract:
            cells = held = _level_cells(state, now, level, sibling, held)
        else:
            cells = cells_of(state, now | {"wanted": level})
        found = best_splits(cells, growth.l2, growth.least_h).collect()
        before, level, sibling = level, [], {}
        for best in sorted(found, key=lambda b: b.slot):
            k, node = before[best.slot]
            tree = trees[k]
            if node == 0:
                tree.g[0], tree.h[0], tree.n[0] = best.ga, best.ha, best.na
            if best.gain > 0:
                left, right = tree.split(node, best)
                small, large = (left, right) if tree.n[left] <= tree.n[right] else (right, left)
                sibling[k, large] = (best.slot, small)
                level += [(k, left), (k, right)]
    if held is not None:
        drop_materialized(held)
    for tree in trees:
        if growth.leaves is not None:
            _best_first(tree, growth.leaves)
        for node in range(len(tree.feature)):
            tree.value[node] = -growth.learning_rate * (tree.g[node] / UNIT) / (tree.h[node] / UNIT + growth.l2)
    return trees


def _level_cells(state, plan, level, sibling, held) -> DataFrame:
    """Stored sums of the level's nodes, those of large children by subtraction."""
    small = [pair for pair in level if pair not in sibling]
    cells = cells_of(state, plan | {"wanted": small})
    slot_of = {pair: s for s, pair in enumerate(level)}
    if held is not None:
        spark = state.sparkSession
        # Slots of the small children, and of the large ones they are taken from.
        own = [(small.index(pair), slot_of[pair], 1) for pair in small]
        taken = [(small.index((k, other)), slot_of[k, large], -1) for (k, large), (_, other) in sibling.items()]
        parents = [(parent, slot_of[pair], 1) for pair, (parent, _) in sibling.items()]
        deal = "of int, slot int, sign int"

        def dealt(rows: DataFrame, pairs: list) -> DataFrame:
            table = F.broadcast(spark.createDataFrame(pairs, deal))
            return rows.withColumnRenamed("slot", "of").join(table, "of").select(
                "slot", "feature", "bin", *[(F.col(c) * F.col("sign")).alias(c) for c in "ghn"]
            )

        parts = dealt(cells, own + taken).unionByName(dealt(held, parents))
        cells = parts.groupBy("slot", "feature", "bin").agg(
            *[F.sum(c).alias(c) for c in "ghn"]
        ).where("n > 0")
    now = materialize(cells, "cells")
    if held is not None:
        drop_materialized(held)
    return now


def _best_first(tree: Tree, leaves: int) -> None:
    """Keep the splits that best-first growth takes before it has ``leaves`` leaves."""
    waiting, count, kept = [], 1, set()

    def offer(node: int) -> None:
        if tree.feature[node] >= 0:
            heapq.heappush(waiting, (-tree.gain[node], node))

    offer(0)
    while waiting and count < leaves:
        _, node = heapq.heappop(waiting)
        kept.add(node)
        count += 1
        offer(tree.left[node])
        offer(tree.right[node])
    for node in range(len(tree.feature)):
        if node not in kept:
            tree.feature[node], tree.gain[node] = -1, 0.0


def checkpoints(total: int, points: int = 100) -> list[int]:
    """Ensemble sizes at evenly spaced shares of the whole, the whole one last."""
    return sorted({-(-total * i // points) for i in range(1, points + 1)})


def staged_counts(
    model: SoftmaxTrees, rows: DataFrame, by: list[str], labels: list[str], points: list[int], scores: bool
) -> DataFrame:
    """Reduced counts of every ensemble size, without a row per input row.

    ``rows`` has ``x``, ``actual`` and the columns ``by``. With ``scores``: label, score,
    pos and neg of each batch's different scores; without: actual, predicted and n of
    its confusion cells. Running sums over the trees give all sizes in one pass.
    """
    shared = rows.sparkSession.sparkContext.broadcast((model, points))
    names = np.array(labels, object)
    kept = rows.select(*by, "actual", F.col("x"))
    kinds = dict(kept.dtypes)
    columns = ["label", "score", "pos", "neg"] if scores else ["actual", "predicted", "n"]
    shape = "label string, score double, pos long, neg long" if scores else "actual string, predicted string, n long"
    head = "".join(f"`{c}` {kinds[c]}, " for c in by)

    def run(batches):
        import pandas as pd

        ensemble, sizes = shared.value
        for whole in batches:
            for start in range(0, len(whole), BATCH_ROWS):
                batch = whole.iloc[start : start + BATCH_ROWS]
                codes = bin_codes(np.stack(batch["x"].to_numpy()).astype(float), ensemble.cuts)
                margins, done = np.zeros((len(batch), ensemble.classes)), 0
                for size in sizes:
                    margins += _margins(ensemble.rounds[done:size], codes, ensemble.classes)
                    done = size
                    shares = _softmax(margins)
                    if scores:
                        frame = pd.concat([
                            batch[by].assign(label=name, score=shares[:, k], pos=(batch["actual"] == name).astype("int64"))
                            for k, name in enumerate(labels)
                        ])
                        frame["neg"] = 1 - frame["pos"]
                        out = frame.groupby([*by, "label", "score"], as_index=False, dropna=False)[["pos", "neg"]].sum()
                    else:
                        frame = batch[[*by, "actual"]].assign(predicted=names[shares.argmax(1)], n=1)
                        out = frame.groupby([*by, "actual", "predicted"], as_index=False, dropna=False)["n"].sum()
                    yield out[[*by, *columns]].assign(iteration=size)

    return kept.mapInPandas(run, f"{head}{shape}, iteration int")


def feature_array(df: DataFrame) -> Column:
    return vector_to_array(F.col("features"))
