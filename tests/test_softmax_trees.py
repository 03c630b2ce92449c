"""Spark's ensembles against the same algorithm over one NumPy matrix."""

from __future__ import annotations

import heapq

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.plans import softmax_trees as trees
from tidewatch.plans.softmax_trees import UNIT, Growth

CLASSES, FEATURES = 3, 4


def fixture_rows(n=400):
    maker = np.random.default_rng(5)
    x = np.round(maker.normal(size=(n, FEATURES)), 1)
    x[:, 3] = x[:, 0]  # ties between features
    x[::37, 2] = np.nan
    y = (x[:, 0] > 0).astype(int) + ((x[:, 1] > 0.3) & (x[:, 0] > -0.5))
    weight = np.where(y == 2, 2.0, 1.0)
    return x, y, weight, np.arange(n) // 2  # pairs of rows share a key


def as_frame(spark, x, y, weight, key, parts):
    rows = [([float(v) for v in a], int(b), float(c), int(d)) for a, b, c, d in zip(x, y, weight, key)]
    return spark.createDataFrame(rows, "x array<double>, y int, weight double, key long").repartition(parts)


class Node:
    def __init__(self, rows, depth):
        self.rows, self.depth, self.best, self.children = rows, depth, None, None


def brute(x, y, weight, key, growth):
    """Trees as plain recursion; returns the margins of all rows."""
    cuts = [np.unique(np.nanquantile(x[:, f], np.arange(1, growth.bins) / growth.bins, method="inverted_cdf")) for f in range(FEATURES)]
    codes = trees.bin_codes(x, cuts)
    margins = np.zeros((len(x), CLASSES))
    picker = np.random.default_rng(growth.seed)
    for r in range(growth.trees):
        chosen = sorted(picker.choice(FEATURES, max(1, round(growth.feature_share * FEATURES)), replace=False))
        g, h = trees.gradients(margins, y, weight)
        inside = trees._uniform(key, r) < growth.subsample
        step = np.zeros_like(margins)
        for k in range(CLASSES):
            gk, hk = g[:, k], h[:, k]

            def score(rows):
                return (gk[rows].sum() / UNIT) ** 2 / (hk[rows].sum() / UNIT + growth.l2)

            def search(node):
                used = node.rows[inside[node.rows]]
                for f in chosen:
                    for b in range(growth.bins):
                        left, right = used[codes[used, f] <= b], used[codes[used, f] > b]
                        if not len(left) or not len(right) or min(hk[left].sum(), hk[right].sum()) / UNIT < growth.least_h:
                            continue
                        gain = score(left) + score(right) - score(used)
                        if gain > 0 and (node.best is None or gain > node.best[0]):
                            node.best = (gain, f, b)

            root = Node(np.arange(len(x)), 0)
            search(root)
            leaves, waiting, order = [root], [(-root.best[0], 0, root)] if root.best else [], 1
            bound = growth.leaves or 1 << growth.max_depth
            while waiting and len(leaves) < bound:
                _, _, node = heapq.heappop(waiting)
                _, f, b = node.best
                below = codes[node.rows, f] <= b
                leaves.remove(node)
                for rows in (node.rows[below], node.rows[~below]):
                    child = Node(rows, node.depth + 1)
                    leaves.append(child)
                    if child.depth < growth.max_depth:
                        search(child)
                        if child.best:
                            heapq.heappush(waiting, (-child.best[0], order, child))
                            order += 1
            for leaf in leaves:
                used = leaf.rows[inside[leaf.rows]]
                step[leaf.rows, k] = -growth.learning_rate * (gk[used].sum() / UNIT) / (hk[used].sum() / UNIT + growth.l2)
        margins += step
    return margins


@pytest.mark.parametrize("growth", [
    Growth(3, 3, 0.3, bins=8),
    Growth(4, 2, 0.3, subsample=0.7, feature_share=0.5, bins=16, l2=0.5, least_h=3.0),
    Growth(3, 4, 0.3, bins=8, leaves=5),
    Growth(2, 3, 0.5, subsample=0.8, bins=8, leaves=31),
])
def test_equal_to_numpy(spark, growth, monkeypatch):
    monkeypatch.setattr(trees, "SUBTRACT_ROWS", 0 if growth.bins == 8 else 10**6)
    x, y, weight, key = fixture_rows()
    model = trees.fit(as_frame(spark, x, y, weight, key, 3), FEATURES, CLASSES, growth)
    expected = brute(x, y, weight, key, growth)
    assert np.abs(expected).max() > 0.1
    np.testing.assert_allclose(model.margins(x), expected, atol=1e-12)
    if growth.leaves:
        assert all(sum(f < 0 for f in _reached(t)) <= growth.leaves for r in model.rounds for t in r)


def _reached(tree):
    found, waiting = [], [0]
    while waiting:
        node = waiting.pop()
        found.append(tree.feature[node])
        if tree.feature[node] >= 0:
            waiting += [tree.left[node], tree.right[node]]
    return found


def test_the_partitioning_does_not_matter(spark, monkeypatch):
    monkeypatch.setattr(trees, "STORE_EVERY", 2)
    monkeypatch.setattr(trees, "SUBTRACT_ROWS", 100)
    x, y, weight, key = fixture_rows()
    growth = Growth(5, 3, 0.3, subsample=0.8, bins=8, leaves=6)
    one, many = (trees.fit(as_frame(spark, x, y, weight, key, n), FEATURES, CLASSES, growth) for n in (1, 7))
    assert (one.margins(x) == many.margins(x)).all()


def test_save_load_and_shares(spark, tmp_path):
    x, y, weight, key = fixture_rows()
    rows = as_frame(spark, x, y, weight, key, 2)
    model = trees.fit(rows, FEATURES, CLASSES, Growth(2, 3, 0.3, bins=8))
    model.save(spark, str(tmp_path / "m"))
    again = trees.SoftmaxTrees.load(spark, str(tmp_path / "m"))
    assert (model.margins(x) == again.margins(x)).all()
    shares = np.array([r[0] for r in rows.select(again.shares(F.col("x"))).collect()])
    np.testing.assert_allclose(shares.sum(1), 1)
    assert again.importance().sum() == pytest.approx(1)


def test_no_rows_and_one_class(spark):
    none = as_frame(spark, *[a[:0] for a in fixture_rows()], 1)
    model = trees.fit(none, FEATURES, CLASSES, Growth(2, 2, 0.3))
    np.testing.assert_allclose(trees._softmax(model.margins(np.zeros((1, FEATURES)))), 1 / CLASSES)
    x, y, weight, key = fixture_rows(50)
    one = trees.fit(as_frame(spark, x, y * 0, weight, key, 1), FEATURES, 1, Growth(1, 2, 0.3))
    assert (one.margins(x) == 0).all()
