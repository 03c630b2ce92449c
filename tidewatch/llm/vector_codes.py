"""Product codes of vectors, assigned over a lexicographic trie of distinct parts.

Every task sorts the distinct parts of its vectors into a trie: parts that begin with
the same components share a path. A depth-first walk carries, for each node, the squared
distances of its prefix to all codebook entries, so a shared prefix is added up once. A
subtree with few leaves is done in one step, level by level with one matrix row a node.
At a leaf the smallest distance gives the code, and the part's values, weighted by the
number of vectors that hold it, go into the sums of that entry. Only these sums leave the task:
at most one row for each entry of each codebook, however many vectors there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.sizing import broadcast_if_small

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
CHUNK_ROWS = 1 << 15
LEAVES = 256
#: Components are held at or below this size, so that no distance leaves 64 bits.
LARGEST = 1 << 27


def integers(rows: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(rows.astype(np.float64) * SCALE), -LARGEST, LARGEST).astype(np.int64)


class Trie:
    """Distances of all distinct parts to the entries of one codebook."""

    def __init__(self, leaves: np.ndarray, entries: np.ndarray):
        self.leaves, self.entries = leaves, entries
        # Depth at which a leaf leaves the path of the one before it.
        differs = leaves[1:] != leaves[:-1]
        self.fork = np.r_[0, np.where(differs.any(1), differs.argmax(1), leaves.shape[1])]
        self.codes = np.zeros(len(leaves), np.int64)
        self.errors = np.zeros(len(leaves), np.int64)

    def walk(self) -> None:
        # Waiting subtrees: first and last leaf, depth, distances of the common prefix.
        waiting = [(0, len(self.leaves), 0, np.zeros(len(self.entries), np.int64))]
        while waiting:
            first, end, depth, so_far = waiting.pop()
            if depth == self.leaves.shape[1] or end - first <= LEAVES:
                self._finish(first, end, depth, so_far)
                continue
            children = np.flatnonzero(self.fork[first:end] <= depth) + first
            children[:1] = first
            stops = np.r_[children[1:], end]
            if len(children) == 1:  # one way down
                waiting.append((first, end, depth + 1, so_far + self._step(first, depth)))
                continue
            for a, b in reversed(self._bundles(children, stops)):
                if b - a <= LEAVES:  # neighbours with few leaves go together
                    waiting.append((a, b, depth, so_far))
                else:
                    waiting.append((a, b, depth + 1, so_far + self._step(a, depth)))

    @staticmethod
    def _bundles(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
        bundles: list[tuple[int, int]] = []
        for a, b in zip(starts.tolist(), stops.tolist()):
            if bundles and b - bundles[-1][0] <= LEAVES:
                bundles[-1] = (bundles[-1][0], b)
            else:
                bundles.append((a, b))
        return bundles

    def _step(self, leaf: int, depth: int) -> np.ndarray:
        return (self.leaves[leaf, depth] - self.entries[:, depth]) ** 2

    def _finish(self, first: int, end: int, depth: int, so_far: np.ndarray) -> None:
        """All leaves of a small subtree, each level's nodes in one matrix."""
        fork = self.fork[first:end].copy()
        fork[0] = 0
        node = np.zeros(end - first, np.int64)
        matrix = so_far[None]
        for d in range(depth, self.leaves.shape[1]):
            heads = np.flatnonzero(fork <= d)
            parent = node[heads]
            matrix = matrix[parent] + (
                self.leaves[first + heads, d, None] - self.entries[None, :, d]
            ) ** 2
            node = np.searchsorted(heads, np.arange(end - first), side="right") - 1
        best = matrix.argmin(1)  # the first of equal ones
        self.codes[first:end] = best[node]
        self.errors[first:end] = matrix[np.arange(len(best)), best][node]


def assign(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes and errors of each row, then sums of values and numbers of rows of each entry."""
    order = np.lexsort(rows.T[::-1])
    ranked = rows[order]
    new = np.r_[True, (ranked[1:] != ranked[:-1]).any(1)]
    leaf = np.cumsum(new) - 1
    trie = Trie(ranked[new], entries)
    trie.walk()
    weight = np.bincount(leaf)
    counts = np.zeros(len(entries), np.int64)
    sums = np.zeros(entries.shape, np.int64)
    np.add.at(counts, trie.codes, weight)
    np.add.at(sums, trie.codes, trie.leaves * weight[:, None])
    codes, errors = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    codes[order], errors[order] = trie.codes[leaf], trie.errors[leaf]
    return codes, errors, sums, counts


def _bounds(width: int, parts: int) -> list[tuple[int, int]]:
    """Consecutive parts, equal where the width divides; else the first ones are longer by one."""
    sizes = [width // parts + (k < width % parts) for k in range(parts)]
    stops = np.cumsum(sizes).tolist()
    return [(b - n, b) for b, n in zip(stops, sizes)]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return integers(values.reshape(len(column), width))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Larger bundles of rows, whose parts share more of their paths."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= CHUNK_ROWS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is there and holds finite numbers only."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(F.col(column).isNotNull() & fine & (F.size(column) > 0))


def first_codebooks(rows: DataFrame, entries: int, parts: int) -> tuple[int, list[np.ndarray]]:
    """Width of the vectors and the starting codebooks, from the vectors of smallest id.

    A bounded read: ``entries`` rows. The width is that of the first of them.
    """
    head = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(1).collect()
    if not head:
        return 0, []
    width = len(head[0]["vector"])
    first = (
        rows.where(F.size("vector") == width)
        .orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    )
    start = integers(np.array([r["vector"] for r in first], np.float64))
    return width, [start[:, a:b] for a, b in _bounds(width, parts)]


def compress(
    vectors: DataFrame,
    column: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of all usable vectors, and the codebooks as one integer matrix a part.

    The rows have vec_id, label, codes (one per part), error and label_error (the
    errors of all vectors with that label, vectors without one together). Vectors that
    are null, empty, or hold null or non-finite components are dropped; so are those
    whose width is not that of the smallest id's vector. Integers beyond 2^27 are held
    at it. Equal ids start in the order of their vectors; a missing id comes last.
    With fewer vectors than entries, a codebook has as many entries as there are
    vectors. Other columns are ignored, and no rows give no rows and no codebooks.
    """
    spark = vectors.sparkSession
    rows = usable(
        vectors.select("vec_id", F.col(column).cast("array<double>").alias("vector"), F.col("label")), "vector"
    )
    width, books = first_codebooks(rows, entries, parts)
    rows = rows.where(F.size("vector") == width)
    bounds = _bounds(width, parts)
    for _ in range(rounds if books else 0):
        books = _improved(rows, spark.sparkContext.broadcast(books), bounds)
    shared = spark.sparkContext.broadcast(books)

    def codes(batches):
        for table in _chunks(batches):
            matrix = _matrix(table["vector"].combine_chunks(), width)
            found = [assign(matrix[:, a:b], book)[:2] for (a, b), book in zip(bounds, shared.value)]
            flat = np.stack([c for c, _ in found], 1).astype("<i4").ravel()
            offsets = pa.array((np.arange(table.num_rows + 1) * parts).astype("<i4"))
            yield pa.RecordBatch.from_arrays(
                [table["vec_id"].combine_chunks(), table["label"].combine_chunks(),
                 pa.ListArray.from_arrays(offsets, pa.array(flat)),
                 pa.array(sum(e for _, e in found), pa.int64())],
                ["vec_id", "label", "codes", "error"],
            )

    kinds = dict(rows.dtypes)
    coded = rows.mapInArrow(
        codes, f"vec_id {kinds['vec_id']}, label {kinds['label']}, codes array<int>, error long"
    )
    of_labels = broadcast_if_small(
        coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    )
    return coded.join(of_labels, F.col("label").eqNullSafe(F.col("of"))).drop("of"), books


def _improved(rows: DataFrame, shared, bounds: list[tuple[int, int]]) -> list[np.ndarray]:
    """One round: all parts assigned, entries moved to the floor of their parts' means."""
    width = bounds[-1][1]

    def sums(batches):
        total = [np.zeros(book.shape, np.int64) for book in shared.value]
        number = [np.zeros(len(book), np.int64) for book in shared.value]
        for table in _chunks(batches):
            matrix = _matrix(table["vector"].combine_chunks(), width)
            for k, ((a, b), book) in enumerate(zip(bounds, shared.value)):
                _, _, added, count = assign(matrix[:, a:b], book)
                total[k] += added
                number[k] += count
        for k, (added, count) in enumerate(zip(total, number)):
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * len(used), pa.int32()), pa.array(used, pa.int32()),
                 pa.array(added[used].tolist(), pa.list_(pa.int64())), pa.array(count[used], pa.int64())],
                ["part", "entry", "total", "number"],
            )

    found = rows.select("vector").mapInArrow(sums, "part int, entry int, total array<long>, number long")
    # Sums of tasks as decimals: they may leave 64 bits when there are very many vectors.
    by_place = found.select("part", "entry", "number", F.posexplode("total").alias("place", "value"))
    moved = by_place.groupBy("part", "entry", "place").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("total"), F.sum("number").alias("number")
    )
    books = [book.copy() for book in shared.value]
    for r in moved.collect():  # parts x entries x width rows at most
        books[r.part][r.entry, r.place] = int(r.total) // int(r.number)
    return books


def codebook_text(books: list[np.ndarray]) -> str:
    return ",".join(str(x) for book in books for x in book.ravel().tolist())


def codebook_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(codebook_text(books).encode()).hexdigest()
