"""Near duplicates by SetSketch registers.

Each text becomes the set of its word shingles. A register holds the exponentially
spaced, truncated level of the smallest of one exponential variate per shingle: level
``floor(1 - log_BASE(minimum))``, cut to 0 .. TOP. Registers of two sets merge by
their maximum, and they agree about as often as the sets overlap.

1. Texts with the same words are one class; only its representative goes on.
2. Bands of registers bring candidates together. Each member of a band group may be
   tied to the group's hub, the representative of the most texts, so a group of n gives
   at most n - 1 pairs. A text is first compared with one of its hubs, and with the
   others only where that has not put both into one component.
3. The overlap of a pair is estimated by maximum likelihood from how often its
   registers are above, below and equal, given both set sizes; far pairs go.
4. The rest is verified on the full sets. Verified links form components.
5. Pairs of a band group that are still in different components are then compared
   all, in blocks, by the same estimate, by one of FINE more registers, and the same
   check. So a member that is unlike its hubs loses no link. Members of a large group
   are mostly joined by few links, so first each one's likeliest pairs are checked, then
   more, and in the last pass all pairs that are still apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import Steps, gram_hashes, mix, text_column, word_hashes
from tidewatch.llm.components import connected_components

REGISTERS = 128
#: Fine steps: a band of few registers then tells very many unlike sets apart.
BASE = 1.02
RATE = 20.0
TOP = 2**16 - 1
MARGIN = 0.13  # four standard deviations at 0.85
FINE = 512
FINE_MARGIN = 0.065  # as many of FINE registers
MISS = 1e-5
BLOCK = 512
#: Pairs of a member in a cell that are checked in each pass over the groups; the last one takes all.
PASSES = (1, 16, None)


def _factors(n: int = REGISTERS) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


def registers(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Register levels of a set of 64-bit shingle hashes."""
    smallest = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 256):
        part = shingles[start : start + 256]
        np.minimum(smallest, (part[:, None] * factors).min(axis=0), out=smallest)
    uniform = (smallest.astype(np.float64) + 1.0) / 2.0**64
    minimum = -np.log1p(-np.minimum(uniform, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(minimum) / np.log(BASE)), 0, TOP).astype("<u2")


def _above(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def estimate(left, right, n_left, n_right) -> np.ndarray:
    """Likeliest Jaccard similarity of pairs of register rows with known set sizes."""
    up = (left > right).sum(axis=1)[:, None]
    down = (left < right).sum(axis=1)[:, None]
    u = (n_left / (n_left + n_right))[:, None]
    v = 1 - u
    grid = np.linspace(0, 1, 51)[None, :] * np.minimum(u / v, v / u)
    p_up = np.maximum(_above(u - v * grid), 1e-9)
    p_down = np.maximum(_above(v - u * grid), 1e-9)
    same = np.maximum(1 - p_up - p_down, 1e-9)
    total = left.shape[1]
    fit = up * np.log(p_up) + down * np.log(p_down) + (total - up - down) * np.log(same)
    return np.take_along_axis(grid, fit.argmax(axis=1)[:, None], axis=1)[:, 0]


def band_rows(similarity: float) -> int:
    """Most registers per band that still miss a pair at ``similarity`` below MISS."""
    x = _above(np.array([(1 - similarity) / 2]))[0]
    equal = 1 - 2 * x
    rows = 1
    while (1 - equal ** (rows + 1)) ** (REGISTERS // (rows + 1)) <= MISS:
        rows += 1
    return rows


def _shingles(text: str, words: int) -> np.ndarray:
    return np.unique(gram_hashes(word_hashes(text.encode())[0], words))


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _factors()
        for batch in batches:
            sizes, digests, levels = [], [], []
            for text in batch.column(2).to_pylist():
                data = text.encode()
                shingles = np.unique(gram_hashes(word_hashes(data)[0], words))
                sizes.append(len(shingles))
                same = b" ".join(data.lower().split())
                digests.append(hashlib.blake2b(same, digest_size=16).digest())
                levels.append(registers(shingles, factors).tobytes() if len(shingles) else None)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(levels, pa.binary())],
                ["doc_id", "tag", "n_shingles", "digest", "levels"],
            )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_shingles(text, words).tobytes() for text in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(sets, pa.binary())], ["rep", "shingles"])

    return run


def _fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """FINE more registers of each shingle set, independent of the first ones."""
    factors = _factors(REGISTERS + FINE)[REGISTERS:]
    for batch in batches:
        fine = [
            registers(np.frombuffer(held, np.uint64), factors).tobytes()
            for held in batch.column(1).to_pylist()
        ]
        yield pa.record_batch([batch.column(0), pa.array(fine, pa.binary())], ["rep", "fine"])


def _rows(column: pa.Array) -> np.ndarray:
    """Register rows of a binary column as one matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), -1)


def _close(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, n_a, n_b, left, right = batch.columns
            guess = estimate(_rows(left), _rows(right), n_a.to_numpy(), n_b.to_numpy())
            near = pa.array(guess >= similarity - MARGIN)
            yield pa.record_batch([a.filter(near), b.filter(near)], ["a", "b"])

    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                one, two = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return run


def _cell_pairs(
    levels, fine, reps, sizes, parts, first, similarity: float, band: int, most: int | None = None
) -> np.ndarray:
    """Close pairs of different components, as rows (a, b, cut), of one cell of a band group.

    Of a row that has more than ``most`` such pairs only the likeliest ones are given, or
    those that are so for the other row; ``cut`` is 1 in cells where pairs are left out.

    ``first`` marks the rows of the cell's first block. If it holds both kinds, pairs
    are formed across; a cell of one block pairs its rows with each other. Pairs that
    share an earlier band than number ``band`` are left to that one.
    """
    rows = band_rows(similarity)
    # Far pairs have few equal registers; four deviations are left for chance.
    rate = 1 - 2 * _above(np.array([(1 - similarity + MARGIN) / 2]))[0]
    total = levels.shape[1]
    enough = total * rate - 4 * np.sqrt(total * rate * (1 - rate))
    inner = first.all()
    left = np.arange(len(reps)) if inner else np.flatnonzero(first)
    right = left if inner else np.flatnonzero(~first)
    found, guesses = [], []
    for start in range(0, len(left), 64):
        own = left[start : start + 64]
        near = parts[own][:, None] != parts[right][None, :]
        if inner:
            near &= reps[own][:, None] < reps[right][None, :]
        small = np.minimum(sizes[own][:, None], sizes[right][None, :])
        near &= small >= similarity * np.maximum(sizes[own][:, None], sizes[right][None, :]) - 1e-9
        i, j = np.nonzero(near)
        for at in range(0, len(i), 8192):
            one, two = own[i[at : at + 8192]], right[j[at : at + 8192]]
            equal = levels[one] == levels[two]
            shared = equal[:, : band * rows].reshape(len(one), band, rows).all(axis=2).any(axis=1)
            close = (equal.sum(axis=1) >= enough) & ~shared
            one, two = one[close], two[close]
            if len(one):
                close = estimate(levels[one], levels[two], sizes[one], sizes[two]) >= similarity - MARGIN
                one, two = one[close], two[close]
            if len(one):
                guess = estimate(fine[one], fine[two], sizes[one], sizes[two])
                close = guess >= similarity - FINE_MARGIN
                found.append(np.stack([one[close], two[close]]))
                guesses.append(guess[close])
    if not found:
        return np.zeros((0, 3), np.int64)
    one, two = np.concatenate(found, axis=1)
    keep = np.ones(len(one), bool)
    if most is not None:
        guess = np.concatenate(guesses)
        keep = _likeliest(one, guess, most) | _likeliest(two, guess, most)
    pairs = np.sort(np.stack([reps[one[keep]], reps[two[keep]]], axis=1), axis=1)
    return np.column_stack([pairs, np.full(len(pairs), int(not keep.all()))])


def _likeliest(owner: np.ndarray, guess: np.ndarray, most: int) -> np.ndarray:
    """Marks the ``most`` largest guesses of each owner."""
    order = np.lexsort((-guess, owner))
    heads = np.flatnonzero(np.diff(owner[order], prepend=-1))
    number = np.arange(len(order)) - np.repeat(heads, np.diff(np.append(heads, len(order))))
    marks = np.zeros(len(order), bool)
    marks[order] = number < most
    return marks


def _blocks(similarity: float, most: int | None):
    """Pairs of all cells of a partition sorted by cell; one cell is in memory at a time."""

    def pairs(table: pa.Table):
        cells = np.stack([table.column(c).to_numpy() for c in range(3)], axis=1)
        edges = np.flatnonzero((np.diff(cells, axis=0) != 0).any(axis=1)) + 1
        levels, fine, numbers = _rows(table.column(7)), _rows(table.column(8)), table.column(9).to_numpy()
        reps, parts, own, sizes = (table.column(c).to_numpy() for c in range(3, 7))
        for start, stop in zip([0, *edges], [*edges, len(cells)]):
            if stop - start > 1:
                at = slice(start, stop)
                first = own[at] == cells[start, 1]
                found = _cell_pairs(
                    levels[at], fine[at], reps[at], sizes[at], parts[at], first, similarity,
                    int(numbers[start]), most,
                )
                yield np.column_stack([found, np.full(len(found), cells[start, 0])])

    def emit(table: pa.Table):
        found = list(pairs(table))
        if found and len(found := np.unique(np.concatenate(found), axis=0)):
            yield pa.record_batch([*map(pa.array, found.T)], ["a", "b", "cut", "band"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            cells = np.stack([table.column(c).to_numpy() for c in range(3)], axis=1)
            last = np.flatnonzero((cells != cells[-1]).any(axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = table.slice(cut)
            if cut:
                yield from emit(table.slice(0, cut))
        if held is not None:
            yield from emit(held)

    return run


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return both.mapInArrow(_linked(percent), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Two documents are linked when ``100 * intersection >= percent * union`` of their
    sets of ``words``-word shingles; A-Z are lowered and words are what white space
    separates. A text with fewer words is one shingle. Texts without words, null ones
    included, link with nothing. ``component_id`` is the smallest id reachable by
    links, and the documents with that id are kept. Rows that repeat an id are linked by
    their own texts each; rows without an id take part in nothing and are their own
    component (null, kept). No rows give no rows.
    """
    steps = Steps(docs.sparkSession, "near")
    similarity = percent / 100
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    base = base.select("doc_id", F.xxhash64("text").alias("tag"), "text")
    sketches = steps.save(
        base.mapInArrow(
            _sketch(words), "doc_id long, tag long, n_shingles long, digest binary, levels binary"
        ),
        "sketches",
    )
    classes = steps.save(
        sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min(F.struct("doc_id", "tag")).alias("first"), F.count("*").alias("texts"),
             F.first("n_shingles").alias("n_shingles"), F.first("levels").alias("levels"))
        .withColumn("rep", F.monotonically_increasing_id()),
        "classes",
    )
    bands = _bands(classes, band_rows(similarity), steps)
    sketch = classes.select("rep", "n_shingles", "levels")
    sets = _candidate_sets(base, classes, bands, words, steps)
    nearest = bands.groupBy("rep").agg(F.max(F.struct("weight", F.col("hub"))).alias("top"))
    pairs = nearest.select(F.col("top.hub").alias("hub"), "rep").where("hub <> rep")
    links = parts = None
    for stars in (lambda known: pairs, lambda known: _apart(bands, known)):
        close = steps.save(_estimated(stars(parts), sketch, similarity), "close")
        more = steps.save(_verify(close, sets, percent), "links")
        links = more if links is None else links.unionByName(more)
        if parts is not None:
            steps.drop(parts.source)
        parts = _parts(links, steps)
        steps.drop(close)
    open_bands = bands
    for most in PASSES:
        rest, mixed = _across(open_bands, sketch, sets, parts, similarity, steps, most)
        cut = rest.agg(F.max("cut")).first()[0]
        if cut is not None:
            more = steps.save(_verify(rest.select("a", "b"), sets, percent), "links")
            links = links.unionByName(more)
            steps.drop(parts.source)
            parts = _parts(links, steps)
        steps.drop(mixed)
        if cut:
            again = rest.where("cut = 1").select("band").distinct()
            open_bands = steps.save(bands.join(again, "band"), "open")
        steps.drop(rest)
        if not cut:
            break
    steps.drop(bands, sets)
    return _answers(sketches, classes, parts)


def _parts(links: DataFrame, steps: Steps) -> DataFrame:
    source = steps.save(connected_components(links, steps), "parts")
    parts = source.select("node", "component")
    parts.source = source
    return parts


def _answers(sketches: DataFrame, classes: DataFrame, parts: DataFrame) -> DataFrame:
    """Documents with the smallest id of their class' component."""
    first = F.col("first.doc_id")
    linked = parts.join(classes.select(F.col("rep").alias("node"), first.alias("first_id")), "node")
    smallest = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    reached = parts.join(smallest, "component").select(F.col("node").alias("rep"), "component_id")
    answer = classes.select("digest", "rep", first.alias("first_id")).join(reached, "rep", "left").select(
        "digest", F.coalesce("component_id", "first_id").alias("component_id")
    )
    members = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", "n_shingles", "digest")
    found = members.join(answer, "digest").select("doc_id", "n_shingles", "component_id")
    alone = sketches.where("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return found.unionByName(alone).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _bands(classes: DataFrame, rows: int, steps: Steps) -> DataFrame:
    """band, its number, rep, size, hub and its weight of every band group with company.

    The hub is the member that stands for the most texts, then the smallest one.
    """
    n = REGISTERS // rows
    keys = F.array(*[
        F.struct(
            F.xxhash64(F.lit(i), F.substring("levels", 1 + 2 * i * rows, 2 * rows)).alias("band"),
            F.lit(i).cast("tinyint").alias("number"),
        )
        for i in range(n)
    ])
    exploded = classes.select("rep", "texts", F.inline(keys))
    groups = exploded.groupBy("band").agg(
        F.count("*").alias("size"), F.max(F.struct("texts", (-F.col("rep")).alias("rep"))).alias("top")
    )
    return steps.save(
        exploded.join(groups.where("size > 1"), "band").select(
            "band", "number", "rep", "size", (-F.col("top.rep")).alias("hub"), F.col("top.texts").alias("weight")
        ),
        "bands",
    )


def _apart(bands: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs of hub and member that are still in different components."""
    named = parts.select(F.col("node").alias("rep"), F.col("component").alias("own"))
    hubs = parts.select(F.col("node").alias("hub"), F.col("component").alias("its"))
    pairs = bands.where("rep <> hub").select("hub", "rep").distinct()
    return (
        pairs.join(named, "rep", "left")
        .join(hubs, "hub", "left")
        .where(F.coalesce("own", "rep") != F.coalesce("its", "hub"))
        .select("hub", "rep")
    )


def _estimated(pairs: DataFrame, sketch: DataFrame, similarity: float) -> DataFrame:
    left = sketch.toDF("a", "n_a", "levels_a")
    right = sketch.toDF("b", "n_b", "levels_b")
    ordered = pairs.select(F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b")).distinct()
    both = (
        ordered.join(left, "a")
        .join(right, "b")
        .where(F.least("n_a", "n_b") >= F.lit(similarity - 1e-9) * F.greatest("n_a", "n_b"))
    )
    return both.select("a", "b", "n_a", "n_b", "levels_a", "levels_b").mapInArrow(
        _close(similarity), "a long, b long"
    )


def _candidate_sets(
    base: DataFrame, classes: DataFrame, bands: DataFrame, words: int, steps: Steps
) -> DataFrame:
    """Full shingle sets of all representatives in any band group."""
    wanted = bands.select("rep").distinct().join(classes.select("rep", "first.*"), "rep")
    texts = base.join(wanted, ["doc_id", "tag"]).groupBy("rep").agg(F.min("text").alias("text"))
    return steps.save(texts.mapInArrow(_sets(words), "rep long, shingles binary"), "sets")


def _across(
    bands: DataFrame, sketch: DataFrame, sets: DataFrame, parts: DataFrame, similarity: float,
    steps: Steps, most: int | None,
) -> tuple[DataFrame, DataFrame]:
    """Close pairs of one band group that are in different components, stored.

    A large group is cut into blocks by a hash, the members of its largest component (if
    they are more than BLOCK), who need no pairs with each other, apart from the others. Each pair of blocks that holds
    others is a cell of its own, so no task holds a whole group, and a group of n with m
    others makes about n + n * m / BLOCK rows. A pair is formed in the first band that
    it shares, and nowhere else. ``cut`` is 1 for pairs of cells that have others which
    are not among the ``most`` likeliest of a member; only their bands need another pass. The second result is what it has read.
    """
    labelled = bands.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(
        "band", "number", "size", "rep", F.coalesce("component", "rep").alias("component")
    )
    # Band groups with several components, and the largest one if it is more than a block.
    mixed = (
        labelled.groupBy("band", "component")
        .agg(F.count("*").alias("members"))
        .groupBy("band")
        .agg(F.count("*").alias("components"), F.max(F.struct("members", "component")).alias("top"))
        .where("components > 1")
        .select("band", F.col("top.component").alias("largest"),
                F.when(F.col("top.members") > BLOCK, F.col("top.members")).otherwise(0).alias("members"))
    )
    inner, blocks, before = F.col("inner"), F.col("blocks"), F.col("before")
    parted = steps.save(
        labelled.join(mixed, "band")
        .withColumn("inner", (F.col("component") == F.col("largest")) & (F.col("members") > 0))
        .withColumn("before", F.ceil(F.col("members") / F.lit(BLOCK)).cast("int"))
        .withColumn("blocks", F.ceil((F.col("size") - F.col("members")) / F.lit(BLOCK)).cast("int"))
        .withColumn("own", F.when(inner, F.pmod(F.xxhash64("rep"), before))
                    .otherwise(before + F.pmod(F.xxhash64("rep"), blocks)).cast("int"))
        .drop("largest", "members"),
        "mixed",
    )
    fine = sets.join(parted.select("rep").distinct(), "rep", "left_semi").mapInArrow(
        _fine, "rep long, fine binary"
    )
    others = F.sequence(F.when(inner, before).otherwise(F.lit(0)), before + blocks - 1)
    other = F.explode(others).alias("other")
    cells = parted.select("band", "number", "rep", "component", "own", other).select(
        "band", "number", "rep", "component", "own",
        F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
    )
    pairs = (
        cells.join(sketch.join(fine, "rep"), "rep")
        .repartition("band", "x", "y")
        .sortWithinPartitions("band", "x", "y")
        .select("band", "x", "y", "rep", "component", "own", "n_shingles", "levels", "fine", "number")
        .mapInArrow(_blocks(similarity, most), "a long, b long, cut long, band long")
    )
    return steps.save(pairs.distinct(), "rest"), parted
