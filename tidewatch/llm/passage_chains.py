"""Passages that occur, exactly or nearly, in more than one document.

1. Seeds are runs of SEED words whose hash is the smallest of WINDOW neighbouring runs;
   a shared stretch of SEED + WINDOW - 1 words has at least one. All places of a seed
   count; of a stretch that repeats with a period below WINDOW the first and the last.
2. All documents of a seed that stands at most FEW times are compared with each other, those
   of a more frequent seed with the smallest and the largest one. What documents share so
   puts their stretches (passages of a document that overlap) into classes.
   Frequent seeds whose places are not all in one class are looked at in longer contexts:
   each run of ``least_words`` words, whose documents meet the smallest and the largest
   one that has it, and two seeds within REACH words of each other. A passage holds such
   a run or two such seeds with different words between them, so in the end all
   documents of two seeds meet whose places are still in different classes and whose
   words between them differ. The two ends of one repeated word are no such seeds: what
   they have in common is an exact run, and with a third seed they are two others.
3. Two documents that meet are compared by all seeds they share, which are chained: of
   the matches before one in both documents the best predecessor is found with a Fenwick
   tree over the second document's places, whose maxima include the linear cost of the gap.
4. The words of each chain are aligned: matches are extended while words agree, and the
   gaps between them are aligned by longest common subsequence, whatever their size. The
   longest part of a chain whose similarity suffices is a passage if it is long enough;
   what is left of the chain before and after it is searched in the same way.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import (
    BASE, Steps, gram_hashes, mix, prefix_hashes, span_hashes, text_column, word_hashes,
)
from tidewatch.llm.components import connected_components
from tidewatch.operators.sizing import at_most

SEED = 6
WINDOW = 12
GAP = 0.1
MARGIN = 32
ROUND = 16
LEAST_WORDS = 40
FEW = 8
REACH = 80
TOLD = 16
ASKED = 1_000_000
MOST, ANY = 127, 1 << 30
SIMILARITY = 0.8

CHAIN = "doc long, other long, places array<int>, others array<int>"


def _lowest(values: np.ndarray, span: int) -> np.ndarray:
    """Places of the smallest of each ``span`` neighbouring values, the first of equal ones."""
    at, low, size = np.arange(len(values)), values, 1
    while size < span:
        step = min(size, span - size)
        later = low[step:] < low[:-step]
        at, low = (np.where(later, x[step:], x[:-step]) for x in (at, low))
        size += step
    return at[np.append(True, at[1:] != at[:-1])]


def seeds(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the seeds of a text, by hash and place."""
    if len(words) < SEED:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = gram_hashes(words, SEED)
    picked = _lowest(grams, min(WINDOW, len(grams)))
    picked = picked[np.argsort(grams[picked], kind="stable")]
    found = grams[picked]
    # Inside of a stretch that repeats, the places between its ends say nothing more.
    near = (found[1:] == found[:-1]) & (np.diff(picked) < WINDOW)
    inner = np.append(False, near) & np.append(near, False)
    return found[~inner], picked[~inner]


def _beside(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    """What stands on either side of each seed, in two bytes: how often its outer word is
    repeated there (MOST or more: MOST), and a byte of the word that ends this (0: none)."""
    breaks = np.flatnonzero(words[1:] != words[:-1]) + 1
    starts, stops = np.append(0, breaks), np.append(breaks, len(words))
    tops = np.zeros(len(words) + 2, np.int64)
    tops[1:-1] = words >> np.uint64(56)
    first, last = (np.searchsorted(starts, at, "right") - 1 for at in (places, places + SEED - 1))
    left = np.minimum(places - starts[first], MOST) << 8 | tops[starts[first]]
    right = np.minimum(stops[last] - places - SEED, MOST) << 8 | tops[stops[last] + 1]
    return (left << 16 | right).astype(np.int32)


def _agreeing_at_most(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Words that can agree beyond two equal seeds, by two bytes of :func:`_beside`; ANY if these do not tell."""
    times, other = one >> 8, two >> 8
    ended = (times < MOST) & (one != two)
    return np.where(times != other, np.minimum(times, other), np.where(ended, times, ANY))


def _seed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, places, beside, sizes = [], [], [], []
        for text in batch.column(1).to_pylist():
            words = word_hashes(text.encode())[0]
            found, place = seeds(words)
            hashes.append(found)
            places.append(place)
            beside.append(_beside(words, place))
            sizes.append(len(found))
        if sum(sizes):
            owner = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            yield pa.record_batch(
                [batch.column(0).take(owner), pa.array(np.concatenate(hashes).view(np.int64)),
                 pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(beside))],
                ["doc", "h", "place", "beside"],
            )


def chains(matches: list[tuple[int, int]], size: int = SEED, gap: float = GAP) -> list[list[int]]:
    """Collinear chains of matches, as indexes into ``matches`` sorted by both places.

    A match adds its words; each word skipped in either text costs ``gap``. A chain
    ends where going on costs more than it has gained.
    """
    order = sorted(set(matches))
    seconds = sorted({y for _, y in order})
    score, before = [], []
    start = 0
    if len(seconds) == len(order) and all(a[0] < b[0] and a[1] < b[1] for a, b in pairwise(order)):
        # All matches before one come before it in both texts, so the best so far is enough.
        top = (-1e18, -1)
        for j, (x, y) in enumerate(order):
            gain = top[0] - gap * (x + y)
            score.append(size + max(gain, 0.0))
            before.append(top[1] if gain > 0 else -1)
            top = max(top, (score[j] + gap * (x + y), j))
        start = len(order)
    rank = {y: i + 1 for i, y in enumerate(seconds)}
    best: list[tuple[float, int]] = [(-1e18, -1)] * (len(seconds) + 1)
    while start < len(order):
        # Matches with one first place are asked before any of them is entered.
        stop = start
        while stop < len(order) and order[stop][0] == order[start][0]:
            x, y = order[stop]
            top, i = (-1e18, -1), rank[y] - 1
            while i > 0:
                top = max(top, best[i])
                i -= i & -i
            gain = top[0] - gap * (x + y)
            score.append(size + max(gain, 0.0))
            before.append(top[1] if gain > 0 else -1)
            stop += 1
        for j in range(start, stop):
            x, y = order[j]
            entry, i = (score[j] + gap * (x + y), j), rank[y]
            while i <= len(seconds):
                best[i] = max(best[i], entry)
                i += i & -i
        start = stop
    used, found = [False] * len(order), []
    for end in sorted(range(len(order)), key=lambda j: -score[j]):
        chain, j = [], end
        while j >= 0 and not used[j]:
            used[j] = True
            chain.append(j)
            j = before[j]
        if chain:
            found.append([order[j] for j in reversed(chain)])
    return found


def _matches(h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all pairs with one hash; ``g`` is sorted."""
    low, high = np.searchsorted(g, h, "left"), np.searchsorted(g, h, "right")
    size = high - low
    one = np.repeat(np.arange(len(h)), size)
    return one, np.arange(len(one)) - np.repeat(np.cumsum(size) - size - low, size)


def _least_span(least: int) -> int:
    """Least distance of the first and the last seed of a passage: the words that agree go on
    for less than WINDOW words beyond them, but in stretches that repeat."""
    return least - SEED - 2 * (WINDOW - 1)


def _chain_rows(least: int):
    """Chains that are long enough to hold a passage.

    A passage reaches no further than the words before the first seed and those after the
    last one agree, so where :func:`_beside` tells that this is too short, the chain goes.
    """
    span = _least_span(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, other, *packed in zip(*(c.to_pylist() for c in batch.columns)):
                h, g = (np.frombuffer(x, np.uint64) for x in packed[::3])
                one, two = _matches(h, g)
                if len(one) < 2 and span > 0:
                    continue
                places, others = (np.frombuffer(x, np.int32) for x in packed[1::3])
                beside, beyond = (np.frombuffer(x, np.int32) for x in packed[2::3])
                beside, beyond = beside[one], beyond[two]
                before = _agreeing_at_most(beside >> 16, beyond >> 16)
                after = _agreeing_at_most(beside & 0xFFFF, beyond & 0xFFFF)
                xs, ys = places[one], others[two]
                if len(xs) and int(min(np.ptp(xs), np.ptp(ys))) + SEED + int(before.max()) + int(after.max()) < least:
                    continue
                matches = list(zip(xs.tolist(), ys.tolist()))
                ends = dict(zip(matches, zip(before.tolist(), after.tolist())))
                sure = len(ends) == len(matches)  # else texts of a repeated id share places
                # Seeds that stand more than once in both may be the ends of a stretch that repeats.
                left, right = Counter(x for x, _ in matches), Counter(y for _, y in matches)
                for chain in chains(matches):
                    (x, y), (x1, y1) = chain[0], chain[-1]
                    reach = min(x1 - x, y1 - y) + SEED + ends[x, y][0] + ends[x1, y1][1]
                    if sure and reach < least:
                        continue
                    if min(x1 - x, y1 - y) >= span or any(left[a] > 1 and right[b] > 1 for a, b in chain):
                        rows.append((doc, other, [a for a, _ in chain], [b for _, b in chain]))
            if rows:
                doc, other, xs, ys = zip(*rows)
                yield pa.record_batch(
                    [pa.array(doc, pa.int64()), pa.array(other, pa.int64()),
                     pa.array(xs, pa.list_(pa.int32())), pa.array(ys, pa.list_(pa.int32()))],
                    ["doc", "other", "places", "others"],
                )

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The seeds of each document by hash, as bytes."""
    for batch in batches:
        columns: list[list[bytes]] = [[], [], []]
        found, ends = batch.column(1).values, batch.column(1).offsets.to_numpy()
        h, place, beside = (found.field(c).to_numpy() for c in ("h", "place", "beside"))
        for i, j in pairwise(ends.tolist()):
            order = i + np.lexsort((place[i:j], h[i:j].view(np.uint64)))
            for column, values in zip(columns, (h, place, beside)):
                column.append(values[order].tobytes())
        yield pa.record_batch(
            [batch.column(0), *(pa.array(c, pa.binary()) for c in columns)], ["doc", "h", "places", "beside"]
        )


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts, compressed for the shuffle."""
    codec = pa.Codec("zstd")
    for batch in batches:
        texts = [text.encode() for text in batch.column(1).to_pylist()]
        packed = [len(text).to_bytes(8, "little") + codec.compress(text, asbytes=True) for text in texts]
        yield pa.record_batch([batch.column(0), pa.array(packed, pa.binary())], ["doc", "text"])


def _words(texts: list[bytes]) -> np.ndarray:
    """Word hashes of a document, of whose texts the smallest counts."""
    codec = pa.Codec("zstd")
    found = [codec.decompress(text[8:], int.from_bytes(text[:8], "little"), asbytes=True) for text in texts]
    return word_hashes(min(found))[0]


def _telling(rows: np.ndarray, places: np.ndarray, columns: tuple[int, ...]) -> set[int]:
    """Some of the ``places`` in ``rows``, at most 16 for three columns: where one of all differs
    from a row of any other table in each of the columns, one of these does."""
    if not len(places):
        return set()
    first = int(places[0])
    found = {first}
    for c in columns:
        # What agrees with the first one in this column differs from all these there.
        other = places[rows[c, places] != rows[c, first]]
        found |= _telling(rows, other, tuple(x for x in columns if x != c))
    return found


def _told(rows: np.ndarray) -> np.ndarray:
    """Rows of a document (run, key, content, left, right), of a key that it has often the telling ones."""
    order = np.lexsort(rows[:2])
    rows = rows[:, order]
    starts = np.flatnonzero(np.append(True, (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)))
    sizes = np.diff(np.append(starts, rows.shape[1]))
    kept = np.repeat(sizes <= TOLD, sizes)
    for start, size in zip(starts[sizes > TOLD], sizes[sizes > TOLD]):
        kept[list(_telling(rows, np.arange(start, start + size), (2, 3, 4)))] = True
    return rows[:, kept]


def _keys(least: int, runs: bool):
    """Longer contexts of the asked places: key, the words it has there, labels of its places.

    Two asked places within REACH words of each other, and if ``runs``, runs of ``least``
    words that hold an asked place. Without ``runs`` the ends of one repeated word are left
    out: an exact run is all they can have in common, unless there is a third seed, and
    with that one the words differ as well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, texts, found in zip(*(c.to_pylist() for c in batch.columns)):
                words = _words(texts)
                found = sorted((f["place"], f["h"], f["label"]) for f in found)
                # Places of another text of a repeated id do not count.
                places, h, label = np.array(found, np.int64).T
                inside = places + SEED <= max(len(words), SEED)
                places, h, label = places[inside], h[inside].view(np.uint64), label[inside]
                sums = prefix_hashes(words)
                at = np.arange(len(places))
                size = np.searchsorted(places, places + REACH, "right") - at - 1
                one = np.repeat(at, size)
                two = np.arange(len(one)) - np.repeat(np.cumsum(size) - size - at - 1, size)
                if not runs and len(words):
                    word = np.cumsum(np.append(0, words[1:] != words[:-1]))  # number of the repeated word
                    last = np.minimum(places + SEED, len(words)) - 1
                    apart = word[np.minimum(places, len(words) - 1)][one] != word[last][two]
                    one, two = one[apart], two[apart]
                key = mix(mix(h[one]) * BASE + mix(h[two]))
                ends = np.minimum(places[two] + SEED, len(words))
                content = span_hashes(sums, places[one], ends)
                rows = [np.stack([np.zeros(len(one), np.int64), key.view(np.int64), content.view(np.int64),
                                  label[one], label[two]])]
                if runs and len(words) >= least and len(places):
                    asked = np.zeros(len(words) + 1, np.int64)
                    np.add.at(asked, np.maximum(places + SEED - least, 0), 1)
                    np.add.at(asked, places + 1, -1)
                    start = np.flatnonzero(np.cumsum(asked)[: len(words) - least + 1] > 0)
                    grams = span_hashes(sums, start, start + least)
                    own = label[np.searchsorted(places, start)]
                    rows.append(np.stack([np.ones(len(start), np.int64), grams.view(np.int64),
                                          np.zeros(len(start), np.int64), own, own]))
                rows = np.concatenate(rows, axis=1)
                names = np.zeros(rows.shape[1], np.uint64)
                for column in rows.view(np.uint64):
                    names = mix(names * BASE + column)
                rows = rows[:, np.unique(names, return_index=True)[1]]
                if rows.shape[1]:
                    rows = _told(rows)
                out.append(np.vstack([np.full(rows.shape[1], doc, np.int64), rows]))
            if out:
                yield pa.record_batch(
                    [*map(pa.array, np.concatenate(out, axis=1))], ["doc", "run", "key", "content", "left", "right"]
                )

    return run


KEYS = "doc long, run long, key long, content long, left long, right long"


def _meetings(shared: DataFrame) -> DataFrame:
    """Pairs doc > other of the documents of a seed: all of one that stands at most FEW times,
    else each with the smallest and the largest."""
    rare = shared.where(f"n <= {FEW}").groupBy("h").agg(F.sort_array(F.collect_set("doc")).alias("docs"))
    first = rare.select("docs", F.posexplode("docs").alias("i", "other"))
    every = first.select(F.explode(F.slice("docs", F.col("i") + 2, F.size("docs"))).alias("doc"), "other")
    return every.unionByName(_stars(shared.where(f"n > {FEW}"))).distinct()


def _stars(members: DataFrame) -> DataFrame:
    """Pairs of each member with the smallest and the largest one."""
    ends = members.select("doc", F.explode(F.array("low", "high")).alias("end")).where("doc <> end")
    return ends.select(F.greatest("doc", "end").alias("doc"), F.least("doc", "end").alias("other")).distinct()


def _open_keys(keyed: DataFrame) -> DataFrame:
    """Rows of the keys whose places are not all in one class and may differ in their words."""
    open_ = keyed.groupBy("run", "key").agg(
        F.min("doc").alias("low"), F.max("doc").alias("high"),
        *[f(c).alias(f"{name}_{c}") for c in ("left", "right", "content")
          for name, f in (("least", F.min), ("most", F.max))],
    ).where(
        "low < high AND least_left < most_left AND least_right < most_right "
        "AND (run = 1 OR least_content < most_content)"
    )
    return keyed.join(open_.select("run", "key", "low", "high"), ["run", "key"])


def _apart(keyed: DataFrame) -> DataFrame:
    """All pairs doc > other of a key whose places are in different classes, with different words."""
    one = _open_keys(keyed).drop("low", "high")
    two = one.select("key", *[F.col(c).alias(f"{c}_2") for c in ("doc", "content", "left", "right")])
    return (
        one.join(two, "key")
        .where("doc > doc_2 AND content <> content_2 AND left <> left_2 AND right <> right_2")
        .select("doc", F.col("doc_2").alias("other"))
        .distinct()
    )


def _stretches(rows: DataFrame) -> DataFrame:
    """Unions of the passages of a document that overlap: doc, start, stop and its node."""
    sides = _sides(rows).groupBy("doc", "first").agg(F.max("last").alias("last"))
    order = Window.partitionBy("doc").orderBy("first")
    fresh = F.col("first") > F.coalesce(F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    numbered = sides.withColumn("fresh", fresh).withColumn("number", F.sum(F.col("fresh").cast("int")).over(order))
    merged = numbered.groupBy("doc", "number").agg(F.min("first").alias("start"), F.max("last").alias("stop"))
    return merged.select("doc", "start", "stop", F.xxhash64("doc", "start").alias("node"))


def _sides(rows: DataFrame) -> DataFrame:
    one = rows.select(F.col("doc_id").alias("doc"), F.col("first_word").alias("first"), F.col("last_word").alias("last"))
    return one.unionByName(rows.select(
        F.col("other_id").alias("doc"), F.col("other_first").alias("first"), F.col("other_last").alias("last")
    ))


def _classes(rows: DataFrame, steps: Steps) -> DataFrame:
    """Stretches with their class: doc, start, stop, component."""
    spans = steps.save(_stretches(rows), "stretches")

    def at(doc: str, first: str, node: str) -> tuple:
        side = spans.select(F.col("doc").alias(doc), *[F.col(c).alias(f"{node}_{c}") for c in ("start", "stop")],
                            F.col("node").alias(node))
        return side, [F.col(first).between(F.col(f"{node}_start"), F.col(f"{node}_stop"))]

    links = rows.select("doc_id", "first_word", "other_id", "other_first").distinct()
    for doc, first, node in (("doc_id", "first_word", "a"), ("other_id", "other_first", "b")):
        side, where = at(doc, first, node)
        links = links.join(side, doc).where(where[0])
    parts = connected_components(links.select("a", "b"), steps)
    found = steps.save(
        spans.join(parts, "node").select("doc", "start", "stop", "component"), "classes"
    )
    steps.drop(spans)
    return found


def _open_places(frequent: DataFrame, classes: DataFrame) -> DataFrame:
    """Places of the frequent seeds that are not all in one class: doc, found (place, h, label).

    The label of a place is the class of its stretch; one that no passage covers has its own.
    """
    inside = classes.groupBy("doc").agg(F.collect_list(F.struct("start", "stop", "component")).alias("spans"))
    own = F.filter("spans", lambda s: (s.start <= F.col("place")) & (s.stop >= F.col("place") + SEED - 1))
    labelled = frequent.join(inside, "doc", "left").select(
        "doc", "h", "place",
        F.coalesce(F.try_element_at(own, F.lit(1)).component, F.xxhash64("doc", "place")).alias("label"),
    )
    open_ = labelled.groupBy("h").agg(
        F.min("label").alias("least"), F.max("label").alias("most"), F.min("doc").alias("low"), F.max("doc").alias("high")
    ).where("least < most AND low < high")
    return labelled.join(open_.select("h"), "h").groupBy("doc").agg(
        F.collect_list(F.struct("place", "h", "label")).alias("found")
    )


def _only(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` of the documents ``docs``; all rows where these documents are many.

    Its join with what is asked of the documents then shuffles the rows of these only.
    """
    return rows.join(F.broadcast(docs), "doc", "left_semi") if at_most(docs, ASKED) else rows


def _sided(pairs: DataFrame) -> DataFrame:
    return pairs.select("doc").unionByName(pairs.select(F.col("other").alias("doc"))).distinct()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hashes of the asked stretches of each document."""
    for batch in batches:
        out = []
        for doc, texts, asked in zip(*(c.to_pylist() for c in batch.columns)):
            words = _words(texts)
            for part in asked:
                start, stop = part["start"], part["stop"]
                out.append((doc, start, stop, words[max(start, 0) : stop].tobytes()))
        if out:
            doc, start, stop, found = zip(*out)
            yield pa.record_batch(
                [pa.array(doc, pa.int64()), pa.array(start, pa.int32()), pa.array(stop, pa.int32()),
                 pa.array(found, pa.binary())],
                ["doc", "start", "stop", "words"],
            )


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by bits of one long number for each word of b."""
    marks: dict[int, int] = {}
    for i, word in enumerate(a.tolist()):
        marks[word] = marks.get(word, 0) | 1 << i
    full = (1 << len(a)) - 1
    open_ = full
    for word in b.tolist():
        met = open_ & marks.get(word, 0)
        if met:
            open_ = ((open_ + met) | (open_ - met)) & full
    return len(a) - open_.bit_count()


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """Number of words that agree from the start on."""
    n = min(len(a), len(b))
    other = np.flatnonzero(a[:n] != b[:n])
    return int(other[0]) if len(other) else n


def _blocks(a, b, xs, ys, size: int) -> list[tuple[int, int, int]]:
    """Places in both texts and words of the matches; matches between which all words agree are one."""
    if xs[-1] > len(a) or ys[-1] > len(b):  # places of another text of a repeated id
        return [(x, y, size) for x, y in zip(xs.tolist(), ys.tolist())]
    step, ahead = np.diff(xs), np.diff(ys)
    between = np.where(step == ahead, np.maximum(step - size, 0), 0)
    owner = np.repeat(np.arange(len(step)), between)
    along = np.arange(len(owner)) - np.repeat(np.cumsum(between) - between, between) + size
    wrong = np.bincount(owner[a[xs[owner] + along] != b[ys[owner] + along]], minlength=len(step))
    fresh = np.append(True, (step != ahead) | (wrong > 0))
    first, last = np.flatnonzero(fresh), np.flatnonzero(np.append(fresh[1:], True))
    return list(zip(xs[first].tolist(), ys[first].tolist(), (xs[last] - xs[first] + size).tolist()))


def _pieces(a, b, xs, ys, size: int) -> list[tuple[int, int, int, int]]:
    """Stretches that agree word for word, in order: place in a, place in b, words, and
    the common words of the gap before it."""
    pieces: list[tuple[int, int, int, int]] = []
    for x, y, n in _blocks(a, b, xs, ys, size):
        if not pieces:
            left = _agreeing(a[:x][::-1], b[:y][::-1])
            pieces.append((x - left, y - left, left + n, 0))
        else:
            x0, y0, n0, c0 = pieces[-1]
            at_a, at_b = x0 + n0, y0 + n0
            skip = max(at_a - x, at_b - y, 0)  # part of this match that is counted already
            x, y, n = x + skip, y + skip, n - skip
            right = _agreeing(a[at_a:x], b[at_b:y])
            pieces[-1] = (x0, y0, at_a - x0 + right, c0)
            at_a, at_b = at_a + right, at_b + right
            left = _agreeing(a[at_a:x][::-1], b[at_b:y][::-1])
            pieces.append((x - left, y - left, n + left, common_words(a[at_a : x - left], b[at_b : y - left])))
    x, y, n, c = pieces[-1]
    pieces[-1] = (x, y, n + _agreeing(a[x + n :], b[y + n :]), c)
    return pieces


def _reach(a, b, xs, ys, size: int = SEED) -> int:
    """Words of the shorter side of all that a chain can hold: up to where words differ on either end."""
    left = _agreeing(a[: xs[0]][::-1], b[: ys[0]][::-1])
    right = _agreeing(a[xs[-1] + size :], b[ys[-1] + size :])
    return int(min(xs[-1] - xs[0], ys[-1] - ys[0])) + size + left + right


def align(a, b, xs, ys, similarity: float, size: int = SEED) -> list[tuple[int, int, int, int, float]]:
    """Bounds in both texts and similarity of the passages in a chain of matches at xs and ys.

    The longest part of the chain whose share of common words is ``similarity`` or more
    is a passage; the parts before and after it are searched in the same way.
    """
    pieces = np.array(_pieces(a, b, xs, ys, size), np.int64)
    x, y, n, c = pieces.T
    # Common words up to the end of each piece; before[i] is what lies before piece i.
    same = np.cumsum(n + c)
    before = same - n
    worth_end = 2 * same - similarity * (x + n + y + n)
    worth_start = 2 * before - similarity * (x + y)
    found, parts = [], [(0, len(x))]
    while parts:
        lo, hi = parts.pop()
        if lo >= hi:
            continue
        # The first start that is worth no more than the end, for each end.
        least = np.minimum.accumulate(worth_start[lo:hi])
        first = lo + np.searchsorted(-least, -(worth_end[lo:hi] + 1e-9), side="left")
        last = np.arange(lo, hi)
        words = (x + n + y + n)[last] - (x + y)[first]
        i = int(words.argmax())
        i, j = int(first[i]), int(last[i])
        ends = int(x[j] + n[j]), int(y[j] + n[j])
        total = ends[0] - int(x[i]) + ends[1] - int(y[i])
        found.append((int(x[i]), ends[0], int(y[i]), ends[1], 2 * int(same[j] - before[i]) / total))
        parts += [(lo, i), (j + 1, hi)]
    return sorted(found)


PASSAGE = (
    "doc_id long, first_word long, last_word long, other_id long, other_first long, other_last long, "
    "similarity double"
)


def _aligned(least: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            lists = [[c.values.to_numpy()[i:j] for i, j in pairwise(c.offsets.to_pylist())] for c in batch.columns[2:4]]
            plain = (c.to_pylist() for i, c in enumerate(batch.columns) if i not in (2, 3))
            for xs, ys, doc, other, start, begin, a, b in zip(*lists, *plain):
                start, begin = max(start, 0), max(begin, 0)
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                near = xs - start, ys - begin
                if _reach(a, b, *near) < least:
                    continue
                for lo, hi, low, high, alike in align(a, b, *near, similarity):
                    if alike >= similarity and min(hi - lo, high - low) >= least:
                        rows.append((doc, lo + start, hi + start - 1, other, low + begin, high + begin - 1, alike))
            if rows:
                columns = list(zip(*rows))
                yield pa.record_batch(
                    [*(pa.array(c, pa.int64()) for c in columns[:6]), pa.array(columns[6], pa.float64())],
                    [c.split()[0] for c in PASSAGE.split(", ")],
                )

    return run


def repeated_passages(
    docs: DataFrame, least_words: int = LEAST_WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """One row per passage of a document that another one has too, see PASSAGE.

    Words are what white space separates, A-Z lowered, counted from 0; bounds include
    both ends. A passage has at least ``least_words`` words on both sides, and
    ``similarity`` is the share of words in common order; doc_id is the larger id.

    Passages of a document that overlap are one stretch, and passages tie stretches into
    classes: ``class_doc`` and ``class_first`` are the smallest document of the row's class
    and the first word of its stretch there. Two documents that share a passage have the
    stretches it lies in in one class; of many documents of one class not each pair has
    a row. Null and empty texts and rows without an id have no passages; rows that repeat
    an id are one document, of which the smallest text counts. No rows give no rows.
    """
    steps = Steps(docs.sparkSession, "passages")
    base = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc"), text_column().alias("text")
    )
    found = steps.save(base.mapInArrow(_seed_rows, "doc long, h long, place int, beside int"), "seeds")
    often = found.groupBy("h").agg(
        F.count("*").alias("n"), F.min("doc").alias("low"), F.max("doc").alias("high")
    ).where("low < high")
    # Only rows that repeat an id can repeat a place.
    shared = steps.save(found.join(often, "h"), "shared")
    steps.drop(found)
    packed = steps.save(
        shared.groupBy("doc").agg(F.collect_set(F.struct("h", "place", "beside")).alias("found"))
        .mapInArrow(_packed, "doc long, h binary, places binary, beside binary"),
        "packed",
    )
    # A document with one place has no passage that is longer than what one seed extends to.
    several = "length(places) > 4" if _least_span(least_words) > 0 else "true"
    texts = steps.save(
        base.mapInArrow(_squeezed, "doc long, text binary")
        .join(packed.where(several).select("doc"), "doc", "left_semi")
        .groupBy("doc").agg(F.collect_list("text").alias("text")),
        "texts",
    )

    met = steps.save(_meetings(shared), "met")
    rows = _compared(texts, packed, met, steps, least_words, similarity)
    frequent = steps.save(shared.where(f"n > {FEW}").select("doc", "h", "place").distinct(), "frequent")
    steps.drop(shared)
    left = None
    for runs in (True, False):
        classes = _classes(rows, steps)
        asked = _open_places(frequent, classes)
        if left is not None:
            # Classes only grow, so a key that is open now was open before.
            asked = asked.join(left, "doc", "left_semi")
        asked_texts = texts if left is None else _only(texts, left)
        keyed = steps.save(asked_texts.join(asked, "doc").select("doc", "text", "found").mapInArrow(_keys(least_words, runs), KEYS), "keys")
        if runs:
            open_ = steps.save(_open_keys(keyed).select("doc", "run", "low", "high").distinct(), "open")
            left = steps.save(open_.where("run = 0").select("doc").distinct(), "left")
        pairs = _stars(open_) if runs else _apart(keyed)
        again = steps.save(pairs.join(met, ["doc", "other"], "left_anti"), "again")
        steps.drop(keyed, classes)
        rows = rows.unionByName(_compared(texts, packed, again, steps, least_words, similarity, few=True))
        met = met.unionByName(again)
    classes = _classes(rows, steps)
    first = classes.groupBy("component").agg(F.min(F.struct("doc", "start")).alias("least"))
    named = classes.join(first, "component").select(
        F.col("doc").alias("doc_id"), "start", "stop",
        F.col("least.doc").alias("class_doc"), F.col("least.start").alias("class_first"),
    )
    return rows.join(named, "doc_id").where("first_word BETWEEN start AND stop").drop("start", "stop")


def _compared(
    texts: DataFrame, packed: DataFrame, met: DataFrame, steps: Steps, least_words: int, similarity: float,
    few: bool = False,
) -> DataFrame:
    """Passages of the pairs ``met`` (doc, other), from the seeds that the two share.

    ``few`` says that the pairs may be of few of all documents.
    """
    if few:
        packed = _only(packed, _sided(met))
    both_seeds = met.join(packed, "doc").join(
        packed.toDF("other", "g", "others", "beyond"), "other"
    )
    chained = steps.save(
        both_seeds.select("doc", "other", "h", "places", "beside", "g", "others", "beyond").mapInArrow(_chain_rows(least_words), CHAIN),
        "chains",
    )

    if few:
        texts = _only(texts, _sided(chained))

    # In a stretch that repeats, one seed may be all that is left of a passage.
    margin = max(MARGIN, least_words)

    def bounds(places: str, start: str, stop: str) -> list:
        first, last = F.element_at(places, 1), F.element_at(places, -1)
        return [
            (F.floor((first - margin) / F.lit(ROUND)) * ROUND).cast("int").alias(start),
            (F.ceil((last + SEED + margin) / F.lit(ROUND)) * ROUND).cast("int").alias(stop),
        ]

    ranged = chained.select(
        "*", *bounds("places", "start", "stop"), *bounds("others", "begin", "end")
    )
    wanted = (
        ranged.select("doc", "start", "stop")
        .unionByName(ranged.select(F.col("other").alias("doc"), F.col("begin").alias("start"), F.col("end").alias("stop")))
        .distinct()
    )
    asked = wanted.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("asked"))
    slices = steps.save(
        texts.join(asked, "doc").select("doc", "text", "asked")
        .mapInArrow(_slices, "doc long, start int, stop int, words binary"),
        "slices",
    )
    both = ranged.join(slices.withColumnRenamed("words", "a"), ["doc", "start", "stop"]).join(
        slices.select(
            F.col("doc").alias("other"), F.col("start").alias("begin"), F.col("stop").alias("end"),
            F.col("words").alias("b"),
        ),
        ["other", "begin", "end"],
    )
    rows = both.select("doc", "other", "places", "others", "start", "begin", "a", "b").mapInArrow(
        _aligned(least_words, similarity), PASSAGE
    )
    found = steps.save(rows, "passages")
    steps.drop(chained, slices)
    return found
