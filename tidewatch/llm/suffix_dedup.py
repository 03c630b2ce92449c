"""Removal of byte strings that occur more than once, by column-wise suffix sorting.

A string of ``length`` bytes is repeated when it starts at two places of the corpus.
Every such string (a window) contains a seed: of its GRAM-byte grams the one with the
smallest hash, the leftmost among equals. Equal windows have equal seeds at the same
place, so windows need only be compared around equal seeds, and there only with the
same distance to the seed.

1. Runs of neighbouring windows with one seed become one row: seed hash, hash of the
   bytes that the run covers, place. Rows whose seed occurs once are done.
2. Runs that are equal as a whole are repeated in all their windows; a count finds
   them, combined before the shuffle, so very common passages cost one row per task.
3. The other runs of a seed are a collection of short strings aligned at the seed.
   Its suffixes are sorted a column at a time from the right: each round inserts one
   symbol of every string, read from a file that holds the strings column by column,
   and updates the order (the rows of the collection's Burrows-Wheeler transform) and
   the common prefixes of neighbours. Neighbours with a common prefix of ``length``
   are repeated windows. As equal windows stand in the same column, columns need not
   be merged with each other.
4. A seed with very many different runs is refined before: its windows are halved by
   their distance to the seed, and each half has a longer common core that takes the
   place of the seed. A core that occurs once ends, runs that become equal are counted
   as in 2, and after eight halvings core and run are the same window.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import Steps, prefix_hashes, span_hashes, text_column

LENGTH = 200
GRAM = 50
PIECE = 1 << 19
PLACE = np.uint64((1 << 20) - 1)
COLLECTION = 16_384
GROUP = 192
MISSING = 256

RUN = "h long, c long, lo int, hi int"


def _windows(data: np.ndarray, ends: np.ndarray, length: int):
    """Runs of windows with one seed: hashes, seed place, smallest and largest distance.

    ``data`` holds texts one after another, ``ends`` where each ends.
    """
    span = length - GRAM + 1
    grams = len(data) - GRAM + 1
    starts = np.arange(max(len(data) - length + 1, 0))
    if not len(starts):
        return None
    starts = starts[starts + length <= ends[np.searchsorted(ends, starts, side="right")]]
    if not len(starts):
        return None
    sums = prefix_hashes(data)
    places = np.arange(grams)
    cores = span_hashes(sums, places, places + GRAM)
    keyed = (cores & ~PLACE) | places.astype(np.uint64)
    padded = np.full(-(-grams // span) * span, np.iinfo(np.uint64).max, np.uint64)
    padded[:grams] = keyed
    tiles = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(tiles, axis=1).ravel()
    back = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
    seed = (np.minimum(back[starts], ahead[starts + span - 1]) & PLACE).astype(np.int64)
    first = np.flatnonzero(np.diff(seed, prepend=-1) | (np.diff(starts, prepend=-2) != 1))
    last = np.append(first[1:], len(seed)) - 1
    place, low, high = seed[first], starts[first], starts[last]
    whole = span_hashes(sums, low, high + length)
    return cores[place].view(np.int64), whole.view(np.int64), place, place - high, place - low


def _seed_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for i, data in enumerate(batch.column(2).to_pylist()):
                for base in range(0, len(data), PIECE):
                    part = data[base : base + PIECE + length - 1]
                    if len(part) < length:
                        continue
                    held.append((i, base, part))
                    size += len(part)
                    if size >= PIECE:
                        yield from rows(batch, held)
                        held, size = [], 0
            yield from rows(batch, held)

    def rows(batch, held):
        if not held:
            return
        ends = np.cumsum([len(part) for _, _, part in held])
        found = _windows(np.frombuffer(b"".join(p for _, _, p in held), np.uint8), ends, length)
        if found is None:
            return
        h, c, place, lo, hi = found
        owner = np.searchsorted(ends, place, side="right")
        begins = ends - np.array([len(part) for _, _, part in held])
        base = np.array([b for _, b, _ in held])
        index = pa.array(np.array([i for i, _, _ in held])[owner])
        yield pa.record_batch(
            [batch.column(0).take(index), batch.column(1).take(index), pa.array(h), pa.array(c),
             pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)),
             pa.array(place - begins[owner] + base[owner])],
            ["doc", "tag", "h", "c", "lo", "hi", "place"],
        )

    return run


def _contexts(length: int):
    """Bytes of the wanted runs of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for r in wanted:
                    bytes_ = data[r["place"] - r["hi"] : r["place"] - r["lo"] + length]
                    out.append((r["h"], r["c"], r["lo"], r["hi"], r["n"], bytes_))
            for start in range(0, len(out), 4096):
                columns = list(zip(*out[start : start + 4096]))
                yield pa.record_batch(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                     pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32()),
                     pa.array(columns[4], pa.int64()), pa.array(columns[5], pa.binary())],
                    ["h", "c", "lo", "hi", "n", "bytes"],
                )

    return run


def _hash(data: bytes, salt: int) -> int:
    digest = hashlib.blake2b(data, digest_size=8, salt=salt.to_bytes(8, "little")).digest()
    return int.from_bytes(digest, "little", signed=True)


def _refine(length: int):
    """Both halves of a run, each under the hash of its longer core."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                middle = (r["low"] + r["high"]) // 2
                for low, high in ((r["low"], middle), (middle + 1, r["high"])):
                    lo, hi = max(r["slo"], low), min(r["shi"], high)
                    if low > high or lo > hi:
                        continue
                    # Place of the seed inside the bytes is the run's largest distance.
                    data = r["bytes"][r["shi"] - hi : r["shi"] - lo + length]
                    core = r["bytes"][max(r["shi"] - low, 0) : r["shi"] - high + length]
                    out.append({
                        **{k: r[k] for k in ("h", "c", "lo", "hi", "n")}, "low": low, "high": high,
                        "slo": lo, "shi": hi, "sh": _hash(core, low), "sc": _hash(data, hi), "bytes": data,
                    })
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=STATE_ARROW)

    return run


STATE = (
    "h long, c long, lo int, hi int, n long, low int, high int, slo int, shi int, "
    "sh long, sc long, bytes binary"
)
STATE_ARROW = pa.schema(
    [(name, {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[kind])
     for name, kind in (column.split() for column in STATE.split(", "))]
)


def repeated_windows(
    strings: list[bytes], seeds: list[int], groups: np.ndarray, length: int, span: int
) -> np.ndarray:
    """Whether each string's window at each distance to the seed is repeated in its group.

    ``seeds`` is the place of the seed in each string. Result: strings x distances.
    """
    count, before = len(strings), span - 1
    width = before + length
    found = np.zeros((count, span), bool)
    with tempfile.TemporaryFile() as columns:
        matrix = np.full((width, count), MISSING, np.uint16)
        for i, (data, seed) in enumerate(zip(strings, seeds)):
            begin = before - seed
            matrix[begin : begin + len(data), i] = np.frombuffer(data, np.uint8)
        matrix[::-1].tofile(columns)
        del matrix
        columns.seek(0)
        order = np.argsort(groups, kind="stable")
        common = np.zeros(count, np.int32)
        for column in reversed(range(width)):
            symbol = np.fromfile(columns, np.uint16, count)
            rank_group, rank_symbol = groups[order], symbol[order]
            # Rows of one group stay together; in it they are dealt out by the new symbol.
            insert = np.lexsort((rank_symbol, rank_group))
            same = np.zeros(count, bool)
            same[1:] = (
                (rank_group[insert][1:] == rank_group[insert][:-1])
                & (rank_symbol[insert][1:] == rank_symbol[insert][:-1])
                & (rank_symbol[insert][1:] != MISSING)
            )
            at = np.flatnonzero(same)
            after = np.zeros(count, np.int32)
            if len(at):
                after[at] = 1 + _range_minimum(common, insert[at - 1] + 1, insert[at])
            order, common = order[insert], after
            distance = before - column
            if distance >= 0:
                hit = np.flatnonzero(common >= length)
                found[order[hit], distance] = True
                found[order[hit - 1], distance] = True
    return found


def _range_minimum(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minimum of ``values[first .. last]`` for each pair of bounds."""
    result = np.empty(len(first), values.dtype)
    level = np.frexp(last - first + 1)[1] - 1
    table, step = values, 0
    for k in range(int(level.max()) + 1):
        here = np.flatnonzero(level == k)
        result[here] = np.minimum(table[first[here]], table[last[here] - (1 << k) + 1])
        step = 1 << k
        table = np.minimum(table[:-step], table[step:]) if len(table) > step else table
    return result


def _collections(length: int, span: int):
    """Repeated windows of whole seed groups, many groups in one collection."""

    def solve(rows: list[tuple]) -> pa.RecordBatch | None:
        groups = np.unique([r[0] for r in rows], return_inverse=True)[1]
        found = repeated_windows(
            [r[-1] for r in rows], [r[-2] for r in rows], groups, length, span
        )
        edge = np.zeros((len(rows), 1), np.int8)
        steps = np.diff(np.hstack([edge, found.astype(np.int8), edge]), axis=1)
        at, first = np.nonzero(steps == 1)
        last = np.nonzero(steps == -1)[1] - 1
        if not len(at):
            return None
        names = [np.array([rows[i][j] for i in at]) for j in range(1, 5)]
        kinds = (np.int64, np.int64, np.int32, np.int32)
        return pa.record_batch(
            [pa.array(v.astype(k)) for v, k in zip(names, kinds)]
            + [pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
            ["h", "c", "lo", "hi", "first", "last"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if len(held) >= COLLECTION and row[0] != held[-1][0]:
                    if (out := solve(held)) is not None:
                        yield out
                    held = []
                held.append(row)
        if held and (out := solve(held)) is not None:
            yield out

    return run


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, spans, left = [], [], []
        for data, marks in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            steps = np.zeros(len(data) + 1, np.int32)
            for mark in marks or ():
                steps[mark["start"]] += 1
                steps[mark["stop"]] -= 1
            gone = np.cumsum(steps[:-1]) > 0
            counts.append(int(gone.sum()))
            spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
            left.append(np.frombuffer(data, np.uint8)[~gone].tobytes() if marks else data)
        yield pa.record_batch(
            [batch.column(0), pa.array([len(d) for d in batch.column(1).to_pylist()], pa.int64()),
             pa.array(counts, pa.int64()), pa.array(spans, pa.int64()), pa.array(left, pa.binary()),
             batch.column(3)],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "left", "rest"],
        )


def _keys() -> list[Column]:
    """Key of a text: its id, 0 for none, and a hash of text and id."""
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc"),
        F.xxhash64("text", "doc_id").alias("tag"),
    ]


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, left, rest.

    Each byte that a repeated string of ``length`` bytes covers is removed; strings
    are judged on the input, overlaps count, and the first copy goes as well. ``left``
    is the bytes that remain, ``rest`` the columns named in ``carry``. Null texts are empty.
    Rows that repeat id and text repeat each other's bytes and get equal answers. Null
    ids are carried along. No rows give no rows.
    """
    steps = Steps(docs.sparkSession, "suffix")
    span = length - GRAM + 1
    rest = F.struct(*carry) if carry else F.struct(F.lit(True).alias("none"))
    texts = docs.select("doc_id", text_column().alias("text"), rest.alias("rest"))
    keyed = texts.select("doc_id", *_keys(), F.col("text").cast("binary").alias("data"), "rest")
    seeds = steps.save(
        keyed.select("doc", "tag", "data").mapInArrow(
            _seed_rows(length), "doc long, tag long, h long, c long, lo int, hi int, place long"
        ),
        "seeds",
    )
    often = seeds.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    runs = steps.save(seeds.join(often, "h"), "runs")
    steps.drop(seeds)
    classes = steps.save(
        runs.groupBy("h", "c", "lo", "hi").agg(
            F.count("*").alias("n"), F.min(F.struct("doc", "tag", "place")).alias("at")
        ),
        "classes",
    )
    mixed = (
        classes.groupBy("h")
        .agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
        .where("kinds > 1 AND least = 1")
    )
    wanted = (
        classes.join(mixed.select("h"), "h")
        .groupBy("at.doc", "at.tag")
        .agg(F.collect_list(F.struct("h", "c", "lo", "hi", "n", "at.place")).alias("wanted"))
    )
    contexts = steps.save(
        keyed.join(wanted, ["doc", "tag"])
        .select("data", "wanted")
        .mapInArrow(_contexts(length), f"{RUN}, n long, bytes binary"),
        "contexts",
    )
    marks = classes.where("n > 1").select(
        "h", "c", "lo", "hi", F.col("lo").alias("first"), F.col("hi").alias("last")
    )
    state = contexts.select(
        "*", F.lit(0).alias("low"), F.lit(span - 1).alias("high"), F.col("lo").alias("slo"),
        F.col("hi").alias("shi"), F.col("h").alias("sh"), F.col("c").alias("sc"),
    ).select([column.split()[0] for column in STATE.split(", ")])
    stored = []
    while True:
        sizes = state.groupBy("sh", "low", "high").agg(F.count("*").alias("size"))
        sized = steps.save(
            state.join(sizes.where("size > 1"), ["sh", "low", "high"]), "state"
        )
        stored.append(_solved(sized.where(F.col("size") <= GROUP), length, span, steps))
        large = sized.where(F.col("size") > GROUP)
        if large.isEmpty():
            break
        halves = steps.save(
            large.select([column.split()[0] for column in STATE.split(", ")]).mapInArrow(
                _refine(length), STATE
            ),
            "halves",
        )
        own = ["sh", "sc", "low", "high", "slo", "shi"]
        counted = halves.groupBy(*own).agg(F.sum("n").alias("copies"), F.count("*").alias("rows"))
        matched = halves.join(counted, own)
        stored.append(
            steps.save(
                matched.where("n = 1 AND copies > 1").select(
                    "h", "c", "lo", "hi", F.col("slo").alias("first"), F.col("shi").alias("last")
                ),
                "equal",
            )
        )
        # One of the equal runs goes on, for the others of its core.
        state = steps.save(_one_each(matched, own), "next")
    for part in stored:
        marks = marks.unionByName(part)
    spans = (
        runs.join(marks, ["h", "c", "lo", "hi"])
        .groupBy("doc", "tag")
        .agg(
            F.collect_set(
                F.struct(
                    (F.col("place") - F.col("last")).alias("start"),
                    (F.col("place") - F.col("first") + length).alias("stop"),
                )
            ).alias("spans")
        )
    )
    return (
        keyed.join(spans, ["doc", "tag"], "left")
        .select("doc_id", "data", "spans", "rest")
        .mapInArrow(
            _removed,
            "doc_id long, n_bytes long, n_removed long, n_spans long, left binary, "
            f"rest {keyed.schema['rest'].dataType.simpleString()}",
        )
    )


def _one_each(matched: DataFrame, own: list[str]) -> DataFrame:
    """One run of each set of equal ones, as many copies as they have together."""
    names = [column.split()[0] for column in STATE.split(", ")]
    alone = matched.where("rows = 1").select(names)
    several = (
        matched.where("rows > 1")
        .groupBy(*own)
        .agg(
            F.max("copies").alias("n"), F.first("bytes").alias("bytes"),
            *[F.first(name).alias(name) for name in ("h", "c", "lo", "hi")],
        )
        .select(names)
    )
    return alone.unionByName(several)


def _solved(sized: DataFrame, length: int, span: int, steps: Steps) -> DataFrame:
    """Repeated windows of the seed groups that fit into a collection."""
    groups = sized.select(
        F.xxhash64("sh", "low", "high").alias("g"), "h", "c", "lo", "hi", "n",
        F.col("shi").alias("seed"), "bytes",
    )
    found = (
        groups.repartition("g")
        .sortWithinPartitions("g")
        .select("g", "h", "c", "lo", "hi", "seed", "bytes")
        .mapInArrow(_collections(length, span), f"{RUN}, first int, last int")
    )
    return steps.save(found, "found")
