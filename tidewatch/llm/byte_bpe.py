"""Byte-level BPE over a global shuffle of distinct words, and its decoding.

Texts are cut into pre-tokens ("words"). The words of a block of documents are numbered,
and each document keeps the numbers in the order of their positions. Only the distinct
words of a block are shuffled, dealt by a checksum into many buckets: equal words meet in
one bucket, each distinct word of the whole corpus is encoded once, and its ids are joined
back to the blocks that hold it. A block then puts the ids of its documents together by
position. A block sends a word once, however often it repeats it, so even a word that
makes up a third of the corpus is one entry a block. A block's words of one bucket travel
as one compressed row.

Decoding joins each id to the table of token bytes, which has one row for each entry of
the vocabulary and is therefore broadcast, and joins the bytes by position.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import text_column

RANKS = "byte_bpe_multi_50k.tiktoken"
BLOCK_CHARS = 8 << 20
#: Buckets of words for each shuffle partition of the session.
BUCKETS = 4
LETTER, NUMBER, SPACE, OTHER, BORDER = range(5)
#: The endings of public_tokenizers.PATTERN that follow an apostrophe.
SHORT_ENDINGS = ("s", "t", "m", "d")
LONG_ENDINGS = ("re", "ve", "ll")


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@functools.cache
def word_encoder(path: str) -> tiktoken.Encoding:
    """Encoder that takes a whole string as one word."""
    return tiktoken.Encoding(
        "words", pat_str=r"(?s).+", mergeable_ranks=ranks_of(path), special_tokens={}
    )


@functools.cache
def class_ranges() -> tuple[tuple[int, int, int], ...]:
    """First code point, end and class of each run of letters, numbers or white space.

    Asked of the library whose words these must be: Unicode versions differ between
    libraries, and with them what counts as a letter.
    """
    found = []
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        bytewise = tiktoken.Encoding(
            "class", pat_str=pattern, special_tokens={},
            mergeable_ranks={bytes([i]): i for i in range(256)},
        )
        inside = bytes(bytewise.encode_ordinary(points)).decode()
        codes = np.frombuffer(inside.encode("utf-32-le"), "<u4")
        breaks = np.flatnonzero(np.diff(codes) != 1)
        first, last = codes[np.r_[0, breaks + 1]], codes[np.r_[breaks, len(codes) - 1]]
        found += [(int(a), int(b) + 1, kind) for a, b in zip(first, last)]
    return tuple(found)


@functools.cache
def _class_table(ranges: tuple) -> np.ndarray:
    table = np.full(0x110000, OTHER, np.int8)
    for first, end, kind in ranges:
        table[first:end] = kind
    return table


def split_words(texts: list[str], ranges: tuple) -> tuple[list[str], np.ndarray]:
    """Words of all texts in order, and the number of words of each text.

    Equal to the matches of public_tokenizers.PATTERN in each text. All are found at
    once: words begin where the class of characters changes, but for three rules. A
    space before a word belongs to it. The last white-space character before a word
    stands apart from those before it. An apostrophe that starts a word takes one of
    the fixed endings with it.
    """
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    borders = np.cumsum(lengths + 1) - 1
    kind = _class_table(ranges)[codes]
    kind[borders] = BORDER
    runs = np.r_[0, np.flatnonzero(kind[1:] != kind[:-1]) + 1]
    begins = np.zeros(len(codes) + 3, bool)
    begins[runs] = True

    after = runs[1:]
    before_word = (kind[after - 1] == SPACE) & (kind[after] != BORDER)
    after = after[before_word]
    begins[after - 1] = True
    begins[after[codes[after - 1] == ord(" ")]] = False

    marks = runs[:-1][np.diff(runs) == 1]
    marks = marks[(codes[marks] == ord("'")) & begins[marks] & (kind[marks + 1] == LETTER)]
    first = codes[marks + 1]
    second = np.where(kind[np.minimum(marks + 2, len(kind) - 1)] == LETTER,
                      codes[np.minimum(marks + 2, len(codes) - 1)], 0)
    short = np.isin(first, [ord(c) for c in SHORT_ENDINGS])
    long = np.zeros(len(marks), bool)
    for a, b in LONG_ENDINGS:
        long |= (first == ord(a)) & (second == ord(b))
    begins[marks[short | long] + 1] = False
    begins[marks[short] + 2] = True
    begins[marks[long] + 3] = True

    starts = np.flatnonzero(begins[: len(codes)])
    ends = np.r_[starts[1:], len(codes)]
    real = kind[starts] != BORDER
    starts, ends = starts[real], ends[real]
    counts = np.diff(np.r_[0, np.searchsorted(starts, borders)])
    return [joined[a:b] for a, b in zip(starts.tolist(), ends.tolist())], counts


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Seven bits a byte, the last byte of a number below 128, then compressed."""
    size = 1 + sum((numbers >= 1 << bits).astype(np.int64) for bits in (7, 14, 21, 28))
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(5):  # k bytes from the end of a number
        has = size > k
        out[ends[has] - 1 - k] = ((numbers[has] >> (7 * k)) & 127) | (128 if k else 0)
    return compress(out)


def compress(data) -> bytes:
    return zstandard.compress(memoryview(data).cast("B") if len(data) else b"")


def unpack_numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    lasts = np.flatnonzero(raw < 128)
    size = np.diff(np.r_[-1, lasts])
    numbers = raw[lasts].astype(np.int64)
    for k in range(1, 5):
        has = size > k
        numbers[has] |= (raw[lasts[has] - k].astype(np.int64) & 127) << (7 * k)
    return numbers


class Numbers(dict):
    """Numbers words by their first appearance."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _blocks(batches: Iterator[pa.RecordBatch], ranges: tuple, block_chars: int):
    """Blocks of batches: the block's id, its numbers, and a list of batches with theirs.

    A block is a run of documents of one input partition, so its id is the same
    whenever the partition is read again by a stage that begins with this table.
    """
    block, chars = TaskContext.get().partitionId() << 32, 0
    numbers, held = Numbers(), []
    for batch in batches:
        texts = batch.column("text").to_pylist()
        if not texts:
            continue
        words, counts = split_words(texts, ranges)
        coded = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        held.append((batch.column("rest"), coded, counts))
        chars += sum(map(len, texts))
        if chars >= block_chars:
            yield block, numbers, held
            block, chars, numbers, held = block + 1, 0, Numbers(), []
    if held:
        yield block, numbers, held


def _dealt_words(block: int, numbers: Numbers, buckets: int) -> pa.RecordBatch:
    """One row for each bucket with words of the block: their numbers, lengths and bytes."""
    words = [word.encode() for word in numbers]
    bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
    order = np.argsort(bucket, kind="stable")
    used, first = np.unique(bucket[order], return_index=True)
    rows = []
    for k, a, b in zip(used.tolist(), first, np.r_[first[1:], len(order)]):
        own = order[a:b]
        mine = [words[i] for i in own.tolist()]
        lengths = np.fromiter(map(len, mine), np.int64, len(mine))
        rows.append((k, block, pack_numbers(np.diff(own, prepend=0)), pack_numbers(lengths), compress(b"".join(mine))))
    columns = zip(*rows) if rows else [[]] * 5
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "block", "numbers", "lengths", "words"]
    )


def _encode_bucket(rows: pa.Table, path: str) -> pa.Table:
    """Ids of a bucket's words, each distinct word encoded once, joined back to its blocks."""
    encoder, known = word_encoder(path), {}
    sizes, ids = [], []
    for lengths, data in zip(rows["lengths"].to_pylist(), rows["words"].to_pylist()):
        text, ends = zstandard.decompress(data), np.cumsum(unpack_numbers(lengths)).tolist()
        found = []
        for a, b in zip([0, *ends], ends):
            word = text[a:b]
            if word not in known:
                known[word] = np.array(encoder.encode_ordinary(word.decode()), "<i4").tobytes()
            found.append(known[word])
        sizes.append(pack_numbers(np.fromiter(map(len, found), np.int64, len(found)) // 4))
        ids.append(compress(b"".join(found)))
    return pa.table(
        [rows["block"], rows["numbers"], pa.array(sizes, pa.binary()), pa.array(ids, pa.binary())],
        ["block", "numbers", "sizes", "ids"],
    )


def encode(
    docs: DataFrame,
    carry: tuple[str, ...] = ("doc_id",),
    path: str | None = None,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The carried columns and ``ids``, one row per document, repeated rows each.

    A null text is an empty one and has no ids. Ids may be null; other columns than
    those carried are ignored, whatever their names. No rows give no rows. ``docs``
    must give its rows in the same order when read again, as stored tables do.
    """
    path = path or public_tokenizers.path(RANKS)
    ranges = class_ranges()
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("rest"), text_column().alias("text"))

    def words(batches):
        for block, numbers, _ in _blocks(batches, ranges, block_chars):
            yield _dealt_words(block, numbers, buckets)

    def positions(batches):
        for block, _, held in _blocks(batches, ranges, block_chars):
            for rest, coded, counts in held:
                offsets = pa.array([0, len(rest)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.ListArray.from_arrays(offsets, rest),
                     pa.array([pack_numbers(counts)], pa.binary()), pa.array([pack_numbers(coded)], pa.binary())],
                    ["block", "rests", "counts", "numbers"],
                )

    rest = texts.schema["rest"].dataType.simpleString()
    dealt = texts.mapInArrow(words, "bucket int, block long, numbers binary, lengths binary, words binary")
    coded = dealt.groupBy("bucket").applyInArrow(
        lambda rows: _encode_bucket(rows, path), "block long, numbers binary, sizes binary, ids binary"
    )
    placed = texts.mapInArrow(positions, f"block long, rests array<{rest}>, counts binary, numbers binary")
    together = coded.groupBy("block").cogroup(placed.groupBy("block"))
    return together.applyInArrow(_by_position, f"rest {rest}, ids array<int>").select(
        *[F.col(f"rest.`{c}`").alias(c) for c in carry], "ids"
    )


def _by_position(words: pa.Table, docs: pa.Table) -> pa.Table:
    """Ids of a block's documents from the ids of its words."""
    numbers = [np.cumsum(unpack_numbers(x)) for x in words["numbers"].to_pylist()]
    sizes = [unpack_numbers(x) for x in words["sizes"].to_pylist()]
    flat = np.frombuffer(b"".join(map(zstandard.decompress, words["ids"].to_pylist())), "<i4")
    order = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
    size, first = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    if numbers:
        size[order] = np.concatenate(sizes)
        first[order] = np.cumsum(size[order]) - size[order]
    tables = []
    for rests, counts, coded in zip(docs["rests"], docs["counts"].to_pylist(), docs["numbers"].to_pylist()):
        coded, ends = unpack_numbers(coded), np.cumsum(unpack_numbers(counts))
        width = size[coded]
        stops = np.r_[0, np.cumsum(width)]
        place = np.repeat(first[coded] - stops[:-1], width) + np.arange(stops[-1])
        ids = pa.ListArray.from_arrays(
            pa.array(stops[np.r_[0, ends]].astype("<i4")), pa.array(flat[place].astype("<i4"))
        )
        tables.append(pa.table([rests.values, ids], ["rest", "ids"]))
    return pa.concat_tables(tables)


def token_bytes(path: str) -> pa.Array:
    """Bytes of each id, null where the vocabulary has no such id."""
    ranks = ranks_of(path)
    table = [None] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        table[i] = token
    return pa.array(table, pa.binary())


def decode(coded: DataFrame, path: str | None = None) -> DataFrame:
    """``coded`` with the column ``decoded``: the bytes of its ``ids`` by position.

    Null ids give null bytes, no ids give none. An id that the vocabulary lacks adds
    nothing. A column that is already named ``decoded`` is replaced.
    """
    path = path or public_tokenizers.path(RANKS)
    others = [c for c in coded.columns if c not in ("ids", "decoded")]
    bare = coded.select(F.struct(*[F.col(f"`{c}`") for c in others], "ids").alias("row"))
    kind = bare.schema["row"].dataType.simpleString()
    table = coded.sparkSession.sparkContext.broadcast(token_bytes(path))

    def run(batches):
        for batch in batches:
            ids = batch.column("row").field("ids")
            texts = []
            for row in ids:
                if not row.is_valid:
                    texts.append(None)
                    continue
                known = np.asarray(row.values.fill_null(-1))
                known = known[(known >= 0) & (known < len(table.value))]
                found = table.value.take(pa.array(known)).drop_null()
                start, end = found.buffers()[1], len(found)
                place = np.frombuffer(start, "<i4")[found.offset : found.offset + end + 1]
                texts.append(found.buffers()[2].to_pybytes()[place[0] : place[-1]] if end else b"")
            yield pa.record_batch([batch.column("row"), pa.array(texts, pa.binary())], ["row", "decoded"])

    return bare.mapInArrow(run, f"row {kind}, decoded binary").select(
        *[F.col(f"row.`{c}`").alias(c) for c in others], F.col("row.ids").alias("ids"), "decoded"
    )
