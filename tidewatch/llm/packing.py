"""Packing of tokenised documents into windows of equal capacity.

Each input partition is packed on its own, so nothing is shuffled. Its token stream is
cut into blocks of ``windows`` windows less a small slack. Inside a block, whole
windows are cut off long documents, what is left is cut into pieces, and the pieces
are spread by Karmarkar-Karp multiway differencing: partial partitions, each a vector
of window sums, wait in a heap by their imbalance, and the two most uneven are merged
with opposing order, largest sum to smallest. If a window still exceeds the capacity,
the block is partitioned anew with one window more. The end of a partition that fills
no window becomes windows whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidewatch.llm.common import text_column

CAPACITY = 2048
WINDOWS = 128
PIECE = 512
SLACK = 8
END = 1
VOCABULARY = "byte_bpe_50k"
END_OF_TEXT = "<|endoftext|>"


class Encoder:
    """Token ids of the vocabulary file; the rank file holds the same vocabulary.

    The rank file's library is several times faster. Texts that it refuses, such as
    extreme runs of white space, go through the vocabulary file itself.
    """

    def __init__(self, vocabulary: str = VOCABULARY):
        import tiktoken

        self.vocabulary = vocabulary
        lines = open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb")
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
            special_tokens={END_OF_TEXT: len(ranks)},
        )
        self.plain = None

    def ids(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4")
        except BaseException as error:
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            if self.plain is None:
                from tokenizers import Tokenizer

                self.plain = Tokenizer.from_file(public_tokenizers.path(f"{self.vocabulary}.json"))
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, "<u4")


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Items of each of ``k`` windows of near-equal sums."""
    left, right = [], []

    def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        first = len(sizes) + len(left)
        left.extend(a.tolist())
        right.extend(b.tolist())
        return np.arange(first, first + len(a))

    def spread(sums: np.ndarray) -> int:
        return int(sums[0]) - (int(sums[-1]) if len(sums) == k else 0)

    heap = []
    for i, size in enumerate(sizes):
        heap.append((-size if k > 1 else 0, i, np.array([size]), np.array([i])))
    heapq.heapify(heap)
    ticket = len(sizes)
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, other, more = heapq.heappop(heap)
        shared = len(sums) + len(other) - k
        if shared > 0:
            # The last ``shared`` sums of one side meet those of the other in reverse.
            a, b = len(sums) - shared, len(other) - shared
            sums = np.concatenate([sums[:a], other[:b], sums[a:] + other[b:][::-1]])
            nodes = np.concatenate([nodes[:a], more[:b], join(nodes[a:], more[b:][::-1])])
        else:
            sums, nodes = np.concatenate([sums, other]), np.concatenate([nodes, more])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        heapq.heappush(heap, (-spread(sums), ticket, sums, nodes))
        ticket += 1
    windows: list[list[int]] = []
    for root in heap[0][3].tolist() if heap else []:
        items, stack = [], [root]
        while stack:
            node = stack.pop()
            if node < len(sizes):
                items.append(node)
            else:
                stack += (left[node - len(sizes)], right[node - len(sizes)])
        windows.append(sorted(items))
    return windows + [[] for _ in range(k - len(windows))]


Piece = tuple[int, int, int]  # document of the block, start, length


def split(pieces: list[Piece], tokens: int) -> tuple[list[Piece], list[Piece]]:
    """The first ``tokens`` tokens and the rest."""
    head = []
    for i, (doc, start, length) in enumerate(pieces):
        if length > tokens:
            if tokens:
                head.append((doc, start, tokens))
            return head, [(doc, start + tokens, length - tokens), *pieces[i + 1 :]]
        head.append((doc, start, length))
        tokens -= length
    return head, []


def pack_block(pieces: list[Piece], capacity: int, piece: int) -> list[list[Piece]]:
    """Windows of one block."""
    whole, items = [], []
    for doc, start, length in pieces:
        while length >= capacity:
            whole.append([(doc, start, capacity)])
            start, length = start + capacity, length - capacity
        while length:
            size = min(piece, length)
            items.append((doc, start, size))
            start, length = start + size, length - size
    if not items:
        return whole
    sizes = [size for _, _, size in items]
    k = -(-sum(sizes) // capacity)
    while True:
        windows = differencing(sizes, k)
        if max(sum(sizes[i] for i in window) for window in windows) <= capacity:
            return whole + [[items[i] for i in window] for window in windows if window]
        k += 1


def powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    total = sum(length for _, _, length in pieces)
    windows = []
    for bit in reversed(range(total.bit_length())):
        if total >> bit & 1:
            window, pieces = split(pieces, 1 << bit)
            windows.append(window)
    return windows


SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, padded_length long"
)


def _packer(capacity: int, windows: int, piece: int, slack: int, end: int, ids: bool):
    fill = windows * (capacity - slack)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        next_sequence = TaskContext.get().partitionId() << 40
        docs, tokens, queue, held = [], [], [], 0

        def emit(sequences: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal next_sequence
            rows = []
            for sequence in sequences:
                length = sum(size for _, _, size in sequence)
                padded = length if length & (length - 1) == 0 else capacity
                offset = 0
                for doc, start, size in sequence:
                    part = tokens[doc][start : start + size]
                    row = (docs[doc], start, size, zlib.crc32(part.tobytes()), len(tokens[doc]),
                           next_sequence, offset, padded)
                    rows.append((*row, part) if ids else row)
                    offset += size
                next_sequence += 1
            columns = list(zip(*rows))
            arrays = [pa.array(c, pa.int64()) for c in columns[:8]]
            if ids:
                arrays.append(pa.array([p.tolist() for p in columns[8]], pa.list_(pa.int64())))
            return pa.record_batch(arrays, [*(c.split()[0] for c in SCHEMA.split(", ")), *["ids"] * ids])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.append(encoder.ids(text), np.uint32(end)).astype("<u4")
                queue.append((len(docs), 0, len(own)))
                docs.append(doc)
                tokens.append(own)
                held += len(own)
                while held >= fill:
                    block, queue = split(queue, fill)
                    held -= fill
                    yield emit(pack_block(block, capacity, piece))
                    first = queue[0][0] if queue else len(docs)
                    docs, tokens = docs[first:], tokens[first:]
                    queue = [(d - first, s, n) for d, s, n in queue]
        count = held // (capacity - slack)
        block, rest = split(queue, count * (capacity - slack))
        last = (pack_block(block, capacity, piece) if block else []) + powers_of_two(rest)
        if last:
            yield emit(last)

    return run


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    windows: int = WINDOWS,
    piece: int = PIECE,
    slack: int = SLACK,
    end: int = END,
    ids: bool = False,
) -> DataFrame:
    """One row per piece of a document, see SCHEMA; with ``ids`` also its token ids.

    A document is its token ids and then ``end``; a null or empty text is ``end``
    alone. Each id lies in exactly one piece. Pieces of one sequence follow each other
    from offset 0 without gaps. ``padded_length`` is the sequence's own length where
    that is a power of two, else ``capacity``. A null id is carried along, repeated
    rows are packed as often as they come, no rows give no rows.
    """
    return docs.select("doc_id", text_column().alias("text")).mapInArrow(
        _packer(capacity, windows, piece, slack, end, ids),
        SCHEMA + (", ids array<long>" if ids else ""),
    )
