"""Sampled segmentations of texts into the pieces of a vocabulary.

A text is cut into words (a run of spaces belongs to the word that follows). The ways
to write a word with pieces form a lattice. Forward filtering sums the probabilities
of all ways to reach each place of a word, once per different word of a batch; backward sampling
then walks every word of a batch from its end to its start at the same time, drawing
one arc a step. The random numbers come from a hash of the row's key, the word's number
and the place, so a row always gets the same segmentation.

The vocabulary's scores are merge ranks. They become log-probabilities by a power law,
``-sharpness * log(rank + 2)``. Characters without a piece are written as bytes, and so
is the mark that stands for a space, wherever it is itself part of a text; decoding
therefore gives back every text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import mix, powers, prefix_hashes

VOCABULARY = "piece_bpe_32k.model"
SHARPNESS = 1.5
SPACE = "▁"
WORD = re.compile(r" *[^ \n]+|\n| +")
BYTE_COST = 12.0
LONGEST = 64
#: Characters whose words share one lattice; more of them repeat more words.
TOGETHER = 1 << 20
FILTER_BITS = 20
SPREAD = np.uint64(0xC4CEB9FE1A85EC53)


class Vocabulary:
    def __init__(self, name: str = VOCABULARY):
        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        self.pieces: dict[str, int] = {}
        self.bytes = {}
        self.text: dict[int, bytes] = {}
        rank = np.zeros(model.get_piece_size())
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.text[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.pieces[piece] = i
                self.text[i] = piece.replace(SPACE, " ").encode()
                rank[i] = min(-model.get_score(i), 1e5)
        spelled = [self.text.get(i, b"") for i in range(model.get_piece_size())]
        self.sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(spelled), np.uint8)
        self.longest = max(map(len, self.pieces))
        self.score = -SHARPNESS * np.log(rank + 2)
        names = list(self.pieces)
        codes, ends = _codes(names)
        hashes = _quick_hashes(prefix_hashes(codes), ends - [len(n) for n in names], ends)
        order = np.argsort(hashes)
        self.hashes, self.found = hashes[order], np.array(list(self.pieces.values()))[order]
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[hashes >> np.uint64(64 - FILTER_BITS)] = True

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are those of pieces, and the pieces."""
        maybe = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - FILTER_BITS)])
        near = np.searchsorted(self.hashes, hashes[maybe])
        near = np.minimum(near, len(self.hashes) - 1)
        hit = self.hashes[near] == hashes[maybe]
        return maybe[hit], self.found[near[hit]]


def _quick_hashes(sums: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hash of spans whose high bits are used; cheaper than the fully mixed one."""
    _, down = powers(len(sums))
    return ((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64)) * SPREAD


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, and where each word ends."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return codes, np.cumsum([len(w) for w in words])


@lru_cache(maxsize=1)
def vocabulary(name: str = VOCABULARY) -> Vocabulary:
    return Vocabulary(name)


class Lattices:
    """Lattices of some words; a word of n characters has the places 0 .. n.

    Arcs are in the order of the place where they stop. ``cumulative`` holds that
    place plus the summed shares of the place's arcs up to this one, so that one
    search over all of it draws an arc of any place.
    """

    def __init__(self, words: list[str], vocabulary: Vocabulary):
        self.index = {word: i for i, word in enumerate(words)}
        marked = [w.replace(SPACE, "\0").replace(" ", SPACE) for w in words]
        codes, ends = _codes(marked)
        begins = ends - np.array([len(w) for w in words])
        owner = np.repeat(np.arange(len(words)), ends - begins)
        self.first = begins + np.arange(len(words))
        self.last = ends + np.arange(len(words))
        sums = prefix_hashes(codes)
        at, room = np.arange(len(codes)), ends[owner]
        starts, stops, pieces = [], [], []
        single = np.zeros(len(codes), bool)
        for n in range(1, vocabulary.longest + 1):
            if n > 1:
                fits = at + n <= room
                at, room = at[fits], room[fits]
            if not len(at):
                break
            hit, found = vocabulary.look_up(_quick_hashes(sums, at, at + n))
            if n == 1:
                single[at[hit]] = True
            starts.append(at[hit])
            stops.append(at[hit] + n)
            pieces.append(found)
        spelt = np.flatnonzero(~single)
        starts, stops = np.concatenate([*starts, spelt]), np.concatenate([*stops, spelt + 1])
        pieces = np.concatenate([*pieces, np.full(len(spelt), -1)])
        order = np.argsort(stops, kind="stable")
        starts, stops, pieces = starts[order], stops[order], pieces[order]
        text = [SPACE if c == 0 else chr(c) for c in codes[starts[pieces < 0]].tolist()]
        spelling = [[vocabulary.bytes[b] for b in c.encode()] for c in text]
        self.lengths = np.ones(len(starts), np.int64)
        self.lengths[pieces < 0] = [len(ids) for ids in spelling]
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.ids = np.repeat(pieces, self.lengths)
        self.ids[self.ids < 0] = [i for ids in spelling for i in ids]
        score = np.where(pieces >= 0, vocabulary.score[pieces], -BYTE_COST * self.lengths)
        self._filter(starts + owner[starts], stops + owner[stops - 1], score, stops - begins[owner[stops - 1]])

    def _filter(self, source, place, score, depth) -> None:
        """Forward filtering: shares of all arcs, for all words a place at a time."""
        self.source = source
        total = np.full(int(self.last[-1]) + 1 if len(self.last) else 1, -np.inf)
        total[self.first] = 0
        self.cumulative = np.empty(len(source))
        by_depth = np.argsort(depth, kind="stable")
        edges = np.searchsorted(depth[by_depth], np.arange(1, int(depth.max(initial=0)) + 2))
        for low, high in zip(edges[:-1], edges[1:]):
            arcs = by_depth[low:high]
            if not len(arcs):
                continue
            weight = total[source[arcs]] + score[arcs]
            heads = np.flatnonzero(np.diff(place[arcs], prepend=-1))
            sizes = np.diff(np.append(heads, len(arcs)))
            top = np.maximum.reduceat(weight, heads)
            share = np.exp(weight - np.repeat(top, sizes))
            whole = np.add.reduceat(share, heads)
            total[place[arcs[heads]]] = top + np.log(whole)
            running = np.cumsum(share)
            running -= np.repeat(running[heads] - share[heads], sizes)
            self.cumulative[arcs] = place[arcs] + np.minimum(running / np.repeat(whole, sizes), 1) * (1 - 1e-9)


def split(text: str) -> list[str]:
    """Words of a text; joined they are the text. Very long ones are cut."""
    words = WORD.findall(text)
    if max(map(len, words), default=0) > LONGEST:
        words = [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]
    return words


def sample(lists: list[list[str]], keys: np.ndarray, words: Vocabulary) -> list[np.ndarray]:
    """Ids of one drawn segmentation of each list of words."""
    counts = np.array([len(own) for own in lists], np.int64)
    if not counts.sum():
        return [np.zeros(0, np.int64) for _ in lists]
    graph = Lattices(list(dict.fromkeys(w for own in lists for w in own)), words)
    kind = np.fromiter((graph.index[w] for own in lists for w in own), np.int64, int(counts.sum()))
    number = np.arange(len(kind)) - np.repeat(np.cumsum(counts) - counts, counts)
    seed = mix(np.repeat(keys, counts) + mix(number.astype(np.uint64)))
    first = graph.first[kind]
    # Words of one kind side by side: neighbouring draws look at neighbouring places.
    place, active = graph.last[kind], np.argsort(kind, kind="stable")
    drawn, owners = [], []
    while len(active):
        now = place[active]
        u = (mix(seed[active] + (now - first[active]).astype(np.uint64)) >> np.uint64(11)) / 2.0**53
        arc = np.searchsorted(graph.cumulative, now + u * (1 - 4e-9), side="left")
        drawn.append(arc)
        owners.append(active)
        place[active] = graph.source[arc]
        active = active[graph.source[arc] > first[active]]
    # Arcs were drawn from the end of each word: its last arc comes first.
    owner = np.concatenate(owners[::-1])
    order = np.argsort(owner, kind="stable")
    arc, owner = np.concatenate(drawn[::-1])[order], owner[order]
    many = graph.lengths[arc]
    at = np.repeat(graph.begins[arc] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    per_word = np.bincount(owner, many, len(kind))
    ends = np.concatenate([[0], np.cumsum(per_word)]).astype(np.int64)[np.cumsum(counts)]
    return np.split(graph.ids[at], ends[:-1])


def decode(ids, vocabulary: Vocabulary) -> str:
    """Text of a sequence of ids: their bytes copied from one array by offsets."""
    ids = np.asarray(ids, np.int64)
    many = vocabulary.sizes[ids]
    ends = np.cumsum(many)
    total = int(ends[-1]) if len(ends) else 0
    place = np.repeat(vocabulary.starts[ids] - (ends - many), many) + np.arange(total)
    return vocabulary.flat[place].tobytes().decode()


def _encode(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary()
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            keys = batch.column(2).to_numpy().view(np.uint64)
            out = []
            start, size = 0, 0
            for stop, text in enumerate(texts, 1):
                size += len(text)
                if size > TOGETHER or stop == len(texts):
                    out += sample([split(t) for t in texts[start:stop]], keys[start:stop], words)
                    start, size = stop, 0
            same = [decode(ids, words) == text for ids, text in zip(out, texts)]
            columns = [
                batch.column(0), pa.array([len(i) for i in out], pa.int64()),
                pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in out], pa.int64()),
                pa.array(same, pa.bool_()),
            ]
            names = ["doc_id", "n_pieces", "ids_crc32", "lossless"]
            if with_ids:
                ends = np.cumsum([0, *map(len, out)])
                flat = np.concatenate(out).astype(np.int32) if out else np.zeros(0, np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
                names.append("ids")
            yield pa.record_batch(columns, names)

    return run


def encode(docs: DataFrame, seed: int = 0, ids: bool = True) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (little-endian 32-bit ids), lossless and, asked for, ids.

    The row key is a hash of the id and ``seed``; rows without an id share one key.
    Null and empty texts have no pieces. Repeated rows get equal answers, no rows give
    no rows. ``lossless`` tells that decoding the ids gave the text again.
    """
    key = F.xxhash64(F.lit(seed).cast("long"), "doc_id")
    return docs.select("doc_id", "text", key.alias("key")).mapInArrow(
        _encode(ids),
        "doc_id long, n_pieces long, ids_crc32 long, lossless boolean" + (", ids array<int>" if ids else ""),
    )


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = vocabulary()
    for batch in batches:
        texts = [None if ids is None else decode(ids, words) for ids in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])


def decode_rows(encoded: DataFrame) -> DataFrame:
    """doc_id and text of rows with ids; null ids give a null text."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode, "doc_id long, text string")
