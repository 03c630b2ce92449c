"""Language of texts by a linear-chain conditional random field over words.

A word's emission is a sum of learned weights of its character n-grams (with word
edges, so prefixes and suffixes are among them), of the word itself and of the
lexicons it is in. Learned transitions tie neighbouring words, so that a text may
switch its language inside. Forward-backward gives each word's label probabilities;
a text's language is the one with the largest mean probability.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import batched, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import prefix_hashes, span_hashes

BUCKETS = 1 << 16
GRAMS = (1, 2, 3, 4)
SAMPLE_ROWS = 1600
LANGUAGE_ROWS = 400  # Spark cuts ranks of up to 1000 before the shuffle
TEXT_PIECES = 25
SEQUENCES = 6000
SEQUENCE_WORDS = 24
ROUNDS = 60
RATE = 0.25
DECAY = 1e-4
LEXICON_COUNT = 3
LEXICON_SHARE = 0.9
CACHE = 200_000
#: Words whose chains advance together; more of them share the cost of a step, but are held at once.
TOGETHER = 500_000
#: Words whose n-grams are held at once.
EMITTED = 4096
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters; none if the text has no letter at all."""
    words = WORD.findall(text.lower()) if text else []
    return words if any(w.isalpha() or any(map(str.isalpha, w)) for w in words) else []


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of all words, and where each word's buckets begin."""
    encoded = [b"\x02" + w.encode() + b"\x03" for w in words]
    data = np.frombuffer(b"".join(encoded), np.uint8)
    ends = np.cumsum([len(e) for e in encoded])
    begins = ends - [len(e) for e in encoded]
    owner = np.repeat(np.arange(len(words)), ends - begins)
    sums = prefix_hashes(data)
    found, owners = [span_hashes(sums, begins, ends)], [np.arange(len(words))]
    for n in GRAMS:
        start = np.flatnonzero(np.arange(len(data)) + n <= ends[owner])
        found.append(span_hashes(sums, start, start + n))
        owners.append(owner[start])
    owners, found = np.concatenate(owners), np.concatenate(found)
    order = np.argsort(owners, kind="stable")
    begin = np.searchsorted(owners[order], np.arange(len(words)))
    return (found[order] % np.uint64(BUCKETS)).astype(np.int64), begin


class Model:
    """Labels, weights of buckets and lexicons, transitions and start weights."""

    def __init__(self, labels, weights, lexicon, lexicon_weights, transitions, starts):
        self.labels, self.weights, self.lexicon = labels, weights, lexicon
        self.lexicon_weights, self.transitions, self.starts = lexicon_weights, transitions, starts

    def emissions(self, words: list[str]) -> np.ndarray:
        found = []
        for some in batched(words, EMITTED):
            buckets, begin = features(some)
            scores = np.add.reduceat(self.weights[buckets], begin, axis=0)
            found.append(scores + self.lexicon_weights[[self.lexicon.get(w, -1) for w in some]])
        return np.concatenate(found)


def forward_backward(
    scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, starts: np.ndarray,
    count_pairs: bool = True,
) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of all words, and summed pair probabilities (else zeros).

    ``scores`` holds the sequences one after another; all sequences advance together.
    """
    begin = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    begin, lengths = begin[order], lengths[order]
    lift = scores - scores.max(axis=1, keepdims=True)
    np.exp(lift, out=lift)
    move = np.exp(transitions)
    most = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(most), side="left")
    forward, backward = np.empty_like(lift), np.empty_like(lift)
    for t in range(most):
        at = begin[: active[t]] + t
        now = lift[at] * (np.exp(starts) if t == 0 else now[: active[t]] @ move)
        now /= now.sum(axis=1, keepdims=True)
        forward[at] = now
    pairs = np.zeros_like(move)
    after = np.empty((0, scores.shape[1]))
    for t in reversed(range(most)):
        at = begin[: active[t]] + t
        now = np.ones((active[t], scores.shape[1]))
        if len(after):
            ahead = after * lift[at[: len(after)] + 1]
            now[: len(after)] = ahead @ move.T
            now[: len(after)] /= now[: len(after)].sum(axis=1, keepdims=True)
            if count_pairs:
                own = forward[at[: len(after)]]
                total = np.einsum("ni,ij,nj->n", own, move, ahead)
                pairs += np.einsum("ni,ij,nj->ij", own / total[:, None], move, ahead)
        backward[at] = after = now
    forward *= backward
    forward /= forward.sum(axis=1, keepdims=True)
    return forward, pairs


def _lexicon(words: list[str], marks: np.ndarray, labels: int) -> dict[str, int]:
    """Words that belong to one language nearly always."""
    counts = Counter(zip(words, marks.tolist()))
    total = Counter(words)
    return {
        word: label
        for (word, label), n in counts.items()
        if total[word] >= LEXICON_COUNT and n >= LEXICON_SHARE * total[word]
    }


def fit(rows: list[tuple[str, str]], seed: int = 0) -> Model | None:
    """Model of (text, language) rows; None if they hold no words.

    Texts are cut into short sequences, which are drawn evenly over the texts of a
    language, however long these are. A third of the training sequences joins parts
    of two texts, which is where transitions between languages are learned.
    """
    random = np.random.default_rng(seed)
    labels = sorted({lang for _, lang in rows})
    pool: list[list[list[list[str]]]] = [[] for _ in labels]
    for text, lang in rows:
        words = words_of(text)
        if words:
            pool[labels.index(lang)].append(
                [words[i : i + SEQUENCE_WORDS] for i in range(0, len(words), SEQUENCE_WORDS)]
            )

    def draw(label: int) -> list[str]:
        pieces = pool[label][random.integers(len(pool[label]))]
        return pieces[random.integers(len(pieces))]

    filled = [i for i, p in enumerate(pool) if p]
    if not filled:
        return None
    words, marks, lengths = [], [], []
    for _ in range(SEQUENCES):
        first = filled[random.integers(len(filled))]
        part = draw(first)
        mark = [first] * len(part)
        if random.random() < 1 / 3:
            second = filled[random.integers(len(filled))]
            more = draw(second)
            cut, size = random.integers(len(part) + 1), random.integers(1, len(more) + 1)
            part = part[:cut] + more[:size]
            mark = mark[:cut] + [second] * size
        words += part
        marks += mark
        lengths.append(len(part))
    marks, lengths = np.array(marks), np.array(lengths)
    types = list(dict.fromkeys(words))
    index = {w: i for i, w in enumerate(types)}
    kind = np.fromiter((index[w] for w in words), np.int64, len(words))
    lexicon = _lexicon(words, marks, len(labels))
    listed = np.array([lexicon.get(w, len(labels)) for w in types])
    buckets, begin = features(types)
    owner = np.repeat(np.arange(len(types)), np.diff(np.append(begin, len(buckets))))
    n = len(labels)
    first_words = np.cumsum(lengths) - lengths
    observed = np.zeros((len(words), n))
    observed[np.arange(len(words)), marks] = 1
    inner = np.ones(len(words), bool)
    inner[first_words] = False
    seen = np.flatnonzero(inner)
    pairs = np.zeros((n, n))
    np.add.at(pairs, (marks[seen - 1], marks[seen]), 1)
    shapes = [(BUCKETS, n), (n + 1, n), (n, n), (n,)]
    values = [np.zeros(s) for s in shapes]
    squares = [np.full(s, 1e-8) for s in shapes]
    for _ in range(ROUNDS):
        weights, by_lexicon, moves, starts = values
        scores = (np.add.reduceat(weights[buckets], begin, axis=0) + by_lexicon[listed])[kind]
        found, expected = forward_backward(scores, lengths, moves, starts)
        gap = observed - found
        by_type = np.stack([np.bincount(kind, gap[:, j], len(types)) for j in range(n)], axis=1)
        slopes = [
            np.stack([np.bincount(buckets, by_type[owner, j], BUCKETS) for j in range(n)], axis=1),
            np.stack([np.bincount(listed, by_type[:, j], n + 1) for j in range(n)], axis=1),
            pairs - expected,
            gap[first_words].sum(axis=0),
        ]
        slopes[1][n] = 0
        for value, square, slope in zip(values, squares, slopes):
            slope = slope / len(lengths) - DECAY * value
            square += slope**2
            value += RATE * slope / np.sqrt(square)
    weights, by_lexicon, moves, starts = values
    return Model(labels, weights.astype(np.float32), lexicon, by_lexicon, moves, starts)


def train(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """Model of at most ``rows`` different labelled texts, LANGUAGE_ROWS of each language at most.

    The sample is the texts with the smallest hashes, so it depends neither on their
    order nor on the number of their copies. TEXT_PIECES sequences of each, spread over
    the whole text, are used. ``docs`` needs text and lang; rows without either are not used.
    """
    return fit([(r.text, r.lang) for r in sample(docs, rows).collect()])


def spread_words(text: str) -> str:
    """TEXT_PIECES runs of SEQUENCE_WORDS words at even distances, or all words of less."""
    words = words_of(text)
    pieces = -(-len(words) // SEQUENCE_WORDS)
    if pieces <= TEXT_PIECES:
        return " ".join(words)
    starts = [i * pieces // TEXT_PIECES * SEQUENCE_WORDS for i in range(TEXT_PIECES)]
    return " ".join(w for at in starts for w in words[at : at + SEQUENCE_WORDS])


def _some_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [spread_words(t) for t in batch.column(3).to_pylist()]
        yield pa.record_batch([*batch.columns[:3], pa.array(texts, pa.string())], ["n", "h", "lang", "text"])


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The texts that :func:`train` learns from, with n (place in their language), h and lang."""
    hashed = docs.where("text IS NOT NULL AND lang IS NOT NULL").select(
        "lang", F.xxhash64("text").alias("h"), "text"
    )
    # Copies are merged as hashes; the texts of those picked are fetched afterwards.
    each = hashed.select("lang", "h").distinct().withColumn(
        "n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    ).where(F.col("n") <= LANGUAGE_ROWS)
    picked = each.orderBy("n", "h", "lang").limit(rows)
    texts = hashed.join(F.broadcast(picked), ["lang", "h"]).groupBy("n", "h", "lang").agg(
        F.min("text").alias("text")
    )
    return texts.mapInArrow(_some_words, "n int, h long, lang string, text string").orderBy("n", "h", "lang")


class Numbers(dict):
    """Numbers words by their first appearance."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _predictor(shared):
    def bundles(batches: Iterator[pa.RecordBatch]):
        """Batches with the number of words of each text, the numbers of their words and all
        words so far, about TOGETHER words at a time. No text or word is held but once."""
        cache, held, lengths, kinds, total = Numbers(), [], [], [], 0
        for batch in batches:
            for text in batch.column(1):
                words = words_of(text.as_py()) if shared.value else []
                lengths.append(len(words))
                total += len(words)
                kinds.append(np.fromiter(map(cache.__getitem__, words), np.int32, len(words)))
            held.append(batch.column(0))
            if total >= TOGETHER:
                yield held, np.array(lengths), np.concatenate(kinds), cache
                held, lengths, kinds, total = [], [], [], 0
                if len(cache) > CACHE:
                    cache = Numbers()
        if held:
            yield held, np.array(lengths, np.int64), np.concatenate([np.zeros(0, np.int32), *kinds]), cache

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known, table = shared.value, None, None
        for held, lengths, kind, cache in bundles(batches):
            pred, score = [UNKNOWN] * len(lengths), np.zeros(len(lengths))
            some = np.flatnonzero(lengths)
            if len(some):
                if cache is not known:
                    known, table = cache, np.zeros((0, len(model.labels)))
                if len(cache) > len(table):
                    table = np.concatenate([table, model.emissions(list(islice(cache, len(table), None)))])
                found, _ = forward_backward(
                    table[kind], lengths[some], model.transitions, model.starts, count_pairs=False
                )
                begin = np.cumsum(lengths[some]) - lengths[some]
                mean = np.add.reduceat(found, begin, axis=0) / lengths[some][:, None]
                score[some] = np.clip(mean.max(axis=1), 0, 1)
                for i, best in zip(some, mean.argmax(axis=1)):
                    pred[i] = model.labels[best]
                del found
            at = 0
            for row in held:
                end = at + len(row)
                yield pa.record_batch(
                    [row, pa.array(pred[at:end], pa.string()), pa.array(score[at:end])],
                    ["row", "lang_pred", "score"],
                )
                at = end

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` as a struct ``row``, with lang_pred and score (mean probability).

    A text that is null or has no letter, and any text if nothing was learned, is
    ``und`` with score 0. Repeated rows and null ids get an answer each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    kind = docs.select(row).schema["row"].dataType.simpleString()
    return docs.select(row, F.col("text").alias("text")).mapInArrow(
        _predictor(shared), f"row {kind}, lang_pred string, score double"
    )


def held_out(doc_id=None):
    """Documents that are not learned from: a quarter, by a checksum of the id."""
    own = F.col("doc_id") if doc_id is None else doc_id
    return F.coalesce(F.crc32(own.cast("string").cast("binary")) % 4 == 2, F.lit(False))
