"""Byte-level BPE, vector codes and spelling groups against brute force."""

from __future__ import annotations

import collections
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from tidewatch.llm import byte_bpe, common, spelling, vector_codes

random_ = random.Random(11)
PIECES = [
    "a", "B", "st", "re", "ve", "ll", "'", "''", "'s", "'re", "'ll", "'x", " ", "  ", "\n", "\r\n", "\t ", " ",
    "　", "\x1c", "\x00", "7", "٣", "½", "é", "é", "日本", "हिन्दी", "😀", "_", "--", ".", "꟎", "\U00031350", "\U0001e5d0",
]


@pytest.fixture(scope="module")
def full():
    ranks = byte_bpe.ranks_of(public_tokenizers.path(byte_bpe.RANKS))
    return tiktoken.Encoding(
        "full", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_words_are_the_pattern_s_matches(full):
    texts = ["".join(random_.choice(PIECES) for _ in range(random_.randint(0, 14))) for _ in range(6000)]
    texts += ["", "'", "'s", "s'", " 's", "\n's", "'st", "a's'd", "a 'll", "'v", "'ve" * 3, "x" * 5000, " " * 3000]
    found, counts = byte_bpe.split_words(texts, byte_bpe.class_ranges())
    ends = np.cumsum(counts)
    encoder = byte_bpe.word_encoder(public_tokenizers.path(byte_bpe.RANKS))
    old = regex.compile(public_tokenizers.PATTERN)
    for text, a, b in zip(texts, ends - counts, ends):
        assert "".join(found[a:b]) == text
        assert [i for w in found[a:b] for i in encoder.encode_ordinary(w)] == full.encode_ordinary(text)
        if not set(text) & set("꟎\U00031350\U0001e5d0"):  # letters of newer Unicode versions
            assert found[a:b] == old.findall(text)


def test_numbers_survive_packing():
    numbers = np.array([0, 1, 127, 128, 16383, 16384, 2**21 - 1, 2**21, 2**28, 2**31 - 1])
    for part in (numbers, numbers[:0], numbers[:1]):
        assert byte_bpe.unpack_numbers(byte_bpe.pack_numbers(part)).tolist() == part.tolist()


TEXTS = [
    (1, "It's  a test, isn't it?\n\n  'sure' 123 done "), (2, None), (3, ""), (4, " \n "), (5, "日本語 é 😀 \x00 " * 40),
    (6, "word " * 3000), (6, "word " * 3000), (None, "no id"), (7, "y" * 20000), (8, "<|endoftext|>"), (9, "word"),
]
CLASH = "doc_id long, text string, rest string, block int, ids string, decoded string, number int"


@pytest.mark.parametrize("block_chars", [byte_bpe.BLOCK_CHARS, 10])
def test_encode_and_decode(spark, full, block_chars):
    common.tune(spark)
    rows = [(i, t, "r", 1, "x", "d", 2) for i, t in TEXTS]
    docs = spark.createDataFrame(rows, CLASH).repartition(3)
    coded = byte_bpe.encode(docs, ("doc_id", "block", "number"), block_chars=block_chars)
    got = byte_bpe.decode(coded)
    assert got.columns == ["doc_id", "block", "number", "ids", "decoded"]
    expected = collections.Counter((i, tuple(full.encode_ordinary(t or "")), (t or "").encode()) for i, t in TEXTS)
    assert collections.Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in got.collect()) == expected


def test_small_blocks_of_several_batches(spark, full):
    docs = spark.createDataFrame([(i, f"text number {i} of it") for i in range(3000)], "doc_id long, text string").coalesce(2)
    got = byte_bpe.encode(docs, block_chars=2000).collect()
    assert {r.doc_id: r.ids for r in got} == {i: full.encode_ordinary(f"text number {i} of it") for i in range(3000)}


def test_encode_nothing_and_decode_odd_ids(spark):
    empty = spark.createDataFrame([], CLASH)
    assert byte_bpe.decode(byte_bpe.encode(empty)).collect() == []
    odd = spark.createDataFrame([(1, None), (2, []), (3, [97, None, -1, 10**8])], "key int, ids array<int>")
    got = {r.key: r.decoded for r in byte_bpe.decode(odd).collect()}
    table = byte_bpe.token_bytes(public_tokenizers.path(byte_bpe.RANKS))
    assert got == {1: None, 2: b"", 3: table[97].as_py()}


def brute_codes(rows, parts, entries, rounds):
    rows = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(rows[0][1])
    rows = [r for r in rows if len(r[1]) == width]
    data = np.array([[int(np.floor(1024 * x)) for x in r[1]] for r in rows])
    cuts = np.array_split(np.arange(width), parts)
    books = [data[:entries][:, c].copy() for c in cuts]
    for step in range(rounds + 1):
        codes, errors = [], []
        for c, book in zip(cuts, books):
            d = ((data[:, None, c] - book[None]) ** 2).sum(2)
            codes.append(d.argmin(1))
            errors.append(d.min(1))
        if step < rounds:
            for c, book, code in zip(cuts, books, codes):
                for e in set(code.tolist()):
                    mine = data[code == e][:, c]
                    book[e] = [int(s) // len(mine) for s in mine.sum(0)]
    error = np.sum(errors, 0)
    of_label = collections.Counter()
    for r, e in zip(rows, error):
        of_label[r[2]] += int(e)
    found = [(r[0], tuple(int(c[i]) for c in codes), int(error[i]), of_label[r[2]]) for i, r in enumerate(rows)]
    return collections.Counter(found), books


def some_vectors(n, width):
    rows = [(i, [round(random_.gauss(0, 0.01), 3) for _ in range(width)], random_.choice([1, 2, None])) for i in range(n)]
    rows += [(n + i, rows[i % 7][1], 1) for i in range(60)]  # a hot vector, ties
    rows += [(5, rows[9][1], 2), (5, rows[9][1], 2), (None, rows[4][1], 1), (-1, None, 1), (-2, [], 1)]
    return rows + [
        (-3, [0.0] * (width - 1) + [None], 1), (-4, [float("nan")] * width, 1), (-5, [float("inf")] * width, None),
        (900, [0.1] * (width - 1), 1),
    ]


@pytest.mark.parametrize("width,parts,entries,leaves", [(8, 4, 16, 256), (8, 4, 16, 3), (7, 2, 300, 1), (4, 4, 5, 8)])
def test_vector_codes(spark, monkeypatch, width, parts, entries, leaves):
    monkeypatch.setattr(vector_codes, "LEAVES", leaves)
    rows = some_vectors(250, width)
    schema = "vec_id long, embedding array<double>, label int, codes string, part int, vector int"
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], schema).repartition(3)
    coded, books = vector_codes.compress(df, parts=parts, entries=entries, rounds=3)
    expected, right = brute_codes(rows, parts, entries, 3)
    assert [b.tolist() for b in books] == [b.tolist() for b in right]
    got = collections.Counter((r.vec_id, tuple(r.codes), r.error, r.label_error) for r in coded.collect())
    assert got == expected


@pytest.mark.parametrize("leaves", [1, 2, 7, 50, 1000])
def test_trie_walk(monkeypatch, leaves):
    monkeypatch.setattr(vector_codes, "LEAVES", leaves)
    maker = np.random.default_rng(leaves)
    for high in (2, 4, 500):
        rows, entries = maker.integers(-high, high, (400, 6)), maker.integers(-high, high, (20, 6))
        codes, errors, sums, counts = vector_codes.assign(rows, entries)
        d = ((rows[:, None] - entries[None]) ** 2).sum(2)
        assert (codes == d.argmin(1)).all() and (errors == d.min(1)).all()
        assert (counts == np.bincount(codes, minlength=20)).all()
        assert all((sums[e] == rows[codes == e].sum(0)).all() for e in range(20))


def test_no_vectors_and_huge_ones(spark):
    schema = "vec_id long, embedding array<float>, label int"
    coded, books = vector_codes.compress(spark.createDataFrame([(1, None, 1)], schema))
    assert coded.collect() == [] and books == []
    coded, books = vector_codes.compress(spark.createDataFrame([(1, [3e38, -3e38] * 2, 1)], schema))
    assert [r.error for r in coded.collect()] == [0]
    assert books[0].tolist() == [[vector_codes.LARGEST]]


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_spelling(docs, letters, occurrences, every):
    counts = collections.Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= letters and c >= occurrences}
    forms, close = {}, {}
    for w in n:
        others = [o for o in n if near(w, o)]
        close[w] = len(others)
        best = min(others, key=lambda o: (-n[o], o), default=None)
        forms[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, forms[w], root, n[w], close[w], n.get(forms[w])))
    return out


def spelling_docs():
    letters = "abcdeé"
    base = ["".join(random_.choice(letters) for _ in range(random_.randint(5, 9))) for _ in range(60)]
    words = []
    for w in base:
        words += [w] * random_.choice([1, 6, 40])
        for _ in range(6):
            i = random_.randrange(len(w))
            v = random_.choice([w[:i] + w[i + 1 :], w[:i] + random_.choice("xyÀz") + w[i + 1 :], w[:i] + "Q" + w[i:]])
            words += [v] * random_.randint(1, 7)
    random_.shuffle(words)
    docs = [(i, " ".join(words[i::80]) + random_.choice([".", "×÷ABCdef!", "ß1", ""])) for i in range(80)]
    return docs + [(None, " ".join(words[:300])), (3, None), (4, ""), (5, " \n 12"), (6, "aabbcc " * 60), (6, "aabbcc " * 60), (9, "aabbccf " * 20), (9, "aabgccf " * 3)]


@pytest.mark.parametrize("crowd", [spelling.CROWD, 2, 0])
def test_spelling_groups(spark, crowd):
    docs = spelling_docs()
    schema = "doc_id long, text string, word string, key int, n int, root int"
    df = spark.createDataFrame([(*d, "x", 1, 2, 3) for d in docs], schema).repartition(3)
    got = spelling.spelling_groups(df, letters=4, occurrences=2, every=7, crowd=crowd).collect()
    expected = brute_spelling(docs, 4, 2, 7)
    assert len(got) == len(expected)
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == expected
    assert any(r.root != r.word and r.root != r.form for r in got)  # ways of several steps


def test_spelling_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_groups(empty).collect() == []
