"""Small fixtures against brute force for the operators of the optional subpackage."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import tracemalloc
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import (
    common, components, embedding_graph, exact_dedup, html_text, langid, license_scan, minhash,
    packing, passage_chains, piece_sampler, suffix_dedup,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, rows int"
random_ = random.Random(3)
VOCABULARY = ["".join(random_.choice("abcdeghilmnorstu") for _ in range(random_.randint(2, 8))) for _ in range(300)]


def prose(n: int) -> str:
    return " ".join(random_.choice(VOCABULARY) for _ in range(n))


BASE, PASSAGE = prose(160), prose(70)
TEXTS = [
    (1, BASE), (2, BASE), (3, BASE.replace(" ", "\n")), (4, BASE.upper()),
    (5, BASE + " " + prose(4)), (6, prose(90) + " " + PASSAGE + " " + prose(60)),
    (7, PASSAGE + " " + prose(80)), (8, None), (9, ""), (10, " \n\t"), (11, "one two"), (12, "one two"),
    (13, "ab" * 400), (14, prose(6000)), (15, "日本語 é 😀 " * 40), (None, BASE), (None, None), (1, BASE),
]


@pytest.fixture(scope="module")
def docs(spark):
    common.tune(spark)
    rows = [(i, t, "en", "s", None if t is None else len(t), "clash", 1) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def check_exact(rows):
    groups = collections.defaultdict(list)
    for i, t in TEXTS:
        groups[squeezed(t)].append((-len(t or ""), i is None, i or 0))
    expected = collections.Counter()
    for i, t in TEXTS:
        best = min(groups[squeezed(t)])
        expected[(i, None if best[1] else best[2], len(groups[squeezed(t)]))] += 1
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size) for r in rows) == expected
    assert sum(r.kept for r in rows) == len(groups)


def test_exact_dedup(docs):
    check_exact(exact_dedup.exact_dedup(docs).collect())


def test_exact_dedup_keeps_contents_of_one_digest_apart(docs):
    clash = exact_dedup.exact_dedup(docs, digest=lambda c: F.unhex(F.lit("00")))
    check_exact(clash.collect())


def test_exact_stage_keeps_all_columns(docs):
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({squeezed(t) for _, t in TEXTS})


def shingle_sets(words, n):
    out = {}
    for i, t in TEXTS:
        if i is not None:
            w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
            out[i] = {tuple(w[k : k + n]) for k in range(max(len(w) - n + 1, 1))} if w else set()
    return out


def joined(nodes, links):
    part = {i: i for i in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(part[a], part[b])
            changed |= part[a] != low or part[b] != low
            part[a] = part[b] = low
    return part


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, words, percent):
    sets = shingle_sets(words, words)
    links = [
        (a, b) for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    part = joined(sets, links)
    for r in minhash.near_duplicates(docs, words, percent).collect():
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), part[r.doc_id])
            assert r.kept == (r.doc_id == r.component_id)


def test_a_repeated_id_keeps_the_links_of_all_its_texts(spark):
    a, b = prose(60), prose(60)
    rows = [(5, a), (5, b), (5, b), (7, b + " more"), (9, a + " more")]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(5, 5), (5, 5), (5, 5), (7, 5), (9, 5)]


@pytest.mark.parametrize("block", [minhash.BLOCK, 7])
def test_pairs_unlike_their_hub_are_found(spark, block, monkeypatch):
    """Chains of texts of which each is near the next one only."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    words = prose(400).split()
    rows = [(i, " ".join(words[4 * i : 4 * i + 60])) for i in range(60)]
    rows += [(100 + i, " ".join([*words[:100], str(i), *words[101 + i :][:30]])) for i in range(40)]
    sets = {i: set(zip(*[t.split()[k:] for k in range(3)])) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in found} == joined(sets, links)


def test_a_crowded_cell_gives_the_likeliest_pairs_first():
    """Sets that are all near: a pass gives few pairs of a row, the last one all of them."""
    shared = common.mix(np.arange(1, 901, dtype=np.uint64))
    sets = [np.concatenate([shared, common.mix(np.arange(10**6 * i, 10**6 * i + 60 + i, dtype=np.uint64))]) for i in range(1, 61)]
    factors = minhash._factors(minhash.REGISTERS + minhash.FINE)
    levels = np.stack([minhash.registers(own, factors) for own in sets])
    reps, sizes = np.arange(60), np.array([len(own) for own in sets])
    for first in (np.ones(60, bool), reps % 2 == 0):
        cell = (levels[:, : minhash.REGISTERS], levels[:, minhash.REGISTERS :], reps, sizes, reps, first, 0.8, 0)
        whole = minhash._cell_pairs(*cell)
        few = minhash._cell_pairs(*cell, 1)
        own = [(a, b) for a, b in itertools.combinations(range(60), 2) if first.all() or a % 2 != b % 2]
        assert sorted(map(tuple, whole[:, :2].tolist())) == own and not whole[:, 2].any()
        assert set(few[:, 2].tolist()) == {1} and {*few[:, 0].tolist(), *few[:, 1].tolist()} == set(range(60))
        assert {*map(tuple, few[:, :2].tolist())} <= set(own) and len(few) <= 120
        assert (minhash._cell_pairs(*cell, 60) == whole).all()


def test_registers_merge_and_estimate():
    factors = minhash._factors()
    x = common.mix(np.arange(1, 4001, dtype=np.uint64))
    a, b = minhash.registers(x[:3000], factors), minhash.registers(x[1000:], factors)
    assert (np.maximum(a, b) == minhash.registers(x, factors)).all()
    guess = minhash.estimate(a[None], b[None], np.array([3000]), np.array([3000]))[0]
    assert abs(guess - 0.5) < 0.2


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components.connected_components(df, common.Steps(spark, "t")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


@pytest.mark.parametrize("group", [suffix_dedup.GROUP, 1])
def test_repeated_strings(docs, group, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    data = [(t or "").encode() for _, t in TEXTS]
    count = collections.Counter(d[s : s + 200] for d in data for s in range(len(d) - 199))
    expected = collections.Counter()
    for (i, _), d in zip(TEXTS, data):
        gone = np.zeros(len(d), bool)
        for s in range(len(d) - 199):
            if count[d[s : s + 200]] > 1:
                gone[s : s + 200] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        expected[(i, len(d), int(gone.sum()), runs, bytes(np.frombuffer(d, np.uint8)[~gone]))] += 1
    got = suffix_dedup.remove_repeats(docs).collect()
    assert collections.Counter(
        (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.left)) for r in got
    ) == expected


def test_packing(docs):
    from tokenizers import Tokenizer
    import public_tokenizers

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack(docs.where("doc_id > 1"), ids=True).collect()
    texts = {i: t for i, t in TEXTS if i and i > 1}
    for i, t in texts.items():
        ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert [x for r in own for x in r.ids] == ids
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in own)
        assert {r.doc_tokens for r in own} == {len(ids)}
    for _, own in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), lambda r: r.sequence_id):
        place = 0
        for r in own:
            assert r.offset == place
            place += r.length
        assert place <= r.padded_length <= 2048
    assert sum(r.length for r in rows) == len([x for r in rows for x in r.ids])


def test_differencing_balances():
    sizes = [random_.randint(1, 500) for _ in range(400)]
    windows = packing.differencing(sizes, 40)
    assert sorted(i for w in windows for i in w) == list(range(400))
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert max(sums) - min(sums) <= 20
    assert packing.differencing([5], 1) == [[0]] and packing.differencing([], 2) == [[], []]


def test_end_of_text_is_the_special_id():
    assert packing.Encoder().ids("a<|endoftext|>").tolist()[-1] == 50256


def test_forward_backward_matches_enumeration():
    random = np.random.default_rng(0)
    scores, moves, starts = random.normal(size=(4, 3)), random.normal(size=(3, 3)), random.normal(size=3)
    found, _ = langid.forward_backward(scores, np.array([4]), moves, starts)
    expected = np.zeros((4, 3))
    for path in itertools.product(range(3), repeat=4):
        weight = np.exp(starts[path[0]] + sum(scores[t, s] for t, s in enumerate(path))
                        + sum(moves[a, b] for a, b in zip(path, path[1:])))
        for t, s in enumerate(path):
            expected[t, s] += weight
    assert np.allclose(found, expected / expected.sum(axis=1, keepdims=True))


def test_language_of_held_out_rows(spark, docs):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.train(table.where(~langid.held_out()))
    rows = langid.predict(table.where(langid.held_out()), model).select("row.lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows)
    mixed = langid.predict(docs, model).select("row.text", "lang_pred", "score").collect()
    for r in mixed:
        assert (r.lang_pred == "und") == (not r.text or not any(map(str.isalpha, r.text)))
        assert 0 <= r.score <= 1


def test_language_sample_has_each_text_once(spark):
    texts = [(prose(30), "aa") for _ in range(500)] + [(prose(5000), "aa")]
    early = spark.createDataFrame(texts, "text string, lang string").orderBy(F.xxhash64("text")).first()
    table = spark.createDataFrame(texts + [(early.text, "aa")] * 2000, "text string, lang string")
    rows = langid.sample(table).collect()
    assert len(rows) == len({r.text for r in rows}) == langid.LANGUAGE_ROWS
    most = langid.TEXT_PIECES * langid.SEQUENCE_WORDS
    assert all(len(r.text.split()) <= most for r in langid.sample(table.where("length(text) > 9999")).collect())
    spread = langid.spread_words(" ".join("abcdefghij"[i // 1000] for i in range(10_000))).split()
    assert len(spread) == most and set(spread) == set("abcdefghij")  # all parts of the text


def test_long_text_does_not_outweigh_its_language(monkeypatch):
    drawn = []
    monkeypatch.setattr(langid, "_lexicon", lambda words, *_: drawn.extend(words) or {})
    langid.fit([("long " * 20000, "aa")] + [("short " * 24, "aa")] * 9)
    assert drawn.count("long") < 0.2 * len(drawn)


def test_prediction_holds_few_words_at_once():
    """Many different words: their n-grams, and the chains of all texts, are not held at once."""
    model = langid.fit([("alpha beta gamma", "a"), ("delta epsilon zeta", "b")])
    words = ["".join(random_.choices("abcdefghij", k=12)) for _ in range(60_000)]
    texts = [" ".join(words[i : i + 60]) for i in range(0, len(words), 60)]
    column = pa.array(texts)
    batches = [pa.record_batch([pa.array([{"text": t} for t in texts]), column], ["row", "text"])]
    shared = types.SimpleNamespace(value=model)
    tracemalloc.start()
    rows = pa.Table.from_batches(langid._predictor(shared)(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
    emitted = np.concatenate([model.emissions([w]) for t in texts[:20] for w in t.split()])
    found, _ = langid.forward_backward(emitted, np.full(20, 60), model.transitions, model.starts)
    mean = found.reshape(20, 60, 2).mean(axis=1)
    assert np.allclose(rows["score"].to_numpy()[:20], mean.max(axis=1))
    assert rows["lang_pred"].to_pylist()[:20] == [model.labels[i] for i in mean.argmax(axis=1)]


def test_embeddings(spark):
    random = np.random.default_rng(1)
    base = random.normal(size=(60, 8))
    points = np.concatenate([base, base + random.normal(size=(60, 8)) * 0.05, base[:3]])
    rows = [(i, p.tolist(), i % 3) for i, p in enumerate(points)]
    odd = [(900, None, 1), (901, [0.0] * 8, 1), (902, [float("nan")] * 8, 1), (903, [1.0] * 8, None), (904, [1.0] * 4, 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & (np.arange(len(points))[:, None] % 3 == np.arange(len(points)) % 3)
    np.fill_diagonal(near, False)
    part = joined(range(len(points)), [tuple(p) for p in np.argwhere(near)])
    got = {r.vec_id: r for r in embedding_graph.near_vectors(df, 0.98, size=24).collect()}
    assert all((got[i].n_links, got[i].component_id) == (near[i].sum(), part[i]) for i in range(len(points)))
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in range(900, 905))


def test_html_layout():
    page = (
        "<head><title>x</title></head><h1>Head</h1>Some <b>bold</b> text<br>next<p>one<p>two<ul><li>a<li>b<ol start=3>"
        "<li>x</ol></ul><table><tr><th>Name<th>N<tr><td>longer name<td>1</table><div hidden>no</div>"
        "<pre> a\n   b</pre><p style='display: none'>no</p><script>no</script>end &amp; &lt;x&gt;"
    )
    assert html_text.page_text(page) == (
        "Head\n\nSome bold text\nnext\n\none\n\ntwo\n\n- a\n- b\n  3. x\n\n"
        "Name         N\nlonger name  1\n\n a\n   b\n\nend & <x>"
    )
    assert html_text.page_text(None) == html_text.page_text("") == ""
    assert html_text.page_text("<div>" * 5000 + "deep") == "deep"
    assert html_text.page_text("a < b <unclosed") == "a < b"


@pytest.mark.parametrize("page,text", [
    ("<table><form><tr><td>a<td>b</tr></form></table>", "a  b"),
    ("<table><form hidden><tr><td>a</form></table>", "a"),
    ("<table><div>one</div><tr><td>two</table>", "one\ntwo"),
    ("<table><div>one<tr><td>two<p>three</table>four", "one\ntwo\n\nthree\n\nfour"),
    ("<table><tr><td>x</td><p>one</p><td>y</tr>", "one\nx  y"),
    ("<table><tbody><td>a<td>b<tr><td>c</table>", "a  b\nc"),
    ("<table><tbody>one<section>two</section><ul><li>three</ul></tbody><tr><td>x</table>", "one\ntwo\n\n- three\nx"),
    ("<table><tr><td>a<table><tr><td>b</table><tr><td>c</table>", "a\n\nb\nc"),
    ("<table><table><tr><td>a</table>", "a"),
    ("<table><caption>cap</caption><center>mid</center><td>x</table>", "mid\ncap\nx"),
    ("<svg><title>no</title><desc>no</desc><text>in</text><text>svg</text></svg>", "in svg"),
    ("<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math>", "x=1"),
    ("<textarea>a &lt; b</textarea>", "a < b"),
    ("<select><option>one<option selected>two</select>", "one\ntwo"),
    ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
    ("<i aria-hidden=true>seen</i><xmp><b>raw</b></xmp>", "seen\n\n<b>raw</b>"),
])
def test_html_tables_and_visible_elements(page, text):
    assert html_text.page_text(page) == text


def test_pieces_are_lossless_and_repeatable(docs):
    first = piece_sampler.encode(docs)
    rows = first.collect()
    assert all(r.lossless for r in rows)
    again = {(r.doc_id, r.ids_crc32) for r in piece_sampler.encode(docs.repartition(5)).collect()}
    assert again == {(r.doc_id, r.ids_crc32) for r in rows}
    other = {(r.doc_id, r.ids_crc32) for r in piece_sampler.encode(docs, seed=1).collect()}
    assert other != again
    texts = collections.Counter(r.text for r in piece_sampler.decode_rows(first).collect())
    assert texts == collections.Counter(t or "" for _, t in TEXTS)


def test_sampled_shares_follow_the_lattice():
    words = piece_sampler.vocabulary()
    drawn = piece_sampler.sample([[" the"]] * 4000, np.arange(4000, dtype=np.uint64), words)
    counts = collections.Counter(tuple(d.tolist()) for d in drawn)

    def ways(text):
        if not text:
            return [((), 0.0)]
        return [
            ((words.pieces[text[:n]], *ids), words.score[words.pieces[text[:n]]] + score)
            for n in range(1, len(text) + 1) if text[:n] in words.pieces
            for ids, score in ways(text[n:])
        ]

    total = sum(np.exp(score) for _, score in ways("▁the"))
    for ids, score in ways("▁the"):
        assert abs(counts[ids] / 4000 - np.exp(score) / total) < 0.03


def test_chains_are_best():
    matches = [(1, 1), (8, 9), (12, 13), (13, 3), (18, 18), (30, 2)]
    assert passage_chains.chains(matches)[0] == [(1, 1), (8, 9), (12, 13), (18, 18)]


def test_passages(docs):
    rows = passage_chains.repeated_passages(docs).collect()
    pairs = {frozenset((r.doc_id, r.other_id)) for r in rows}
    assert {frozenset((6, 7)), frozenset((1, 2)), frozenset((1, 5))} <= pairs
    row = next(r for r in rows if {r.doc_id, r.other_id} == {6, 7})
    assert row.last_word - row.first_word + 1 >= 68
    assert not any(14 in p or 15 in p for p in pairs)


def test_chain_of_two_passages_is_cut(spark):
    first, second = prose(100), prose(100)
    texts = [(1, f"{first} {prose(100)} {second}"), (2, f"{first} {prose(100)} {second}")]
    rows = passage_chains.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert len(rows) == 2
    for r, start in zip(sorted(rows, key=lambda r: r.first_word), (0, 200)):
        assert abs(r.first_word - start) <= 3 and abs(r.last_word - start - 99) <= 3 and r.similarity > 0.97


def test_passage_whose_seeds_stand_elsewhere_too(spark):
    """Two documents share a passage; all its runs of words also stand in smaller and larger ones."""
    words, many = prose(60).split(), prose(60).split()
    texts = [(50, prose(30) + " " + " ".join(words) + " " + prose(30)), (60, prose(20) + " " + " ".join(words))]
    texts += [(i, " ".join([prose(40), *many, prose(40)])) for i in (51, 61)]
    for number, i in enumerate([*range(1, 13), *range(100, 112)]):
        for source in (words, many):
            parts = [source[k : k + 18] for k in range(number % 6, 60, 20)]
            texts.append((i + 1000 * (source is many), " ".join(" ".join(p) + " " + prose(30) for p in parts)))
            texts.append((i - 1000 - 200 * (source is many), texts[-1][1]))
    rows = passage_chains.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    pairs = {frozenset((r.doc_id, r.other_id)) for r in rows}
    assert {frozenset((50, 60)), frozenset((51, 61))} <= pairs


def test_all_places_of_a_seed_count(spark):
    line, passage = prose(20), prose(30)
    texts = [(1, f"{line} {prose(50)} {line} {passage} {line}"), (2, f"{line} {prose(70)} {line} {passage} {line}")]
    rows = passage_chains.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert [(r.first_word, r.last_word, r.similarity) for r in rows] == [(90, 159, 1.0)]
    found, places = passage_chains.seeds(common.word_hashes(texts[0][1].encode())[0])
    assert len(found) > len(set(found.tolist())) and (np.diff(found.astype(object)) >= 0).all()
    assert len(passage_chains.seeds(common.word_hashes(b"a " * 5000)[0])[1]) == 2


def test_common_words_of_large_gaps():
    random = np.random.default_rng(4)
    a, b = random.integers(0, 9, 60), random.integers(0, 9, 50)
    table = np.zeros((61, 51), int)
    for i, j in itertools.product(range(60), range(50)):
        table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
    assert passage_chains.common_words(a, b) == table[-1, -1]
    assert passage_chains.common_words(np.arange(1500), np.arange(1500)) == 1500
    assert passage_chains.common_words(a[:0], b) == passage_chains.common_words(a, b[:0]) == 0


def test_licences(spark):
    lines = [(1, "x\nLicensed under the Apache License, Version 2.0.\ny"), (2, "Released under the MIT License."),
             (3, prose(40)), (4, None), (5, "")]
    own = spark.createDataFrame(lines, "doc_id long, text string")
    corpus = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    model = license_scan.train(corpus)
    got = {(r.doc_id, r.paragraph, r.family) for r in license_scan.scan(own, model).where("confirmed").collect()}
    assert got == {(1, 1, "apache-2.0"), (2, 0, "mit")}


def test_only_the_smallest_lines_are_shuffled(spark):
    lines = [prose(3) for _ in range(300)] * 2 + ["the same"] * 500
    own = spark.createDataFrame([(line,) for line in lines], "line string")
    ordered = [r.line for r in own.orderBy(F.xxhash64("line"), "line").collect()]
    for n in (1, 40, 2000):
        found = license_scan.smallest_lines(own, n)
        assert [r.line for r in found.collect()] == ordered[:n]
    plan = license_scan.smallest_lines(own, 40)._jdf.queryExecution().optimizedPlan().toString()
    assert "shiftright" in plan and "Aggregate [h" in plan  # filtered and counted before they are sorted
    assert license_scan.smallest_lines(own.limit(0), 5).count() == 0


def test_wrapped_licences(spark):
    import textwrap

    gpl, mit = license_scan.TEMPLATES["gpl"][1], license_scan.TEMPLATES["mit"][2]
    lines = [(1, "int a;\n\n/*\n" + "".join(f" * {x}\n" for x in textwrap.wrap(gpl, 72)) + " */\nint b;"),
             (2, "\n".join("# " + x for x in textwrap.wrap(mit, 50)))]
    own = spark.createDataFrame(lines, "doc_id long, text string")
    corpus = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = license_scan.scan(own, license_scan.train(corpus)).collect()
    assert {(r.doc_id, r.paragraph, r.family) for r in rows if r.confirmed} == {(1, 3, "gpl"), (2, 0, "mit")}


def test_empty_tables(spark, empty):
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert minhash.near_duplicates(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert packing.pack(empty).count() == 0
    assert passage_chains.repeated_passages(empty).count() == 0
    assert piece_sampler.encode(empty).count() == 0
    assert langid.predict(empty, langid.train(empty)).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_graph.near_vectors(vectors).count() == 0


def test_pipeline_stages(spark, docs):
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
    cut = corpus_pipeline.repeated_strings(spark, docs, "").collect()
    assert all(r.n_chars == len(r.text) for r in cut if r.text and r.doc_id == 6)
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_passages_of_frequent_seeds_are_all_found(spark):
    """A passage whose seeds, pairs and triples stand in many smaller and larger documents, which do not have it."""
    parts = [prose(18).split() for _ in range(3)]
    joined = [(2, 2), (3, 2)]
    texts = []
    for number, (a, b) in enumerate(joined):
        middle = [" ".join(parts[0]), prose(a), " ".join(parts[1]), prose(b), " ".join(parts[2])]
        texts.append((50 + number, " ".join([prose(30), *middle, prose(30)])))
    for number in range(24):
        far = [" ".join(parts[0]), prose(30 + number), " ".join(parts[1]), prose(20 + number), " ".join(parts[2])]
        texts.append((number + (100 if number % 2 else 0), " ".join([prose(30), *far, prose(30)])))
    rows = passage_chains.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    found = [r for r in rows if (r.doc_id, r.other_id) == (51, 50)]
    assert found and min(found[0].last_word - found[0].first_word, found[0].other_last - found[0].other_first) >= 39
    assert (found[0].class_doc, found[0].class_first) == (50, found[0].other_first)


def test_largest_component_is_not_copied_into_cells(spark, monkeypatch):
    """Members of the largest component are in one cell for each block of others."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    steps = common.Steps(spark, "across")
    size, others = 200, 3
    levels = np.arange(minhash.REGISTERS, dtype="<u2").tobytes()
    held = np.arange(50, dtype=np.uint64).tobytes()
    bands = spark.range(size).selectExpr("7L AS band", "0Y AS number", "id AS rep", f"{size}L AS size")
    sketch = spark.range(size).select(
        F.col("id").alias("rep"), F.lit(50).cast("long").alias("n_shingles"), F.lit(bytearray(levels)).alias("levels")
    )
    sets = spark.range(size).select(F.col("id").alias("rep"), F.lit(bytearray(held)).alias("shingles"))
    parts = spark.range(others, size).selectExpr("id AS node", f"{others}L AS component")
    rest, parted = minhash._across(bands, sketch, sets, parts, 0.8, steps, None)
    got = {(r.a, r.b) for r in rest.collect()}
    assert got == {(a, b) for a in range(others) for b in range(a + 1, size)}
    rows = parted.selectExpr("sum(IF(inner, blocks, before + blocks)) AS n").first().n
    assert rows <= size + others * (size // 4 + 2)


def test_passage_of_one_word_repeated(spark):
    texts = [(1, " ".join(["the"] * 60)), (2, " ".join(["the"] * 90))]
    texts = [(i, f"{' '.join(f'{i}w{k}' for k in range(10))} {t} {' '.join(f'{i}v{k}' for k in range(40))}") for i, t in texts]
    rows = passage_chains.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert all(r.last_word - r.first_word >= 39 and r.similarity == 1 for r in rows)
    assert (10, 10) in {(r.first_word, r.other_first) for r in rows}


def _chains_of(one, two, least=passage_chains.LEAST_WORDS):
    """Chains that are kept of two texts, given as lists of words."""
    sides = []
    for text in (one, two):
        words = common.word_hashes(" ".join(text).encode())[0]
        h, places = passage_chains.seeds(words)
        sides.append([h.tobytes(), places.astype(np.int32).tobytes(), passage_chains._beside(words, places).tobytes()])
    names = ["doc", "other", "h", "places", "beside", "g", "others", "beyond"]
    row = [pa.array([2]), pa.array([1]), *(pa.array([x], pa.binary()) for side in sides for x in side)]
    batch = pa.record_batch(row, names)
    return [r for found in passage_chains._chain_rows(least)(iter([batch])) for r in found.to_pylist()]


def test_short_repeats_of_a_word_are_no_chains():
    """Texts of repeated words share seeds with all others that repeat one of the words."""
    one = ["a"] * 8 + ["the"] * 30 + ["b"] * 20
    assert not _chains_of(one, ["c"] * 8 + ["the"] * 25 + ["d"] * 20)
    assert _chains_of(one, ["a"] * 8 + ["the"] * 31 + ["b"] * 20)
    assert _chains_of(["x"] + ["the"] * 45 + ["y"], ["z"] + ["the"] * 41)
    assert _chains_of(["x"] + ["the"] * 300 + ["y"], ["z"] + ["the"] * 300)


def test_words_beside_seeds_bound_what_agrees():
    random_texts = random.Random(5)

    def part(words):
        times = (random_texts.choice((1, 1, 3, 9, 200)) for _ in range(random_texts.randint(1, 9)))
        return [w for n in times for w in [random_texts.choice(words)] * n]

    told = 0
    for _ in range(200):
        words = "abcdefghijkl"[: random_texts.choice((2, 4, 12))]
        middle = part(words)
        a, b = (
            common.word_hashes(" ".join(part(words) + middle + part(words)).encode())[0] for _ in range(2)
        )
        (h, x), (g, y) = passage_chains.seeds(a), passage_chains.seeds(b)
        one, two = passage_chains._matches(h, g)
        p, q = passage_chains._beside(a, x)[one], passage_chains._beside(b, y)[two]
        left = passage_chains._agreeing_at_most(p >> 16, q >> 16)
        right = passage_chains._agreeing_at_most(p & 0xFFFF, q & 0xFFFF)
        told += int((left < passage_chains.ANY).sum())
        for i, j, before, after in zip(x[one], y[two], left, right):
            assert passage_chains._agreeing(a[:i][::-1], b[:j][::-1]) <= before
            assert passage_chains._agreeing(a[i + passage_chains.SEED :], b[j + passage_chains.SEED :]) <= after
    assert told > 100


def test_agreeing_matches_are_one_block():
    a = np.arange(300, dtype=np.uint64)
    b = np.concatenate([a[:100], a[95:]])
    b[250] = 7
    xs = np.array([3, 9, 40, 90, 120, 180, 230, 260])
    ys = xs + 5 * (xs > 95)
    whole = passage_chains._blocks(a, b, xs, ys, 6)
    assert whole == [(3, 3, 93), (120, 125, 116), (260, 265, 6)]
    assert passage_chains.align(a, b, xs, ys, 0.8) == [(0, 300, 0, 305, pytest.approx(2 * 299 / 605))]


def _keyed(words, runs, labels=None, doc=1):
    """Keys of one document of all its seeds, each place a class of its own."""
    text = " ".join(words).encode()
    packed = len(text).to_bytes(8, "little") + pa.Codec("zstd").compress(text, asbytes=True)
    h, places = passage_chains.seeds(common.word_hashes(text)[0])
    labels = places.tolist() if labels is None else labels
    found = [{"place": p, "h": x, "label": n} for p, x, n in zip(places.tolist(), h.view(np.int64).tolist(), labels)]
    kind = pa.list_(pa.struct([("place", pa.int32()), ("h", pa.int64()), ("label", pa.int64())]))
    batch = pa.record_batch(
        [pa.array([doc]), pa.array([[packed]], pa.list_(pa.binary())), pa.array([found], kind)], ["doc", "text", "found"]
    )
    return [r for out in passage_chains._keys(40, runs)(iter([batch])) for r in out.to_pylist()]


def test_ends_of_a_repeated_word_are_no_key():
    """Else all documents that repeat a word would meet in pairs; with a third seed they still do."""
    junk = [w for n, w in ((20, "the"), (30, "of"), (25, "a")) for w in [w] * n]
    keys = collections.Counter(r["key"] for r in _keyed(junk, False))
    h, places = passage_chains.seeds(common.word_hashes(" ".join(junk).encode())[0])
    ends = {x for x, n in collections.Counter(h.tolist()).items() if n == 2}
    own = {int(common.mix(common.mix(np.array([x], np.uint64)) * common.BASE + common.mix(np.array([x], np.uint64))).view(np.int64)[0]) for x in ends}
    assert len(ends) == 3 and not own & set(keys)
    assert own <= {r["key"] for r in _keyed(junk, True)}
    pairs = sum(q - p <= passage_chains.REACH for p, q in itertools.combinations(sorted(places.tolist()), 2))
    assert sum(keys.values()) == pairs - 3


def test_few_rows_of_a_key_tell_as_much_as_all():
    random_rows = random.Random(11)
    for n, kinds in ((40, 2), (60, 3), (200, 4), (300, 9)):
        rows = np.array([[0, 5, *(random_rows.randrange(kinds) for _ in range(3))] for _ in range(n)], np.int64).T
        told = passage_chains._told(rows)
        assert told.shape[1] <= 16
        for other in itertools.product(range(-1, kinds), repeat=3):
            differs = [(x[2:] != np.array(other)[:, None]).all(axis=0).any() for x in (rows, told)]
            assert differs[0] == differs[1]
    # A page that repeats a sentence: a row for each pair of its places before.
    page = [f"w{k}" for k in range(30)] * 40
    rows = _keyed(page, False)
    assert max(collections.Counter((r["run"], r["key"]) for r in rows).values()) <= 16


def test_lowest_of_neighbours():
    random_values = np.random.default_rng(3)
    for n, most, span in ((1, 9, 1), (12, 3, 12), (50, 4, 12), (400, 2**60, 12), (30, 5, 7)):
        values = random_values.integers(0, most, n).astype(np.uint64)
        views = np.lib.stride_tricks.sliding_window_view(values, span)
        assert passage_chains._lowest(values, span).tolist() == np.unique(views.argmin(axis=1) + np.arange(len(views))).tolist()


def test_texts_that_nobody_asks_for_are_not_shuffled(spark, monkeypatch):
    rows = spark.range(50).select(F.col("id").alias("doc"), F.lit("text").alias("text"))
    pairs = spark.createDataFrame([(7, 3), (9, 3)], "doc long, other long")
    docs = passage_chains._sided(pairs)
    found = passage_chains._only(rows, docs)
    assert sorted(r.doc for r in found.collect()) == [3, 7, 9]
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(passage_chains, "ASKED", 2)
    assert passage_chains._only(rows, docs) is rows
