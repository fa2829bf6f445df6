"""Collocations, language-model scores and divergences against plain Python."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chatloom.llm import blocks, collocations, divergence, eliasfano, scoring
from chatloom.llm.collocations import Trie
from chatloom.llm.eliasfano import Sequence, from_buffer, to_bytes

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING"
ROWS = [
    (1, "A b c. A b c, a b; X y", "en", "s1"),
    (2, "a B c a b c\ta b c d e f", "en", "s2"),
    (2, "a b c d e f a b c d e f", "en", "s2"),
    (3, None, "en", "s3"),
    (4, "", None, None),
    (5, "été Été a b\nc été été", None, "s1"),
    (None, "a b c " * 30 + "été 1 2", "de", None),
    (7, "a\x0bb\x0cc\x01d    x a b c", "", "s1"),
    (8, "w%d " * 3 % (1, 2, 3) * 20, "de", "s1"),
]


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


def naive_collocations(rows, least, most, top):
    f, n = {}, Counter()
    for _, text, lang, _ in rows:
        of = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            words = re.findall("[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(words)
            for size in range(1, most + 1):
                of.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, of in f.items():
        cand = {p: a for p, a in of.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            longer = [q for q in cand if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(cand[q] >= a for q in longer):
                continue
            score, k = min((1000 * a * n[lang] // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), of[p[:k]], of[p[k:]], n[lang]))
        for rank, (score, a, phrase, left, right, total) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total, -score))
    return sorted(out)


@pytest.mark.parametrize("trie_phrases", [500_000, 2])
def test_collocations(spark, docs, trie_phrases):
    got = collocations.collocations(docs, min_count=3, top=6, trie_phrases=trie_phrases)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = naive_collocations(ROWS, 3, 5, 6)
    assert len(want) > 8
    assert sorted(map(tuple, got.collect())) == want


def test_sums_are_dealt_by_words_not_by_packed_bytes(spark, monkeypatch):
    text = " ".join(f"w{k % 50}" for k in range(500))
    docs = spark.createDataFrame([(i, text, "en") for i in range(40)], "doc_id long, text string, lang string")
    sent, pairs = [], collocations.pairs
    monkeypatch.setattr(collocations, "SUM_ROWS", 1000)
    monkeypatch.setattr(collocations, "pairs", lambda seq, parts, least: sent.append(parts) or pairs(seq, parts, least))
    got = collocations.collocations(docs, min_count=10).count()
    assert sent == [-(-40 * 501 // 1000)] and got == len(naive_collocations([(i, text, "en", None) for i in range(40)], 10, 5, 2000))


def test_collocations_on_whole_texts(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    got = collocations.collocations(docs, min_count=20, top=300)
    assert sorted(map(tuple, got.collect())) == naive_collocations(rows, 20, 5, 300)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(1, 30), min_size=3, max_size=3), min_size=1, max_size=60), st.lists(st.integers(0, 31), max_size=200))
def test_double_array(phrases, text):
    phrases = np.unique(np.array(phrases, np.int32), axis=0)
    got = Trie.of(phrases).accepted(np.array(text, np.int64))
    place = {tuple(p): i for i, p in enumerate(phrases.tolist())}
    assert got.tolist() == [place.get(tuple(text[i : i + 3]), -1) for i in range(len(text))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50), st.integers(0, 10**9), st.integers(10**6, 10**6 + 300)), max_size=300), st.integers(0, 10**9))
def test_elias_fano(values, other):
    values = np.array(sorted(set(values)), np.int64)
    sequence = Sequence(from_buffer(np.frombuffer(to_bytes(Sequence.arrays(values, "s")), np.uint8)), "s")
    at = np.arange(len(values))
    assert sequence.get(at).tolist() == values.tolist()
    asked = np.r_[values, values + 1, values - 1, other, -1]
    place = {v: i for i, v in enumerate(values.tolist())}
    assert sequence.locate(asked).tolist() == [place.get(v, -1) for v in asked.tolist()]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=50))
def test_packed(values):
    assert blocks.unpacked(blocks.packed(np.array(values, np.int64))).tolist() == values


def naive_scores(rows):
    discount = scoring.DISCOUNT
    texts = [re.findall("[^\x20\x09-\x0d]+", lower(r[1])) + ["\0end"] for r in rows]
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2 for r in rows]
    one, three = Counter(), Counter()
    for words, out in zip(texts, held):
        if not out:
            one.update(words)
            line = ["\0b", "\0b", *words]
            three.update(zip(line, line[1:], line[2:]))
    n, v = sum(one.values()), len(one)
    once, twice = (sum(c == k for c in one.values()) for k in (1, 2))
    d1 = (once + 0.5) / (once + 2 * twice + 1)
    two, contexts, middle, fan, share = Counter(), Counter(), Counter(), Counter(), Counter()
    for (a, b, c), k in three.items():
        two[b, c] += k
        contexts[a, b] += k
    for (b, _), k in two.items():
        middle[b] += k
        fan[b] += 1
    for (a, b, _), k in three.items():
        if k >= scoring.LEAST_TRIPLE:
            share[a, b] += (k - discount) / contexts[a, b]
    out = []
    for row, words, is_out in zip(rows, texts, held):
        base = score = known = 0
        line = ["\0b", "\0b", *words]
        for a, b, c in zip(line, line[1:], line[2:]):
            known += one[c] > 0
            base += math.log10((one[c] + 1) / (n + v + 1))
            p = (one[c] - d1) / n if one[c] else d1 * v / n if n else 1
            if middle[b]:
                p = max(two[b, c] - discount, 0) / middle[b] + discount * fan[b] / middle[b] * p
            if (a, b) in share:
                k = three[a, b, c]
                p = (k >= scoring.LEAST_TRIPLE) * (k - discount) / contexts[a, b] + (1 - share[a, b]) * p
            score += math.log10(p)
        out.append((row[0], is_out, len(words), known, n, base, score))
    return out


def same_scores(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], abs=1e-9)
        assert abs(g[6] - w[6]) < 2e-4 * g[2]


@pytest.mark.parametrize("shard_tokens", [scoring.SHARD_TOKENS, 7])
def test_scores(spark, docs, shard_tokens):
    got = scoring.score_documents(docs, shard_tokens=shard_tokens)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    same_scores(got.collect(), naive_scores(ROWS))


def test_scores_of_whole_texts(spark, small, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_TOKENS", 9000)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = scoring.score_documents(docs, shard_tokens=3000).collect()
    want = naive_scores(rows)
    same_scores(got, want)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.75 * sum(r.base_score for r in held)


def test_probabilities_sum_to_one():
    """Over all words after a context, unknown ones as one, up to the rounding of codes."""
    rng = np.random.default_rng(3)
    n_words, n = 40, 4000
    a, b, c = (rng.zipf(1.5, n) % n_words for _ in range(3))
    triples, k = np.unique(np.c_[a, b, c], axis=0, return_counts=True)
    none = (np.zeros(0, np.int64),) * 4
    arrays = scoring.shard_arrays((*triples.T.astype(np.int64), k.astype(np.int64)), none, n_words + 1)
    shard = scoring.Shard(from_buffer(np.frombuffer(to_bytes(arrays), np.uint8)), n_words + 1)
    single = np.full(n_words + 1, 1 / (n_words + 1))
    for x, y in ((0, 1), (1, 1), (5, 7), (39, 2)):
        words = np.r_[np.arange(n_words), -1]
        triple, left, pair, middle = shard.shares(np.full(n_words + 1, x), np.full(n_words + 1, y), words)
        assert (triple + left * (pair + middle * single)).sum() == pytest.approx(1, abs=2e-3)


def naive_divergence(rows):
    term = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    texts = [(lang or "", source or "", term.findall(lower(text))) for _, text, lang, source in rows]
    groups = {(lang, source) for lang, source, _ in texts}
    out = []
    for lang in {g[0] for g in groups}:
        mine = [t for t in texts if t[0] == lang]
        in_docs = Counter(w for _, _, words in mine for w in set(words))
        kept = sorted(w for w, k in in_docs.items() if k >= 3)
        v = len(kept)

        def weights(of):
            count = Counter(w for _, s, words in mine if of is None or s == of for w in words if w in set(kept))
            total = sum(count.values())
            return {w: 1 + 10**9 * (count[w] + 1) // (total + v) for w in kept}, count

        sources = sorted(s for g, s in groups if g == lang)
        p = {s: weights(s) for s in sources}
        q = weights(None)[0]
        for s in sources:
            pair = [(-sum((p[s][0][w] - p[o][0][w]) ** 2 // p[o][0][w] for w in kept), o) for o in sources if o != s]
            over = [(-((p[s][0][w] - q[w]) ** 2 // q[w]), w) for w in kept if p[s][1][w] and p[s][0][w] > q[w]]
            for part, found in (("pair", pair), ("term", over)):
                order = sorted(found, key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, item, -value, r) for r, (value, item) in enumerate(order, 1) if part == "pair" or r <= 200]
    return sorted(out)


def test_divergence(spark, docs, monkeypatch):
    monkeypatch.setattr(divergence, "BUCKET_POSTINGS", 5)
    monkeypatch.setattr(divergence, "FLUSH_TERMS", 4)
    got = divergence.audit(docs)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == naive_divergence(ROWS)


def test_weights_of_very_large_counts(spark):
    from pyspark.sql import functions as F

    n, total, kept = 9 * 10**12, 10**13, 10**9
    got = spark.range(1).select(divergence.weight(F.lit(n), F.lit(total), F.lit(kept)).alias("w")).first().w
    assert got == 1 + 10**9 * (n + 1) // (total + kept)


@pytest.mark.parametrize(
    "operator", [lambda d: collocations.collocations(d, min_count=2), scoring.score_documents, divergence.audit]
)
def test_edges(spark, docs, operator):
    from pyspark.sql import functions as F

    assert operator(docs.limit(0)).count() == 0
    plain = sorted(map(tuple, operator(docs).collect()), key=str)
    extra = {c: F.lit("own") for c in ("n", "f", "number", "block", "group", "rank", "score", "words", "term", "p", "_x")}
    assert sorted(map(tuple, operator(docs.withColumns(extra)).collect()), key=str) == plain
    twice = operator(docs.union(docs))
    assert twice.count() >= len(plain)


def test_very_long_text(spark):
    long = "ab cd. " * 300_000
    rows = [(1, long, "en", "a"), (3, "ab cd ab", "en", "b"), (4, "ab", "en", "b")]
    docs = spark.createDataFrame(rows, DOCS)
    (row,) = collocations.collocations(docs).collect()
    assert (row.phrase, row.a) == ("ab cd", 300_001)
    scores = {r.doc_id: r for r in scoring.score_documents(docs).collect()}
    assert scores[1].n_tokens == 600_001
    assert sorted(map(tuple, divergence.audit(docs).collect())) == naive_divergence(rows)


@pytest.mark.parametrize("together", [0, 8, 1 << 40])
def test_located_places(monkeypatch, together):
    monkeypatch.setattr(eliasfano, "TOGETHER", together)
    rng = np.random.default_rng(3)
    dense, wide = np.arange(5000, 9000), rng.integers(0, 1 << 41, 3000)
    for values in (np.unique(np.r_[dense, wide]), dense, np.zeros(0, np.int64), np.array([7]), np.repeat([0, 3, 900], 40)):
        held = eliasfano.Sequence(eliasfano.Sequence.arrays(values, "v"), "v")
        ask = np.r_[values, values + 1, rng.integers(0, 1 << 41, 500), -1, 0]
        for asked in (ask, np.sort(ask), ask[:0]):
            at = np.searchsorted(values, asked)
            known = np.isin(asked, values)
            assert np.array_equal(held.locate(asked), np.where(known, at, -1))
        assert np.array_equal(held.get(np.arange(len(values))), values)
