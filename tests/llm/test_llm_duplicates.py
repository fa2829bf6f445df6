"""SimHash groups, repeated passages, contamination, and the pipeline."""

import random
import re

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from chatloom.llm import components, decontamination, passages, quality, simhash
from chatloom.llm.queries import ORACLES, QUERIES
from checks.compare import compare, connect


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_fingerprint(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    runs = [" ".join(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in [None, "", " \x0b", "A", "a B", "a b c", "É  B\x0bc\x85d \xa0 e F", "x y z " * 50, "no break space"]:
        assert simhash.fingerprint(text) == brute_fingerprint(text)


def random_fingerprints(n):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    base[: n // 2] &= np.uint64(0xFFFFFFFF00000FFF)  # many with the same bits in some parts
    flip = lambda x: x ^ (np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64))
    return np.unique(np.concatenate([base, flip(base[::2]), flip(flip(base[::3])), flip(flip(flip(base[::4])))]))


@pytest.mark.parametrize("tau,parts", [(2, 3), (2, 2), (3, 4), (1, 1)])
def test_links_equal_brute_force(spark, tau, parts):
    fps = random_fingerprints(300)
    near = np.bitwise_count(fps[:, None] ^ fps) <= tau
    signed = simhash.signed(fps).tolist()
    want = {tuple(sorted((signed[a], signed[b]))) for a, b in zip(*np.nonzero(near)) if a != b}
    table = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    rows = simhash.link_pairs(table, tau, parts).collect()
    assert len(rows) == len(want) and {(r.a, r.b) for r in rows} == want


def test_thresholds_add_up_and_cost_least():
    rng = np.random.default_rng(3)
    costs = np.cumsum(rng.uniform(0, 9, (50, 3, 4)), axis=2)
    chosen = simhash.allocate(costs, 2)
    assert (chosen.sum(axis=1) == 0).all()
    every = [(a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 0]
    total = lambda row, t: sum(costs[row, p, t[p] + 1] for p in range(3))
    for row in range(50):
        assert total(row, chosen[row]) == pytest.approx(min(total(row, t) for t in every))


def test_number_of_parts_follows_the_data():
    chosen = [simhash.best_parts(n, 2) for n in (10, 10**6, 10**9, 10**13)]
    assert chosen[1:] == [3, 2, 1] and chosen[0] >= 3


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 900)]
    links = chain + star + [(7, 7), (None, 3), (3, 9), (9, 3), (3, 9)]
    table = spark.createDataFrame(links, "a long, b long").repartition(4)
    got = {r.node: r.label for r in components.connected_components(table).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 900)} | {3: 3, 9: 3}
    assert got == want
    assert components.connected_components(table.limit(0)).count() == 0


def test_simhash_groups(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    extra = [(10_000, None), (10_001, ""), (10_002, " \n"), (None, "only null id"), (10_003, "w " * 30_000), (3, "again")]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string")).repartition(5)
    rows = docs.collect()
    fps = np.array([brute_fingerprint(r.text) for r in rows], np.uint64)
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in np.flatnonzero(np.bitwise_count(fps ^ fps[a]) <= 2):
            low, high = sorted((label[a], label[b]))
            label = [low if x == high else x for x in label]
    least = {}
    for r, x in zip(rows, label):
        if r.doc_id is not None:
            least[x] = min(least.get(x, r.doc_id), r.doc_id)
    want = sorted((str(r.doc_id), f"{int(f):016x}", str(least.get(x))) for r, f, x in zip(rows, fps, label))
    got = simhash.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    kept = simhash.keep_one(docs)
    assert kept.where("doc_id is null").count() == 1
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == set(least.values()) | {None} - {None}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def prose(r, n):
    return [f"w{r.randint(0, 10**7)}" for _ in range(n)]


def planted(r):
    """Texts, and the pairs that share a passage of at least 50 words."""
    passage, near, common, line = prose(r, 55), prose(r, 90), prose(r, 70), prose(r, 20)
    edited = list(near)
    edited[45] = "changed"
    texts = {0: prose(r, 40) + passage + prose(r, 30), 1: prose(r, 90) + [w.upper() for w in passage] + prose(r, 10)}
    texts |= {2: near, 3: prose(r, 20) + edited + prose(r, 60)}
    texts |= {i: prose(r, r.randint(0, 60)) + common + prose(r, r.randint(0, 60)) for i in range(10, 60)}
    texts |= {i: prose(r, 60) + line + prose(r, 60) for i in range(100, 150)}  # too short to count
    texts |= {200: prose(r, 49), 201: None, 202: "", 203: ["the"] * 400, 204: ["the"] * 300}
    texts[205] = texts[200] + prose(r, 40)
    return {i: ", ".join(t) if isinstance(t, list) else t for i, t in texts.items()}


def test_planted_passages(spark):
    texts = planted(random.Random(8))
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in texts.items()], "doc_id long, text string, doc int, key int").repartition(6)
    rows = passages.occurrences(docs).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        assert r.last_word - r.first_word + 1 >= 50 and r.similarity >= 0.8 and r.doc_id != r.match_doc_id
    assert set(by_doc) == {0, 1, 2, 3, 203, 204} | set(range(10, 60))
    assert {r.match_doc_id for r in by_doc[0]} == {1} and {r.match_doc_id for r in by_doc[2]} == {3}
    (r,) = [r for r in by_doc[1] if r.match_doc_id == 0]
    assert (r.first_word, r.last_word, r.match_first_word, r.match_last_word) == (90, 144, 40, 94)
    # All that share the common passage hang together, with a few links each.
    group = spark.createDataFrame([(r.doc_id, r.match_doc_id) for i in range(10, 60) for r in by_doc[i]], "a long, b long")
    assert {r.label for r in components.connected_components(group).collect()} == {10}
    assert passages.occurrences(docs.limit(0)).count() == 0


def test_rare_passage_around_a_frequent_notice(spark):
    """Forty words that all share, and twelve more that pairs and a group share."""
    r = random.Random(10)
    notice, rare = prose(r, 40), {}
    texts = {i: prose(r, 60) + notice + prose(r, 60) for i in range(40)}
    for pair in range(12):
        # Each pair is an exact passage of 52 words, and 9 documents share one more.
        more = prose(r, 12)
        for i in [100 + 2 * pair, 101 + 2 * pair] if pair < 11 else range(200, 209):
            texts[i], rare[i] = prose(r, 60) + notice + more + prose(r, 60), pair
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string").repartition(5)
    rows = [x for x in passages.occurrences(docs).collect() if x.similarity == 1]
    assert {x.doc_id for x in rows} == set(rare)
    assert all(rare[x.doc_id] == rare[x.match_doc_id] and (x.first_word, x.last_word) == (60, 111) for x in rows)
    least = {pair: min(i for i in rare if rare[i] == pair) for pair in rare.values()}
    assert {(least[p], i) for i, p in rare.items() if i != least[p]} <= {(x.match_doc_id, x.doc_id) for x in rows}


def test_near_passages_around_a_frequent_notice(spark):
    """Forty-five words that all share, and thirteen more that pairs have alike but for a word."""
    r = random.Random(12)
    notice, pairs = prose(r, 45), [(100 + 2 * p, 101 + 2 * p) for p in range(24)]
    texts = {i: prose(r, 60) + notice + prose(r, 60) for i in range(40)}
    for a, b in pairs:
        # No 50 words are equal: 49 are, then one is not.
        more = prose(r, 13)
        texts[a] = prose(r, 60) + notice + more + prose(r, 60)
        texts[b] = prose(r, 60) + notice + more[:4] + ["changed"] + more[5:] + prose(r, 60)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string").repartition(5)
    found = {(x.doc_a, x.doc_b) for x in passages.shared(docs).collect()}
    assert len(found & set(pairs)) >= 21


def linked(docs):
    rows = passages.linked_documents(passages.all_windows(docs, "doc_id", "text"), docs, "doc_id", "text").collect()
    return {(x.a, x.b) for x in rows}


def test_links_of_a_group_grow_with_its_documents(spark):
    """Near copies hang together by few links; those that share less than a passage have none."""
    r = random.Random(14)
    passage, notice, texts = prose(r, 120), prose(r, 36), {}
    for i in range(60):
        # One more word, so that copies do not lie over each other.
        at = r.randint(20, 100)
        texts[i] = prose(r, r.randint(1, 60)) + passage[:at] + prose(r, 1) + passage[at:] + prose(r, r.randint(1, 60))
    texts |= {i: prose(r, 150) + notice + prose(r, 150) for i in range(100, 160)}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string").repartition(5)
    links = linked(docs)
    assert len([x for x in links if x[1] >= 100]) < 60
    copies = {x for x in links if x[1] < 60}
    assert len(copies) < 60 * 8
    found = passages.shared(docs).select(passages.F.col("doc_a").alias("a"), passages.F.col("doc_b").alias("b"))
    assert {(x.node, x.label) for x in components.connected_components(found).collect()} == {(i, 0) for i in range(60)}


def passages_of(a, b):
    """What two word lists share, over all places that meet, without Spark."""
    (ka, pa, _), (kb, pb, _) = (passages.window_rows(" ".join(t).encode()) for t in (a, b))
    i, j = np.nonzero(ka[:, None] == kb)
    tokens = [passages.shingles_of(passages.words_of(" ".join(t).encode())[2]) for t in (a, b)]
    return passages.shared_passages(*tokens, pa[i], pb[j]) if len(i) else []


def test_large_groups_lose_no_words_of_near_passages(spark):
    """What all pairs of documents share is found, by links of a few of them; also what earlier ones have."""
    r = random.Random(41)
    core, lines, texts = prose(r, 50), [prose(r, 24) for _ in range(6)], {}
    for i in range(60):
        # A near copy of what all share, between two of some lines.
        copy = list(core)
        copy[r.randint(8, 42)] = f"x{i}"
        texts[i] = prose(r, 30) + lines[r.randint(0, 5)] + copy + lines[r.randint(0, 5)] + prose(r, 30)
    rows = {i: passages.window_rows(" ".join(t).encode()) for i, t in texts.items()}
    tokens = {i: passages.shingles_of(passages.words_of(" ".join(t).encode())[2]) for i, t in texts.items()}
    held, later = set(), set()
    for b in texts:
        for a in range(b):
            i, j = np.nonzero(rows[a][0][:, None] == rows[b][0])
            if len(set(passages.unpacked(rows[b][1][j])[1].tolist())) < passages.LEAST_FUNCTIONS:
                continue
            for q in passages.shared_passages(tokens[a], tokens[b], rows[a][1][i], rows[b][1][j]):
                held |= {(a, k) for k in range(q[0], q[1] + passages.SHINGLE)}
                later |= {(b, k) for k in range(q[2], q[3] + passages.SHINGLE)}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string").repartition(4)
    found = passages.shared(docs).collect()
    of_b = {(x.doc_b, k) for x in found for k in range(x.first_b, x.last_b + 1)}
    of_a = {(x.doc_a, k) for x in found for k in range(x.first_a, x.last_a + 1)}
    assert len(held | later) > 5000 and not (held | later) - of_a - of_b
    assert len(later - of_b) <= 0.005 * len(later)


def test_near_passage_whose_slogan_also_stands_elsewhere():
    r, found = random.Random(11), 0
    for _ in range(20):
        passage = prose(r, 90)
        edited = passage[:45] + ["changed"] + passage[46:]
        a = prose(r, 200) + passage[:7] + prose(r, 53) + passage + prose(r, 200)
        b = prose(r, 150) + edited + prose(r, 150)
        found += any(q[0] == 260 and q[2] == 150 and q[3] == 235 for q in passages_of(a, b))
    assert found >= 17


def test_cut_passages(spark):
    texts = planted(random.Random(9))
    texts |= {300: texts[2], 301: "(" + texts[0] + " !"}
    docs = spark.createDataFrame([(i, t, "s", 0) for i, t in texts.items()], "doc_id long, text string, first_b string, links int")
    cut = passages.cut_repeats(docs)
    assert cut.columns == docs.columns
    left = {r.doc_id: r.text for r in cut.collect()}
    assert set(left) == set(texts) - {300, 301, 204}
    assert all(left[i] == texts[i] for i in (0, 2, 10, 100, 149, 200, 201, 202, 205))
    assert len(left[1].split()) < 105 and left[1].startswith(texts[1][:50])
    again = passages.shared(spark.createDataFrame([(i, t) for i, t in left.items()], "doc_id long, text string"))
    assert again.count() == 0


def test_texts_move_once_for_many_pairs(spark):
    words = random.Random(7).choices([f"w{i}" for i in range(5000)], k=120)
    size = 3 * passages.UNIT
    pairs = [(a, b) for b in range(size) for a in range(b) if (a + b) % 3 == 0 or a == 0]
    linked = [(a, b, [place], [place]) for a, b in pairs for place in [(50 << 30) | (50 << 14) | 65]]
    linked = spark.createDataFrame(linked, "a long, b long, a_places array<long>, b_places array<long>")
    units = passages.pair_units(linked).select("unit", "a", "b").collect()
    assert sorted((u.a, u.b) for u in units) == sorted(pairs)
    sent = {(u.unit, d) for u in units for d in (u.a, u.b)}
    assert len(sent) < len(pairs) / 10
    held = {}
    for unit, doc in sent:
        held[unit] = held.get(unit, 0) + 1
    assert max(held.values()) < 4 * passages.UNIT
    docs = [(i, " ".join(words)) for i in range(size)] + [(5, " ".join(words)), (None, "a"), (6, None)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    rows = passages.verified(linked, docs, "doc_id", "text").collect()
    assert sorted((x.doc_a, x.doc_b) for x in rows) == sorted(pairs)
    assert {(x.first_a, x.last_a, x.first_b, x.last_b, x.similarity) for x in rows} == {(0, 119, 0, 119, 1.0)}


def test_every_exact_repeat_is_found(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(4)
    seen = {}
    for r in docs.collect():
        words = re.findall(r"[0-9a-z\x80-\U0010FFFF]+", lowered(r.text))
        for i in range(len(words) - 49):
            seen.setdefault(hash(tuple(words[i : i + 50])), set()).add(r.doc_id)
    want = set().union(*(s for s in seen.values() if len(s) > 1))
    rows = passages.occurrences(docs).select("doc_id").distinct().collect()
    assert want and want <= {r.doc_id for r in rows}


def test_nearest_lesser_and_window_least():
    rng = np.random.default_rng(4)
    for n in (0, 1, 5, 200):
        v = rng.integers(0, 50, n)
        want = [max((j for j in range(i) if v[j] < v[i]), default=-1) for i in range(n)]
        assert passages.nearest_lesser(v).tolist() == want
        assert passages.window_least(v, 7).tolist() == [v[i : i + 7].min() for i in range(max(n - 6, 0))]


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute_contamination(docs, items):
    windows = {}
    for i, (_, text) in enumerate(items):
        w = re.findall(WORD, lowered(text))
        t = min(13, len(w))
        for s in range(len(w) - t + 1 if w else 0):
            windows.setdefault(tuple(w[s : s + t]), set()).add(i)
    lengths = {len(w) for w in windows}
    for doc, text in docs:
        w = re.findall(WORD, lowered(text))
        hit, found = set(), set()
        for t in lengths:
            for s in range(len(w) - t + 1):
                if tuple(w[s : s + t]) in windows:
                    hit |= set(range(s, s + t))
                    found |= windows[tuple(w[s : s + t])]
        ids = sorted({str(items[i][0]) for i in found})
        yield str(doc), len(w), len(hit), ids, bool(hit) and 20 * len(hit) >= len(w)


def test_contamination_equals_brute_force(spark):
    r = random.Random(6)
    word = lambda: r.choice(["a", "B", "c3", "É", "é", "dd"])
    items = [(i, " ".join(word() for _ in range(r.choice([0, 1, 2, 5, 12, 13, 14, 30])))) for i in range(12)]
    items += [(50, items[7][1]), (51, None), (52, "x, y; z"), (53, " ".join(f"u{i}" for i in range(60)))]
    docs = [(i, " ".join(word() for _ in range(r.randint(0, 60)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "?!"), (103, f"{items[-1][1]} tail"), (103, "x y z"), (None, items[8][1])]
    docs += [(104, " ".join(f"u{i}" for i in range(20, 32))), (105, "n " * 50 + " ".join(f"u{i}" for i in range(20, 33)))]
    table = spark.createDataFrame([(i, t, 9, "k") for i, t in docs], "doc_id long, text string, n_hit int, kept string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contamination(table, bench)
    rows = sorted((str(x.kept.doc_id), x.n_words, x.n_hit, x["items"], x.contaminated) for x in got.collect())
    assert rows == sorted(brute_contamination(docs, items))
    assert decontamination.keep_clean(table, bench).columns == table.columns
    assert decontamination.contamination(table, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontamination.contamination(table.limit(0), bench).count() == 0


def test_native_queries_run_no_python(spark, small):
    for name in ("op2_winnowing", "op6_url_filters"):
        plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, name):
    assert compare(QUERIES[name](spark, small), connect(small), ORACLES[name]) == ""


def test_pipeline_equals_the_stages_by_brute_force(spark, small):
    """Each stage against plain Python over the rows it was given."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, small)
        after = {r.doc_id: r for r in out.collect()}
        assert out.count() == len(after)
        if name == "quality classifier":
            scores = quality.score_documents(docs, spark.read.parquet(f"{small}/labels.parquet"))
            want = {r.doc_id for r in scores.collect() if r.score >= 0.3}
        elif name == "SimHash near-dedup":
            want = {r.component_id for r in simhash.near_duplicates(docs).collect()}
            fps = [simhash.fingerprint(r.text) for r in after.values()]
            assert all((a ^ b).bit_count() > 2 for i, a in enumerate(fps) for b in fps[:i])
        elif name == "substring dedup":
            want = {i for i in before if i in after or not re.search(r"\w", before[i].text)}
            assert passages.shared(out).count() == 0
        elif name == "benchmark decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
            marked = brute_contamination([(i, r.text) for i, r in before.items()], items)
            want = {int(m[0]) for m in marked if not m[4]}
        else:
            want = set(before)
        assert set(after) == want
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
            docs = out
    assert {r.doc_id for r in corpus_pipeline.run(spark, small).collect()} == set(after)


def test_near_passages_by_similarity():
    """Insertions, deletions and replacements of 1 to 14 words, wherever similarity is 0.8."""
    rng = random.Random(4)
    words = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    shingles = lambda t: {tuple(t[i : i + 5]) for i in range(len(t) - 4)}
    found = asked = 0
    for n in (60, 90, 120, 300):
        for kind in ("insert", "delete", "replace"):
            for k in range(1, 15):
                for _ in range(3):
                    passage, at = words(n), rng.randrange(5, n - 5 - k)
                    new = [] if kind == "delete" else words(k)
                    copy = passage[:at] + new + passage[at + k * (kind != "insert") :]
                    p, q = shingles(passage), shingles(copy)
                    if len(p & q) < passages.SIMILARITY * len(p | q):
                        continue
                    before = words(rng.randrange(100))
                    held = set()
                    for r in passages_of(words(rng.randrange(100)) + passage + words(50), before + copy + words(50)):
                        held |= set(range(r[2], r[3] + passages.SHINGLE))
                    span = set(range(len(before), len(before) + len(copy)))
                    asked += 1
                    found += len(held & span) >= 0.8 * len(copy)
    assert asked > 250 and found >= 0.9 * asked


def test_one_row_per_periodic_stretch():
    rng = random.Random(8)
    line = [f"w{i}" for i in range(10)]
    a, b = (["x%d" % rng.randrange(10**6) for _ in range(60)] + line * 20 + ["y%d" % rng.randrange(10**6)] for _ in range(2))
    rows = passages_of(a, b)
    assert len(rows) == 1 and rows[0][1] - rows[0][0] + passages.SHINGLE == 200
