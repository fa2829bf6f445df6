import bisect
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from chatloom.operators import lengths, mixing


def docs(spark, n, first=0, parts=5):
    rows = [(first + i, f"text {i}") for i in range(n)]
    return spark.createDataFrame(rows, "id BIGINT, text STRING").repartition(parts, F.rand(parts))


def test_sample_to_share_sizes(spark):
    base, pool = docs(spark, 620), docs(spark, 380, 1000)
    chosen = mixing.sample_to_share(base, pool, 0.25, 2407)
    ids = [r.id for r in chosen.collect()]
    assert len(ids) == len(set(ids)) == 206
    again = mixing.sample_to_share(base, docs(spark, 380, 1000, 13), 0.25, 2407)
    assert sorted(r.id for r in again.collect()) == sorted(ids)
    other = mixing.sample_to_share(base, pool, 0.25, 1)
    assert sorted(r.id for r in other.collect()) != sorted(ids)
    report = mixing.mix_report(mixing.mix({"base": base, "pool": chosen}))
    shares = {r.source: (r.n, r.share) for r in report.collect()}
    assert shares["pool"] == (206, 206 / 826)


def test_pool_too_small(spark):
    with pytest.raises(Exception, match="fewer rows than the share"):
        mixing.sample_to_share(docs(spark, 100), docs(spark, 5, 500), 0.5, 1).collect()
    with pytest.raises(ValueError):
        mixing.sample_to_share(docs(spark, 1), docs(spark, 1), 1.0, 1)


def test_mix_keeps_duplicates(spark):
    one = docs(spark, 3)
    assert mixing.mix({"a": one, "b": one}).count() == 6


@pytest.mark.parametrize("parts", [1, 7, 32])
def test_shuffle_is_a_permutation(spark, parts):
    both = mixing.mix({"a": docs(spark, 150, 0, parts), "b": docs(spark, 150, 0, parts)})
    rows = mixing.shuffle(both, 3407, "id", F.col("source")).collect()
    assert sorted(r.pos for r in rows) == list(range(300))
    order = [(r.source, r.id) for r in sorted(rows, key=lambda r: r.pos)]
    assert order != sorted(order) and len(set(order)) == 300
    reference = mixing.shuffle(
        mixing.mix({"a": docs(spark, 150), "b": docs(spark, 150)}), 3407, "id", F.col("source")
    ).orderBy("pos")
    assert [(r.source, r.id) for r in reference.collect()] == order


@pytest.mark.parametrize(("n", "size"), [(1000, 100), (101, 11), (1, 1)])
def test_split_sizes(spark, n, size):
    parts = mixing.split_train_eval(docs(spark, n), 0.1, 42).groupBy("split").count().collect()
    counts = {r.split: r["count"] for r in parts}
    assert counts.get("eval", 0) == size and sum(counts.values()) == n


def test_split_by_hash_is_row_local(spark):
    df = mixing.split_by_hash(docs(spark, 3000), 0.2, 1)
    assert 480 < df.where("split = 'eval'").count() < 720
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and "Aggregate" not in plan


def test_cap_and_head(spark):
    df = docs(spark, 90).withColumn("source", F.when(F.col("id") < 60, "hot").otherwise("cold"))
    capped = mixing.cap_per_source(df, 20, "source", "id").collect()
    assert sorted(r.id for r in capped) == [*range(20), *range(60, 80)]
    assert [r.id for r in mixing.head_slice(df, 7, "id").orderBy("id").collect()] == list(range(7))


def test_length_stats_and_own_estimate(spark):
    df = spark.createDataFrame([("a", "x y z"), ("a", ""), ("b", None)], "g STRING, text STRING")
    rows = {r.g: tuple(r)[1:] for r in lengths.length_stats(df, "g", limit=2).collect()}
    assert rows == {"a": (2, 0, 3, 3, 1), "b": (1, 0, 0, 0, 0)}
    own = lengths.length_stats(df, est=lambda c: F.length(c), limit=4).first()
    assert (own.n, own.max_len, own.n_over) == (3, 5, 1)


def test_truncate(spark):
    texts = ["one two\n\nthree four", " a b ", "", "ab" * 30, None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id INT, text STRING")
    rows = lengths.truncate(df, limit=2).orderBy("id").collect()
    assert [(r.text, r.was_truncated) for r in rows] == [
        ("one two", True), (" a b ", False), ("", False), ("ab" * 30, False), (None, False),
    ]
    rows = lengths.truncate(df, limit=3, est="chars4").orderBy("id").collect()
    assert [r.text for r in rows] == [None if t is None else t[:12] for t in texts]
    with pytest.raises(ValueError):
        lengths.truncate(df, est="other")


def test_truncated_texts_meet_the_limit(spark, small):
    d = spark.read.parquet(f"{small}/documents.parquet")
    cut = lengths.truncate(d, limit=50)
    assert lengths.length_stats(cut, limit=50).first().n_over == 0


def test_pack(spark):
    rows = [(i, (i * 7) % 40 + 1) for i in range(500)]
    df = spark.createDataFrame(rows, "id BIGINT, n BIGINT").repartition(9)
    packed = lengths.pack(df, "n", 64, n_buckets=4, seed=1).collect()
    assert len(packed) == 500 and {r.bucket for r in packed} == {0, 1, 2, 3}
    totals, longest = {}, {}
    for r in packed:
        totals[r.bucket, r.pack] = totals.get((r.bucket, r.pack), 0) + r.n
        longest[r.bucket, r.pack] = max(longest.get((r.bucket, r.pack), 0), r.n)
    assert all(t < 64 + longest[k] for k, t in totals.items())
    again = lengths.pack(df.repartition(2), "n", 64, n_buckets=4, seed=1).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, packed))


def test_bucket_count_follows_the_volume(spark):
    small = spark.range(100).withColumn("n", F.lit(10))
    large = spark.range(10000).withColumn("n", F.lit(10))
    count = lambda d: (
        lengths.pack(d, "n", 100, packs_per_bucket=5).select("bucket").distinct().count()
    )
    assert count(small) == 2 and count(large) == 200


def greedy(sizes, budget):
    packs, fill, pack = [], 0, -1
    for n in sizes:
        if pack < 0 or fill + n > budget:
            fill, pack = 0, pack + 1
        fill += n
        packs.append(pack)
    return packs


def test_pack_within_budget(spark):
    import random

    rng = random.Random(5)
    for budget, n_buckets in ((64, 4), (10, None), (1, 2), (5000, 3)):
        sizes = [rng.choice([0, 1, 3, 7, 20, 63, 64, 65, 500, None]) for _ in range(400)]
        df = spark.createDataFrame(list(enumerate(sizes)), "id INT, n INT").repartition(5)
        packed = lengths.pack_within_budget(df, "n", budget, n_buckets, seed=1).collect()
        buckets = {}
        for r in packed:
            key = hashlib.md5(f"1::{r.id}".encode()).hexdigest()
            buckets.setdefault(r.bucket, []).append((key, r.id, r.n or 0, r.pack))
        assert sorted(r.id for r in packed) == list(range(400))
        for rows in buckets.values():
            rows.sort()
            assert [r[3] for r in rows] == greedy([r[2] for r in rows], budget)


def test_pack_within_budget_by_group(spark):
    rows = [(i, ("a", None)[i % 3 == 0], i % 17) for i in range(300)]
    df = spark.createDataFrame(rows, "id INT, side STRING, n INT")
    both = lengths.pack_within_budget(df, "n", 20, seed=2, by=["side"])
    for side in ("side = 'a'", "side is null"):
        alone = lengths.pack_within_budget(df.where(side), "n", 20, seed=2)
        assert sorted(map(str, both.where(side).collect())) == sorted(map(str, alone.collect()))
    assert lengths.pack_within_budget(df.limit(0), "n", 20).count() == 0


def test_configured_run(spark):
    from chatloom.plans.training_text import configured_training_rows

    rows = [(i, "Do it.", f"question {i}", "word " * i) for i in range(40)]
    df = spark.createDataFrame(rows, "id INT, task STRING, input STRING, expected_output STRING")
    made = configured_training_rows({"a": df, "b": df.where("id < 7")}, cutoff=20, most_rows=10, eval_fraction=0.2, packing=True).collect()
    assert sorted((r.dataset, r.id) for r in made) == [("a", i) for i in range(10)] + [("b", i) for i in range(7)]
    assert sum(r.split == "eval" for r in made) == 4
    assert all(r.n_tokens <= 20 and len(r.text.split()) == r.n_tokens for r in made)
    fills = {}
    for r in made:
        fills[r.split, r.bucket, r.pack] = fills.get((r.split, r.bucket, r.pack), 0) + r.n_tokens
    assert max(fills.values()) <= 20


def texts_of(spark, n):
    """Word counts 0 to 1,999 in a skewed order, a third of all rows in group a."""
    words = F.repeat(F.lit("w "), (F.col("id") * F.col("id") % 2000).cast("int"))
    text = F.when(F.col("id") % 50 != 7, words)
    group = F.when(F.col("id") % 3 == 0, "a").otherwise(F.concat(F.lit("g"), F.col("id") % 5))
    return spark.range(n).select("id", group.alias("g"), text.alias("text"), F.lit("own").alias("len"))


def lengths_by_group(rows):
    found = {}
    for r in rows:
        found.setdefault(r.g, []).append(len((r.text or "").split()))
    return {g: sorted(v) for g, v in found.items()}


def test_length_quantiles_are_exact(spark):
    df = texts_of(spark, 3000).repartition(7)
    want = lengths_by_group(df.collect())
    shares = (0.0, 0.25, 0.5, 0.99, 1.0)
    got = lengths.length_quantiles(df, "g", shares=shares).collect()
    assert len(got) == len(want) * len(shares)
    for r in got:
        values = want[r.g]
        place = max(1, math.ceil(r.share * len(values)))
        assert (r.n, r.len) == (len(values), values[place - 1])
    every = sorted(v for values in want.values() for v in values)
    whole = {r.share: r.len for r in lengths.length_quantiles(df).collect()}
    assert whole == {s: every[math.ceil(s * 3000) - 1] for s in (0.5, 0.9, 0.99)}
    assert lengths.length_quantiles(df.limit(0), "g").count() == 0
    with pytest.raises(ValueError):
        lengths.length_quantiles(df, "g", "len")


def test_merged_sketches_keep_their_rank_error(spark):
    k, df = 200, texts_of(spark, 20_000)
    parts = [df.where(F.col("id") % 4 == i) for i in range(4)]
    made = [lengths.length_sketches(p.repartition(3), "g", k=k) for p in parts]
    all_parts = made[0].union(made[1]).union(made[2]).union(made[3])
    merged = lengths.merge_length_sketches(all_parts, "g", k=k)
    want = lengths_by_group(df.collect())
    got = lengths.sketched_quantiles(merged, "g", shares=(0.1, 0.5, 0.9, 0.99)).collect()
    assert len(got) == 4 * len(want)
    for r in got:
        values = want[r.g]
        assert r.n == len(values)
        # Twice the bound of 99 cases in 100, since the sketches draw at random.
        off = 2 * lengths.sketch_rank_error(k) * r.n + 1
        assert bisect.bisect_left(values, r.len) <= r.share * r.n + off
        assert bisect.bisect_right(values, r.len) >= r.share * r.n - off
    assert lengths.sketched_quantiles(lengths.length_sketches(df.limit(0))).count() == 0
