import random

import pytest
from pyspark.sql import functions as F

from chatloom.functions.keys import order_key
from chatloom.operators import indexing as ix
from chatloom.sources.writers import assign_shards


def frame(spark, rows, schema, parts):
    return spark.createDataFrame(rows, schema).repartition(parts, F.rand(parts))


@pytest.mark.parametrize("parts", [1, 7, 32])
def test_global_index_by_id(spark, parts):
    ids = random.Random(3).sample(range(-10**12, 10**12), 500)
    df = frame(spark, [(i,) for i in ids], "id BIGINT", parts)
    got = {r.id: r.idx for r in ix.global_index(df, ["id"]).collect()}
    assert got == {v: i for i, v in enumerate(sorted(ids))}


def test_global_index_with_few_bounds(spark):
    df = spark.range(5000).withColumn("id", F.col("id") * 7)
    got = ix.global_index(df, ["id"], ix.range_buckets(df, ["id"], buckets=16))
    assert got.where(F.col("idx") * 7 != F.col("id")).count() == 0
    assert got.agg(F.countDistinct("idx")).first()[0] == 5000


def test_hot_leading_column_is_split(spark):
    # A third of all rows share the leading order value; strings and nulls mixed in.
    rows = [("hot", f"k{i:04d}") for i in range(400)]
    rows += [(f"s{i:03d}", "x") for i in range(600)] + [(None, f"n{i}") for i in range(200)]
    df = frame(spark, rows, "source STRING, id STRING", 5)
    order = ["source", "id"]
    buckets = ix.range_buckets(df, order, buckets=64)
    sizes = [r["count"] for r in buckets(df).groupBy("__cl_bucket").count().collect()]
    assert max(sizes) < 150
    got = [(r.source, r.id) for r in ix.global_index(df, order, buckets).orderBy("idx").collect()]
    assert got == sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))


def test_bounds_never_become_row_data(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for df in (ix.global_index(docs, ["doc_id"]), assign_shards(docs, 10, "doc_id")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "AS _bounds" not in plan


def test_running_total_in_groups(spark):
    rng = random.Random(5)
    rows = [(None if j == 3 else j, b, rng.randrange(10)) for j in range(4) for b in range(50)]
    df = frame(spark, rows, "job INT, batch INT, v INT", 6)
    out = ix.running_total(df, ["batch"], ix.value_buckets("batch", 8), "s", ["job"], F.col("v"))
    got = {(r.job, r.batch): r.s for r in out.collect()}
    want, acc = {}, {}
    for j, b, v in rows:
        acc[j] = acc.get(j, 0) + v
        want[j, b] = acc[j]
    assert got == want
    assert out.columns == ["job", "batch", "v", "s"]


@pytest.mark.parametrize("n", [0, 1, 37, 200, 500])
def test_first_rows(spark, n):
    df = frame(spark, [(i * 3, "x") for i in range(200)], "id BIGINT, t STRING", 7)
    got = sorted(r.id for r in ix.first_rows(df, n, ["id"]).collect())
    assert got == [i * 3 for i in range(min(n, 200))]


def test_first_rows_with_null_order_values(spark):
    df = frame(spark, [(None, "n")] + [(i, "x") for i in range(20)], "id BIGINT, t STRING", 3)
    got = [r.id for r in ix.first_rows(df, 3, ["id"]).collect()]
    assert sorted(got, key=lambda v: (v is not None, v)) == [None, 0, 1]


def test_first_rows_of_nothing(spark):
    df = spark.createDataFrame([], "id BIGINT")
    assert ix.first_rows(df, 5, ["id"]).count() == 0
    assert ix.global_index(df, ["id"]).count() == 0


def test_ties_at_the_cut_are_an_error(spark):
    df = spark.createDataFrame([(i // 2,) for i in range(20)], "id BIGINT")
    assert ix.first_rows(df, 4, ["id"]).count() == 4
    with pytest.raises(Exception, match="does not identify"):
        ix.first_rows(df, 5, ["id"]).collect()


def test_first_rows_per_group_with_a_hot_group(spark):
    rows = [("hot", i) for i in range(600)] + [(f"s{i % 40}", i) for i in range(600, 1000)]
    rows += [(None, i) for i in range(1000, 1030)]
    df = frame(spark, rows, "source STRING, id BIGINT", 9)
    got = {}
    for r in ix.first_rows_per_group(df, 12, ["source"], ["id"]).collect():
        got.setdefault(r.source, []).append(r.id)
    want = {}
    for s, i in rows:
        want.setdefault(s, []).append(i)
    assert {s: sorted(v) for s, v in got.items()} == {s: sorted(v)[:12] for s, v in want.items()}


def test_cut_reaches_the_scan(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = ix.first_rows(docs, 5, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(doc_id" in plan or "Or(IsNull(doc_id)" in plan


def test_order_key_is_md5_of_seed_source_id(spark):
    import hashlib

    df = spark.createDataFrame([("s", 5)], "source STRING, id INT")
    row = df.select(
        order_key(7, "id", F.col("source")).alias("a"), order_key(7, "id").alias("b")
    ).first()
    assert row.a == hashlib.md5(b"7:s:5").hexdigest()
    assert row.b == hashlib.md5(b"7::5").hexdigest()


def test_value_buckets_need_groups(spark):
    with pytest.raises(ValueError, match="groups"):
        ix.running_total(spark.range(5), ["id"], ix.value_buckets("id", 2), "sum")


def test_planning_starts_no_job(spark):
    from chatloom.operators import mixing
    from chatloom.sources.writers import assign_shards

    df = spark.range(100).selectExpr("id", "id % 3 AS source", "'x' AS text")
    spark.sparkContext.setJobGroup("planning", "plans only")
    mixing.cap_per_source(df, 5)
    mixing.head_slice(df, 5, "id")
    mixing.shuffle(mixing.mix({"a": df, "b": df}, "part"), 1, "id", df["source"].cast("string"))
    mixing.split_train_eval(df)
    assign_shards(df, 10)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup("", "")


def test_user_columns_with_working_names_survive(spark):
    from chatloom.operators import lengths, mixing

    names = ["_source", "_key", "_bucket", "_value", "_total", "_offset", "_b", "_k", "_n"]
    df = spark.range(40).selectExpr("id", "'s' AS source", "id AS n", *[f"id * {i + 2} AS {c}" for i, c in enumerate(names)])
    made = [
        mixing.head_slice(df, 40, "id"),
        mixing.cap_per_source(df, 40),
        mixing.mix({"a": df}, "part"),
        mixing.sample_exact(df, 40, 1),
        mixing.shuffle(df, 1, "id", df["source"]),
        mixing.split_train_eval(df),
        ix.global_index(df, ["id"]),
        lengths.pack(df, "n"),
    ]
    for out in made:
        rows = out.collect()
        assert len(rows) == 40
        assert all(r[c] == r.id * (i + 2) for r in rows for i, c in enumerate(names))
    with pytest.raises(ValueError, match="already"):
        mixing.mix({"a": df})
    with pytest.raises(ValueError, match="already"):
        ix.global_index(df, ["id"], out="n")
    with pytest.raises(ValueError, match="already"):
        mixing.head_slice(mixing.mix({"a": df}, "x"), 3, "id").transform(lambda d: mixing.mix({"b": d}, "x"))
