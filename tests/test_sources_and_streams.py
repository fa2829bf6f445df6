import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chatloom.session import scratch_path
from chatloom.sources.readers import read_annotations, read_many, read_splits, read_table
from chatloom.sources.writers import annotation_line, assign_shards, shard_manifest, write_jsonl_sharded
from chatloom.streaming.annotations import keep_malformed, render_new_files, stream_lines
from chatloom.plans.training_text import annotation_training_text

NOTE = {"text": "ä note", "entities": [{"mention": "m", "type": "T", "assertion": "P", "context_window": "c"}]}


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines), encoding="utf-8")


def test_read_glob_and_clean(spark, tmp_path):
    put(tmp_path / "in", "a.jsonl", json.dumps(NOTE), json.dumps({"text": "b"}))
    put(tmp_path / "in", "b.jsonl", json.dumps(NOTE, ensure_ascii=False))
    put(tmp_path / "in", "c.txt", "ignored")
    df = read_annotations(spark, f"{tmp_path}/in/*.jsonl")
    clean = read_annotations(spark, [f"{tmp_path}/in/a.jsonl", f"{tmp_path}/in/b.jsonl"], clean=True)
    for rows in (df.collect(), clean.collect()):
        assert sorted((r.text, len(r.entities)) for r in rows) == [("b", 0), ("ä note", 1), ("ä note", 1)]
    put(tmp_path / "in", "bad.jsonl", "{broken")
    for options in ({}, {"clean": True}):
        with pytest.raises(Exception):
            read_annotations(spark, f"{tmp_path}/in/bad.jsonl", **options).collect()


def test_splits(spark, tmp_path):
    put(tmp_path / "s", "train.jsonl", json.dumps(NOTE), json.dumps(NOTE))
    put(tmp_path / "s", "eval.jsonl", json.dumps(NOTE))
    train, held = f"{tmp_path}/s/train.jsonl", f"{tmp_path}/s/eval.jsonl"
    both = read_splits(spark, {"train": train, "eval": held}).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in both} == {"train": 2, "eval": 1}
    assert {r.split for r in read_splits(spark, {"train": train, "eval": None}).collect()} == {"train"}
    with pytest.raises(ValueError):
        read_splits(spark, {"eval": None})


def test_read_many_by_name(spark, small):
    for name in ("documents", "benchmark"):
        read_table(spark, f"{small}/{name}.parquet").createOrReplaceTempView(f"many_{name}")
    df = read_many(spark, "many_documents, many_benchmark", ["text"])
    n = {r.source: r["count"] for r in df.groupBy("source").count().collect()}
    assert n == {f"many_{t}": read_table(spark, f"{small}/{t}.parquet").count() for t in ("documents", "benchmark")}


def shard_files(path):
    return {
        folder.name: [line for f in sorted(folder.glob("part-*")) for line in f.read_text("utf-8").splitlines()]
        for folder in sorted(Path(path).glob("shard=*"))
    }


def test_shards_are_exact_ordered_and_single_files(spark):
    out = scratch_path(spark, "exact")
    df = spark.range(0, 2500, 1, 9).select((F.col("id") * 3).alias("id"), F.lit("é").alias("text"), F.lit(None).cast("string").alias("z"))
    write_jsonl_sharded(df, out, 1000, "id")
    got = shard_files(out)
    assert [len(v) for v in got.values()] == [1000, 1000, 500]
    assert list(got) == ["shard=0000", "shard=0001", "shard=0002"]
    ids = [json.loads(line)["id"] for lines in got.values() for line in lines]
    assert ids == [3 * i for i in range(2500)]
    assert got["shard=0000"][0] == '{"id":0,"text":"é","z":null}'
    assert all(len(list(f.glob("part-*"))) == 1 for f in Path(out).glob("shard=*"))
    with pytest.raises(Exception):
        write_jsonl_sharded(df, out, 1000, "id", mode="errorifexists")


def test_empty_input_writes_no_shard(spark):
    out = scratch_path(spark, "empty")
    write_jsonl_sharded(spark.createDataFrame([], "id BIGINT"), out)
    assert shard_files(out) == {}


def test_annotation_lines_are_exact(spark):
    out = scratch_path(spark, "lines")
    df = spark.createDataFrame(
        [(1, NOTE["text"], [tuple(NOTE["entities"][0].values())])],
        "id INT, text STRING, entities ARRAY<STRUCT<mention: STRING, type: STRING, assertion: STRING, context_window: STRING>>",
    )
    write_jsonl_sharded(df, out, line=annotation_line())
    assert shard_files(out) == {"shard=0000": [json.dumps(NOTE, ensure_ascii=False)]}


def test_shards_by_text_key_and_manifest(spark):
    keys = [f"k{(i * 37) % 501:04d}" for i in range(501)]
    df = spark.createDataFrame([(k,) for k in keys], "key STRING").repartition(6)
    rows = assign_shards(df, 50, "key").collect()
    assert {r.key: (r.idx, r.shard) for r in rows} == {k: (i, i // 50) for i, k in enumerate(sorted(keys))}
    m = {r.shard: (r.file_name, r.n, r.first, r.last) for r in shard_manifest(df, 50, "key").collect()}
    assert m[10] == ("annotations.0010.jsonl", 1, "k0500", "k0500") and len(m) == 11


def test_ties_are_exact_or_an_error(spark, monkeypatch):
    paired = spark.range(20).selectExpr("id div 2 AS id", "id AS n")
    got = assign_shards(paired, 20).collect()
    assert sorted(r.idx for r in got) == list(range(20))
    # Blocks of four rows never cut a pair, blocks of five do.
    monkeypatch.setattr("chatloom.sources.writers.BLOCKS", 5)
    rows = assign_shards(paired, 4).collect()
    assert sorted(r.idx for r in rows) == list(range(20)) and {r.shard for r in rows} == set(range(5))
    with pytest.raises(Exception, match="does not identify"):
        assign_shards(paired, 5).collect()


def test_more_blocks_than_the_usual_number(spark, monkeypatch):
    monkeypatch.setattr("chatloom.sources.writers.BLOCKS", 7)
    monkeypatch.setattr("chatloom.sources.writers.BLOCK_ROWS", 3)
    rows = assign_shards(spark.range(1000), 2).collect()
    assert {r.id: (r.idx, r.shard) for r in rows} == {i: (i, i // 2) for i in range(1000)}


def test_shards_keep_columns_named_idx_and_shard(spark):
    df = spark.range(10).selectExpr("id", "id + 900 AS idx", "id * 7 AS shard")
    with pytest.raises(ValueError, match="already"):
        assign_shards(df, 5)
    for order in ("id", "idx"):
        out = scratch_path(spark, "own")
        write_jsonl_sharded(df, out, 5, order)
        lines = [json.loads(line) for lines in shard_files(out).values() for line in lines]
        assert lines == [{"id": i, "idx": i + 900, "shard": 7 * i} for i in range(10)]
    assert shard_manifest(df, 5, "idx").agg(F.sum("n")).first()[0] == 10


def test_read_many_refuses_to_replace_a_column(spark, small):
    path = {"d": f"{small}/documents.parquet"}
    with pytest.raises(ValueError, match="already"):
        read_many(spark, path)
    assert read_many(spark, path, tag="part").columns[-1] == "part"


def test_one_wide_shuffle_for_shards(spark, small):
    d = spark.read.parquet(f"{small}/documents.parquet")
    plan = assign_shards(d, 10, "doc_id")._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "FileScan" in line and "text:string" in line]
    assert len(wide) == 1


def test_stream_equals_batch_and_only_sees_new_files(spark, tmp_path):
    source, out, bad = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/bad"

    def run():
        for q in (
            render_new_files(stream_lines(spark, str(source), 1), out, f"{tmp_path}/cp1"),
            keep_malformed(stream_lines(spark, str(source)), bad, f"{tmp_path}/cp2"),
        ):
            q.awaitTermination()

    put(source, "a.jsonl", json.dumps(NOTE), "broken")
    run()
    put(source, "b.jsonl", json.dumps({"text": "second"}))
    run()
    batch = annotation_training_text(spark.read.text(str(source)), bad_lines="skip")
    streamed = spark.read.schema("text STRING").json(out)
    assert sorted(r.text for r in streamed.collect()) == sorted(r.text for r in batch.collect())
    assert [r.defect for r in spark.read.json(bad).collect()] == ["not_json"]
