"""Growing shard sets against plain lists."""

import pytest
from pyspark.sql import functions as F

from chatloom.sources import shard_sets
from chatloom.sources.shard_sets import append_shards, manifest, read_shard_set, versions
from chatloom.sources.writers import write_jsonl_sharded


def rows(spark, first, last):
    return spark.range(first, last).select("id", F.format_string("row %dé", "id").alias("text"))


def shards(spark, path, version=None):
    lines = read_shard_set(spark, path, version).select("shard", F.get_json_object("value", "$.id").cast("int").alias("id"))
    out = {}
    for r in lines.collect():
        out.setdefault(r.shard, set()).add(r.id)
    return out


def cut(ids, size):
    return {i // size: set(ids[i : i + size]) for i in range(0, len(ids), size)}


def test_append_fills_the_last_shard_and_keeps_old_versions(spark, tmp_path):
    path = str(tmp_path / "set")
    # Later rows have smaller ids: an append never moves rows that were there.
    written = []
    for first, last in ((1000, 1025), (500, 503), (0, 1), (600, 640)):
        written += range(first, last)
        version = append_shards(rows(spark, first, last), path, 10)
        assert shards(spark, path, version) == cut(written, 10)
    assert list(versions(spark, path)) == [1, 2, 3, 4]
    assert shards(spark, path, 1) == cut(list(range(1000, 1025)), 10)
    assert [r.n for r in manifest(spark, path).orderBy("shard").collect()] == [10] * 6 + [9]


def test_order_inside_a_filled_shard(spark, tmp_path):
    path = str(tmp_path / "set")
    append_shards(rows(spark, 50, 57), path, 20)
    append_shards(rows(spark, 0, 5), path, 20)
    run = manifest(spark, path).first().run
    (file,) = (tmp_path / "set" / "data" / f"run={run}" / "shard=0000").glob("part-*")
    ids = [int(line.split('"id":')[1].split(",")[0]) for line in file.read_text().splitlines()]
    assert ids == [*range(50, 57), *range(5)]


def test_append_without_filling(spark, tmp_path):
    path = str(tmp_path / "set")
    append_shards(rows(spark, 0, 25), path, 10)
    append_shards(rows(spark, 25, 37), path, 10, fill=False)
    assert [r.n for r in manifest(spark, path).orderBy("shard").collect()] == [10, 10, 5, 10, 2]
    assert [r.file_name for r in manifest(spark, path).orderBy("shard").collect()][-1] == "annotations.0004.jsonl"


def test_lost_job_leaves_the_version_before(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "set")
    append_shards(rows(spark, 0, 25), path, 10)

    def lost(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(shard_sets, "_commit", lost)
    with pytest.raises(RuntimeError):
        append_shards(rows(spark, 25, 60), path, 10)
    monkeypatch.undo()
    assert list(versions(spark, path)) == [1]
    assert shards(spark, path) == cut(list(range(25)), 10)
    # The next append ignores what the lost one left.
    append_shards(rows(spark, 100, 108), path, 10)
    assert shards(spark, path) == cut([*range(25), *range(100, 108)], 10)


def test_failed_tasks_commit_nothing(spark, tmp_path):
    path = str(tmp_path / "set")
    append_shards(rows(spark, 0, 5), path, 10)
    bad = rows(spark, 5, 9).withColumn("text", F.when(F.col("id") == 7, F.raise_error(F.lit("bad"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="bad"):
        append_shards(bad, path, 10)
    assert shards(spark, path) == {0: set(range(5))}


def test_two_writers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "set")
    append_shards(rows(spark, 0, 5), path, 10)
    plain, began = shard_sets._commit, []

    def slow(*args):
        if not began:
            began.append(1)
            append_shards(rows(spark, 50, 52), path, 10)
        plain(*args)

    monkeypatch.setattr(shard_sets, "_commit", slow)
    with pytest.raises(shard_sets.VersionTaken):
        append_shards(rows(spark, 70, 99), path, 10)
    assert shards(spark, path) == {0: {*range(5), 50, 51}}


def test_empty_sets_and_appends(spark, tmp_path):
    path = str(tmp_path / "set")
    assert versions(spark, path) == {} and shards(spark, path) == {}
    assert append_shards(rows(spark, 0, 0), path, 10) == 0
    assert append_shards(rows(spark, 0, 20), path, 10) == 1
    assert append_shards(rows(spark, 0, 0), path, 10) == 1
    assert append_shards(rows(spark, 20, 21), path, 10) == 2
    assert shards(spark, path) == cut(list(range(21)), 10)
    with pytest.raises(ValueError, match="10 rows"):
        append_shards(rows(spark, 30, 31), path, 11)
    with pytest.raises(ValueError, match="no version"):
        manifest(spark, path, 9)


def test_plain_writer_refuses_append(spark, tmp_path):
    with pytest.raises(ValueError, match="append"):
        write_jsonl_sharded(rows(spark, 0, 5), str(tmp_path / "x"), 2, mode="append")
