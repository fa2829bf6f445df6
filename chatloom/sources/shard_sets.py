"""Shard sets that grow: exact-size JSONL shards with versions and a commit step.

    outdir/data/run=<id>/shard=0003/part-....txt   lines, one file per shard
    outdir/manifests/<id>/                         which run holds each shard, and its rows
    outdir/versions/00000002                       names the manifest of version 2

A version is the file under ``versions``. It is created last, in one step that fails if
the name is taken, so of two writers one wins and the other gets an error. Before that
step nothing that a reader looks at has changed: a lost job leaves files that no version
names, and the version before it stays what it was. (Refusing a taken name is up to the
file system's rename; a plain local disk checks the name first, so two writers there that
commit in the same instant are not told apart.) Older versions stay readable, since
no data file is ever written again.

An append continues the shard numbers. By default it fills the last shard if that is
short: its lines are copied in front of the new ones into a shard of the new run, at most
one shard's rows. With ``fill=False`` the new rows begin a shard of their own and the
short one stays as it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.fixed_values import SHARD_NAME, SHARD_ROWS
from chatloom.sources.writers import assign_shards, json_line

MANIFEST = "shard BIGINT, run STRING, n BIGINT, shard_size BIGINT"
VERSION_NAME = "{:08d}"


class VersionTaken(RuntimeError):
    """Another writer has committed the version this one was about to."""


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _commit(spark: SparkSession, outdir: str, version: int, run: str) -> None:
    files, path = _files(spark, f"{outdir}/versions/{VERSION_NAME.format(version)}")
    draft, draft_path = _files(spark, f"{outdir}/drafts/{run}")
    # The name appears with its whole content, or not at all.
    stream = draft.create(draft_path, False)
    stream.write(bytearray(f"{run}\n".encode()))
    stream.close()
    files.mkdirs(path.getParent())
    if files.exists(path) or not files.rename(draft_path, path):
        raise VersionTaken(f"version {version} of {outdir} exists")


def versions(spark: SparkSession, outdir: str) -> dict[int, str]:
    """Committed versions and their runs, oldest first."""
    files, path = _files(spark, f"{outdir}/versions")
    if not files.exists(path):
        return {}
    rows = spark.read.text(f"{outdir}/versions").select(F.col("_metadata.file_name").alias("name"), "value")
    return {int(r.name): r.value for r in rows.orderBy("name").collect()}


def manifest(spark: SparkSession, outdir: str, version: int | None = None) -> DataFrame:
    """``(shard, run, n, shard_size, file_name)`` of a version, the newest by default."""
    known = versions(spark, outdir)
    if version is None and not known:
        rows = spark.createDataFrame([], MANIFEST)
    else:
        version = max(known) if version is None else version
        if version not in known:
            raise ValueError(f"{outdir} has no version {version}")
        rows = spark.read.schema(MANIFEST).parquet(f"{outdir}/manifests/{known[version]}")
    return rows.withColumn("file_name", F.format_string(SHARD_NAME, "shard"))


def read_shard_set(spark: SparkSession, outdir: str, version: int | None = None) -> DataFrame:
    """``(shard, value)``: the lines of a version.

    Shards that a later run filled, and leftovers of lost runs, are pruned as partitions.
    """
    held = manifest(spark, outdir, version).select("run", "shard")
    if not versions(spark, outdir):
        return spark.createDataFrame([], "shard BIGINT, value STRING")
    lines = spark.read.schema("value STRING, run STRING, shard BIGINT").text(f"{outdir}/data")
    return lines.join(held, ["run", "shard"]).select("shard", "value")


def _short_lines(spark: SparkSession, outdir: str, run: str, shard: int) -> DataFrame:
    """The lines of one shard with their place in it."""
    folder = f"{outdir}/data/run={run}/shard={shard:04d}"
    at = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return spark.read.text(folder).select("value", at.alias("at"))


def append_shards(
    df: DataFrame,
    outdir: str,
    shard_size: int = SHARD_ROWS,
    order_by: str | Sequence[str] = "id",
    line: Column | None = None,
    fill: bool = True,
) -> int:
    """Add rows to a shard set, or begin one; returns the version committed.

    Rows get positions behind all rows there are, in the order of ``order_by`` among
    themselves. Every shard but the last has exactly ``shard_size`` rows (with
    ``fill=False``: every shard but the last of each append). Without new rows no version
    is made. A set keeps the shard size it began with; another one is an error.
    """
    spark = df.sparkSession
    known = versions(spark, outdir)
    latest = max(known, default=0)
    held = manifest(spark, outdir).drop("file_name")
    size = held.agg(F.max("shard_size")).first()[0]
    if size is not None and size != shard_size:
        raise ValueError(f"{outdir} has shards of {size} rows, not {shard_size}")
    last = held.orderBy(F.desc("shard")).first()
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    keys = [f"key_{i}" for i in range(len(order))]
    body = line if line is not None else json_line(df)
    lines = df.select(*[F.col(c).alias(k) for c, k in zip(order, keys)], body.alias("value"))
    if not lines.take(1):
        return latest
    first = 0 if last is None else last.shard + 1
    run = uuid.uuid4().hex
    if fill and last is not None and last.n < shard_size:
        first = last.shard
        none = [F.lit(None).cast(t).alias(k) for k, t in lines.select(*keys).dtypes]
        old = _short_lines(spark, outdir, last.run, last.shard).select("at", *none, "value")
        # Structs without a value come last in this order; the old lines have one.
        new = lines.select(F.lit(None).cast(old.schema["at"].dataType).alias("at"), *keys, "value")
        lines = old.unionByName(new).withColumn("fresh", F.col("at").isNull())
        keys = ["fresh", "at", *keys]
    rows = assign_shards(lines, shard_size, keys).withColumn("shard", F.col("shard") + F.lit(first))
    (
        rows.select("idx", F.format_string("%04d", "shard").alias("shard"), "value")
        .sortWithinPartitions("shard", "idx")
        .select("shard", "value")
        .write.mode("errorifexists")
        .partitionBy("shard")
        .text(f"{outdir}/data/run={run}")
    )
    written = spark.read.schema("value STRING, shard BIGINT").text(f"{outdir}/data/run={run}")
    made = written.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    made = made.select("shard", F.lit(run).alias("run"), "n", F.lit(shard_size).cast("bigint").alias("shard_size"))
    kept = held.where(F.col("shard") < first)
    # One narrow row per shard.
    kept.unionByName(made).coalesce(1).write.mode("errorifexists").parquet(f"{outdir}/manifests/{run}")
    try:
        _commit(spark, outdir, latest + 1, run)
    except PySparkException as error:  # pragma: no cover - the file system's own refusal
        raise VersionTaken(f"version {latest + 1} of {outdir} could not be committed") from error
    return latest + 1
