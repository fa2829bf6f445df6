"""Exact-size JSONL shards and their manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.fixed_values import SHARD_NAME, SHARD_ROWS
from chatloom.functions.jsonfmt import entity_json, json_list, json_string
from chatloom.operators.indexing import refuse_reserved, with_blocks

# At least this many blocks where there are rows enough, more where a block would
# pass BLOCK_ROWS rows.
BLOCKS = 4096
BLOCK_ROWS = 1_000_000


def annotation_line(text: str = "text", entities: str = "entities") -> Column:
    """One annotation as a JSON line, keys in record order."""
    return F.concat(
        F.lit('{"text": '),
        json_string(text),
        F.lit(', "entities": '),
        json_list(F.transform(entities, entity_json)),
        F.lit("}"),
    )


def json_line(df: DataFrame) -> Column:
    """A row as JSON text: all columns, nulls included."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def assign_shards(
    df: DataFrame, shard_size: int = SHARD_ROWS, order_by: str | Sequence[str] = "id"
) -> DataFrame:
    """Add ``idx`` (0-based position) and ``shard`` (``idx // shard_size``).

    Positions are cut into blocks of whole shards, whose number grows with the
    rows. Block borders come from indexing the order columns alone; the wide rows
    are then shuffled once, by block, into equal parts that each hold complete
    shards. A table with its own ``idx`` or ``shard`` is refused, and so are rows
    that tie across a block's border.
    """
    refuse_reserved(df, "idx", "shard")
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    blocks = F.greatest(F.lit(BLOCKS).cast("bigint"), F.ceil(rows / F.lit(BLOCK_ROWS)))
    per_block = F.greatest(F.lit(1).cast("bigint"), F.ceil(rows / (blocks * F.lit(shard_size))))
    block_rows = (per_block * F.lit(shard_size)).cast("bigint")
    w = Window.partitionBy("__cl_block").orderBy(*order)
    idx = F.col("__cl_block") * block_rows + F.row_number().over(w) - 1
    return (
        with_blocks(df, order, block_rows)
        .withColumn("idx", idx.cast("bigint"))
        .withColumn("shard", F.expr(f"idx div {shard_size}"))
        .drop("__cl_block")
    )


def shard_manifest(
    df: DataFrame, shard_size: int = SHARD_ROWS, order_by: str | Sequence[str] = "id"
) -> DataFrame:
    """Shard number, file name, rows and first and last order value; writes nothing."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    keys = [f"key_{i}" for i in range(len(order))]
    lead = keys[0]
    narrow = df.select(*[F.col(c).alias(k) for c, k in zip(order, keys)])
    return (
        assign_shards(narrow, shard_size, keys)
        .groupBy("shard")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(lead).alias("first"),
            F.max(lead).alias("last"),
        )
        .withColumn("file_name", F.format_string(SHARD_NAME, "shard"))
    )


def write_jsonl_sharded(
    df: DataFrame,
    outdir: str,
    shard_size: int = SHARD_ROWS,
    order_by: str | Sequence[str] = "id",
    mode: str = "overwrite",
    line: Column | None = None,
) -> None:
    """Write shards of exactly ``shard_size`` rows as ``outdir/shard=0000/...``.

    One file per shard, rows in order, non-ASCII as is, no file for empty input.
    ``line`` is the JSON text of a row (see :func:`annotation_line`); by default
    all columns, nulls included. At large volumes choose a ``shard_size`` that
    keeps the number of folders in the tens of thousands. ``mode="append"`` is refused,
    since numbers would begin at 0 again; ``shard_sets.append_shards`` continues them.
    """
    if mode == "append":
        raise ValueError("shards cannot be appended to; use shard_sets.append_shards")
    body = line if line is not None else json_line(df)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    keys = [f"key_{i}" for i in range(len(order))]
    # The line is made before positions are added, so it has the table's own columns.
    lines = df.select(*[F.col(c).alias(k) for c, k in zip(order, keys)], body.alias("value"))
    rows = assign_shards(lines, shard_size, keys)
    (
        rows.select("idx", F.format_string("%04d", "shard").alias("shard"), "value")
        .sortWithinPartitions("shard", "idx")
        .select("shard", "value")
        .write.mode(mode)
        .partitionBy("shard")
        .text(outdir)
    )
