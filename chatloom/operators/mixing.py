"""Slices, caps, exact samples, mixes, shuffles and splits.

Random choices order rows by ``md5(seed:source:id)``: repeatable, independent of
partitioning, exact in size. ``id`` has to be unique within ``source``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.fixed_values import ROWS_PER_SOURCE
from chatloom.functions.keys import hash_fraction, order_key
from chatloom.operators.indexing import (
    first_rows,
    first_rows_per_group,
    global_index,
    key_buckets,
    order_struct,
    rank_cutoff,
    refuse_reserved,
)


def _cols(order_by: str | Sequence[str]) -> list[str]:
    return [order_by] if isinstance(order_by, str) else list(order_by)


def head_slice(df: DataFrame, n: int, order_by: str | Sequence[str]) -> DataFrame:
    """The first ``n`` rows in the order given; a larger ``n`` keeps all rows."""
    return first_rows(df, n, _cols(order_by))


def cap_per_source(
    df: DataFrame,
    n: int = ROWS_PER_SOURCE,
    source: str = "source",
    order_by: str | Sequence[str] = "id",
) -> DataFrame:
    """At most the first ``n`` rows of every source."""
    return first_rows_per_group(df, n, [source], _cols(order_by))


def mix(parts: dict[str, DataFrame], source: str = "source") -> DataFrame:
    """Bag union of the parts, duplicates kept, each row tagged with its part.

    Parts that already have a column of the tag's name are refused; name another.
    """
    for df in parts.values():
        refuse_reserved(df, source)
    tagged = [df.withColumn(source, F.lit(name)) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, tagged)


def _keyed(df: DataFrame, seed: int | str, id: str, source: Column | str) -> DataFrame:
    refuse_reserved(df)
    return df.withColumn("__cl_key", order_key(seed, id, source))


def sample_exact(
    df: DataFrame, n: int | Column, seed: int | str, id: str = "id", source: Column | str = ""
) -> DataFrame:
    """Exactly ``n`` rows without replacement."""
    keyed = _keyed(df, seed, id, source)
    return first_rows(keyed, n, ["__cl_key", id], key_buckets()).drop("__cl_key")


def sample_to_share(
    base: DataFrame,
    pool: DataFrame,
    share: float,
    seed: int | str,
    id: str = "id",
    source: Column | str = "",
) -> DataFrame:
    """The part of ``pool`` that makes up ``share`` of a mix with ``base``.

    The size is ``int(len(base) * share / (1 - share))``. A pool that is too
    small is an error, as there is no replacement.
    """
    if not 0 <= share < 1:
        raise ValueError("share has to be in [0, 1)")
    ratio = F.lit(share / (1 - share))
    wanted = (F.count(F.lit(1)).cast("double") * ratio).cast("bigint")
    available = pool.agg(F.count(F.lit(1)).alias("n")).scalar()
    short = F.raise_error(F.lit("the pool holds fewer rows than the share asks for"))
    size = base.agg(wanted.alias("n")).select(
        F.when(F.col("n") > available, short.cast("bigint")).otherwise(F.col("n")).alias("n")
    )
    return sample_exact(pool, size.scalar(), seed, id, source)


def shuffle(
    df: DataFrame,
    seed: int | str,
    id: str = "id",
    source: Column | str = "",
    out: str = "pos",
) -> DataFrame:
    """Seeded full shuffle: adds the 0-based position ``pos`` of every row.

    Rows are keyed by source and id; position buckets are leading hex digits of
    the key, so they are equal in size whatever the data looks like.
    """
    refuse_reserved(df, out)
    keyed = _keyed(df, seed, id, source)
    order = ["__cl_key", id]
    if isinstance(source, Column):
        keyed = keyed.withColumn("__cl_source", source)
        order = ["__cl_key", "__cl_source", id]
    return global_index(keyed, order, key_buckets(), out).drop("__cl_key", "__cl_source")


def split_train_eval(
    df: DataFrame,
    eval_fraction: float = 0.1,
    seed: int | str = 42,
    id: str = "id",
    out: str = "split",
) -> DataFrame:
    """Tag ``ceil(n * eval_fraction)`` rows ``eval`` and the rest ``train``.

    Wide rows are only tagged, never shuffled.
    """
    refuse_reserved(df, out)
    keyed = _keyed(df, seed, id, "")
    size = df.agg(
        F.ceil(F.count(F.lit(1)).cast("double") * F.lit(float(eval_fraction))).alias("n")
    ).scalar()
    order = ["__cl_key", id]
    cutoff = rank_cutoff(keyed, size, order, key_buckets())
    held_out = F.coalesce(order_struct(order) <= cutoff.select("cutoff").scalar(), F.lit(False))
    return keyed.withColumn(out, F.when(held_out, "eval").otherwise("train")).drop("__cl_key")


def split_by_hash(
    df: DataFrame,
    eval_fraction: float = 0.1,
    seed: int | str = 42,
    id: str = "id",
    out: str = "split",
) -> DataFrame:
    """Row-local split for streams and growing tables: sizes are approximate,
    and a row keeps its side for good."""
    refuse_reserved(df, out)
    held_out = hash_fraction(order_key(seed, id)) < F.lit(float(eval_fraction))
    return df.withColumn(out, F.when(held_out, "eval").otherwise("train"))


def mix_report(df: DataFrame, source: str = "source") -> DataFrame:
    """Rows per part and achieved share."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        df.groupBy(source)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("share", F.col("n").cast("double") / total.cast("double"))
    )
