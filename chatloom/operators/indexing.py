"""Exact positions, cut-offs and running sums without a single-task stage.

``row_number() over (order by k)`` moves all rows into one task. Here rows get a
coarse ``bucket`` that respects the order, the buckets are counted (map-side
combined, narrow columns only), and the exact position is the bucket's offset
plus the position inside it. Buckets never depend on how the input happens to be
partitioned, so a lost executor recomputes the same positions.

``order_by`` has to identify rows (an id, or a key followed by an id).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.keys import hash_bucket

RANGE_BUCKETS = 32768
BUCKET_ROWS = 1_000_000
MAX_BOUNDS = 2**24 - 1

# Adds a ``__cl_bucket`` column that never decreases along the order. All working
# columns here begin with ``__cl_``, a prefix no table may use itself.
Bucketing = Callable[[DataFrame], DataFrame]


def order_struct(order_by: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order_by])


def order_value(order_by: Sequence[str]) -> Column:
    """What bounds are compared with: the plain column where there is just one."""
    return F.col(order_by[0]) if len(order_by) == 1 else order_struct(order_by)


def with_count_up_to(
    df: DataFrame, bounds: Column, order_by: Sequence[str], out: str
) -> DataFrame:
    """Add how many of the sorted ``bounds`` (at most ``MAX_BOUNDS``) are at or before the row.

    A binary search with as many steps as the number of bounds has digits. ``bounds`` is a scalar subquery, which may not
    be written inside a lambda; as a column referenced once it is merged back
    into the search and never copied into the rows. (Chained columns would be
    compiled, but into a method too long for the JIT.)
    """
    key = order_value(order_by)
    steps = F.filter(
        F.array(*[F.lit(2**i) for i in range(23, -1, -1)]),
        lambda step: step <= F.size(F.col("__cl_bounds")),
    )
    found = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: at
        + F.when(F.get(F.col("__cl_bounds"), at + step - 1) <= key, step).otherwise(0),
    )
    # Never null, so that a join on it needs no null test that repeats the search.
    found = F.coalesce(found.cast("bigint"), F.lit(0).cast("bigint"))
    return df.withColumn("__cl_bounds", bounds).withColumn(out, found).drop("__cl_bounds")


def range_buckets(
    df: DataFrame, order_by: Sequence[str], buckets: int = RANGE_BUCKETS
) -> Bucketing:
    """Buckets that grow with ``order_by``, of any orderable type.

    Bounds are about ``buckets`` distinct keys picked by hash, more where a bucket
    would pass ``BUCKET_ROWS`` rows, so they follow the data's distribution and
    size; a leading column with a hot value is split by the columns after it. Any
    bounds give exact positions, only balance varies.
    """
    # Missing values come first in the order and so belong to the first bucket.
    keys = df.select(order_value(order_by).alias("k")).where(F.col("k").isNotNull())
    stride = keys.agg(
        F.greatest(
            F.lit(1).cast("bigint"),
            F.least(
                (F.count(F.lit(1)) / F.lit(buckets)).cast("bigint"),
                F.lit(BUCKET_ROWS).cast("bigint"),
            ),
        ).alias("m")
    ).scalar()
    picked = keys.where(F.pmod(F.xxhash64("k"), stride) == 0).groupBy("k").agg(F.lit(1))
    bounds = picked.agg(F.array_sort(F.collect_list("k")).alias("b")).scalar()
    return lambda rows: with_count_up_to(rows, bounds, order_by, "__cl_bucket")


def key_buckets(key: str = "__cl_key") -> Bucketing:
    """Buckets from the leading hex digits of a hash key: equal by construction."""
    return lambda rows: rows.withColumn("__cl_bucket", hash_bucket(key))


def value_buckets(column: str, width: int) -> Bucketing:
    """Buckets of ``width`` consecutive integer values.

    Their number grows with the values, so they are for sums inside groups only.
    """

    def bucketing(rows: DataFrame) -> DataFrame:
        return rows.withColumn("__cl_bucket", F.floor(F.col(column) / F.lit(width)).cast("bigint"))

    bucketing.unbounded = True
    return bucketing


def refuse_reserved(df: DataFrame, *added: str) -> None:
    """An error if the table has columns that would be overwritten or are reserved."""
    taken = [c for c in df.columns if c.lower().startswith("__cl_") or c.lower() in {a.lower() for a in added}]
    if taken:
        raise ValueError(f"the table already has columns {taken}")


def _same_group(by: Sequence[str]) -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(f"__cl_by_{c}")) for c in by]


def bucket_totals(
    df: DataFrame, bucketing: Bucketing, by: Sequence[str] = (), value: Column | None = None
) -> DataFrame:
    """Per group and bucket: total and exclusive running offset.

    Without groups the window sees one row per bucket, a number fixed by the
    bucketing and not by the data.
    """
    if not by and getattr(bucketing, "unbounded", False):
        raise ValueError("buckets of values grow with the data; give groups to sum in")
    if value is None:
        value = F.lit(1)
    totals = (
        bucketing(df.withColumn("__cl_value", value))
        .groupBy(*by, "__cl_bucket")
        .agg(F.sum("__cl_value").alias("__cl_total"))
    )
    w = Window.partitionBy(*by).orderBy("__cl_bucket")
    before = F.sum("__cl_total").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return totals.select(
        *[F.col(c).alias(f"__cl_by_{c}") for c in by],
        F.col("__cl_bucket").alias("__cl_b"),
        "__cl_total",
        F.coalesce(before, F.lit(0)).alias("__cl_offset"),
        F.lead("__cl_total").over(w).isNull().alias("__cl_last"),
    )


def running_total(
    df: DataFrame,
    order_by: Sequence[str],
    bucketing: Bucketing,
    out: str,
    by: Sequence[str] = (),
    value: Column | None = None,
) -> DataFrame:
    """Inclusive running sum of ``value`` (of 1 when not given) in exact order."""
    if out in df.columns:
        raise ValueError(f"the table already has a column {out}")
    totals = bucket_totals(df, bucketing, by, value)
    if not by:
        totals = F.broadcast(totals)
    joined = bucketing(df).join(totals, [*_same_group(by), F.col("__cl_bucket") == F.col("__cl_b")])
    w = Window.partitionBy(*by, "__cl_bucket").orderBy(*order_by)
    inside = (
        F.row_number().over(w)
        if value is None
        else F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    return joined.withColumn(out, (F.col("__cl_offset") + inside).cast("bigint")).drop(
        "__cl_bucket", "__cl_b", "__cl_total", "__cl_offset", "__cl_last", *[f"__cl_by_{c}" for c in by]
    )


def global_index(
    df: DataFrame,
    order_by: Sequence[str],
    bucketing: Bucketing | None = None,
    out: str = "idx",
) -> DataFrame:
    """Add the 0-based position of every row: one wide shuffle, no global sort."""
    bucketing = bucketing or range_buckets(df, order_by)
    return running_total(df, order_by, bucketing, out).withColumn(out, F.col(out) - 1)


def with_blocks(
    df: DataFrame, order_by: Sequence[str], block_rows: Column, out: str = "__cl_block"
) -> DataFrame:
    """Add the number of the block of ``block_rows`` consecutive rows a row is in.

    Only the order columns are indexed to find the blocks' first rows; the wide
    rows are looked up against those, without a shuffle. Rows that tie across a
    block's border are an error, since no border could keep the blocks' sizes.
    """
    positions = global_index(df.select(*order_by), order_by, out="__cl_pos")
    place = F.pmod(F.col("__cl_pos"), block_rows)
    # The first and the last row of every block, in order.
    edges = positions.where((place == 0) | (place == block_rows - 1)).select(
        F.struct(
            F.col("__cl_pos").alias("pos"), (place == 0).alias("first"), order_value(order_by).alias("key")
        ).alias("e")
    )
    sorted_edges = edges.agg(F.array_sort(F.collect_list("e")).alias("e"))

    def split_tie(e: Column, i: Column) -> Column:
        before = F.get(F.col("e"), i - 1)
        return e["first"] & (before["pos"] == e["pos"] - 1) & (before["key"] == e["key"])

    tied = F.exists(
        F.transform("e", lambda e, i: F.coalesce(split_tie(e, i), F.lit(False))), lambda t: t
    )
    keys = F.transform(F.filter("e", lambda e: e["first"]), lambda e: e["key"])
    stop = F.raise_error(F.lit("order_by does not identify the rows at a block's border"))
    starts = sorted_edges.select(F.when(~tied, keys).otherwise(stop).alias("starts"))
    found = with_count_up_to(df, starts.scalar(), order_by, out)
    return found.withColumn(out, F.col(out) - 1)


def rank_cutoff(
    df: DataFrame,
    n: int | Column,
    order_by: Sequence[str],
    bucketing: Bucketing | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """The order key of the n-th row (of the last row, when there are fewer).

    One row per group, ``(by..., cutoff)``; none where nothing qualifies. Two
    passes over narrow columns: bucket counts, then the one bucket per group the
    cut falls into, collapsed by key before it is shuffled. Keys that tie across
    the cut are an error, since no cut-off could keep exactly ``n`` rows.
    """
    bucketing = bucketing or range_buckets(df, order_by)
    n = F.lit(n) if isinstance(n, int) else n
    edge = bucket_totals(df, bucketing, by).where(
        (F.col("__cl_offset") < n) & ((n <= F.col("__cl_offset") + F.col("__cl_total")) | F.col("__cl_last"))
    )
    edge = edge.select(
        *[f"__cl_by_{c}" for c in by],
        "__cl_b",
        F.least(n - F.col("__cl_offset"), F.col("__cl_total")).alias("__cl_want"),
    )
    # One row per group: proven small only without groups.
    small = edge if by else F.broadcast(edge)
    hits = (
        bucketing(df)
        .select(*by, order_struct(order_by).alias("__cl_k"), "__cl_bucket")
        .join(small, [*_same_group(by), F.col("__cl_bucket") == F.col("__cl_b")])
        .groupBy(*by, "__cl_k", "__cl_want")
        .agg(F.count(F.lit(1)).alias("__cl_n"))
    )
    w = Window.partitionBy(*by, "__cl_want").orderBy("__cl_k")
    upto = F.sum("__cl_n").over(w.rowsBetween(Window.unboundedPreceding, 0))
    ranked = hits.withColumn("__cl_upto", upto).where(
        (F.col("__cl_upto") >= F.col("__cl_want")) & (F.col("__cl_upto") - F.col("__cl_n") < F.col("__cl_want"))
    )
    tie = F.raise_error(F.lit("order_by does not identify the rows at the cut")).cast("boolean")
    exact = F.when(F.col("__cl_upto") > F.col("__cl_want"), tie).otherwise(F.lit(True))
    return ranked.where(exact).select(*by, F.col("__cl_k").alias("cutoff"))


def first_rows(
    df: DataFrame,
    n: int | Column,
    order_by: Sequence[str],
    bucketing: Bucketing | None = None,
) -> DataFrame:
    """Exactly the first ``n`` rows in order; wide rows are filtered, not shuffled.

    With a single order column the test is a plain comparison, which reaches the
    file scan and skips row groups beyond the cut.
    """
    if isinstance(n, int) and n <= 0:
        return df.where(F.lit(False))
    cutoff = rank_cutoff(df, n, order_by, bucketing)
    if len(order_by) == 1 and isinstance(n, int):
        lead = F.col(order_by[0])
        last = cutoff.select(F.col("cutoff")[order_by[0]].alias("last")).scalar()
        return df.where(lead.isNull() | (lead <= last))
    return df.where(order_struct(order_by) <= cutoff.select("cutoff").scalar())


def first_rows_per_group(
    df: DataFrame,
    n: int,
    by: Sequence[str],
    order_by: Sequence[str],
    bucketing: Bucketing | None = None,
) -> DataFrame:
    """Exactly the first ``n`` rows of every group.

    The cut-off table has one row per group; the adaptive planner sees its real
    size and broadcasts it or splits hot groups.
    """
    cuts = rank_cutoff(df, n, order_by, bucketing, by)
    cuts = cuts.select(*[F.col(c).alias(f"__cl_by_{c}") for c in by], F.col("cutoff").alias("__cl_cut"))
    joined = df.join(cuts, _same_group(by))
    return joined.where(order_struct(order_by) <= F.col("__cl_cut")).select(*df.columns)
