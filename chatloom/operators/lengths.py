"""Length estimates, truncation and packing. Lengths are estimates, not tokens."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.fixed_values import SEQUENCE_LIMIT
from chatloom.functions.keys import hash_bucket, order_key
from chatloom.functions.text import estimate_length, first_words, word_count
from chatloom.operators.indexing import refuse_reserved

Estimate = str | Callable[[Column], Column]


def length_stats(
    df: DataFrame,
    *by: str,
    column: str = "text",
    est: Estimate = "words",
    limit: int = SEQUENCE_LIMIT,
) -> DataFrame:
    """Estimated length per group: ``n, min_len, max_len, sum_len, n_over``."""
    lengths = df.select(*by, estimate_length(column, est).alias("__cl_len"))
    return lengths.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("__cl_len").alias("min_len"),
        F.max("__cl_len").alias("max_len"),
        F.sum("__cl_len").alias("sum_len"),
        F.count_if(F.col("__cl_len") > limit).alias("n_over"),
    )


def length_quantiles(
    df: DataFrame,
    *by: str,
    shares: Sequence[float] = (0.5, 0.9, 0.99),
    column: str = "text",
    est: Estimate = "words",
) -> DataFrame:
    """``(*by, share, n, len)``: the exact length at each share of a group's rows.

    It is the least length that at least ``share`` of the rows do not exceed; null texts
    have length 0. Rows become counts per length before the shuffle, so what is sorted
    grows with the number of different lengths and not with the rows.
    """
    refuse_reserved(df.select(*by), "share", "n", "len")
    counts = df.select(*by, estimate_length(column, est).alias("__cl_len")).groupBy(*by, "__cl_len")
    counts = counts.agg(F.count(F.lit(1)).alias("__cl_rows"))
    # Without groups one constant stands in; its rows are as few as there are lengths.
    groups = [F.col(c) for c in by] or [F.lit(0)]
    in_order = Window.partitionBy(*groups).orderBy("__cl_len")
    first, last = Window.unboundedPreceding, Window.unboundedFollowing
    upto = counts.withColumn("__cl_upto", F.sum("__cl_rows").over(in_order.rowsBetween(first, Window.currentRow)))
    upto = upto.withColumn("n", F.sum("__cl_rows").over(in_order.rowsBetween(first, last)))
    asked = F.array(*[F.lit(float(s)) for s in shares])
    wanted = upto.withColumn("share", F.explode(asked))
    place = F.greatest(F.ceil(F.col("share") * F.col("n")), F.lit(1))
    reached = (F.col("__cl_upto") >= place) & (F.col("__cl_upto") - F.col("__cl_rows") < place)
    return wanted.where(reached).select(*by, "share", "n", F.col("__cl_len").alias("len"))


def sketch_rank_error(k: int) -> float:
    """Rank error of a sketch of size ``k`` as a share of the rows, at 99 % confidence."""
    return 2.296 / k**0.9021


def length_sketches(
    df: DataFrame, *by: str, column: str = "text", est: Estimate = "words", k: int = 800
) -> DataFrame:
    """``(*by, n, sketch)``: a mergeable sketch of each group's lengths, of a few kB.

    For tables that grow: sketch every new part once, keep the sketches, and put them
    together with :func:`merge_length_sketches`. Null texts have length 0.
    """
    refuse_reserved(df.select(*by), "n", "sketch")
    lengths = df.select(*by, estimate_length(column, est).alias("__cl_len"))
    return lengths.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint("__cl_len", F.lit(k)).alias("sketch")
    )


def merge_length_sketches(sketches: DataFrame, *by: str, k: int = 800) -> DataFrame:
    """Sketches of parts as one per group; merging does not add to the rank error."""
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch")
    )


def sketched_quantiles(
    sketches: DataFrame, *by: str, shares: Sequence[float] = (0.5, 0.9, 0.99)
) -> DataFrame:
    """``(*by, share, n, len)`` like :func:`length_quantiles`, from sketches: the rank of
    ``len`` is off by no more than :func:`sketch_rank_error` of the rows, in 99 of 100 cases."""
    at = lambda s: F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(s)))
    found = [F.struct(F.lit(float(s)).alias("share"), at(s).alias("len")) for s in shares]
    rows = sketches.where(F.col("n") > 0).select(*by, "n", F.explode(F.array(*found)).alias("__cl_q"))
    return rows.select(*by, "__cl_q.share", "n", "__cl_q.len")


def truncate(
    df: DataFrame, column: str = "text", limit: int = SEQUENCE_LIMIT, est: str = "words"
) -> DataFrame:
    """Cut texts whose estimate exceeds ``limit``; adds ``was_truncated``.

    ``words`` cuts after the limit-th word and leaves inner whitespace alone;
    ``chars4`` cuts after ``4 * limit`` characters.
    """
    refuse_reserved(df, "was_truncated")
    text = F.col(column)
    if est == "words":
        over, cut = word_count(text) > limit, first_words(text, limit)
    elif est == "chars4":
        over, cut = F.length(text) > 4 * limit, F.substring(text, 1, 4 * limit)
    else:
        raise ValueError("est is 'words' or 'chars4'")
    over = F.coalesce(over, F.lit(False))
    return df.withColumn("was_truncated", over).withColumn(
        column, F.when(F.col("was_truncated"), cut).otherwise(text)
    )


def _bucket_count(df: DataFrame, length: Column, room: int, n_buckets: int | None) -> Column:
    """Buckets of about ``room`` each, or as many as given."""
    if n_buckets is not None:
        return F.lit(n_buckets).cast("bigint")
    wanted = F.ceil(F.coalesce(F.sum(length), F.lit(0)) / F.lit(float(room)))
    return df.agg(F.greatest(F.lit(1), wanted).cast("bigint").alias("n")).scalar()


def pack(
    df: DataFrame,
    len_col: str,
    budget: int = SEQUENCE_LIMIT,
    n_buckets: int | None = None,
    seed: int | str = 0,
    id: str = "id",
    packs_per_bucket: int = 64,
) -> DataFrame:
    """Assign short examples to shared sequences: adds ``bucket`` and ``pack``.

    Examples are laid end to end in hash order inside a bucket, and a pack is
    the stretch that starts within one budget. A pack may exceed the budget by
    its last example. Unless given, the number of buckets follows the total
    length, so a bucket stays the same size whatever the data volume.
    """
    refuse_reserved(df, "bucket", "pack")
    key = order_key(seed, id)
    count = _bucket_count(df, F.col(len_col), budget * packs_per_bucket, n_buckets)
    w = (
        Window.partitionBy("bucket")
        .orderBy("__cl_key", id)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    start = F.sum(len_col).over(w) - F.col(len_col)
    return (
        df.withColumn("__cl_key", key)
        .withColumn("bucket", F.pmod(hash_bucket("__cl_key", 8), count))
        .withColumn("pack", F.floor(start / F.lit(float(budget))).cast("bigint"))
        .drop("__cl_key")
    )


def count_up_to(sorted_values: Column, limit: Column, most: int = 31) -> Column:
    """How many values of a sorted array are at most ``limit``, by binary search."""
    steps = F.filter(
        F.array(*[F.lit(2**i) for i in range(most - 1, -1, -1)]), lambda step: step <= F.size(sorted_values)
    )
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: at + F.when(F.get(sorted_values, at + step - 1) <= limit, step).otherwise(0),
    )


def pack_within_budget(
    df: DataFrame,
    len_col: str,
    budget: int = SEQUENCE_LIMIT,
    n_buckets: int | None = None,
    seed: int | str = 0,
    id: str = "id",
    packs_per_bucket: int = 64,
    by: Sequence[str] = (),
) -> DataFrame:
    """Like :func:`pack`, but no pack passes the budget: adds ``bucket`` and ``pack``.

    With ``by`` every group of these columns has buckets and packs of its own.

    Examples are taken in hash order inside a bucket, and a pack ends before the example
    that would pass the budget. Only an example that is longer than the budget itself
    makes a longer pack, of its own. A missing length counts as 0.

    No row waits for the pack before it: a bucket's running lengths are put into one
    array, and each pack's first example is found by binary search for the end of the
    one before. Two packs next to each other hold more than one budget, so a bucket has
    at most twice as many packs as its length asks for. A bucket is a fixed number of
    budgets long whatever the data volume (an example counts as one at least), so the
    array does not grow with the table; the wide rows are shuffled once, by bucket.
    """
    refuse_reserved(df, "bucket", "pack")
    length = F.coalesce(F.col(len_col), F.lit(0)).cast("bigint")
    keyed = df.withColumn("__cl_key", order_key(seed, id)).withColumn("__cl_len", length)
    same = [F.col(c).eqNullSafe(F.col(f"__cl_by_{c}")) for c in by]
    groups = [F.col(c).alias(f"__cl_by_{c}") for c in by]
    if by:
        # One row per group; the adaptive planner sees how many there are.
        wanted = F.ceil(F.sum(F.greatest("__cl_len", F.lit(1))) / F.lit(float(budget * packs_per_bucket)))
        wanted = wanted if n_buckets is None else F.lit(n_buckets)
        counts = keyed.groupBy(*groups).agg(F.greatest(F.lit(1), wanted).cast("bigint").alias("__cl_count"))
        keyed = keyed.join(counts, same).drop(*(f"__cl_by_{c}" for c in by))
    else:
        count = _bucket_count(df, F.greatest(length, F.lit(1)), budget * packs_per_bucket, n_buckets)
        keyed = keyed.withColumn("__cl_count", count)
    keyed = keyed.withColumn("bucket", F.pmod(hash_bucket("__cl_key", 8), "__cl_count")).drop("__cl_count")
    order = Window.partitionBy(*by, "bucket").orderBy("__cl_key", id)
    upto = F.sum("__cl_len").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    narrow = keyed.select(*by, "bucket", "__cl_key", id, "__cl_len").withColumn("__cl_end", upto)
    ends = narrow.groupBy(*groups, "bucket").agg(F.array_sort(F.collect_list("__cl_end")).alias("ends"))

    def next_first(firsts: Column, _: Column) -> Column:
        """Adds the first example after the last pack, if there is one."""
        at = F.element_at(firsts, F.lit(-1))
        before = F.when(at > 0, F.get("ends", at - 1)).otherwise(0)
        after = F.greatest(at + 1, count_up_to(F.col("ends"), before + budget))
        return F.when(after < F.size("ends"), F.concat(firsts, F.array(after))).otherwise(firsts)

    most = (F.lit(2) * F.ceil(F.element_at("ends", F.lit(-1)) / F.lit(float(budget))) + 1).cast("int")
    firsts = F.aggregate(F.sequence(F.lit(1), most), F.array(F.lit(0)), next_first)
    packs = ends.select(
        *(f"__cl_by_{c}" for c in by), F.col("bucket").alias("__cl_bucket"), firsts.alias("__cl_firsts")
    )
    placed = keyed.withColumn("__cl_at", F.row_number().over(order) - 1)
    joined = placed.join(packs, [*same, F.col("bucket") == F.col("__cl_bucket")])
    pack_of = (count_up_to(F.col("__cl_firsts"), F.col("__cl_at")) - 1).cast("bigint")
    return joined.withColumn("pack", pack_of).select(*df.columns, "bucket", "pack")
