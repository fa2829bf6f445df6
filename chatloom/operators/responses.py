"""Reading generation responses: gates, validation, accounting, retries.

A response row is ``(job_id, batch_id, attempt, raw, expected)``. Nothing raises
on bad data; rows carry a status instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.jsonfmt import parse_json_text, repeated_keys, variant_at, variant_list
from chatloom.functions.text import let, preview
from chatloom.operators.indexing import refuse_reserved
from chatloom.operators.shaping import evaluate_once, explode_rows
from chatloom.schemas import ENTITIES_DDL, ENTITY_FIELDS

REQUIRED_ENTITY_FIELDS = ("mention", "type", "assertion")
BATCHES_PER_BUCKET = 4096


def is_string(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def object_fields(v: Column) -> Column:
    """An object's fields as a map of variants; null for anything else."""
    return F.try_variant_get(v, "$", "map<string, variant>")


def parse_responses(df: DataFrame, raw: str = "raw", expected: str = "expected") -> DataFrame:
    """Add ``status``, ``n_items``, ``count_mismatch`` and ``items``.

    Status: ``not_json``, ``no_items`` (no object, or no such key),
    ``items_not_list``, ``ok``. A wrong number of items is only flagged. Of repeated
    keys the last counts.
    """
    refuse_reserved(df, "status", "n_items", "count_mismatch", "items")
    with repeated_keys(df.sparkSession):
        document = df.withColumn("__cl_doc", parse_json_text(F.col(raw)))
    document = document.withColumn("__cl_items", variant_list(F.col("__cl_doc"), "$.items"))
    object_like = F.col(raw).rlike("^\\s*\\{")
    status = (
        F.when(F.col("__cl_doc").isNull(), "not_json")
        .when(~object_like | variant_at(F.col("__cl_doc"), "$.items").isNull(), "no_items")
        .when(F.col("__cl_items").isNull(), "items_not_list")
        .otherwise("ok")
    )
    parsed = evaluate_once(document, status=status, items=F.col("__cl_items")).drop("__cl_doc", "__cl_items")
    n_items = F.when(F.col("status") == "ok", F.size("items").cast("bigint"))
    mismatch = F.coalesce(F.col("n_items") != F.col(expected), F.lit(False))
    return parsed.withColumn("n_items", n_items).withColumn("count_mismatch", mismatch)


def explode_items(parsed: DataFrame, *ids: str) -> DataFrame:
    """One row per item of an accepted response: ids, ``item_pos``, ``item``."""
    usable = parsed.where(F.col("status") == "ok")
    return explode_rows(usable, *ids, array="items", pos="item_pos", item="item")


def entity_flags(entity: Column) -> Column:
    """What is wrong with one entity: its fields are taken out once and then tested."""

    def flags(fields: Column) -> Column:
        there = fields.isNotNull()
        at = lambda f: F.try_element_at(fields, F.lit(f))
        window = at("context_window")
        return F.struct(
            (~there).alias("entity"),
            *[(there & ~is_string(at(f))).alias(f) for f in REQUIRED_ENTITY_FIELDS],
            (window.isNotNull() & ~is_string(window)).alias("context_window"),
        )

    return let(object_fields(entity), flags)


def item_errors(item: Column, entities: Column) -> Column:
    """Names of the rules an item breaks; empty for a valid one."""

    def named(flags: Column) -> Column:
        def some(f: str) -> Column:
            return F.coalesce(F.exists(flags, lambda e: e[f]), F.lit(False))

        checks = [
            F.when(~is_string(variant_at(item, "$.text")), "text_not_string"),
            F.when(
                entities.isNull() & variant_at(item, "$.entities").isNotNull(), "entities_not_list"
            ),
            F.when(some("entity"), "entity_not_object"),
            *[F.when(some(f), f"{f}_not_string") for f in REQUIRED_ENTITY_FIELDS],
            F.when(some("context_window"), "context_window_not_string"),
        ]
        whole = F.array(F.lit("item_not_object"))
        return F.when(object_fields(item).isNull(), whole).otherwise(
            F.array_compact(F.array(*checks))
        )

    return let(F.transform(entities, entity_flags), named)


def validate_annotations(items: DataFrame, item: str = "item") -> DataFrame:
    """Check items against the record shape; adds ``valid``, ``errors`` and the
    clean ``text`` and ``entities``.

    ``text`` and an entity's mention, type and assertion have to be strings,
    ``context_window`` may be missing, ``entities`` may be missing, unknown keys
    are dropped. One bad item does not stop the others.
    """
    refuse_reserved(items, "errors", "valid", "text", "entities")
    v = F.col(item)

    def clean(e: Column) -> Column:
        return F.struct(
            *[
                F.coalesce(F.try_variant_get(e, f"$.{f}", "string"), F.lit("")).alias(f)
                for f in ENTITY_FIELDS
            ]
        )

    checked = items.withColumn("__cl_entities", variant_list(v, "$.entities"))
    checked = evaluate_once(checked, errors=item_errors(v, F.col("__cl_entities")))
    valid = F.size("errors") == 0
    entities = F.coalesce(F.transform("__cl_entities", clean), F.array().cast(ENTITIES_DDL))
    return (
        checked.withColumn("valid", valid)
        .withColumn("text", F.when(valid, F.try_variant_get(v, "$.text", "string")))
        .withColumn("entities", F.when(valid, entities))
        .drop("__cl_entities")
    )


def count_accepted(parsed: DataFrame, out: str = "accepted") -> DataFrame:
    """Add the number of valid items per response (0 for a rejected one).

    Counted inside the row: no explode, no grouping, no join back.
    """

    refuse_reserved(parsed, out)

    def valid(item: Column) -> Column:
        return let(variant_list(item, "$.entities"), lambda es: F.size(item_errors(item, es)) == 0)

    n = F.size(F.filter("items", valid)).cast("bigint")
    usable = (F.col("status") == "ok") & F.col("items").isNotNull()
    return evaluate_once(parsed, **{out: F.when(usable, n).otherwise(F.lit(0).cast("bigint"))})


def first_usable(
    df: DataFrame,
    job: str = "job_id",
    batch: str = "batch_id",
    attempt: str = "attempt",
    status: str = "status",
    value: str = "accepted",
) -> DataFrame:
    """``(job, batch, accepted)`` of the first usable attempt of every batch.

    Later successes of a batch do not count again, and batches without a usable
    attempt are left out. Attempts combine before the shuffle.
    """
    return (
        df.where(F.col(status) == "ok")
        .groupBy(job, batch)
        .agg(F.min_by(value, attempt).alias(value))
    )


def progress(
    df: DataFrame,
    job: str = "job_id",
    batch: str = "batch_id",
    accepted: str = "accepted",
    total: str = "total",
) -> DataFrame:
    """Accepted so far and items remaining, per job in batch order.

    One row per job and batch is expected (see :func:`first_usable`). Remaining may
    go below zero. The input is read once: counts are gathered per stretch of
    batches, stretches get their offsets in job order, and batches are summed up
    inside their stretch.
    """
    stretch = F.floor(F.col(batch) / F.lit(BATCHES_PER_BUCKET)).cast("bigint")
    rows = df.select(
        job, batch, F.col(accepted).alias("accepted"), F.col(total).alias("total"), stretch.alias("stretch")
    )
    gathered = rows.groupBy(job, "stretch").agg(
        F.collect_list(F.struct(F.col(batch).alias("batch"), "accepted", "total")).alias("rows"),
        F.sum("accepted").alias("sum"),
    )
    earlier = Window.partitionBy(job).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = gathered.withColumn("offset", F.coalesce(F.sum("sum").over(earlier), F.lit(0)))
    inside = Window.partitionBy(job, "stretch").orderBy("r.batch")
    so_far = F.col("offset") + F.sum("r.accepted").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (
        offsets.select(job, "stretch", "offset", F.explode("rows").alias("r"))
        .withColumn("accepted_so_far", so_far.cast("bigint"))
        .select(
            job,
            F.col("r.batch").alias(batch),
            F.col("r.accepted").alias(accepted),
            F.col("r.total").alias(total),
            "accepted_so_far",
            (F.col("r.total") - F.col("accepted_so_far")).alias("remaining"),
        )
    )


def pending_requests(
    requests: DataFrame,
    valid_responses: DataFrame,
    keys: Sequence[str] = ("job_id", "batch_id"),
) -> DataFrame:
    """Requests without a usable response; sent again under the same batch id.

    Responses are reduced to distinct keys first (combined before the shuffle),
    so a request answered very often costs one row.
    """
    done = valid_responses.select(*keys).distinct()
    return requests.join(done, list(keys), "left_anti")


def quarantine(parsed: DataFrame, *ids: str, raw: str = "raw") -> DataFrame:
    """Rejected responses with the reason and the start of the text."""
    return parsed.where(F.col("status") != "ok").select(
        *ids,
        F.col("status").alias("reason"),
        F.length(raw).cast("bigint").alias("raw_chars"),
        preview(raw).alias("raw_preview"),
    )
