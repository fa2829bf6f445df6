"""Dataset rules as counts per note.

Checks work on the entity array inside the row. Exploding would copy the note
once per entity; counting in place keeps every check a narrow map.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.fixed_values import (
    ASSERTIONS,
    CONTEXT_WORDS,
    ENTITY_TYPES,
    NOTE_LENGTH_TOLERANCE_PERCENT,
)
from chatloom.functions.jsonfmt import variant_list
from chatloom.functions.text import estimate_length, let, word_count
from chatloom.operators.indexing import refuse_reserved
from chatloom.operators.shaping import explode_rows
from chatloom.schemas import ENTITY_FIELDS

ITEM_KEYS = ("text", "entities")


def count_entities(test: Callable[[Column], Column], entities: str = "entities") -> Column:
    """Number of entities a test holds for."""
    return F.size(F.filter(entities, test)).cast("bigint")


def _n_entities(entities: str = "entities") -> Column:
    return F.size(entities).cast("bigint")


def _missing(value: Column) -> Column:
    return F.coalesce(value, F.lit("")) == ""


def _fails(test: Column) -> Column:
    """A test on a missing value counts as failed."""
    return F.coalesce(test, F.lit(True))


def _absent(field: str, text: str) -> tuple[Column, Column]:
    """Entities whose ``field`` is not in the note: exact, and ignoring case.

    An empty or missing field is in no note.
    """
    exact = count_entities(
        lambda e: _missing(e[field]) | _fails(~F.contains(F.col(text), e[field]))
    )
    nocase = let(
        F.lower(text),
        lambda low: count_entities(
            lambda e: _missing(e[field]) | _fails(~F.contains(low, F.lower(e[field])))
        ),
    )
    return exact, nocase


def check_enums(df: DataFrame) -> DataFrame:
    """Entities with a type or assertion outside the label sets, missing ones included."""
    refuse_reserved(df, "n_entities", "n_bad_type", "n_bad_assertion", "n_missing")
    return (
        df.withColumn("n_entities", _n_entities())
        .withColumn("n_bad_type", count_entities(lambda e: _fails(~e["type"].isin(*ENTITY_TYPES))))
        .withColumn(
            "n_bad_assertion", count_entities(lambda e: _fails(~e["assertion"].isin(*ASSERTIONS)))
        )
        .withColumn(
            "n_missing", count_entities(lambda e: _missing(e["type"]) | _missing(e["assertion"]))
        )
    )


def check_extra_keys(parsed: DataFrame) -> DataFrame:
    """Keys outside the record shape, per accepted response.

    Adds ``n_items_extra``, ``n_entities_extra`` and the names in ``extra_keys``.
    """
    refuse_reserved(parsed, "n_items_extra", "n_entities_extra", "extra_keys")

    def surplus(v: Column, allowed: tuple[str, ...]) -> Column:
        keys = F.map_keys(F.try_variant_get(v, "$", "map<string, variant>"))
        found = F.array_except(keys, F.array(*[F.lit(k) for k in allowed]))
        return F.coalesce(found, F.array().cast("array<string>"))

    none = F.array().cast("array<variant>")
    per_item = F.transform("items", lambda i: surplus(i, ITEM_KEYS))
    entities = F.flatten(
        F.transform("items", lambda i: F.coalesce(variant_list(i, "$.entities"), none))
    )
    per_entity = F.transform(entities, lambda e: surplus(e, ENTITY_FIELDS))

    def some(lists: str) -> Column:
        return F.size(F.filter(lists, lambda k: F.size(k) > 0)).cast("bigint")

    names = F.array_distinct(F.flatten(F.concat("__cl_items", "__cl_entities")))
    return (
        parsed.where(F.col("status") == "ok")
        .withColumn("__cl_items", per_item)
        .withColumn("__cl_entities", per_entity)
        .withColumn("n_items_extra", some("__cl_items"))
        .withColumn("n_entities_extra", some("__cl_entities"))
        .withColumn("extra_keys", F.array_sort(names))
        .drop("__cl_items", "__cl_entities")
    )


def check_grounding(df: DataFrame, text: str = "text") -> DataFrame:
    """Mentions that do not occur in their note; ``n_missing`` of them are empty."""
    refuse_reserved(df, "n_entities", "n_ungrounded", "n_ungrounded_nocase", "n_missing")
    exact, nocase = _absent("mention", text)
    return (
        df.withColumn("n_entities", _n_entities())
        .withColumn("n_ungrounded", exact)
        .withColumn("n_ungrounded_nocase", nocase)
        .withColumn("n_missing", count_entities(lambda e: _missing(e["mention"])))
    )


def check_context_copied(df: DataFrame, text: str = "text") -> DataFrame:
    """Context windows that are not copied from their note; ``n_missing`` are empty."""
    refuse_reserved(df, "n_entities", "n_not_copied", "n_not_copied_nocase", "n_missing")
    exact, nocase = _absent("context_window", text)
    return (
        df.withColumn("n_entities", _n_entities())
        .withColumn("n_not_copied", exact)
        .withColumn("n_not_copied_nocase", nocase)
        .withColumn("n_missing", count_entities(lambda e: _missing(e["context_window"])))
    )


def check_context_shape(df: DataFrame) -> DataFrame:
    """Context windows of the wrong size, or without their mention.

    A missing window fails both tests, an empty or missing mention the second.
    """
    refuse_reserved(df, "n_entities", "n_bad_size", "n_without_mention")
    low, high = CONTEXT_WORDS
    return (
        df.withColumn("n_entities", _n_entities())
        .withColumn(
            "n_bad_size",
            count_entities(lambda e: _fails(~word_count(e["context_window"]).between(low, high))),
        )
        .withColumn(
            "n_without_mention",
            count_entities(
                lambda e: _missing(e["mention"])
                | _fails(~F.contains(F.lower(e["context_window"]), F.lower(e["mention"])))
            ),
        )
    )


def check_note_length(
    df: DataFrame,
    target: int,
    text: str = "text",
    est: str = "words",
    tolerance: int = NOTE_LENGTH_TOLERANCE_PERCENT,
) -> DataFrame:
    """Estimated length and whether it is within the tolerance of the target."""
    refuse_reserved(df, "n_words", "in_range")
    low, high = (100 - tolerance) * target, (100 + tolerance) * target
    return df.withColumn("n_words", estimate_length(text, est)).withColumn(
        "in_range", (F.col("n_words") * 100).between(low, high)
    )


def label_balance(df: DataFrame, entities: str = "entities") -> DataFrame:
    """Entities per type and assertion with subtotals, and their shares.

    Pairs are counted first, so the rollup runs over the few distinct pairs. A
    null label with ``level`` above 0 is a subtotal.
    """
    pairs = explode_rows(df, array=entities, pos="__cl_pos", item="__cl_e").select("__cl_e.type", "__cl_e.assertion")
    counts = pairs.groupBy("type", "assertion").agg(F.count(F.lit(1)).alias("c"))
    total = counts.agg(F.sum("c").alias("n")).scalar()
    return (
        counts.rollup("type", "assertion")
        .agg(F.sum("c").alias("n"), F.grouping_id().cast("bigint").alias("level"))
        .withColumn("share", F.col("n").cast("double") / total.cast("double"))
    )


def batch_label_coverage(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Whether each batch holds some negated and some possible entity."""

    def some(label: str) -> Column:
        return F.coalesce(F.max(F.exists("entities", lambda e: e["assertion"] == label)), F.lit(False))

    return df.groupBy(batch).agg(
        F.count(F.lit(1)).alias("n_notes"),
        some("Negated").alias("has_negated"),
        some("Possible").alias("has_possible"),
    )
