"""Irregular annotation lines -> one fixed shape; small projections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.jsonfmt import parse_json_object, parse_json_text
from chatloom.functions.text import as_column, remove_prefix, text_or_empty
from chatloom.operators.shaping import evaluate_once
from chatloom.schemas import ENTITIES_DDL, ENTITY, ENTITY_FIELDS


def entity_struct(raw: Column) -> Column:
    """Four string fields, ``""`` where missing; other keys are left behind."""
    return F.struct(*[F.coalesce(raw[f], F.lit("")).alias(f) for f in ENTITY_FIELDS])


def entity_list(raw: Column | str) -> Column:
    """The raw JSON text of ``entities`` as a typed list.

    A missing or null value is the empty list, a lone object a one-element list.
    Null when the text is neither, or when an element is not an object.
    """
    raw = as_column(raw)
    head = F.substring(raw, 1, 1)
    lone = F.array(F.from_json(raw, ENTITY))
    many = F.from_json(raw, ENTITIES_DDL)
    parsed = F.when(head == "{", lone).when(head == "[", many)
    return F.when(raw.isNull(), F.array().cast(ENTITIES_DDL)).otherwise(
        F.transform(parsed, entity_struct)
    )


def parse_annotation_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Add ``text``, ``entities`` and ``defect`` (null for a usable line).

    Defects: ``not_json``, ``not_object``, ``bad_entities``. Null becomes ``""``
    and other scalars their JSON text (so ``true`` stays ``true``).
    """
    value = F.col(line)
    row = lines.withColumn("__cl_parsed", parse_json_object(value, "text: STRING, entities: STRING"))
    row = row.withColumn("__cl_entities", entity_list(F.col("__cl_parsed.entities")))
    other = F.when(parse_json_text(value).isNull(), "not_json").otherwise("not_object")
    defect = F.when(F.col("__cl_parsed").isNull(), other).when(
        F.col("__cl_entities").isNull(), "bad_entities"
    )
    parsed = evaluate_once(
        row, text=text_or_empty("__cl_parsed.text"), entities=F.col("__cl_entities"), defect=defect
    )
    return parsed.drop("__cl_parsed", "__cl_entities")


def normalize_annotations(
    lines: DataFrame, line: str = "value", bad_lines: str = "fail"
) -> DataFrame:
    """Annotation lines -> ``text STRING, entities ARRAY<STRUCT<...>>``.

    ``bad_lines="fail"`` stops on a malformed line; ``"skip"`` leaves them to
    :func:`malformed_lines`. Other columns of the input are kept.
    """
    parsed = parse_annotation_lines(lines, line)
    if bad_lines == "fail":
        complaint = F.raise_error(
            F.concat(F.lit("malformed annotation line: "), F.col("defect"))
        ).cast("string")
        parsed = parsed.withColumn(
            "text", F.when(F.col("defect").isNotNull(), complaint).otherwise(F.col("text"))
        )
    elif bad_lines == "skip":
        parsed = parsed.where(F.col("defect").isNull())
    else:
        raise ValueError("bad_lines is 'fail' or 'skip'")
    return parsed.drop(line, "defect")


def malformed_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """The lines :func:`normalize_annotations` cannot use, with the defect."""
    parsed = parse_annotation_lines(lines, line)
    return parsed.where(F.col("defect").isNotNull()).drop("text", "entities")


def normalize_records(records: DataFrame) -> DataFrame:
    """Fill defaults on already typed records (``text``, ``entities``)."""
    empty = F.array().cast(ENTITIES_DDL)
    return records.withColumn("text", text_or_empty("text")).withColumn(
        "entities", F.coalesce(F.transform("entities", entity_struct), empty)
    )


def keep_only(df: DataFrame, *columns: str) -> DataFrame:
    """Drop every column but these."""
    return df.select(*columns)


def as_text(df: DataFrame, column: str, *ids: str) -> DataFrame:
    """Rename one column to ``text``; keep only it and the id columns."""
    return df.select(*ids, F.col(column).alias("text"))


def strip_prefix(df: DataFrame, prefix: str, column: str = "text") -> DataFrame:
    """Remove a literal prefix (such as a begin-of-text marker) once."""
    return df.withColumn(column, remove_prefix(column, prefix))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per named table as ``(table_name, n)``."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
