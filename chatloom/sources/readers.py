"""Reading annotation lines, named splits and registered tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.operators.indexing import refuse_reserved
from chatloom.operators.normalize import normalize_annotations, normalize_records
from chatloom.schemas import ANNOTATION


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw lines of one file, several files or a glob, in column ``value``."""
    return spark.read.text(path)


def read_annotations(
    spark: SparkSession, path: str | list[str], bad_lines: str = "fail", clean: bool = False
) -> DataFrame:
    """JSONL annotations -> ``(text, entities)``; no schema inference pass.

    ``clean=True`` trusts every line to have the fixed shape and parses it
    straight into that schema; otherwise irregular records are normalized.
    """
    if clean:
        records = spark.read.schema(ANNOTATION).option("mode", "FAILFAST").json(path)
        return normalize_records(records)
    return normalize_annotations(read_lines(spark, path), bad_lines=bad_lines)


def read_splits(
    spark: SparkSession,
    files: dict[str, str | None],
    reader: Callable[[SparkSession, str], DataFrame] = read_annotations,
) -> DataFrame:
    """Several files as one table with a ``split`` column.

    A split without a file is left out, as an optional ``eval`` is.
    """
    parts = [
        reader(spark, path).withColumn("split", F.lit(name)) for name, path in files.items() if path
    ]
    if not parts:
        raise ValueError("no split has a file")
    return reduce(DataFrame.unionByName, parts)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A registered table by name, or a parquet folder or file by path."""
    is_path = "/" in name_or_path or name_or_path.endswith(".parquet")
    return spark.read.parquet(name_or_path) if is_path else spark.table(name_or_path)


def read_many(
    spark: SparkSession,
    names: str | list[str] | dict[str, str],
    columns: list[str] | None = None,
    tag: str = "source",
) -> DataFrame:
    """Several datasets as one training set, tagged in the column ``tag``.

    ``names`` is a comma list, a list, or ``{source name: table or path}``.
    ``columns`` picks what the sets have in common. A set that already has a column
    of the tag's name is refused; name another tag.
    """
    if isinstance(names, str):
        names = [n.strip() for n in names.split(",") if n.strip()]
    if not isinstance(names, dict):
        names = {n: n for n in names}
    parts = []
    for source, name in names.items():
        df = read_table(spark, name)
        df = df.select(*columns) if columns else df
        refuse_reserved(df, tag)
        parts.append(df.withColumn(tag, F.lit(source)))
    return reduce(DataFrame.unionByName, parts)
