"""Two ways to keep a costly expression from being evaluated twice.

The optimizer copies a column's expression into every filter on it, and adds a
filter on the array below every ``explode``. For parsed or built columns that
doubles the work (inside a lambda it can make it quadratic). A generator is a
point no filter is pushed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions later filters will not repeat."""
    values = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    once = df.select(*kept, F.explode_outer(F.array(values)).alias("__cl_once"))
    return once.select(*kept, *[F.col(f"__cl_once.{name}").alias(name) for name in columns])


def explode_rows(df: DataFrame, *keep: str, array: Column | str, pos: str, item: str) -> DataFrame:
    """One row per element with its 0-based position; empty arrays give none."""
    rows = df.select(*keep, F.posexplode_outer(array).alias(pos, item))
    return rows.where(F.col(pos).isNotNull()).withColumn(pos, F.col(pos).cast("bigint"))
