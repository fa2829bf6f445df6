"""Deterministic order keys: every random choice is a hash of seed, source and id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions.text import as_column, text_or_empty


def order_key(seed: int | str, id_col: Column | str, source: Column | str = "") -> Column:
    """``md5(seed:source:id)`` as hex; a plain string is a literal source name."""
    name = F.lit(source) if isinstance(source, str) else text_or_empty(source)
    return F.md5(F.concat(F.lit(f"{seed}:"), name, F.lit(":"), text_or_empty(id_col)))


def hash_bucket(key: Column | str, digits: int = 5) -> Column:
    """Leading hex digits as a number: equal-sized buckets in key order."""
    number = F.conv(F.substring(as_column(key), 1, digits), 16, 10).cast("bigint")
    return F.coalesce(number, F.lit(0).cast("bigint"))


def hash_fraction(key: Column | str) -> Column:
    """The key as a uniform number in [0, 1)."""
    return hash_bucket(key, 8) / F.lit(float(16**8))
