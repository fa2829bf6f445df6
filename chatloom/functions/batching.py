"""Request-size arithmetic for generation jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.fixed_values import BATCH_TOKEN_CAP, OUTPUT_TOKEN_LIMIT, TOKEN_MARGIN
from chatloom.functions.text import as_column


def safe_batch(count: Column | str, tokens: Column | str, cap: int = BATCH_TOKEN_CAP) -> Column:
    """How many items one request may ask for under an output-token cap.

    ``count`` when the estimate fits, else the cap divided by the margin-adjusted
    tokens per item, at least 1. For tiny ``tokens`` the fallback can exceed
    ``count``; that is kept, so a plan may overshoot. All arithmetic is double,
    since decimal literals would truncate differently.
    """
    count = as_column(count).cast("bigint")
    tokens = as_column(tokens).cast("bigint")
    per_item = tokens * F.lit(TOKEN_MARGIN)
    fits = F.ceil(count * tokens * F.lit(TOKEN_MARGIN)) <= cap
    whole = F.greatest(F.lit(1).cast("bigint"), per_item.cast("bigint"))
    fallback = F.floor(F.lit(cap) / whole)
    return F.when(fits, count).otherwise(
        F.greatest(F.lit(1).cast("bigint"), fallback.cast("bigint"))
    )


def max_output_tokens(
    count: Column | str, tokens: Column | str, limit: int = OUTPUT_TOKEN_LIMIT
) -> Column:
    """Output limit of one request: twice the target size, never above ``limit``."""
    wanted = as_column(tokens).cast("bigint") * as_column(count).cast("bigint") * 2
    return F.least(F.lit(limit).cast("bigint"), wanted)
