"""Rendering conversations and running caller-supplied batch functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.functions.templates import (
    TEMPLATES,
    TemplateSpec,
    fold_system,
    render_chat,
    render_turns,
    system_text,
    without_system,
)


def render_conversations(
    df: DataFrame,
    spec: TemplateSpec | str,
    column: str = "conversations",
    out: str = "text",
    add_generation_prompt: bool = False,
) -> DataFrame:
    """Add the rendered training text of each conversation."""
    spec = TEMPLATES[spec] if isinstance(spec, str) else spec
    return df.withColumn(out, render_chat(column, spec, add_generation_prompt))


def render_conversation_parts(
    parts: DataFrame,
    spec: TemplateSpec | str,
    id: str = "conv_id",
    part: str = "part",
    column: str = "conversations",
    out: str = "text",
    add_generation_prompt: bool = False,
) -> DataFrame:
    """Add the text of each part of a conversation (see ``assemble_conversations``).

    The parts' texts, joined in order, are the whole conversation's text: only the
    first has the begin mark, only the last the generation prompt, and folded system
    turns go to the part with the first user turn. What is looked up per conversation
    is its outline; parts themselves are not moved together.
    """
    spec = TEMPLATES[spec] if isinstance(spec, str) else spec
    turns = F.col(column)
    asks = F.exists(turns, lambda m: m["role"] == "user")
    outline = parts.select(
        F.col(id).alias("__cl_id"),
        F.col(part).alias("__cl_part"),
        F.when(asks, F.col(part)).alias("__cl_asks"),
        system_text(turns).alias("__cl_system"),
    )
    said = F.filter(
        F.array_sort(F.collect_list(F.when(F.col("__cl_system") != "", F.struct("__cl_part", "__cl_system")))),
        lambda s: s.isNotNull(),
    )
    outline = outline.groupBy("__cl_id").agg(
        F.min("__cl_part").alias("__cl_first"),
        F.max("__cl_part").alias("__cl_last"),
        F.coalesce(F.min("__cl_asks"), F.min("__cl_part")).alias("__cl_folded"),
        F.array_join(F.transform(said, lambda s: s["__cl_system"]), "\n\n").alias("__cl_said"),
    )
    if spec.system_policy == "fold_into_first_user":
        here = F.when(F.col(part) == F.col("__cl_folded"), F.col("__cl_said")).otherwise("")
        turns = fold_system(turns, here)
    elif spec.system_policy == "drop":
        turns = without_system(turns)
    pieces = [
        F.when(F.col(part) == F.col("__cl_first"), spec.bos).otherwise(""),
        render_turns(turns, spec),
    ]
    if add_generation_prompt:
        pieces.append(F.when(F.col(part) == F.col("__cl_last"), spec.response_part).otherwise(""))
    joined = parts.join(outline, F.col(id).eqNullSafe(F.col("__cl_id")))
    return joined.withColumn(out, F.concat(*pieces)).select(
        *[c for c in parts.columns if c != out], out
    )


def map_batches(
    df: DataFrame,
    function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str | T.StructType,
) -> DataFrame:
    """Apply an opaque batch function; rows arrive as Arrow-backed batches.

    Only for functions Spark expressions cannot state: everything else in this
    library stays in the JVM. No shuffle, batch size set by
    ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return df.mapInPandas(run, schema)
