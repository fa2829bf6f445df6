"""Response-only training mask over rendered texts, in characters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.functions.masks import response_span_array, trained_chars
from chatloom.functions.templates import TEMPLATES, TemplateSpec
from chatloom.operators.shaping import explode_rows


def _parts(spec: TemplateSpec | str) -> tuple[str, str]:
    spec = TEMPLATES[spec] if isinstance(spec, str) else spec
    return spec.instruction_part, spec.response_part


def response_spans(
    df: DataFrame, *ids: str, spec: TemplateSpec | str, column: str = "text"
) -> DataFrame:
    """Trained spans of each text: ids, ``seq``, ``start``, ``end``, ``text``."""
    spans = response_span_array(column, *_parts(spec))
    rows = explode_rows(df, *ids, array=spans, pos="seq", item="s")
    return rows.select(*ids, "seq", "s.start", "s.end", "s.text")


def mask_stats(
    df: DataFrame, *ids: str, spec: TemplateSpec | str, column: str = "text"
) -> DataFrame:
    """Trained and total characters per text, so empty targets show up."""
    return df.select(
        *ids,
        trained_chars(column, *_parts(spec)).alias("trained_chars"),
        F.length(column).cast("bigint").alias("total_chars"),
    )
