"""Render annotation files as they arrive.

Normalization, message building and rendering keep no state, so the batch plan
runs unchanged on a stream. Checkpoints and output belong on a folder all
executors can reach.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from chatloom.functions.templates import LLAMA, TemplateSpec
from chatloom.operators.normalize import malformed_lines
from chatloom.plans.training_text import annotation_training_text


def stream_lines(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """New JSONL files below ``folder`` as raw lines."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(folder)


def _append(df: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.format("json")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def render_new_files(
    lines: DataFrame, target: str, checkpoint: str, spec: TemplateSpec = LLAMA
) -> StreamingQuery:
    """Append the training text of all lines not seen before, then stop.

    Malformed lines do not stop the stream; :func:`keep_malformed` stores them.
    """
    return _append(
        annotation_training_text(lines, spec=spec, bad_lines="skip"), target, checkpoint
    )


def keep_malformed(lines: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append the malformed lines with their defect, then stop."""
    return _append(malformed_lines(lines), target, checkpoint)
