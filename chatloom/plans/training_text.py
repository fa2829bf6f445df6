"""From records to training text, end to end."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.fixed_values import (
    EXTRACTION_NOTE_TAG_PROMPT,
    EXTRACTION_USER_PROMPT,
    ROWS_PER_SOURCE,
    SEQUENCE_LIMIT,
)
from chatloom.functions.templates import CHATML, GEMMA, LLAMA, TemplateSpec
from chatloom.functions.text import estimate_length
from chatloom.operators.indexing import refuse_reserved
from chatloom.operators.lengths import pack_within_budget, truncate
from chatloom.operators.messages import (
    annotation_messages,
    pair_messages,
    standardize_sharegpt,
    triple_messages,
)
from chatloom.operators.mixing import cap_per_source, mix, sample_to_share, shuffle, split_train_eval
from chatloom.operators.normalize import normalize_annotations, strip_prefix
from chatloom.operators.rendering import render_conversations


def annotation_training_text(
    lines: DataFrame,
    *ids: str,
    line: str = "value",
    spec: TemplateSpec = LLAMA,
    bad_lines: str = "fail",
    user_template: str = EXTRACTION_USER_PROMPT,
) -> DataFrame:
    """Raw annotation lines -> normalized -> messages -> ``text``. One narrow map."""
    notes = normalize_annotations(lines, line, bad_lines)
    built = annotation_messages(notes, user_template=user_template)
    return render_conversations(built, spec).select(*ids, "text")


def annotation_training_splits(
    splits: dict[str, DataFrame | None],
    *ids: str,
    line: str = "value",
    spec: TemplateSpec = LLAMA,
    bad_lines: str = "fail",
    user_template: str = EXTRACTION_NOTE_TAG_PROMPT,
) -> DataFrame:
    """Lines of named splits -> ``(split, ids..., text)``; everything else is dropped.

    The note stands between tags by default. A split without lines is left out, as an
    optional ``eval`` is.
    """
    parts = [
        annotation_training_text(
            lines, *ids, line=line, spec=spec, bad_lines=bad_lines, user_template=user_template
        ).select(F.lit(name).alias("split"), *ids, "text")
        for name, lines in splits.items()
        if lines is not None
    ]
    if not parts:
        raise ValueError("no split has lines")
    return reduce(DataFrame.unionByName, parts)


def instruction_training_text(
    triples: DataFrame, *ids: str, spec: TemplateSpec = GEMMA
) -> DataFrame:
    """Instruction triples -> messages -> ``text`` without the begin-of-text mark."""
    rendered = render_conversations(triple_messages(triples), spec)
    return (strip_prefix(rendered, spec.bos) if spec.bos else rendered).select(*ids, "text")


def reasoning_chat_mix(
    pairs: DataFrame,
    chats: DataFrame,
    id: str = "id",
    share: float = 0.25,
    sample_seed: int = 2407,
    shuffle_seed: int = 3407,
    spec: TemplateSpec = CHATML,
) -> DataFrame:
    """Problem/solution pairs plus a share of chats, shuffled: ``(pos, source, id, text)``.

    The chat sample is drawn before rendering, so rows that are not kept are
    never rendered; the result is the same.
    """
    chosen = sample_to_share(pairs, chats, share, sample_seed, id)
    parts = {
        "reasoning": render_conversations(pair_messages(pairs), spec).select(id, "text"),
        "chat": render_conversations(standardize_sharegpt(chosen), spec).select(id, "text"),
    }
    source: Column = F.col("source")
    return shuffle(mix(parts), shuffle_seed, id, source)


def configured_training_rows(
    datasets: dict[str, DataFrame],
    id: str = "id",
    spec: TemplateSpec = GEMMA,
    cutoff: int = SEQUENCE_LIMIT,
    most_rows: int | None = ROWS_PER_SOURCE,
    eval_fraction: float = 0.1,
    packing: bool = False,
    est: str = "words",
    seed: int | str = 42,
) -> DataFrame:
    """A whole run as one plan: ``(dataset, id, split, text, was_truncated, n_tokens)``.

    Of every listed dataset of instruction triples the first ``most_rows`` are taken, in
    order of ``id``, before anything is rendered. Texts are cut after ``cutoff`` estimated
    tokens, exactly ``ceil(n * eval_fraction)`` rows are held out, and with ``packing``
    rows of a split share sequences within the cut-off: ``bucket`` and ``pack`` are added.
    """
    for df in datasets.values():
        refuse_reserved(df, "split", "was_truncated", "n_tokens", "bucket", "pack")
    taken = mix(datasets, "dataset")
    if most_rows is not None:
        taken = cap_per_source(taken, most_rows, "dataset", id)
    rendered = instruction_training_text(taken, "dataset", id, spec=spec)
    key = F.concat_ws("/", "dataset", F.col(id).cast("string"))
    cut = truncate(rendered, "text", cutoff, est).withColumn("row_key", key)
    rows = split_train_eval(cut, eval_fraction, seed, "row_key")
    rows = rows.withColumn("n_tokens", estimate_length("text", est))
    if packing:
        rows = pack_within_budget(rows, "n_tokens", cutoff, seed=seed, id="row_key", by=["split"])
    return rows.drop("row_key")
