"""Builders that turn records into ordered lists of ``{role, content}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.fixed_values import EXTRACTION_SYSTEM_PROMPT, EXTRACTION_USER_PROMPT
from chatloom.functions.jsonfmt import entities_json
from chatloom.functions.templates import fill_template, message
from chatloom.functions.text import text_or_empty
from chatloom.operators.shaping import explode_rows

# Role names used by the {from, value} message format.
SHAREGPT_ROLES = {"human": "user", "gpt": "assistant", "system": "system"}


def annotation_messages(
    df: DataFrame,
    system: str = EXTRACTION_SYSTEM_PROMPT,
    user_template: str = EXTRACTION_USER_PROMPT,
    out: str = "conversations",
) -> DataFrame:
    """``(text, entities)`` -> system, user (note) and assistant (JSON target)."""
    return df.withColumn(
        out,
        F.array(
            message("system", F.lit(system)),
            message("user", fill_template(user_template, note="text")),
            message("assistant", entities_json("entities")),
        ),
    )


def triple_messages(
    df: DataFrame,
    task: str = "task",
    input: str = "input",
    output: str = "expected_output",
    out: str = "conversations",
) -> DataFrame:
    """Instruction triple -> system, user, assistant."""
    return df.withColumn(
        out,
        F.array(
            message("system", text_or_empty(task)),
            message("user", text_or_empty(input)),
            message("assistant", text_or_empty(output)),
        ),
    )


def pair_messages(
    df: DataFrame,
    problem: str = "problem",
    solution: str = "generated_solution",
    out: str = "conversations",
) -> DataFrame:
    """Problem and solution -> user, assistant."""
    return df.withColumn(
        out,
        F.array(
            message("user", text_or_empty(problem)),
            message("assistant", text_or_empty(solution)),
        ),
    )


def standardize_sharegpt(
    df: DataFrame,
    column: str = "conversations",
    aliases: dict[str, str] | None = None,
    unknown: str | None = None,
) -> DataFrame:
    """``{from, value}`` messages -> ``{role, content}``.

    Roles outside the alias table pass through; name a column in ``unknown`` to
    count them per conversation.
    """
    aliases = SHAREGPT_ROLES if aliases is None else aliases

    def role(m: Column) -> Column:
        out = m["from"]
        for theirs, ours in aliases.items():
            out = F.when(m["from"] == theirs, F.lit(ours)).otherwise(out)
        return out

    raw = F.col(column)
    known = [*aliases.keys(), *aliases.values()]
    if unknown:
        strange = F.filter(raw, lambda m: ~F.coalesce(m["from"].isin(known), F.lit(False)))
        df = df.withColumn(unknown, F.size(strange).cast("bigint"))
    return df.withColumn(column, F.transform(raw, lambda m: message(role(m), m["value"])))


def assemble_conversations(
    df: DataFrame,
    id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    out: str = "conversations",
    turns_per_row: int | None = None,
) -> DataFrame:
    """Long turn rows -> one ordered conversation per id.

    Turns are sorted by ``turn`` inside the group; arrival order is never used.
    The result row holds the whole conversation. Where one id may carry more
    turns than a row can hold, ``turns_per_row`` cuts a conversation into
    consecutive rows ``(id, part, conversations)`` by turn number, which also
    spreads one hot id over many groups. No turn is dropped either way.
    """
    keys = [F.col(id)]
    if turns_per_row:
        keys.append(F.floor(F.col(turn) / F.lit(turns_per_row)).cast("bigint").alias("part"))
    turns = F.array_sort(
        F.collect_list(
            F.struct(
                F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content")
            )
        )
    )
    return (
        df.groupBy(*keys)
        .agg(turns.alias(out))
        .withColumn(out, F.transform(out, lambda m: message(m["role"], m["content"])))
    )


def prompt_messages(
    df: DataFrame,
    system: str | None = None,
    user_template: str = EXTRACTION_USER_PROMPT,
    out: str = "conversations",
    **values: str,
) -> DataFrame:
    """Inference prompt: optional system turn and one user turn, no target.

    ``values`` maps placeholders to columns; by default ``{note}`` is ``text``.
    """
    turns = [message("user", fill_template(user_template, **(values or {"note": "text"})))]
    if system is not None:
        turns.insert(0, message("system", F.lit(system)))
    return df.withColumn(out, F.array(*turns))


def message_rows(df: DataFrame, *ids: str, column: str = "conversations") -> DataFrame:
    """One row per message: ids, ``seq`` (0-based), ``role``, ``content``."""
    rows = explode_rows(df, *ids, array=column, pos="seq", item="m")
    return rows.select(*ids, "seq", "m.role", "m.content")
