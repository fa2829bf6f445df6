"""Which spans of a rendered text a response-only run trains on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions.text import as_column, let, split_literal

BLOCK = 256
SPANS_DDL = "ARRAY<STRUCT<start: BIGINT, end: BIGINT, text: STRING>>"


def response_span_array(
    text: Column | str, instruction_part: str, response_part: str
) -> Column:
    """Trained spans as ``(start, end, text)``, 0-based, end exclusive.

    A span runs from the end of a response header to the next instruction
    header or the end of the text. A second response header before the next
    instruction belongs to the open span. Offsets count characters, since
    tokenization happens elsewhere.

    Spans are gathered in blocks of pieces: appending to one ever longer list
    would be quadratic in the number of turns.
    """
    gap, lead = len(instruction_part), len(response_part)

    def gathered(pos: Column) -> Column:
        return F.struct(pos.alias("pos"), F.array().cast(SPANS_DDL).alias("spans"))

    def step(acc: Column, piece: Column) -> Column:
        at = F.instr(piece, response_part)
        begin = at + (lead - 1)
        span = F.struct(
            (acc["pos"] + begin).cast("bigint").alias("start"),
            (acc["pos"] + F.length(piece)).cast("bigint").alias("end"),
            F.substr(piece, begin + 1).alias("text"),
        )
        return F.struct(
            (acc["pos"] + F.length(piece) + gap).cast("bigint").alias("pos"),
            F.when(at > 0, F.concat(acc["spans"], F.array(span)))
            .otherwise(acc["spans"])
            .alias("spans"),
        )

    def blocks(pieces: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(pieces), F.lit(1)), F.lit(BLOCK))
        return F.transform(starts, lambda at: F.slice(pieces, at, F.lit(BLOCK)))

    def add_block(acc: Column, block: Column) -> Column:
        return let(
            F.aggregate(block, gathered(acc["pos"]), step),
            lambda got: F.struct(
                got["pos"].alias("pos"), F.concat(acc["spans"], got["spans"]).alias("spans")
            ),
        )

    return F.aggregate(
        let(split_literal(text, instruction_part), blocks),
        gathered(F.lit(0).cast("bigint")),
        add_block,
        lambda acc: acc["spans"],
    )


def trained_chars(text: Column | str, instruction_part: str, response_part: str) -> Column:
    """Number of characters inside trained spans, without building the spans."""
    lead = len(response_part)

    def add(acc: Column, piece: Column) -> Column:
        at = F.instr(piece, response_part)
        kept = F.when(at > 0, F.length(piece) - at + 1 - lead).otherwise(0)
        return acc + kept.cast("bigint")

    return F.aggregate(
        split_literal(as_column(text), instruction_part), F.lit(0).cast("bigint"), add
    )
