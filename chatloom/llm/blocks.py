"""Tokenized blocks: many documents as arrays of small numbers beside the block's own words.

A task reads texts once and writes blocks of about ``BLOCK_TOKENS`` tokens. A block has its
words in a list and every token as a place in that list, so that counting and looking up
words moves one row per block and word, never one per token, and no vocabulary has to fit
in a task. Place 0 is the mark that ends every document.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_TOKENS = 1_000_000
BLOCK = (
    "block long, group string, docs array<long>, counted array<boolean>, lengths array<long>, "
    "tokens binary, words array<string>, counts array<long>"
)
_ARROW = pa.schema(
    [
        ("block", pa.int64()),
        ("group", pa.string()),
        ("docs", pa.list_(pa.int64())),
        ("counted", pa.list_(pa.bool_())),
        ("lengths", pa.list_(pa.int64())),
        ("tokens", pa.binary()),
        ("words", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
    ]
)


_PACKED = struct.Struct("<Bq")
PLACE_BITS = 23  # of a place; the other 40 bits hold its value


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0, byte by byte: all lowest bytes first, then compressed."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    planes = np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return _PACKED.pack(width, len(values)) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(blob: bytes) -> np.ndarray:
    width, n = _PACKED.unpack_from(blob)
    out = np.zeros((n, 8), np.uint8)
    data = memoryview(blob)[_PACKED.size :]
    out[:, :width] = np.frombuffer(pa.decompress(data, width * n, codec="zstd"), np.uint8).reshape(width, n).T
    return out.view("<i8").ravel()


class Places(dict):
    """Words to their places, in order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


class _Block:
    def __init__(self, mark: bytes):
        self.places, self.mark = Places(), mark
        self.places[mark]
        self.docs, self.counted, self.parts = [], [], []
        self.size = 0

    def add(self, doc: int | None, counted: bool, words: list[bytes]) -> None:
        words.append(self.mark)
        self.docs.append(doc)
        self.counted.append(counted)
        self.parts.append(np.fromiter(map(self.places.__getitem__, words), np.uint32, len(words)))
        self.size += len(words)

    def row(self, group: str) -> pa.RecordBatch:
        lengths = [len(p) for p in self.parts]
        tokens = np.concatenate(self.parts)
        counted = np.repeat(np.array(self.counted), lengths)
        counts = np.bincount(tokens[counted], minlength=len(self.places))
        if len(self.places) >> PLACE_BITS:
            raise ValueError("a block has too many different words")
        values = (
            uuid.uuid4().int >> 65, group, self.docs, self.counted, lengths, packed(tokens),
            [w.decode() for w in self.places], counts,
        )
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _ARROW)], schema=_ARROW)


def tokenized(
    docs: DataFrame, group: Column, doc: Column, counted: Column, text: Column, split: Callable[[bytes], list[bytes]], mark: bytes
) -> DataFrame:
    """One row per block; ``counts`` has the occurrences in documents that are ``counted``.

    A block holds documents of one group. Its number is drawn when it is made, so the
    table has to be written before it is used twice.
    """
    rows = docs.select(group.alias("group"), doc.cast("bigint").alias("doc"), counted.alias("counted"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Block] = {}
        size = 0
        for batch in batches:
            for name, doc, counted, text in zip(*batch.columns):
                block = held.get(name.as_py())
                if block is None:
                    block = held[name.as_py()] = _Block(mark)
                words = split((text.as_py() or "").encode())
                size += len(words) + 1
                block.add(doc.as_py(), counted.as_py(), words)
                if size >= BLOCK_TOKENS:
                    yield from (b.row(g) for g, b in held.items())
                    held, size = {}, 0
        yield from (b.row(g) for g, b in held.items())

    return rows.mapInArrow(run, BLOCK)


def block_words(blocks: DataFrame) -> DataFrame:
    """``(block, group, place, word, n)``: one row per block and word."""
    words = F.posexplode(F.arrays_zip("words", "counts")).alias("place", "of")
    return blocks.select("block", "group", words).select("block", "group", "place", "of.words", "of.counts").toDF(
        "block", "group", "place", "word", "n"
    )


def numbered(words: DataFrame, n: str, by: list[str], name: str, least: int = 1) -> DataFrame:
    """The rows with gapless numbers from 0: those of at least ``least`` first, and among
    them frequent ones (by powers of two of ``n``).

    Parts by frequency and hash are numbered on their own and put one behind the other;
    there are some thousand parts at most, whatever the number of rows.
    """
    level = F.lit(63) - F.floor(F.log2(F.col(n) + F.lit(0.5))).cast("int") + F.when(F.col(n) < least, 64).otherwise(0)
    rows = words.withColumn("part", level * 64 + F.pmod(F.xxhash64(*by), F.lit(64)))
    sizes = rows.groupBy("part").count()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*by)) - 1
    placed = rows.withColumn("inside", inside).join(starts, "part")
    return placed.withColumn(name, F.col("start") + F.col("inside")).drop("part", "start", "inside")


def with_columns_of(blocks: DataFrame, found: DataFrame, columns: list[str], *totals: Column) -> DataFrame:
    """The blocks with the values that ``found``, ``(block, place, *columns)``, has for their
    words, each column a list of longs for ``by_place``; null values are left out.
    ``totals`` are further aggregates of a block's rows."""
    value = lambda c: F.shiftleft(F.col("place").cast("long"), 63 - PLACE_BITS).bitwiseOR(F.col(c).cast("long"))
    per_block = found.groupBy("block").agg(*(F.collect_list(value(c)).alias(c) for c in columns), *totals)
    return blocks.withColumn("n_words", F.size("words")).drop("words", "counts").join(per_block, "block", "left")


def by_place(values: np.ndarray, n_words: int, missing: int) -> np.ndarray:
    out = np.full(n_words, missing, np.int64)
    out[values >> (63 - PLACE_BITS)] = values & ((1 << (63 - PLACE_BITS)) - 1)
    return out
