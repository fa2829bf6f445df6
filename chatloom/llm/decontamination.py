"""Benchmark decontamination by winnowing, in DataFrame functions only.

Texts become words: A-Z lower-cased, runs of digits, letters and characters beyond
ASCII. An item's windows are its runs of ``span`` consecutive words; an item of fewer
words is one window. Of every ``span - gram + 1`` consecutive word grams the one with
the least hash is a fingerprint, the first of equal ones, so that a run of ``span``
words gives the same fingerprint at the same place wherever it stands. Documents and
items meet on equal fingerprints; each meeting fixes how the two texts lie over each
other, and there every word is compared and every whole window is a hit. Items shorter
than ``span`` are fingerprinted by their one window, and documents by all their grams
of those lengths.

A document's fingerprints are first tested against a bit map of the items' fingerprints
of at most ``MAX_MAP_WORDS`` words; it only spares the join what cannot meet, and a
fuller map lets more through. Fingerprints of items are broadcast up to
``BROADCAST_ROWS`` and joined by a shuffle beyond.

Defined results: a null text has no words; rows with equal ids each get their own
result; equal items are compared once and listed each; null item ids are listed as an
empty string; with no items nothing is hit.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import materialize
from chatloom.llm.urls import LOWER, UPPER

SPAN = 13
GRAM = 8
MAX_MAP_WORDS = 1 << 18  # 2 MB
BROADCAST_ROWS = 200_000
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count_to(n: Column) -> Column:
    """0 .. n - 1; empty for n <= 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def words_of(text: Column) -> Column:
    """Words of a text; null gives none."""
    plain = F.octet_length(text) == F.length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), BREAKS, -1), "")


def gram_hashes(words: Column, gram: int) -> Column:
    return F.transform(
        count_to(F.size(words) - (gram - 1)), lambda i: F.xxhash64(F.slice(words, i + 1, gram))
    )


def fingerprints(
    words: Column, gram: int, window: int, wanted: Callable[[Column], Column] | None = None
) -> Column:
    """``array<struct<gram, at, hash>>`` of the fingerprints that pass ``wanted``."""

    def chosen(hashes: Column) -> Column:
        least = lambda s: F.array_min(F.slice(hashes, s + 1, window))
        starts = count_to(F.size(hashes) - (window - 1))
        if wanted is not None:
            starts = F.filter(starts, lambda s: wanted(least(s)))
        place = lambda s: F.array_position(F.slice(hashes, s + 1, window), least(s))
        entry = lambda s: F.struct(
            F.lit(gram).alias("gram"),
            (s + place(s).cast("int") - 1).alias("at"),
            least(s).alias("hash"),
        )
        # Windows that chose the same gram follow each other.
        return let(
            F.transform(starts, entry),
            lambda all: F.filter(
                all, lambda e, i: (i == 0) | (F.get(all, i - 1)["at"] != e["at"])
            ),
        )

    return let(gram_hashes(words, gram), chosen)


def benchmark_items(benchmark: DataFrame, id: str, text: str) -> DataFrame:
    """``(item, words, ids)``: different word sequences and the ids that have them."""
    words = benchmark.select(F.col(id).cast("string").alias("id"), words_of(F.col(text)).alias("words"))
    return (
        words.where(F.size("words") > 0)
        .groupBy("words")
        .agg(F.collect_set(F.coalesce("id", F.lit(""))).alias("ids"))
        .withColumn("item", F.monotonically_increasing_id())
    )


def bit_map(prints: DataFrame, n: int) -> tuple[DataFrame, int]:
    """One row with the map's words, two bits set per fingerprint, and their number."""
    size = 64
    while size < 4 * n and size < MAX_MAP_WORDS:
        size *= 2
    places = F.array(*[F.struct(w.alias("word"), b.alias("bit")) for w, b in _places(F.col("hash"), size)])
    words = prints.select(F.inline(places)).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    every = prints.sparkSession.range(size).select(F.col("id").cast("int").alias("word"))
    full = every.join(words, "word", "left").select("word", F.coalesce("bits", F.lit(0)).alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return full.agg(F.transform(ordered, lambda x: x["bits"]).alias("map")), size


def _places(value: Column, size: int) -> list[tuple[Column, Column]]:
    """Two words of the map and a bit in each, from separate bits of a hash."""
    part = lambda shift, mask: F.shiftrightunsigned(value, shift).bitwiseAND(F.lit(mask)).cast("int")
    return [(part(0, size - 1), part(40, 63)), (part(20, size - 1), part(46, 63))]


def compared(words: Column, item: Column, shift: Column, span: int) -> Column:
    """Starts, in the item, of its windows that stand in the document at ``shift``."""
    window = F.least(F.lit(span), F.size(item))
    same = F.transform(
        item, lambda w, i: F.coalesce(F.get(words, i + shift) == w, F.lit(False))
    )
    return let(
        same,
        lambda flags: F.filter(
            count_to(F.size(item) - window + 1),
            lambda s: F.forall(F.slice(flags, s + 1, window), lambda x: x),
        ),
    )


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    keep: Sequence[str] | None = None,
    span: int = SPAN,
    gram: int = GRAM,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(rows, spans, items)``.

    ``rows``: every document row as ``(row, kept, n_words)``, with the columns ``keep``
    in a struct. ``spans``: ``(row, item, first, length)``, every occurrence of an
    item's window. ``items``: see :func:`benchmark_items`.
    """
    items = materialize(benchmark_items(benchmark, item_id, item_text), "items")
    short = [r[0] for r in items.select(F.size("words")).where(F.size("words") < span).distinct().collect()]
    window = span - gram + 1
    whole = F.array(
        F.struct(F.size("words").alias("gram"), F.lit(0).alias("at"), F.xxhash64("words").alias("hash"))
    )
    prints = F.when(F.size("words") < span, whole).otherwise(fingerprints(F.col("words"), gram, window))
    prints = materialize(items.select("item", F.inline(prints)), "fingerprints")
    n_prints = prints.count()
    map_row, size = bit_map(prints, n_prints)

    def passing(bits: Column) -> Callable[[Column], Column]:
        def test(value: Column) -> Column:
            (w1, b1), (w2, b2) = _places(value, size)
            return (F.bit_get(F.get(bits, w1), b1) == 1) & (F.bit_get(F.get(bits, w2), b2) == 1)

        return test

    def described(words: Column, bits: Column) -> Column:
        found = fingerprints(words, gram, window, passing(bits))
        for n in sorted(short):
            found = F.concat(found, fingerprints(words, n, 1, passing(bits)))
        return let(
            found,
            lambda hits: F.struct(
                F.size(words).alias("n_words"),
                F.when(F.size(hits) > 0, words).alias("words"),
                hits.alias("hits"),
            ),
        )

    kept = F.struct(*[F.col(c) for c in (keep if keep is not None else docs.columns)])
    scanned = docs.select(kept.alias("kept"), F.col(text).alias("body")).withColumn("bits", map_row.scalar())
    seen = let(words_of(F.col("body")), lambda words: described(words, F.col("bits")))
    # The row number is fixed by being written, so that every later join agrees on it.
    rows = materialize(
        scanned.select("kept", F.inline(F.array(seen))).withColumn("row", F.monotonically_increasing_id()),
        "scanned",
    )

    marked = rows.where(F.size("hits") > 0)
    meetings = marked.select("row", F.inline("hits"))
    theirs = prints.withColumnRenamed("at", "item_at")
    theirs = F.broadcast(theirs) if n_prints <= BROADCAST_ROWS else theirs
    lying = (
        meetings.join(theirs, ["gram", "hash"])
        .select("row", "item", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    texts = items.select("item", F.col("words").alias("item_words"))
    texts = F.broadcast(texts) if n_prints <= BROADCAST_ROWS else texts
    starts = compared(F.col("words"), F.col("item_words"), F.col("shift"), span)
    spans = (
        # Item words first, so that a document's words are never shuffled per meeting.
        lying.join(texts, "item")
        .join(marked.select("row", "words"), "row")
        .select(
            "row",
            "item",
            "shift",
            F.least(F.lit(span), F.size("item_words")).alias("length"),
            F.explode(starts).alias("start"),
        )
        .select("row", "item", (F.col("start") + F.col("shift")).alias("first"), "length")
    )
    return rows.select("row", "kept", "n_words"), materialize(spans, "spans"), items


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Per document row: the kept columns as ``kept``, ``n_words``, ``n_hit``, ``items``
    (sorted ids of the items with occurring windows), ``n_items`` and ``contaminated``.

    A word inside any occurring window is hit. Contaminated: at least one word is hit
    and at least one in twenty.
    """
    rows, spans, items = find_hits(docs, benchmark, text, item_id, item_text, keep)
    n_hit = (
        spans.select("row", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("length") - 1)).alias("at"))
        .distinct()
        .groupBy("row")
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    listed = (
        spans.select("row", "item")
        .distinct()
        .join(items.select("item", F.explode("ids").alias("id")), "item")
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("id")).alias("items"))
    )
    hits = n_hit.join(listed, "row")
    n = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return rows.join(hits, "row", "left").select(
        "kept",
        F.col("n_words").cast("bigint").alias("n_words"),
        n.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        ((n > 0) & (20 * n >= F.col("n_words"))).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows that are not contaminated, with all their columns."""
    marked = contamination(docs, benchmark, text)
    return marked.where(~F.col("contaminated")).select("kept.*")
