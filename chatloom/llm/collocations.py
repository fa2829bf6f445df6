"""Collocations: phrases of a language that occur more often than their parts suggest.

A-Z is lower-cased, texts are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words
``[^\\x20\\x09]+``. ``n`` counts all words of a language, ``f(phrase)`` all its contiguous
occurrences within pieces. Candidates have 2 to ``MOST_WORDS`` words and ``f >= MIN_COUNT``.
The score of a cut after k words is ``floor(1000 f n / (f(first part) f(rest)))``; the cut of
the lowest score counts, of equal ones the least k.

Words that are frequent in a language get numbers, so a text is an array of numbers (0: a
piece's end or a rare word). Phrases of m words are counted on double-array tries: a trie
goes to all tasks, numpy advances the states of all text positions by one word at a time,
``bincount`` counts the accepting states, and the counts of all tasks are added up. Where two
neighbouring positions accept, a phrase of m + 1 words stands whose first and last m words
are both frequent: an Apriori-safe candidate. These are summed up too, and those below
``MIN_COUNT`` never get a path in the next trie.

A trie holds about ``TRIE_PHRASES`` phrases, whatever the size of the corpus: phrases are
dealt by the words a longer phrase's two ends share, so that both ends meet in one trie,
and there is one counting job per trie. Of more candidates come more tries, not larger ones.

Defined results: a null text is empty, a null language is ``und``; equal rows count as often
as they stand; ties rank by frequency, then by the phrase's UTF-8 bytes; texts of any length
are counted whole; an empty table gives an empty result. Other columns are never read,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm import blocks as B
from chatloom.llm.common import materialize

MIN_COUNT, MOST_WORDS, TOP = 100, 5, 2000
TRIE_PHRASES = 500_000
SUM_ROWS = 2_000_000
WINDOW = 4096  # places of a double array that are tried at once
BREAK = b"."
# A-Z lower-cased, a tab a blank, every byte that ends a piece the break.
PIECE_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else 32 if b == 9 else 46 if b in b".,;:!?\x0a\x0b\x0c\x0d" else b for b in range(256)
)


def words_and_breaks(data: bytes) -> list[bytes]:
    # Only blanks are left of the bytes that split() cuts at.
    return data.translate(PIECE_BYTES).replace(BREAK, b" . ").split()


class Trie:
    """A double-array trie over phrases of equal length; a word's number leads from a state
    at ``base + word`` if ``check`` there names the state. State 0 is the root."""

    def __init__(self, base: np.ndarray, check: np.ndarray, accept: np.ndarray, phrases: np.ndarray):
        self.base, self.check, self.accept, self.phrases = base, check, accept, phrases

    @classmethod
    def of(cls, phrases: np.ndarray) -> Trie:
        """``phrases``: one row of word numbers (from 1) each, sorted and distinct."""
        n, depth = phrases.shape
        size = int(phrases.max(initial=0)) + 2 * n * depth + 2 * WINDOW
        base, check = np.zeros(size, np.int64), np.full(size, -1, np.int32)
        check[0] = -2  # the root's own place
        state_of = np.zeros(n, np.int64)
        for level in range(depth):
            new = np.ones(n, bool)
            new[1:] = (phrases[1:, : level + 1] != phrases[:-1, : level + 1]).any(axis=1)
            first = np.flatnonzero(new)
            parents, words = state_of[first], phrases[first, level].astype(np.int64)
            begin = np.r_[0, np.flatnonzero(np.diff(parents)) + 1]
            fan = np.diff(np.r_[begin, len(parents)])
            made = np.zeros(len(parents), np.int64)
            low = 1
            # Many children first: they need the most room at once.
            for k in np.argsort(-fan, kind="stable")[: int((fan > 1).sum())].tolist():
                mine = words[begin[k] : begin[k] + fan[k]]
                offsets = mine - mine[0]
                while True:
                    if low + WINDOW + offsets[-1] >= len(check):
                        check, base = np.r_[check, np.full(len(check), -1, np.int32)], np.r_[base, np.zeros(len(base), np.int64)]
                    free = low + np.flatnonzero(check[low : low + WINDOW] == -1)
                    for offset in offsets[1:].tolist():
                        free = free[check[free + offset] == -1]
                        if not len(free):
                            break
                    if len(free):
                        break
                    low += WINDOW
                parent = int(parents[begin[k]])
                base[parent] = free[0] - mine[0]
                made[begin[k] : begin[k] + fan[k]] = free[0] + offsets
                check[free[0] + offsets] = parent
            # A lone child fits anywhere.
            lone = begin[fan == 1]
            at = np.flatnonzero(check == -1)
            if len(at) < len(lone):
                at = np.r_[at, len(check) + np.arange(len(lone))]
                check, base = np.r_[check, np.full(len(lone), -1, np.int32)], np.r_[base, np.zeros(len(lone), np.int64)]
            at = at[: len(lone)]
            made[lone] = at
            base[parents[lone]] = at - words[lone]
            check[at] = parents[lone]
            state_of = made[np.cumsum(new) - 1]
        used = int(np.flatnonzero(check != -1)[-1]) + 1
        accept = np.full(used, -1, np.int32)
        accept[state_of] = np.arange(n)
        return cls(base[:used], check[:used], accept, phrases)

    def accepted(self, words: np.ndarray) -> np.ndarray:
        """For every position the phrase that begins there, or -1."""
        depth = self.phrases.shape[1]
        out = np.full(len(words), -1, np.int32)
        at = np.flatnonzero(words[: max(len(words) - depth + 1, 0)])
        state = np.zeros(len(at), np.int64)
        for level in range(depth):
            word = words[at + level]
            to = self.base[state] + word
            live = (word > 0) & (to > 0) & (to < len(self.check))
            live[live] = self.check[to[live]] == state[live]
            at, state = at[live], to[live]
        out[at] = self.accept[state]
        return out


def encoded(docs: DataFrame, lang: str, text: str, min_count: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sequences of frequent words' numbers, those words, and the words counted per language."""
    made = B.tokenized(
        docs.select(lang, text), F.coalesce(F.col(lang), F.lit("und")), F.lit(None), F.lit(True), F.col(text),
        words_and_breaks, BREAK,
    )
    blocks = materialize(made, "blocks")
    words = B.block_words(blocks).where("place > 0")
    counts = materialize(words.groupBy("group", "word").agg(F.sum("n").alias("f")), "word_counts")
    totals = counts.groupBy("group").agg(F.sum("f").alias("n"))
    # Rare words stay in the join, without a number: its rows grow with the texts alone.
    number = F.when(F.col("f") >= min_count, F.col("number") + 1).alias("number")
    ids = B.numbered(counts, "f", ["group", "word"], "number", min_count).select("group", "word", "f", number)
    ids = materialize(ids, "word_numbers")
    found = words.select("block", "group", "place", "word").join(ids.drop("f"), ["group", "word"])
    rows = B.with_columns_of(blocks, found, ["number"]).select("tokens", "n_words", "number")
    frequent = ids.where("number is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tokens, n_words, numbers in zip(*batch.columns):
                if not numbers.is_valid:
                    continue
                number_of = B.by_place(numbers.values.to_numpy(), n_words.as_py(), 0)
                sequence = number_of[B.unpacked(tokens.as_py())]
                # One 0 is enough between words that no phrase joins.
                keep = np.ones(len(sequence), bool)
                keep[1:] = (sequence[1:] != 0) | (sequence[:-1] != 0)
                sequence = sequence[keep]
                columns = [pa.array([B.packed(sequence)], pa.binary()), pa.array([len(sequence)], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["sequence", "places"])

    sequences = materialize(rows.mapInArrow(run, "sequence binary, places long"), "sequences")
    return sequences, frequent, totals


def summed(keys: DataFrame, least: int) -> DataFrame:
    """Adds up ``(part, keys, counts)`` blobs by key; ``(key, n)`` of at least ``least``."""

    def run(rows: pa.Table) -> pa.Table:
        key = np.concatenate([np.frombuffer(b, np.int64) for c in rows["keys"].chunks for b in (v.as_buffer() for v in c)])
        n = np.concatenate([np.frombuffer(b, np.int32) for c in rows["counts"].chunks for b in (v.as_buffer() for v in c)])
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order].astype(np.int64)
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        n = np.add.reduceat(n, first) if len(key) else n
        enough = n >= least
        return pa.table({"key": key[first][enough], "n": n[enough]})

    return keys.groupBy("part").applyInArrow(run, "key long, n long")


KEYS = "part int, keys binary, counts binary"


def dealt(key: np.ndarray, parts: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Distinct keys with their counts, by part."""
    return shared_out(*np.unique(key, return_counts=True), parts)


def shared_out(key: np.ndarray, n: np.ndarray, parts: int) -> Iterator[tuple[int, bytes, bytes]]:
    part = (key * np.int64(-7046029254386353131)).view(np.uint64) % np.uint64(parts) if parts > 1 else np.zeros(len(key), np.uint64)
    order = np.argsort(part, kind="stable")
    key, n, part = key[order], n[order].astype(np.int32), part[order]
    edges = np.searchsorted(part, np.arange(parts + 1))
    for p in np.unique(part).tolist():
        a, b = edges[p], edges[p + 1]
        yield int(p), key[a:b].tobytes(), n[a:b].tobytes()


def _key_batch(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    part, keys, counts = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())],
        names=["part", "keys", "counts"],
    )


def pairs(sequences: DataFrame, parts: int, least: int) -> DataFrame:
    """``(words)`` of the pairs of frequent words that occur often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                seq = B.unpacked(blob.as_py())
                both = (seq[:-1] > 0) & (seq[1:] > 0)
                rows = list(dealt(seq[:-1][both] << 32 | seq[1:][both], parts))
                if rows:
                    yield _key_batch(rows)

    found = summed(sequences.mapInArrow(run, KEYS), least)
    low = F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    return found.select(F.array(F.shiftright("key", 32).cast("int"), low).alias("words"))


def tries_of(phrases: DataFrame, size: int, trie_phrases: int) -> tuple[DataFrame, int]:
    """``(shard, trie...)``: one row per trie, phrases dealt by what longer ones share."""
    spark_rows = phrases.count()
    shards = max(1, -(-spark_rows // trie_phrases))
    overlap = lambda start: F.pmod(F.xxhash64(F.slice("words", start, size - 1)), F.lit(shards))
    # As the left end of a longer phrase a phrase counts; as its right end it is only met.
    left = phrases.select(overlap(2).alias("shard"), "words", F.lit(True).alias("counts"))
    right = phrases.select(overlap(1).alias("shard"), "words", F.lit(False).alias("counts"))
    both = left.unionByName(right).groupBy("shard", "words").agg(F.max("counts").alias("counts"))

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        words = np.concatenate([c.flatten().to_numpy() for c in rows["words"].chunks]).reshape(-1, size).astype(np.int32)
        counts = rows["counts"].to_numpy()
        order = np.lexsort(words.T[::-1])
        trie = Trie.of(words[order])
        blobs = (trie.base.tobytes(), trie.check.tobytes(), trie.accept.tobytes(), trie.phrases.tobytes(), counts[order].tobytes())
        return pa.table({"shard": [key[0].as_py()], **{c: pa.array([b], pa.binary()) for c, b in zip(TRIE, blobs)}})

    kinds = "shard long, " + ", ".join(f"{c} binary" for c in TRIE)
    return both.groupBy("shard").applyInArrow(run, kinds), shards


TRIE = ["base", "check", "accept", "phrases", "counts"]


def walked(sequences: DataFrame, blobs: dict[str, bytes], size: int, longer: bool, parts: int) -> DataFrame:
    """``(part, keys, counts)``: accepting states of one trie (parts below 0, as their
    phrases' numbers) and candidates of one word more, as pairs of the phrases of both ends."""
    sent = sequences.sparkSession.sparkContext.broadcast(blobs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = sent.value
        phrases = np.frombuffer(b["phrases"], np.int32).reshape(-1, size)
        trie = Trie(np.frombuffer(b["base"], np.int64), np.frombuffer(b["check"], np.int32), np.frombuffer(b["accept"], np.int32), phrases)
        counts = np.frombuffer(b["counts"], bool)
        total = np.zeros(len(phrases), np.int64)
        for batch in batches:
            for blob in batch.column(0):
                at = trie.accepted(B.unpacked(blob.as_py()))
                total += np.bincount(at[at >= 0], minlength=len(phrases))
                if longer:
                    both = (at[:-1] >= 0) & (at[1:] >= 0)
                    both[both] = counts[at[:-1][both]]
                    rows = list(dealt(at[:-1][both].astype(np.int64) << 32 | at[1:][both], parts))
                    if rows:
                        yield _key_batch(rows)
        hit = np.flatnonzero((total > 0) & counts)
        rows = [(-1 - part, keys, n) for part, keys, n in shared_out(hit, total[hit], parts)]
        if rows:
            yield _key_batch(rows)

    return sequences.mapInArrow(run, KEYS)


def phrase_counts(sequences: DataFrame, min_count: int, most_words: int, trie_phrases: int) -> DataFrame:
    """``(words, f)`` of every phrase of 2 to ``most_words`` frequent words that is frequent."""
    # No more keys are summed up than there are places; packed bytes say nothing of them,
    # as repeated texts pack to next to none.
    places = sequences.agg(F.sum("places")).first()[0] or 0
    parts = max(1, -(-places // SUM_ROWS))
    candidates = materialize(pairs(sequences, parts, min_count), "candidates_2")
    counted = None
    for width in range(2, most_words + 1):
        tries, shards = tries_of(candidates, width, trie_phrases)
        tries = materialize(tries, f"tries_{width}")
        longer, found = width < most_words, []
        for shard in range(shards):
            row = tries.where(F.col("shard") == shard).first()
            if row is None:
                continue
            blobs = {c: bytes(row[c]) for c in TRIE}
            made = materialize(walked(sequences, blobs, width, longer, parts), f"walk_{width}_{shard}")
            phrases = np.frombuffer(blobs["phrases"], np.int32).reshape(-1, width)
            found.append(_named(made, phrases, min_count, longer))
        if not found:
            break
        f = found[0][0]
        for more, _ in found[1:]:
            f = f.unionByName(more)
        counted = f if counted is None else counted.unionByName(f)
        if longer:
            candidates = found[0][1]
            for _, more in found[1:]:
                candidates = candidates.unionByName(more)
            candidates = materialize(candidates, f"candidates_{width + 1}")
    if counted is None:
        return candidates.select("words", F.lit(0).cast("long").alias("f"))
    return counted


def _named(made: DataFrame, phrases: np.ndarray, min_count: int, longer: bool) -> tuple[DataFrame, DataFrame | None]:
    """Counts of phrases and longer candidates of one walk, as words' numbers."""
    sent = made.sparkSession.sparkContext.broadcast(phrases)
    kept = pa.schema([("words", pa.list_(pa.int32())), ("f", pa.int64())])

    def rows(words: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        edges = pa.array(np.arange(len(words) + 1) * words.shape[1], pa.int32())
        lists = pa.ListArray.from_arrays(edges, pa.array(words.ravel(), pa.int32()))
        return pa.RecordBatch.from_arrays([lists, pa.array(f, pa.int64())], schema=kept)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield rows(sent.value[batch.column(0).to_numpy()], batch.column(1).to_numpy())

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy()
            left, right = sent.value[key >> 32], sent.value[key & 0xFFFFFFFF]
            yield rows(np.c_[left, right[:, -1]], batch.column(1).to_numpy())

    kinds = "words array<int>, f long"
    f = summed(made.where("part < 0"), min_count).mapInArrow(name, kinds)
    if not longer:
        return f, None
    return f, summed(made.where("part >= 0"), min_count).mapInArrow(extend, kinds).select("words")


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    min_count: int = MIN_COUNT,
    most_words: int = MOST_WORDS,
    top: int = TOP,
    trie_phrases: int = TRIE_PHRASES,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases.

    A phrase inside a longer one that is as frequent is left out.
    """
    sequences, frequent, totals = encoded(docs, lang, text, min_count)
    counted = materialize(phrase_counts(sequences, min_count, most_words, trie_phrases), "phrase_counts")
    single = frequent.select(F.array(F.col("number").cast("int")).alias("words"), "f")
    known = single.unionByName(counted)
    k = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    cuts = counted.select("words", F.col("f").alias("a"), k)
    cuts = cuts.withColumn("head", F.slice("words", F.lit(1), F.col("k")))
    cuts = cuts.withColumn("tail", F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")))
    cuts = cuts.join(known.select(F.col("words").alias("head"), F.col("f").alias("l")), "head")
    cuts = cuts.join(known.select(F.col("words").alias("tail"), F.col("f").alias("r")), "tail")
    lang_of = frequent.select(F.col("number").cast("int").alias("first_word"), F.col("group").alias("lang"))
    cuts = cuts.withColumn("first_word", F.col("words")[0]).join(lang_of, "first_word")
    cuts = cuts.join(totals.withColumnRenamed("group", "lang"), "lang")
    exact = lambda c: F.col(c).cast("decimal(16,0)")
    above = exact("a") * exact("n") * F.lit(1000).cast("decimal(4,0)")
    score = F.call_function("div", above, exact("l") * exact("r"))
    cuts = cuts.withColumn("score", score)
    best = cuts.groupBy("lang", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    # Every shorter phrase inside a candidate, with the highest count of such a candidate.
    inside = counted.select("words", "f", F.explode(F.sequence(F.lit(1), F.size("words"))).alias("at"))
    inside = inside.select("words", "f", "at", F.explode(F.sequence(F.lit(2), F.lit(most_words))).alias("size"))
    inside = inside.where("at + size - 1 <= size(words) and size < size(words)")
    covered = inside.select(F.slice("words", F.col("at"), F.col("size")).alias("words"), "f")
    covered = covered.groupBy("words").agg(F.max("f").alias("longer"))
    left = best.join(covered, "words", "left").where("longer is null or 100 * longer < 100 * a")
    spelled = left.select("lang", "words", F.posexplode("words").alias("at", "number")).join(
        frequent.select(F.col("number").cast("int").alias("number"), "word"), "number"
    )
    spelled = spelled.groupBy("lang", "words").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("spelled"))
    rows = left.join(spelled, ["lang", "words"]).select(
        "lang", F.array_join("spelled.word", " ").alias("phrase"), "a", "best.l", "best.r", "n", "best.score"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
