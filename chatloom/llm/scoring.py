"""Language-model scores of whole texts by an n-gram trie of Elias-Fano sequences.

A-Z is lower-cased; the tokens of a text are its words ``[^\\x20\\x09-\\x0D]+`` and one end.
The model learns from the training documents only. With ``n`` for counts, ``D`` for the
discount and a begin mark in front of a text, the probability of c after a, b is

    p(c)       = (n(c) - D1) / N, and D1 V / N for all unknown words together
    p(c | b)   = (n(bc) - D) / n(b) + g(b) p(c)
    p(c | a b) = (n(abc) - D) / n(ab) + g(ab) p(c | b)

where ``g`` is what the discounts leave, so each sums to one; D1 follows from how many words
occur once and twice. A triple that occurs once is left to the shorter context. The two
fractions and ``g`` are stored in 16 bits, in steps of 2 ** (1/1024): a score is off by less
than 0.0002 decades a token.

The model is cut by the middle word into shards of about ``SHARD_TOKENS`` tokens, a very
frequent middle word further by the word before it (the pairs behind it go to all of its
shards); each shard is built by one task and is one file. Its levels are monotone sequences in Elias-Fano form: the successors c of each b;
the contexts a before each b; for each context a monotone pointer to as many slots as b has
successors; and the triples as slots, a slot being the pointer plus the place of c among the
successors of b. So a lookup finds c among the successors of b, takes the place relative to
b's first successor, and searches the context's slots for that place. Files are memory-mapped
where the folder is a local path, else copied to an unnamed file first; a task has
``OPEN_SHARDS`` of them open.

Every training token is counted and no n-gram count is capped or sampled, so the model
grows with the corpus. Counting moves packed arrays of a block's distinct triples, not one row per token.

Defined results: a null text is empty and has the end as its only token; a null id counts as
the text ``''`` when documents are held out; equal rows are scored each; without training
documents every token is unknown with probability 1; ties do not arise; texts of any length
are scored whole; an empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.llm import blocks as B
from chatloom.llm.common import LOWER, materialize, mix64
from chatloom.llm.eliasfano import Sequence, from_buffer, to_bytes
from chatloom.llm.records import _filesystem
from chatloom.session import scratch_path

DISCOUNT = 0.8
LEAST_TRIPLE = 2
SHARD_TOKENS = 2_000_000
OPEN_SHARDS = 64
QUERY = 1 << 15
STEPS = 1024  # codes per halving of a probability
END = b""
GRAMS = "shard long, kind int, a binary, b binary, c binary, n binary"
_GRAMS = pa.schema([("shard", pa.int64()), ("kind", pa.int32())] + [(x, pa.binary()) for x in "abcn"])
ENCODED = ["docs", "counted", "lengths", "tokens", "n_words", "number", "f"]


def words_of(data: bytes) -> list[bytes]:
    return data.translate(LOWER).split()


def code(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log2(p) * STEPS), 0, 65535).astype(np.uint16)


_DECODED = np.exp2(np.arange(1 << 16) / -STEPS)


def decoded(codes: np.ndarray) -> np.ndarray:
    return _DECODED[codes]


class Words:
    """Per place of a block: the word's number (-1: unknown), count, and how many shards
    share its triples. One more place, the last, stands for the begin of a text."""

    def __init__(self, row: dict, model: dict):
        n = self.begin = row["n_words"]
        self.shards = model["shards"]
        number, f = (np.zeros(0, np.int64) if row[c] is None else row[c] for c in ("number", "f"))
        self.number = np.r_[B.by_place(number, n, -1), model["numbers"]]
        self.count = np.zeros(n + 1, np.int64)
        self.count[number >> (63 - B.PLACE_BITS)] = f
        self.spread = np.maximum(-(-self.count // model["shard_tokens"]), 1)
        self.tokens = B.unpacked(row["tokens"])
        self.starts = np.cumsum(row["lengths"]) - row["lengths"]

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the second and of the last word before every token."""
        last = np.r_[self.begin, self.tokens[:-1]]
        last[self.starts] = self.begin
        second = np.r_[self.begin, last[:-1]]
        second[self.starts] = self.begin
        return second, last

    def shards_of(self, second: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The shard of each context; that of a very frequent last word depends on both words."""
        spread = self.spread[last].view(np.uint64)
        share = mix64(self.number[second].view(np.uint64), 5) % spread
        return self.shard(self.number[last], share.view(np.int64))

    def shard(self, number: np.ndarray, share: np.ndarray) -> np.ndarray:
        key = mix64(mix64(number.view(np.uint64), 6) + share.view(np.uint64), 7)
        return (key % np.uint64(self.shards)).view(np.int64)


def encoded_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {}
            for name, column in zip(ENCODED, batch.columns):
                value = column[i]
                if not value.is_valid:
                    row[name] = None
                elif name in ("tokens", "n_words"):
                    row[name] = value.as_py()
                elif name == "docs":
                    row[name] = value.values
                else:
                    row[name] = value.values.to_numpy(zero_copy_only=False)
            yield row


def numbered_words(blocks: DataFrame, parts: int) -> DataFrame:
    """``(block, place, number, f, is_first)``: every block's words with their number and
    count in training documents; words that these do not hold have neither.

    One shuffle by hash part: a word's number is its rank in the part by count, times the
    number of parts, plus the part, so frequent words have small numbers. ``is_first``
    marks one row of every word.
    """
    rows = B.block_words(blocks).withColumn("part", F.pmod(F.xxhash64("word"), F.lit(parts)))
    # Dealt by part alone, which serves the windows over parts and those over words.
    rows = rows.repartition("part")
    # Sorted by a hash first: rows compare by one number, and by the word only where it ties.
    rows = rows.withColumn("key", F.xxhash64("word"))
    same = Window.partitionBy("key", "word", "part")
    rows = rows.withColumn("f", F.sum("n").over(same)).withColumn("is_first", F.min("block").over(same) == F.col("block"))
    rank = F.dense_rank().over(Window.partitionBy("part").orderBy(F.desc("f"), "key", "word")) - 1
    rows = rows.withColumn("number", rank * F.lit(parts) + F.col("part"))
    known = lambda c: F.when(F.col("f") > 0, F.col(c)).alias(c)
    return rows.select("block", "place", known("number"), known("f"), "is_first")


TOTALS = ["tokens", "words", "once", "twice", "top"]


def encoded_blocks(blocks: DataFrame, shard_tokens: int) -> tuple[DataFrame, dict]:
    """Blocks with their words' numbers and counts, and the model's totals."""
    size = blocks.agg(F.count(F.lit(1))).first()[0]
    found = numbered_words(blocks, max(64, size))
    first = F.col("is_first") & F.col("f").isNotNull()
    sums = [
        F.sum(F.when(first, F.col("f"))).alias("sum_tokens"),
        F.count_if(first).alias("sum_words"),
        F.count_if(first & (F.col("f") == 1)).alias("sum_once"),
        F.count_if(first & (F.col("f") == 2)).alias("sum_twice"),
        F.max("number").alias("sum_top"),
    ]
    # One list is gathered row by row with the other, so counts need no places of their own.
    counts = F.collect_list("f").alias("f")
    rows = B.with_columns_of(blocks, found, ["number"], counts, *sums)
    encoded = materialize(rows.select(*ENCODED, *(f"sum_{t}" for t in TOTALS)), "encoded", "zstd")
    total = encoded.agg(
        *(F.coalesce(F.sum(f"sum_{t}"), F.lit(0)).alias(t) for t in TOTALS[:-1]), F.coalesce(F.max("sum_top"), F.lit(-1)).alias("top")
    ).first()
    model = {
        "tokens": total.tokens,
        "words": total.words,
        "numbers": total.top + 1,
        "shards": max(1, -(-total.tokens // shard_tokens)),
        "shard_tokens": shard_tokens,
        "discount": (total.once + 0.5) / (total.once + 2 * total.twice + 1),
    }
    return encoded.select(*ENCODED), model


def grams(encoded: DataFrame, model: dict) -> DataFrame:
    """``GRAMS``: distinct triples (kind 0) of every block's training documents by shard, and
    pairs (kind 1) behind words that have several shards, for all of those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in encoded_rows(batches):
            w = Words(row, model)
            second, last = w.contexts()
            train = np.repeat(row["counted"], row["lengths"])
            # Places in the order of the words' numbers, so that packed keys sort by number.
            by_number = np.argsort(w.number, kind="stable")
            rank = np.empty_like(by_number)
            rank[by_number] = np.arange(len(by_number))
            size = len(by_number)
            b, a, c = (rank[x[train]] for x in (last, second, w.tokens))
            if size**3 < 1 << 63:
                key, n = np.unique((b * size + a) * size + c, return_counts=True)
                context = key // size
            else:
                contexts, which = np.unique(b * size + a, return_inverse=True)
                key, n = np.unique(which * size + c, return_counts=True)
                context = contexts[key // size]
            b, a, c = (by_number[x] for x in (context // size, context % size, key % size))
            yield from _sharded(w.shards_of(a, b), 0, w.number[a], w.number[b], w.number[c], n)
            wide = w.spread[b] > 1
            if wide.any():
                pair, at = np.unique(b[wide] * size + c[wide], return_inverse=True)
                n = np.bincount(at, weights=n[wide]).astype(np.int64)
                b, c = pair // size, pair % size
                copies = w.spread[b]
                share = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
                b, c, n = (np.repeat(x, copies) for x in (w.number[b], w.number[c], n))
                shard = w.shard(b, share)
                # Two shares of a word may fall into one shard.
                b, c, n, shard = _once(b, c, n, shard)
                yield from _sharded(shard, 1, np.zeros_like(b), b, c, n)

    return encoded.mapInArrow(run, GRAMS)


def _once(b: np.ndarray, c: np.ndarray, n: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.lexsort((c, b, shard))
    b, c, n, shard = b[order], c[order], n[order], shard[order]
    new = np.r_[True, (b[1:] != b[:-1]) | (c[1:] != c[:-1]) | (shard[1:] != shard[:-1])]
    return b[new], c[new], n[new], shard[new]


def _sharded(shard: np.ndarray, kind: int, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    # Narrow whole numbers are sorted by their digits.
    order = np.argsort(shard.astype(np.min_scalar_type(shard.max(initial=0))), kind="stable")
    shard = shard[order]
    for part, of in zip(np.split(order, np.flatnonzero(np.diff(shard)) + 1), np.unique(shard).tolist()):
        values = (of, kind, *(B.packed(x[part]) for x in columns))
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _GRAMS.types)], schema=_GRAMS)


def _added(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    if not len(key):
        return key, n
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(n[order], first)


def shard_arrays(triples: tuple[np.ndarray, ...], wide: tuple[np.ndarray, ...], universe: int) -> dict[str, np.ndarray]:
    """The levels of one shard from ``(a, b, c, n)`` of triples and of pairs."""
    a, b, c, n = triples
    middle = np.unique(np.r_[b, wide[1]])
    at = np.searchsorted(middle, b)
    contexts, of = np.unique(at * universe + a, return_inverse=True)
    key, n = _added(of * universe + c, n)
    of, c = key // universe, key % universe
    at = contexts[of] // universe
    # Pairs behind a word with several shards are counted over all of them.
    apart = np.isin(middle, wide[1])
    mine = ~apart[at] if len(at) else np.zeros(0, bool)
    pairs = np.r_[at[mine] * universe + c[mine], np.searchsorted(middle, wide[1]) * universe + wide[2]]
    pairs, pair_n = _added(pairs, np.r_[n[mine], wide[3]])
    pair_at = pairs // universe
    total = np.bincount(pair_at, weights=pair_n, minlength=len(middle))
    fan = np.bincount(pair_at, minlength=len(middle))
    first = np.cumsum(fan) - fan
    context_n = np.bincount(of, weights=n, minlength=len(contexts))
    keep = n >= LEAST_TRIPLE
    of, c, n = of[keep], c[keep], n[keep]
    share = (n - DISCOUNT) / context_n[of]
    left = 1 - np.bincount(of, weights=share, minlength=len(contexts))
    used, of = np.unique(of, return_inverse=True)
    contexts = contexts[used]
    context_at = contexts // universe
    slots = np.cumsum(fan[context_at]) - fan[context_at]
    place = np.searchsorted(pairs, context_at[of] * universe + c) - first[context_at[of]]
    return {
        "middle": middle,
        "middle_left": code(DISCOUNT * fan / np.maximum(total, 1)),
        "pair_share": code((pair_n - DISCOUNT) / total[pair_at]),
        "context_left": code(np.maximum(left[used], 2.0**-60)),
        "triple_share": code(share),
        **Sequence.arrays(first, "first"),
        **Sequence.arrays(pairs, "pairs"),
        **Sequence.arrays(contexts, "contexts"),
        **Sequence.arrays(slots, "slots"),
        **Sequence.arrays(slots[of] + place, "triples"),
    }


def build(packed: DataFrame, folder: str, model: dict) -> list[int]:
    """Writes one file per shard; returns the shards there are: a number per shard."""
    universe = model["numbers"] + 1

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        grams = {0: [[], [], [], []], 1: [[], [], [], []]}
        for row in rows.to_pylist():
            for part, name in zip(grams[row["kind"]], "abcn"):
                part.append(B.unpacked(row[name]))
        arrays = [tuple(np.concatenate(p) if p else np.zeros(0, np.int64) for p in grams[k]) for k in (0, 1)]
        shard = key[0].as_py()
        data = to_bytes(shard_arrays(*arrays, universe))
        files, path = _filesystem(folder)
        files.create_dir(path, recursive=True)
        # Every attempt writes the same bytes; a name appears only when its file is whole.
        draft = f"{path}/draft-{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as out:
            out.write(data)
        files.move(draft, f"{path}/shard-{shard:09d}")
        return pa.table({"shard": [shard], "bytes": [len(data)]})

    made = packed.groupBy("shard").applyInArrow(run, "shard long, bytes long")
    return [r.shard for r in materialize(made, "shards").select("shard").collect()]


def _located(sequence: Sequence, values: np.ndarray) -> np.ndarray:
    """Equal values are looked up once, in order."""
    distinct, which = np.unique(values, return_inverse=True)
    return sequence.locate(distinct)[which]


class Shard:
    """One shard's levels, looked up for many triples at once."""

    def __init__(self, arrays: dict[str, np.ndarray], universe: int):
        self.arrays, self.universe = arrays, universe
        for name in ("first", "pairs", "contexts", "slots", "triples"):
            setattr(self, name, Sequence(arrays, name))
        # As many as there are middle words; asked for with every token.
        self.start = self.first.get(np.arange(self.first.n))

    def shares(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
        """Share and what is left at the triple's context, then at the pair's."""
        held, universe = self.arrays, self.universe
        triple, context_left = np.zeros(len(b)), np.ones(len(b))
        pair, middle_left = np.zeros(len(b)), np.ones(len(b))
        at = np.searchsorted(held["middle"], b)
        known = np.flatnonzero(at < len(held["middle"]))
        known = known[held["middle"][at[known]] == b[known]]
        middle_left[known] = decoded(held["middle_left"][at[known]])
        met = known[(c[known] >= 0)]
        place = _located(self.pairs, at[met] * universe + c[met])
        met, place = met[place >= 0], place[place >= 0]
        pair[met] = decoded(held["pair_share"][place])
        relative = np.full(len(b), -1, np.int64)
        relative[met] = place - self.start[at[met]]
        known = known[a[known] >= 0]
        distinct, which = np.unique(at[known] * universe + a[known], return_inverse=True)
        context = self.contexts.locate(distinct)
        held_by = context >= 0
        slots = np.zeros(len(distinct), np.int64)
        slots[held_by] = self.slots.get(context[held_by])
        known, which = known[held_by[which]], which[held_by[which]]
        context_left[known] = decoded(held["context_left"][context[which]])
        both = relative[known] >= 0
        known, which = known[both], which[both]
        slot = _located(self.triples, slots[which] + relative[known])
        triple[known[slot >= 0]] = decoded(held["triple_share"][slot[slot >= 0]])
        return triple, context_left, pair, middle_left


@lru_cache(maxsize=OPEN_SHARDS)
def open_shard(folder: str, shard: int, universe: int) -> Shard:
    from pyarrow import fs

    files, path = _filesystem(folder)
    name = f"{path}/shard-{shard:09d}"
    if isinstance(files, fs.LocalFileSystem):
        data = np.memmap(name, np.uint8, "r")
    else:
        copy = tempfile.TemporaryFile()
        with files.open_input_stream(name) as source:
            while part := source.read(8 << 20):
                copy.write(part)
        copy.flush()
        data = np.memmap(copy, np.uint8, "r")
    return Shard(from_buffer(data), universe)


def scores(encoded: DataFrame, folder: str, shards: list[int], model: dict, id: str, kind: str) -> DataFrame:
    n, vocabulary, discount = model["tokens"], model["words"], model["discount"]
    # One number per shard, that is per SHARD_TOKENS tokens of the corpus.
    present = encoded.sparkSession.sparkContext.broadcast(set(shards))
    unknown = discount * vocabulary / n if n else 1.0
    columns = f"`{id}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in encoded_rows(batches):
            w = Words(row, model)
            second, last = w.contexts()
            count = w.count[w.tokens]
            single = np.where(count > 0, (count - discount) / max(n, 1), unknown)
            p = single.copy()
            shard = np.where(w.number[last] >= 0, w.shards_of(second, last), -1)
            # By shard and middle word, so that neighbours ask for neighbouring places.
            order = np.argsort(shard * model["numbers"] + w.number[last])
            for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                of = int(shard[part[0]])
                if of not in present.value:
                    continue
                held = open_shard(folder, of, model["numbers"] + 1)
                for at in np.split(part, range(QUERY, len(part), QUERY)):
                    numbers = (w.number[x[at]] for x in (second, last, w.tokens))
                    triple, context_left, pair, middle_left = held.shares(*numbers)
                    p[at] = triple + context_left * (pair + middle_left * single[at])
            base = np.log10((count + 1) / (n + vocabulary + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    row["docs"].cast(pa.int64()),
                    pa.array(~row["counted"].astype(bool)),
                    pa.array(row["lengths"]),
                    pa.array(np.add.reduceat((count > 0).astype(np.int64), w.starts)),
                    pa.array(np.full(len(w.starts), n, np.int64)),
                    pa.array(np.add.reduceat(base, w.starts)),
                    pa.array(np.add.reduceat(np.log10(p), w.starts)),
                ],
                names=[id, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return encoded.select(*ENCODED).mapInArrow(run, columns)


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of jobs that have ended and been written.

    It does so when the driver's garbage is collected, which a driver that does little
    work may put off until the disks are full.
    """
    spark.sparkContext._jvm.System.gc()


def score_documents(
    docs: DataFrame, id: str = "doc_id", text: str = "text", folds: int = 7, held_out: int = 2, shard_tokens: int = SHARD_TOKENS
) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row."""
    name = F.coalesce(F.col(id).cast("string"), F.lit(""))
    train = F.crc32(name.cast("binary")) % folds != held_out
    made = B.tokenized(docs.select(id, text), F.lit(""), F.col(id), train, F.col(text), words_of, END)
    blocks = materialize(made, "blocks", "zstd")
    encoded, model = encoded_blocks(blocks, shard_tokens)
    release(docs.sparkSession)
    folder = scratch_path(docs.sparkSession, "model")
    shards = build(grams(encoded, model), folder, model) if model["tokens"] else []
    release(docs.sparkSession)
    return scores(encoded, folder, shards, model, id, "long")
