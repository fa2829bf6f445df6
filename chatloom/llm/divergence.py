"""Divergence of sources by their words: every pair of sources, and each against its language.

Terms are runs of letters and characters beyond ASCII, only A-Z lower-cased. A language
keeps the terms that at least ``MIN_DOCS`` of its documents hold, ``V`` of them. A group is
a (lang, source); a group and a language give each kept term the integer weight
``p = 1 + floor(SCALE * (count + 1) / (N + V))``. The divergence of p from q at one term is
``floor((p - q)^2 / q)``, all in whole numbers.

Sums over all kept terms need no row for a term that neither side holds. With ``z`` the
weight of a count of zero, the sum of a group g against a peer s is

    V f(z_g, z_s) + sum over terms of g of f(p_g, z_s) - f(z_g, z_s)
                  + sum over terms of s of f(z_g, p_s) - f(z_g, z_s)
                  + sum over terms of both of f(p_g, p_s) - f(p_g, z_s) - f(z_g, p_s) + f(z_g, z_s)

The first line and the two corrections depend on how often each weight occurs, so they come
from one histogram per group. The last sum is Gustavson's row accumulation: terms are dealt
into buckets, a task indexes the terms of a bucket (term-major, with the peers that hold
each), and every group scatters its terms through the index into a dense accumulator with
one cell per peer. A bucket gives one row per pair of groups, never one per pair of postings.

Texts are read once; what moves is one row per (lang, source, term) of a task, so a hot
source is added up before it moves, and a hot term has at most one row per source. One row
holds the peers of a language: as many as the pairs asked for have sources.

Defined results: null text, lang and source are ``''``, and ``''`` is a group as any other; a
group without terms is paired with count zero everywhere; a language without kept terms has
values of 0; equal rows count as often as they stand; ties rank by the item's UTF-8 bytes;
texts of any length are counted whole; an empty table gives an empty result. Other columns
are never read, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.common import materialize

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
FLUSH_TERMS = 300_000  # entries a task holds before it passes them on
BUCKET_POSTINGS = 500_000
STEP = 1 << 20  # scattered cells at a time

# A-Z lower-cased, every byte that belongs to no term a blank.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
GROUP = ["lang", "source"]


def term_counts(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """``(lang, source, term, n, n_docs)``: occurrences and documents of every term."""
    schema = pa.schema(
        [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("n_docs", pa.int64())]
    )

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        for (of_lang, of_source), (n, n_docs) in held.items():
            if n:
                terms = [t.decode() for t in n]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([of_lang] * len(n), pa.string()),
                        pa.array([of_source] * len(n), pa.string()),
                        pa.array(terms, pa.string()),
                        pa.array(n.values(), pa.int64()),
                        pa.array(map(n_docs.__getitem__, n), pa.int64()),
                    ],
                    schema=schema,
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for of_lang, of_source, t in zip(*(batch.column(i) for i in range(3))):
                n, n_docs = held.setdefault((of_lang.as_py(), of_source.as_py()), (Counter(), Counter()))
                words = t.as_py().encode().translate(TERM_BYTES).split()
                size -= len(n)
                n.update(words)
                n_docs.update(set(words))
                size += len(n)
                if size > FLUSH_TERMS:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    text_of = [F.coalesce(F.col(c), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))]
    found = docs.select(*text_of).mapInArrow(run, "lang string, source string, term string, n long, n_docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def weight(n: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(SCALE * (n + 1) / (total + kept))`` in exact arithmetic."""
    above = (n + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = F.greatest(total + kept, F.lit(1)).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


def gap(p, q):
    """``floor((p - q)^2 / q)`` of whole numbers below 2**31."""
    return (p - q) ** 2 // q


def groups_of(docs: DataFrame, kept: DataFrame, lang: str, source: str) -> DataFrame:
    """Every group with its ``total``, its language's ``lang_total`` and ``kept`` terms, and
    the weight ``z`` of a count of zero."""
    names = [F.coalesce(F.col(c), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"))]
    totals = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count_if("is_first").alias("firsts")
    )
    # Each kept term counts once for its language: at the first source that holds it.
    per_lang = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("firsts").alias("kept"))
    groups = docs.select(*names).distinct().join(totals.drop("firsts"), GROUP, "left").join(per_lang, "lang", "left")
    groups = groups.na.fill(0, ["total", "lang_total", "kept"])
    return groups.withColumn("z", weight(F.lit(0), F.col("total"), F.col("kept")))


def baselines(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value)``: the sums as if no term were shared by two groups."""
    weights = postings.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("k"))
    weights = weights.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "k")).alias("weights"))
    peers = groups.groupBy("lang").agg(F.collect_list(F.struct("source", "z")).alias("peers"))
    rows = groups.join(weights, GROUP, "left").join(peers, "lang")
    rows = rows.select("lang", "source", "z", "kept", "weights.p", "weights.k", "peers.source", "peers.z")
    rows = rows.toDF("lang", "source", "z", "kept", "ps", "ks", "peers", "zs")
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                of_lang, me, z, kept, ps, ks, peers, zs = (c[row].as_py() for c in batch.columns)
                zs = np.array(zs, np.int64)
                forth = kept * gap(z, zs)
                back = np.zeros(len(zs), np.int64)
                for p, k in zip(ps or (), ks or ()):
                    forth += k * (gap(p, zs) - gap(z, zs))
                    back += k * (gap(zs, p) - gap(zs, z))
                others = [i for i, s in enumerate(peers) if s != me]
                names = [peers[i] for i in others]
                if others:
                    same, lang_of = [me] * len(others), [of_lang] * len(others)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lang_of), pa.array(same), pa.array(names), pa.array(forth[others])], schema=schema
                    )
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lang_of), pa.array(names), pa.array(same), pa.array(back[others])], schema=schema
                    )

    return rows.mapInArrow(run, "lang string, source string, item string, value long")


def accumulate(term: np.ndarray, group: np.ndarray, p: np.ndarray, z: np.ndarray, n_groups: int) -> np.ndarray:
    """What shared terms add to each pair of groups, as a matrix of group by peer.

    ``term`` and ``group`` are codes from 0, one posting each; ``z`` has a weight a group.
    """
    order = np.argsort(term, kind="stable")
    term, group, p = term[order], group[order], p[order]
    begin = np.searchsorted(term, np.arange(term[-1] + 2 if len(term) else 1))
    cells = np.zeros((n_groups, n_groups), np.int64)
    rows = np.argsort(group, kind="stable")
    for mine in np.split(rows, np.flatnonzero(np.diff(group[rows])) + 1):
        size = np.diff(begin)[term[mine]]
        for part in np.split(mine, np.flatnonzero(np.diff(np.cumsum(size) // STEP)) + 1):
            if not len(part):
                continue
            g = group[part[0]]
            width = np.diff(begin)[term[part]]
            # The index rows of all terms of this group, one behind the other.
            at = np.repeat(begin[term[part]] - np.r_[0, np.cumsum(width)[:-1]], width) + np.arange(width.sum())
            peer, p_s, p_g = group[at], p[at], np.repeat(p[part], width)
            z_s = z[peer]
            np.add.at(cells[g], peer, gap(p_g, p_s) - gap(p_g, z_s) - gap(z[g], p_s) + gap(z[g], z_s))
    np.fill_diagonal(cells, 0)
    return cells


def shared_terms(postings: DataFrame) -> DataFrame:
    """``(lang, source, item, value)``: what shared terms add, one row per bucket and pair."""
    buckets = max(1, -(-postings.count() // BUCKET_POSTINGS))
    dealt = postings.select(
        "lang", F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("bucket"), "term", "source", "p", "z"
    )

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        term = rows["term"].combine_chunks().dictionary_encode().indices.to_numpy()
        named = rows["source"].combine_chunks().dictionary_encode()
        group, names = named.indices.to_numpy(), named.dictionary.to_pylist()
        z = np.zeros(len(names), np.int64)
        z[group] = rows["z"].to_numpy()
        cells = accumulate(term.astype(np.int64), group.astype(np.int64), rows["p"].to_numpy(), z, len(names))
        at, to = np.nonzero(cells)
        return pa.table(
            {
                "lang": pa.array([key[0].as_py()] * len(at), pa.string()),
                "source": pa.array([names[i] for i in at], pa.string()),
                "item": pa.array([names[i] for i in to], pa.string()),
                "value": pa.array(cells[at, to], pa.int64()),
            }
        )

    return dealt.groupBy("lang", "bucket").applyInArrow(run, "lang string, source string, item string, value long")


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``(lang, source, part, item, value, rank)``: in part ``pair`` every other source of the
    language, in part ``term`` the ``TOP_TERMS`` terms a source has most above its language."""
    counts = materialize(term_counts(docs, lang, source, text), "term_counts")
    of_term = Window.partitionBy("lang", "term")
    kept = (
        counts.withColumn("lang_docs", F.sum("n_docs").over(of_term))
        .withColumn("lang_n", F.sum("n").over(of_term))
        .withColumn("is_first", F.min("source").over(of_term) == F.col("source"))
        .where(F.col("lang_docs") >= MIN_DOCS)
        .select("lang", "source", "term", "n", "lang_n", "is_first")
    )
    kept = materialize(kept, "kept_terms")
    groups = materialize(groups_of(docs, kept, lang, source), "groups")
    postings = kept.join(groups, GROUP).select(
        *GROUP,
        "term",
        weight(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        weight(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
        "z",
    )
    postings = materialize(postings, "postings")
    pairs = baselines(postings, groups).unionByName(shared_terms(postings))
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    terms = postings.where("p > q").select(*GROUP, F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div q").alias("value"))
    ranked = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    rank = F.row_number().over(ranked)
    top = terms.withColumn("rank", rank).where(F.col("rank") <= TOP_TERMS)
    return (
        pairs.withColumn("rank", rank)
        .withColumn("part", F.lit("pair"))
        .unionByName(top.withColumn("part", F.lit("term")))
        .select(*GROUP, "part", "item", "value", "rank")
    )
