"""Nearest neighbours by multiprobe p-stable hashing.

A table of the index hashes a vector by ``functions`` Gaussian projections, each cut
into cells of equal width. A near vector differs from the query by a normal amount in
each projection, so the chance that it lies in a cell follows from the query's place and
its distance; a bucket's chance is the product over its cells. A query visits buckets in
descending order of that chance until their chances add up to ``mass``, in each of
``tables`` tables; the candidates of all tables are merged and ranked by exact inner
products in double precision.

The largest inner product is turned into the least distance by a further coordinate
that gives all vectors the same length. The cell width follows the distance of a k-th
neighbour, estimated on at most ``SAMPLE`` vectors and ``SAMPLE_QUERIES`` of the queries
(every vector is indexed).

Buckets and the queries that visit them are cut into blocks of bounded size, so that a
common bucket is many rows of work. Of equal vectors only the ``k + 1`` with the least
ids are indexed; the others cannot be among a query's first k.

Defined results: vectors that are null, zero, of another length than most, or hold a
null or a value that is not finite take no part, nor do null ids. A row is never its own neighbour; rows
with equal ids count as one row. A query that finds fewer than k (or than there are
candidates) is compared with every vector. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product
from math import erf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.common import materialize, mix64

TABLES, FUNCTIONS, CELLS = 3, 6, 4
WIDTH, MASS = 1.6, 0.6
SAMPLE, SAMPLE_QUERIES = 8000, 200
SEED = 7
VECTOR_BLOCK, QUERY_BLOCK = 256, 256
BUFFER_ROWS = 400_000

_PHI = np.vectorize(lambda x: 0.5 * (1 + erf(x / 2**0.5)), otypes=[float])
_GRID = np.linspace(-9, 9, 4001)
_GRID_PHI = _PHI(_GRID)


def normal_cdf(x: np.ndarray) -> np.ndarray:
    return np.interp(x, _GRID, _GRID_PHI)


@dataclass(frozen=True)
class Hashing:
    """Projections and cell width of all tables."""

    projections: np.ndarray  # table, coordinate, function
    shifts: np.ndarray  # table, function
    width: float
    radius: float
    longest: float

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors scaled below length 1 and brought to length 1 by one more coordinate."""
        x = vectors / self.longest
        rest = np.sqrt(np.maximum(1 - (x * x).sum(axis=1), 0))
        return np.column_stack([x, rest])

    def directions(self, queries: np.ndarray) -> np.ndarray:
        q = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        return np.column_stack([q, np.zeros(len(q))])

    def places(self, points: np.ndarray, table: int) -> np.ndarray:
        return (points @ self.projections[table] + self.shifts[table]) / self.width

    def keys(self, cells: np.ndarray) -> np.ndarray:
        """One 64-bit key for the cells of a bucket (last axis)."""
        key = np.zeros(cells.shape[:-1], np.uint64)
        for j in range(cells.shape[-1]):
            key = mix64(key ^ cells[..., j].astype(np.int64).view(np.uint64), j)
        return key.view(np.int64)

    def probes(self, queries: np.ndarray, table: int, mass: float) -> tuple[np.ndarray, np.ndarray]:
        """Row of the query and key of the bucket for all visits, likeliest first."""
        place = self.places(self.directions(queries), table)
        offsets = np.arange(-CELLS + 1, CELLS)
        cell = np.floor(place)[:, :, None] + offsets
        scale = self.width / self.radius
        chance = normal_cdf((cell + 1 - place[:, :, None]) * scale) - normal_cdf((cell - place[:, :, None]) * scale)
        likely = np.argsort(-chance, axis=2)[:, :, :CELLS]
        chance, cell = np.take_along_axis(chance, likely, 2), np.take_along_axis(cell, likely, 2)
        combos = np.array(list(product(range(CELLS), repeat=place.shape[1])))
        rows, keys = [], []
        for i in range(len(queries)):
            success = np.ones(len(combos))
            for j in range(place.shape[1]):
                success *= chance[i, j, combos[:, j]]
            order = np.argsort(-success, kind="stable")
            visits = order[: np.searchsorted(np.cumsum(success[order]), mass) + 1]
            cells = np.stack([cell[i, j, combos[visits, j]] for j in range(place.shape[1])], axis=1)
            rows.append(np.full(len(visits), i))
            keys.append(self.keys(cells))
        return np.concatenate(rows), np.concatenate(keys)


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """``(id, v)`` of the rows that take part, ``v`` as doubles."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id).cast("bigint").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()
    )
    return rows.where(finite & F.exists("v", lambda x: x != 0)).dropDuplicates(["id"])


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def blobs(rows: np.ndarray) -> pa.Array:
    raw, width = np.ascontiguousarray(rows, "<f8").tobytes(), rows.shape[1] * 8
    return pa.array([raw[i : i + width] for i in range(0, len(raw), width)], pa.binary())


def estimated_radius(stored: DataFrame, queries: DataFrame, n: int, k: int, longest: float) -> float:
    """Median distance of the k-th neighbour, after lifting, from bounded samples."""
    some = lambda df, total, most: np.array(
        [r.v for r in df.where(F.pmod(F.xxhash64("id"), F.lit(max(1, total // most))) == 0).limit(2 * most).collect()]
    )
    seen = some(stored, n, SAMPLE)
    asked = some(queries, queries.count(), SAMPLE_QUERIES)
    if len(seen) < 2 or not len(asked):
        return 1.0
    asked = asked / np.linalg.norm(asked, axis=1, keepdims=True)
    near = np.sort(asked @ seen.T / longest, axis=1)[:, ::-1]
    # Rank 0 may be the query itself; in a sample the k-th neighbour has a lower rank.
    rank = min(max(1, round(k * len(seen) / n)), near.shape[1] - 1)
    distance = np.sqrt(np.maximum(2 - 2 * np.median(near[:, rank]), 0))
    return float(np.clip(distance, 0.05, 2.0))


def in_blocks(rows: DataFrame, id: str, size: int) -> DataFrame:
    """Rows of a bucket gathered into blocks of about ``size``."""
    counts = rows.groupBy("part", "key").agg(F.ceil(F.count(F.lit(1)) / size).alias("blocks"))
    block = F.pmod(F.xxhash64(id), F.col("blocks"))
    return (
        rows.join(counts, ["part", "key"])
        .groupBy("part", "key", block.alias("block"))
        .agg(F.collect_list(F.struct(F.col(id).alias("id"), "v")).alias("rows"))
        .select("part", "key", F.col("rows.id").alias(f"{id}s"), F.col("rows.v").alias(f"{id}_vectors"))
    )


def best_of(query: np.ndarray, found: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best of each query, a found id once, ties to the smaller id."""
    order = np.lexsort((found, -score, query))
    query, found, score = query[order], found[order], score[order]
    again = np.zeros(len(query), bool)
    # The same pair has the same score whichever block it came from.
    again[1:] = (query[1:] == query[:-1]) & (found[1:] == found[:-1])
    query, found, score = query[~again], found[~again], score[~again]
    first = np.searchsorted(query, query, "left")
    keep = np.arange(len(query)) - first < k
    return query[keep], found[keep], score[keep]


def score_blocks(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The k best of every query among the blocks of one task."""
    held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    parts: list[list[np.ndarray]] = [held]
    size = 0

    def merged() -> list[np.ndarray]:
        return list(best_of(*[np.concatenate(c) for c in zip(*parts)], k))

    for batch in batches:
        for row in range(batch.num_rows):
            ids, vectors, asked, questions = (batch.column(c)[row].as_py() for c in range(4))
            x = np.frombuffer(b"".join(vectors)).reshape(len(ids), -1)
            q = np.frombuffer(b"".join(questions)).reshape(len(asked), -1)
            ids, asked = np.array(ids), np.array(asked)
            score = q @ x.T
            score[asked[:, None] == ids] = -np.inf
            if len(ids) > k:
                edge = -np.partition(-score, k - 1, axis=1)[:, k - 1 : k]
                a, b = np.nonzero((score >= edge - 1e-9 * (1 + np.abs(edge))) & np.isfinite(score))
            else:
                a, b = np.nonzero(np.isfinite(score))
            # Summed row by row, so that a pair's score does not depend on its block.
            exact = (q[a] * x[b]).sum(axis=1)
            parts.append([asked[a], ids[b], exact])
            size += len(a)
            if size > BUFFER_ROWS:
                held = merged()
                parts, size = [held], 0
    query, found, score = merged()
    for at in range(0, len(query), 50_000):
        cut = slice(at, at + 50_000)
        yield pa.RecordBatch.from_pydict({"query_id": query[cut], "vec_id": found[cut], "score": score[cut]})


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    mass: float = MASS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k found with the largest inner products.

    ``is_query`` is a condition on the column ``id`` of the given table.
    """
    rows = materialize(usable(vectors, id, vector).withColumn("n", F.size("v")), "vectors")
    result = "query_id long, vec_id long, score double"
    common = rows.groupBy("n").count().orderBy(F.desc("count"), "n").first()
    if common is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.col("n") == common.n).select("id", "v")
    same = Window.partitionBy("v").orderBy("id")
    stored = materialize(
        rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1).select("id", "v"), "stored"
    )
    queries = rows.withColumnRenamed("id", id).where(is_query).withColumnRenamed(id, "id")
    n = stored.count()
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    longest = stored.agg(F.max(length)).first()[0]
    radius = estimated_radius(stored, queries, n, k, longest)
    rng = np.random.default_rng(SEED)
    width = WIDTH * radius
    hashing = Hashing(
        rng.normal(size=(tables, common.n + 1, FUNCTIONS)), rng.uniform(0, width, (tables, FUNCTIONS)), width, radius, longest
    )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch.column(1))
                points, raw = hashing.lifted(v), blobs(v)
                for table in range(tables):
                    key = hashing.keys(np.floor(hashing.places(points, table)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(key), table), pa.int32()), pa.array(key), batch.column(0), raw],
                        names=["part", "key", "vec_id", "v"],
                    )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                v = matrix(part.column(1))
                ids, raw = part.column(0), blobs(v)
                for table in range(tables):
                    row, key = hashing.probes(v, table, mass)
                    row = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(key), table), pa.int32()), pa.array(key), ids.take(row), raw.take(row)],
                        names=["part", "key", "query_id", "v"],
                    )

    def compare(visits: DataFrame) -> DataFrame:
        asked = in_blocks(visits, "query_id", QUERY_BLOCK)
        met = blocks.join(asked, ["part", "key"])
        met = met.select("vec_ids", "vec_id_vectors", "query_ids", "query_id_vectors")
        found = met.mapInArrow(lambda batches: score_blocks(batches, k), result)
        ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return (
            found.groupBy("query_id", "vec_id")
            .agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(ranked))
            .where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score")
        )

    indexed = stored.mapInArrow(index, "part int, key long, vec_id long, v binary")
    blocks = materialize(in_blocks(indexed, "vec_id", VECTOR_BLOCK), "index")
    visits = queries.mapInArrow(probe, "part int, key long, query_id long, v binary")
    found = materialize(compare(visits), "found")
    counts = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_found"))
    others = min(k, n - 1)
    short = queries.join(counts, F.col("id") == F.col("query_id"), "left").where(
        F.coalesce("n_found", F.lit(0)) < others
    )
    short = materialize(short.select("id", "v"), "short")
    if short.isEmpty():
        return found

    def everywhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(batch.num_rows), pa.int32()), batch.column(0), blobs(matrix(batch.column(1)))],
                    names=["part", "query_id", "v"],
                )

    # These queries visit all buckets of the first table.
    buckets = blocks.where("part = 0").select("part", "key").distinct()
    all_visits = short.mapInArrow(everywhere, "part int, query_id long, v binary").join(buckets, "part")
    full = compare(all_visits.select("part", "key", "query_id", "v"))
    return found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(full)
