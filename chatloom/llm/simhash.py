"""SimHash near-duplicates by the generalised pigeonhole principle.

Two fingerprints within ``tau`` bits, cut into m parts with thresholds that add up to
``tau - m + 1``, are within the threshold of at least one part (a threshold of -1
leaves a part out). Correlated bits are grouped into the same part. Each fingerprint
chooses its own thresholds: counts of how often each part's values occur estimate the
candidates a threshold would bring, and dynamic programming finds the cheapest
allocation, so that a part whose value is common is left to the others. It then probes
every value within a part's threshold and every candidate is verified on all bits.

Equal fingerprints are one node throughout, so copies are never paired; links between
different fingerprints are all found. Components are their transitive closure.

Defined results: a null or empty text has fingerprint 0 and links like any other; a
text of fewer words than the shingle is one shingle; rows with equal ids are rows of
their own; the component of rows that have only null ids is null; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import LOWER, materialize, mix64
from chatloom.llm.components import connected_components
from chatloom.llm.sums import array_sum

SEED = 42
CELLS = 1 << 14
COUNT_ROWS = 1 << 15
PROBE_COST = 1.0


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """XXH64 of every shingle of A-Z-lower-cased words, repeats included."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = list(accumulate(map(len, words), lambda at, n: at + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1 :])]
    return np.array(hashes, np.uint64)


def bit_matrix(values: np.ndarray) -> np.ndarray:
    """Bits of unsigned 64-bit values, least significant first."""
    rows = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(len(values), 8)
    return np.unpackbits(rows, axis=1, bitorder="little")


def from_bits(bits: np.ndarray) -> int:
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, width: int = 3) -> int:
    """A bit is set if it is set in over half of the shingles' hashes."""
    hashes = shingle_hashes(text or "", width)
    if not len(hashes):
        return 0
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), COUNT_ROWS):
        count += bit_matrix(hashes[at : at + COUNT_ROWS]).sum(axis=0, dtype=np.int64)
    return from_bits(2 * count > len(hashes))


def signed(values: np.ndarray) -> np.ndarray:
    return np.asarray(values, np.uint64).view(np.int64)


def fingerprints(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3
) -> DataFrame:
    """``(id, fingerprint)``, the fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(t, width) for t in batch.column(1).to_pylist()]
            made = pa.array(signed(np.array(made, np.uint64)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), made], names=[id, "fingerprint"])

    kind = dict(docs.dtypes)[id]
    return docs.select(id, text).mapInArrow(run, f"`{id}` {kind}, fingerprint long")


def bit_groups(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """64 bits in ``parts`` groups of near equal size, correlated bits together.

    ``both[i, j]`` counts the fingerprints with bits i and j set. A group starts with
    the bit most correlated to any other that is left and takes in, one by one, the
    bit most correlated to those it has.
    """
    share = both / max(n, 1)
    mean = np.diag(share)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    corr = np.abs((share - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    left, groups = list(range(64)), []
    for part in range(parts):
        size = len(left) // (parts - part)
        first = max(left, key=lambda i: (max((corr[i, j] for j in left), default=0), -i))
        group = [first]
        left.remove(first)
        while len(group) < size:
            nearest = max(left, key=lambda i: (corr[i, group].sum(), -i))
            group.append(nearest)
            left.remove(nearest)
        groups.append(sorted(group))
    return groups


def part_values(fps: np.ndarray, groups: list[list[int]]) -> list[np.ndarray]:
    """Each part's bits gathered into one integer per fingerprint."""
    fps, out = np.asarray(fps).view(np.uint64), []
    for group in groups:
        value = np.zeros(len(fps), np.uint64)
        for k, bit in enumerate(group):
            value |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
        out.append(value)
    return out


def cell_of(values: np.ndarray) -> np.ndarray:
    return (mix64(values) & np.uint64(CELLS - 1)).astype(np.int64)


def allocate(costs: np.ndarray, tau: int) -> np.ndarray:
    """Thresholds per row and part by dynamic programming.

    ``costs[row, part, t + 1]`` is the estimate for threshold t from -1 to ``tau``.
    Thresholds of a row add up to ``tau - parts + 1`` at the least total cost.
    """
    rows, parts, _ = costs.shape
    # With u = t + 1 of 0 .. tau + 1, the sum of u is tau + 1.
    most = tau + 1
    best = np.full((rows, most + 1), np.inf)
    best[:, 0] = 0
    choice = np.zeros((parts, rows, most + 1), np.int64)
    for part in range(parts):
        new = np.full((rows, most + 1), np.inf)
        for total in range(most + 1):
            for u in range(total + 1):
                cost = best[:, total - u] + costs[:, part, u]
                better = cost < new[:, total]
                new[better, total] = cost[better]
                choice[part, better, total] = u
        best = new
    total = np.full(rows, most)
    out = np.zeros((rows, parts), np.int64)
    for part in reversed(range(parts)):
        out[:, part] = choice[part, np.arange(rows), total]
        total -= out[:, part]
    return out - 1


def flips(bits: int, errors: int) -> np.ndarray:
    """Masks of exactly ``errors`` of ``bits`` bits."""
    masks = [sum(1 << i for i in c) for c in combinations(range(bits), errors)]
    return np.array(masks, np.uint64)


def estimated_costs(
    values: list[np.ndarray], groups: list[list[int]], counts: np.ndarray, tau: int
) -> np.ndarray:
    """Probes plus expected candidates of thresholds -1 .. tau, cumulative in the threshold.

    Up to one error the counts of all probed cells are added up; beyond, every probe
    counts as an average one.
    """
    rows = len(values[0])
    costs = np.zeros((rows, len(groups), tau + 2))
    for part, (value, group) in enumerate(zip(values, groups)):
        average = counts[part].sum() / CELLS
        total = np.zeros(rows)
        for errors in range(tau + 1):
            masks = flips(len(group), errors)
            if errors <= 1:
                for mask in masks:
                    total = total + PROBE_COST + counts[part][cell_of(value ^ mask)]
            else:
                total = total + len(masks) * (PROBE_COST + average)
            costs[:, part, errors + 1] = total
    return costs


def best_parts(n: int, tau: int) -> int:
    """The number of parts with the least work per fingerprint if bits were even.

    Few fingerprints make probes dear and candidates rare, which favours many parts;
    with many fingerprints only long parts keep buckets small.
    """

    def work(parts: int) -> float:
        costs = np.zeros((1, parts, tau + 2))
        for part in range(parts):
            bits = (64 + part) // parts
            per_probe = PROBE_COST + n / 2.0**bits
            costs[0, part, 1:] = np.cumsum([comb(bits, e) * per_probe for e in range(tau + 1)])
        chosen = allocate(costs, tau)[0]
        return sum(costs[0, part, t + 1] for part, t in enumerate(chosen))

    return min(range(1, tau + 3), key=work)


def link_pairs(distinct: DataFrame, tau: int, parts: int | None = None) -> DataFrame:
    """All pairs ``a < b`` of different fingerprints within ``tau`` bits, each once.

    The number of parts follows the number of fingerprints unless given. What reaches the driver is of fixed size: 64 x 64 counts of bits set together and
    ``CELLS`` counts per part, both over all fingerprints.
    """

    def together(batch: pa.RecordBatch) -> np.ndarray:
        bits = bit_matrix(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)).astype(np.float32)
        return bits.T @ bits

    both, n = array_sum(distinct, together, (64, 64)), distinct.count()
    parts = parts or best_parts(n, tau)
    groups = bit_groups(both, n, parts)

    def cells(batch: pa.RecordBatch) -> np.ndarray:
        values = part_values(batch.column(0).to_numpy(zero_copy_only=False), groups)
        return np.stack([np.bincount(cell_of(v), minlength=CELLS) for v in values])

    counts = array_sum(distinct, cells, (parts, CELLS))
    sent = distinct.sparkSession.sparkContext.broadcast(counts)
    schema = pa.schema([("part", pa.int32()), ("value", pa.int64()), ("fp", pa.int64())])

    def rows_of(part: int, value: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(np.full(len(fp), part), pa.int32()), pa.array(value.view(np.int64)), pa.array(fp)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for part, value in enumerate(part_values(fp, groups)):
                yield rows_of(part, value, fp)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            values = part_values(fp, groups)
            limits = allocate(estimated_costs(values, groups, sent.value, tau), tau)
            for part, (value, group) in enumerate(zip(values, groups)):
                for errors in range(tau + 1):
                    use = limits[:, part] >= errors
                    if use.any():
                        for mask in flips(len(group), errors):
                            yield rows_of(part, value[use] ^ mask, fp[use])

    kinds = "part int, value long, fp long"
    probes = distinct.mapInArrow(probe, kinds).withColumnRenamed("fp", "a")
    indexed = distinct.mapInArrow(index, kinds).withColumnRenamed("fp", "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= tau
    found = probes.join(indexed, ["part", "value"]).where((F.col("a") != F.col("b")) & near)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, tau: int = 2
) -> DataFrame:
    """``(id, fingerprint, component_id)``: 16 hex digits and the component's least id."""
    marked = materialize(fingerprints(docs, id, text, width), "fingerprints")
    nodes = materialize(
        marked.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(id).alias("least_id")), "nodes"
    )
    labels = connected_components(link_pairs(nodes.select("fp"), tau))
    labelled = nodes.join(labels, F.col("fp") == F.col("node"), "left").select(
        "fp", "least_id", F.coalesce("label", "fp").alias("label")
    )
    least = labelled.groupBy("label").agg(F.min("least_id").alias("component_id"))
    members = labelled.join(least, "label").select(F.col("fp").alias("fingerprint"), "component_id")
    return marked.join(members, "fingerprint").select(
        id, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, tau: int = 2) -> DataFrame:
    """The documents that carry the least id of their component; all columns kept.

    Rows with a null id are kept, since no other row can stand for them.
    """
    groups = near_duplicates(docs, id, text, width, tau)
    dropped = groups.where(F.col(id) != F.col("component_id")).select(id).distinct()
    return docs.join(dropped, id, "left_anti")
