"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Every record hashes into one of ``slots`` virtual slots. Bytes and rows are summed
per slot, slots are dealt to shards so that the shards' bytes are near equal, and the
resulting map is stored as a version. A later rebalance edits that map: it moves as
few slots as bring the shards level again, and records move only with their slot.

What reaches the driver is the slot table: ``slots`` rows, whatever the input.

Defined results: a null text has no bytes (size 1, crc of nothing); null ids hash
like any value; repeated rows share a slot and get places of their own; an empty
table gives an empty result and a map of empty slots. Only the id and text columns
are read, so other columns cannot clash.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.llm.common import materialize
from chatloom.session import scratch_path

SLOTS = 4096


@dataclass(frozen=True)
class SlotMap:
    """Version, number of shards and the shard of every slot."""

    version: int
    shards: int
    shard_of: tuple[int, ...]


def text_size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def sized_records(
    docs: DataFrame, id: str = "doc_id", text: str = "text", slots: int = SLOTS
) -> DataFrame:
    """``(id, size, text_crc32, virtual_slot)`` of every record; texts are left behind.

    The hash takes the text's checksum beside the id, so an id that many different
    records share is spread over slots.
    """
    checksum = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).cast("bigint")
    rows = docs.select(F.col(id), text_size(text).alias("size"), checksum.alias("text_crc32"))
    slot = F.pmod(F.xxhash64(id, "text_crc32", "size"), F.lit(slots)).cast("int")
    return rows.withColumn("virtual_slot", slot)


def slot_totals(sized: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of every slot: one aggregation with ``slots`` rows as its result."""
    totals = sized.groupBy("virtual_slot").agg(F.sum("size"), F.count(F.lit(1))).collect()
    size, rows = [0] * slots, [0] * slots
    for slot, b, n in totals:
        size[slot], rows[slot] = b, n
    return size, rows


def new_map(size: list[int], shards: int) -> SlotMap:
    """Version 1: the largest slot first, each to the shard with the fewest bytes so far."""
    heap = [(0, shard) for shard in range(shards)]
    shard_of = [0] * len(size)
    for slot in sorted(range(len(size)), key=lambda s: (-size[s], s)):
        load, shard = heapq.heappop(heap)
        shard_of[slot] = shard
        # An empty slot counts as a byte, so that empty slots are spread as well.
        heapq.heappush(heap, (load + max(size[slot], 1), shard))
    return SlotMap(1, shards, tuple(shard_of))


def rebalanced(current: SlotMap, size: list[int], shards: int, slack: float = 0.01) -> SlotMap:
    """The next version for ``shards`` shards and today's sizes.

    Slots of shards that no longer exist move to the emptiest shards. Then slots move
    from the fullest to the emptiest shard while that makes them more level and the
    fullest is more than ``slack`` above the mean. Every other slot stays.
    """
    shard_of = list(current.shard_of)
    load = [0] * shards
    held: list[list[int]] = [[] for _ in range(shards)]
    homeless = []
    for slot, shard in enumerate(shard_of):
        if shard < shards:
            load[shard] += size[slot]
            held[shard].append(slot)
        else:
            homeless.append(slot)
    for slot in sorted(homeless, key=lambda s: (-size[s], s)):
        to = min(range(shards), key=lambda s: (load[s], s))
        shard_of[slot], load[to] = to, load[to] + size[slot]
        held[to].append(slot)
    mean = sum(load) / shards
    while True:
        full = max(range(shards), key=lambda s: (load[s], -s))
        empty = min(range(shards), key=lambda s: (load[s], s))
        gap = load[full] - load[empty]
        fits = [s for s in held[full] if 0 < size[s] < gap]
        if load[full] <= mean * (1 + slack) or not fits:
            break
        # The slot that comes closest to closing half of the gap.
        slot = min(fits, key=lambda s: (abs(gap - 2 * size[s]), s))
        held[full].remove(slot)
        held[empty].append(slot)
        load[full] -= size[slot]
        load[empty] += size[slot]
        shard_of[slot] = empty
    return replace(current, version=current.version + 1, shards=shards, shard_of=tuple(shard_of))


def save_map(spark: SparkSession, slot_map: SlotMap, folder: str) -> None:
    """Write the map as ``folder/version=N``; an existing version is never replaced."""
    rows = [(slot, shard, slot_map.shards) for slot, shard in enumerate(slot_map.shard_of)]
    table = spark.createDataFrame(rows, "virtual_slot int, shard int, shards int")
    table.coalesce(1).write.mode("errorifexists").parquet(f"{folder}/version={slot_map.version}")


def load_map(spark: SparkSession, folder: str, version: int) -> SlotMap:
    table = spark.read.parquet(f"{folder}/version={version}").orderBy("virtual_slot").collect()
    return SlotMap(version, table[0].shards, tuple(r.shard for r in table))


def place(
    sized: DataFrame, slot_map: SlotMap, rows: list[int], id: str = "doc_id"
) -> DataFrame:
    """Add ``shard`` and ``slot``, the record's place in its shard, gapless from 0.

    Places follow (virtual slot, id, size, checksum). The map and the first place of
    each slot are one row per slot, so they are broadcast; records are shuffled once,
    by virtual slot, without their texts.
    """
    first, seen = [], [0] * slot_map.shards
    for virtual, shard in enumerate(slot_map.shard_of):
        first.append((virtual, shard, seen[shard]))
        seen[shard] += rows[virtual]
    table = sized.sparkSession.createDataFrame(first, "virtual_slot int, shard int, first_place long")
    within = Window.partitionBy("virtual_slot").orderBy(id, "size", "text_crc32")
    return (
        sized.withColumn("slot", F.row_number().over(within) - 1)
        .join(F.broadcast(table), "virtual_slot")
        .withColumn("slot", F.col("slot") + F.col("first_place"))
        .drop("first_place")
    )


def shard_documents(
    docs: DataFrame,
    shards: int = 16,
    id: str = "doc_id",
    text: str = "text",
    slots: int = SLOTS,
    map_folder: str | None = None,
    grown: int | None = None,
) -> DataFrame:
    """``(id, size, text_crc32, virtual_slot, shard, slot)`` of every record.

    The map is stored as version 1 and records are placed by what is read back. With
    ``grown`` shards version 1 is edited into version 2, which is stored and read back
    as well; ``next_shard`` is a record's shard under it.
    """
    spark = docs.sparkSession
    folder = map_folder or scratch_path(spark, "slot_map")
    sized = materialize(sized_records(docs, id, text, slots), "sized_records")
    size, rows = slot_totals(sized, slots)
    save_map(spark, new_map(size, shards), folder)
    current = load_map(spark, folder, 1)
    placed = place(sized, current, rows, id)
    if grown is None:
        return placed
    save_map(spark, rebalanced(current, size, grown), folder)
    later = load_map(spark, folder, 2)
    moved = spark.createDataFrame(list(enumerate(later.shard_of)), "virtual_slot int, next_shard int")
    return placed.join(F.broadcast(moved), "virtual_slot")


def write_shards(docs: DataFrame, slot_map: SlotMap, folder: str, id: str = "doc_id", text: str = "text") -> None:
    """Write whole records as Parquet below ``folder/shard=N``, one shuffle by slot."""
    slots = len(slot_map.shard_of)
    checksum = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).cast("bigint")
    virtual = F.pmod(F.xxhash64(id, checksum, text_size(text)), F.lit(slots)).cast("int")
    shard = F.get(F.array(*[F.lit(s) for s in slot_map.shard_of]), virtual)
    if "shard" in docs.columns:
        raise ValueError("the records have a column named shard")
    docs.withColumn("shard", shard).repartition("shard", virtual).write.partitionBy("shard").parquet(folder)
