"""The stored slot map against plain Python."""

import zlib
from collections import Counter

from chatloom.llm import sharding

ROWS = [(i % 90, None if i % 17 == 0 else f"tëxt {i % 40} " * (i % 23)) for i in range(400)] + [(None, "no id")] * 3


def test_slots_of_the_stored_map(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_id LONG, text STRING").repartition(4)
    folder = str(tmp_path / "map")
    rows = sharding.shard_documents(docs, 5, slots=64, map_folder=folder, grown=7).collect()
    first, second = (sharding.load_map(spark, folder, v) for v in (1, 2))
    assert (first.shards, second.shards) == (5, 7)

    texts = [(i, (t or "").encode()) for i, t in ROWS]
    want = Counter((i, len(t) + 1, zlib.crc32(t)) for i, t in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want

    # Both maps decide by virtual slot alone, so exactly the rows of moved slots move.
    moved = {s for s in range(64) if first.shard_of[s] != second.shard_of[s]}
    assert moved and len(moved) < 64
    for r in rows:
        assert r.shard == first.shard_of[r.virtual_slot]
        assert r.next_shard == second.shard_of[r.virtual_slot]
        assert (r.shard != r.next_shard) == (r.virtual_slot in moved)

    # Places: gapless, slot by slot, by id, size and checksum (a null id first).
    for shard in range(5):
        mine = sorted((r for r in rows if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        order = [(r.virtual_slot, r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in mine]
        assert order == sorted(order)
    bytes_of = [sum(r.size for r in rows if r.next_shard == s) for s in range(7)]
    assert max(bytes_of) < 1.5 * min(bytes_of)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id LONG, text STRING")
    assert sharding.shard_documents(docs, 3, slots=8, grown=4).count() == 0
