"""Token ids as length-delimited binary records with an offset index.

A data file is a sequence of frames, one per document, in ascending id order:

    length   unsigned 64-bit, little-endian
    masked CRC-32 of the length's 8 bytes, unsigned 32-bit
    payload  (``length`` bytes)
    masked CRC-32 of the payload, unsigned 32-bit

The mask rotates the checksum by 15 bits and adds a constant, so that a checksum
stored inside checked data does not check itself. A payload is a flag byte (1: the id is null, 2:
wide), the document's id (signed 64-bit) and its token ids, the end id last: unsigned
16-bit if they all fit, else (wide) unsigned 32-bit. Beside the data files there is an index table: file, record,
offset and length of every frame and how many tokens come before it in its file, so
that a shuffled read can seek to any record.

Tasks write files through ``pyarrow.fs``, which opens local and shared paths as well
as object stores by their URI. A file's name carries the task attempt, and the index
names the files that count: what a lost or repeated attempt leaves is never read.

Defined results: a null text is empty and holds the end id only; a null id comes
first; rows with equal ids get a record each, ordered by text; an empty table gives an
empty index and no file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.bpe import byte_level_ids
from chatloom.session import scratch_path

MASK_DELTA = 0xA282EAD8
HEAD = struct.Struct("<QI")
DOC = struct.Struct("<Bq")
FILE_BYTES = 128 << 20
PART_BYTES = 16 << 20
INDEX = (
    "part int, seq int, file string, record long, offset long, length long, "
    "doc_id long, n_tokens long, before long"
)
INDEX_ARROW = pa.schema(
    [(name, {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[kind])
     for name, kind in (c.split() for c in INDEX.split(", "))]
)
READ_BYTES = 8 << 20


def pack(doc: int | None, ids: np.ndarray) -> bytes:
    wide = bool(ids.max(initial=0) >> 16)
    return DOC.pack((doc is None) + 2 * wide, doc or 0) + ids.astype("<u4" if wide else "<u2").tobytes()


def unpack(payload: bytes) -> tuple[int | None, bytes]:
    """The document's id and its token ids as unsigned 32-bit integers."""
    flags, doc = DOC.unpack_from(payload)
    ids = np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=DOC.size)
    return None if flags & 1 else doc, ids.astype("<u4").tobytes()


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join(
        (length, struct.pack("<I", masked(zlib.crc32(length))), payload, struct.pack("<I", masked(zlib.crc32(payload))))
    )


def unframe(data: memoryview) -> bytes:
    """The payload of one frame; an error if a checksum does not fit."""
    length, check = HEAD.unpack_from(data)
    if masked(zlib.crc32(data[:8])) != check or len(data) != HEAD.size + length + 4:
        raise ValueError("a record's length is damaged")
    payload = bytes(data[HEAD.size : HEAD.size + length])
    if struct.pack("<I", masked(zlib.crc32(payload))) != bytes(data[-4:]):
        raise ValueError("a record's payload is damaged")
    return payload


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def ordered_by_id(docs: DataFrame, id: str, text: str, parts: Column | int | None = None) -> DataFrame:
    """``(doc_id, text)`` range-partitioned and sorted by id.

    The number of partitions follows the bytes of text, so that a task's share, and a
    file, stays near ``PART_BYTES``.
    """
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    if parts is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(1, -(-size // PART_BYTES))
    # The start of the text splits an id that very many rows share.
    start = F.substring("text", 1, 32)
    return rows.repartitionByRange(parts, "doc_id", start).sortWithinPartitions("doc_id", "text")


def write_records(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 0,
    id: str = "doc_id",
    text: str = "text",
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Tokenize and write all documents; returns the stored index table.

    One pass: texts move once, into id ranges, and every task streams its sorted share
    into files of about ``file_bytes``. Files are opened only when there is a record.
    """
    spark = docs.sparkSession
    end = np.array([end_id], np.uint32).tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        files, path = _filesystem(folder)
        out, name, seq, at, record, before = None, "", 0, 0, 0, 0
        for batch in batches:
            rows = []
            docs = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, ids in zip(docs, byte_level_ids(texts, tokenizer)):
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                        seq += 1
                    name = f"part-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.tokens"
                    files.create_dir(path, recursive=True)
                    out, at, record, before = files.open_output_stream(f"{path}/{name}"), 0, 0, 0
                data = frame(pack(doc, np.frombuffer(ids + end, np.uint32)))
                out.write(data)
                n = len(ids) // 4 + 1
                rows.append((part, seq, name, record, at, len(data), doc, n, before))
                at, record, before = at + len(data), record + 1, before + n
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), INDEX_ARROW)] if rows else [pa.array([], f.type) for f in INDEX_ARROW],
                schema=INDEX_ARROW,
            )
        if out is not None:
            out.close()

    index = ordered_by_id(docs, id, text).mapInArrow(write, INDEX)
    index.write.parquet(f"{folder}/index")
    return spark.read.schema(index.schema).parquet(f"{folder}/index")


def file_starts(index: DataFrame) -> DataFrame:
    """Per file: how many tokens all files before it hold. One row per file."""
    totals = index.groupBy("part", "seq", "file").agg(F.sum("n_tokens").alias("tokens"))
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("file", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("file_start"))


def read_records(index: DataFrame, folder: str, shuffle_seed: int | None = None) -> DataFrame:
    """All indexed records: ``(file, record, before, doc_id, ids)``, ids as bytes.

    A task gets whole files and reads their records in order; with ``shuffle_seed`` it
    gets records of all files in a random order and seeks to each.
    """
    fields = [("file", pa.string()), ("record", pa.int64()), ("before", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary())]
    schema = pa.schema(fields)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _filesystem(folder)
        name, source = None, None
        for batch in batches:
            rows, size = [], 0
            for row in batch.to_pylist():
                if row["file"] != name:
                    if source is not None:
                        source.close()
                    name, source = row["file"], files.open_input_file(f"{path}/{row['file']}")
                payload = unframe(memoryview(source.read_at(row["length"], row["offset"])))
                rows.append((name, row["record"], row["before"], *unpack(payload)))
                size += len(payload)
                if size >= READ_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        if source is not None:
            source.close()

    places = index.select("file", "record", "before", "offset", "length")
    if shuffle_seed is None:
        places = places.repartition("file").sortWithinPartitions("file", "offset")
    else:
        key = F.xxhash64("file", "record", F.lit(shuffle_seed))
        places = places.withColumn("_order", key).repartition("_order").sortWithinPartitions("_order")
    return places.mapInArrow(read, "file string, record long, before long, doc_id long, ids binary")


def token_record_digests(
    docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 0
) -> DataFrame:
    """Write the files, read them back and describe every record:
    ``doc_id, start, n_tokens, ids_crc32``."""
    folder = folder or scratch_path(docs.sparkSession, "token_records")
    index = write_records(docs, folder, tokenizer, end_id)
    return (
        read_records(index, folder)
        .select(
            "file",
            "before",
            "doc_id",
            (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
            F.crc32("ids").cast("bigint").alias("ids_crc32"),
        )
        .join(file_starts(index), "file")
        .select("doc_id", (F.col("file_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
    )
