"""SentencePiece encoding that keeps the original byte span of every piece.

A text is normalized by the model's compiled character map: at every place the
longest prefix with an entry is replaced by the entry's text, otherwise one character
is copied; blanks become the blank mark, and a mark is put in front. The normalizer
records for every normalized byte the original byte it came from. The model's pieces
spell out the normalized text, so running sums of their lengths, looked up in that
record, give each piece's span in the original text.

The map is the trie of the model file: an array of 32-bit units. A unit's low byte is
its label, bit 8 says that a value ends there, bit 9 widens the offset, and the value
of an ending is the place of its replacement in a block of zero-terminated strings.

Ids are exactly those of the sentencepiece library, which encodes the segments of a
text (see ``bpe``), and decoding is the library's.

Defined results: a null or empty text has no pieces and decodes to an empty text.
Spans are 0-based bytes of the UTF-8 text, end excluded; a piece made only of the
prefixed mark has an empty span; several byte pieces of one character each get the
whole character's bytes from their own byte on. A model that removes extra blanks or
treats blanks as suffixes is refused.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chatloom.llm.bpe import piece_ids, sentencepiece_model

MARK = "▁".encode()


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a serialized protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            length = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at : at + length]
            at += length


class CharacterMap:
    """Longest-prefix lookup in the compiled character map."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.strings = compiled[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest entry that ``text`` has at ``at``, and its replacement."""
        if not self.units:
            return None
        found, node = None, self._offset(self.units[0])
        for i in range(at, len(text)):
            byte = text[i]
            node ^= byte
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= self._offset(unit)
            if unit & 256:
                value = self.units[node] & 0x7FFFFFFF
                found = i - at + 1, self.strings[value : self.strings.index(b"\0", value)]
        return found

    def first_bytes(self) -> frozenset[int]:
        """Bytes an entry can begin with."""
        if not self.units:
            return frozenset()
        root = self._offset(self.units[0])
        fits = lambda b: root ^ b < len(self.units) and self.units[root ^ b] & 0x800000FF == b
        return frozenset(b for b in range(1, 256) if fits(b))


class Normalizer:
    """The model's normalization with the origin of every normalized byte."""

    def __init__(self, model_file: str):
        proto = sentencepiece_model(model_file).serialized_model_proto()
        spec = dict(message_fields(next(v for k, v in message_fields(proto) if k == 3)))
        trainer = dict(message_fields(next((v for k, v in message_fields(proto) if k == 2), b"")))
        self.map = CharacterMap(spec.get(2, b""))
        self.starts = self.map.first_bytes()
        self.prefix = bool(spec.get(3, 1))
        if spec.get(4, 1) or not spec.get(5, 1) or trainer.get(24, 0):
            raise ValueError("only models that keep blanks and mark them in front are supported")

    def replaced(self, text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The text after the character map, and begin and end of every byte's origin."""
        plain = np.arange(len(text))
        where = [i for i in range(len(text)) if text[i] in self.starts] if self.starts else []
        if not where:
            return text, plain, plain + 1
        out, begin, end, done = [], [], [], 0
        for at in where:
            if at < done or (hit := self.map.longest(text, at)) is None:
                continue
            length, new = hit
            out += [text[done:at], new]
            begin += [plain[done:at], np.full(len(new), at)]
            end += [plain[done:at] + 1, np.full(len(new), at + length)]
            done = at + length
        out.append(text[done:])
        begin.append(plain[done:])
        end.append(plain[done:] + 1)
        return b"".join(out), np.concatenate(begin), np.concatenate(end)

    def normalized(self, text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Normalized bytes, and for each byte where its origin begins and ends."""
        if not text:
            return b"", np.zeros(0, int), np.zeros(0, int)
        new, begin, end = self.replaced(text)
        if not new:
            return b"", begin, end
        width = np.where(np.frombuffer(new, np.uint8) == 32, len(MARK), 1)
        marked = new.replace(b" ", MARK)
        begin, end = np.repeat(begin, width), np.repeat(end, width)
        if self.prefix:
            none = np.zeros(len(MARK), int)
            return MARK + marked, np.concatenate([none, begin]), np.concatenate([none, end])
        return marked, begin, end


@lru_cache(maxsize=2)
def _normalizer(path: str) -> Normalizer:
    return Normalizer(path)


@lru_cache(maxsize=2)
def _piece_bytes(path: str) -> tuple[np.ndarray, list[str]]:
    """Normalized bytes each piece stands for, and every id as decimal text.

    A byte piece stands for one byte; 0 marks the unknown piece, of any length.
    """
    model = sentencepiece_model(path)
    ids = range(model.get_piece_size())
    size = [1 if model.is_byte(i) else 0 if model.is_unknown(i) else len(model.id_to_piece(i).encode()) for i in ids]
    return np.array(size), [str(i) for i in ids]


def spans(text: str, ids: np.ndarray, model_file: str) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every piece, in bytes of the original text."""
    normal, begin, end = _normalizer(model_file).normalized(text.encode())
    size = _piece_bytes(model_file)[0][ids]
    if (size == 0).any():
        size = _with_unknown(normal, ids, size, model_file)
    stop = np.cumsum(size)
    if len(ids) and stop[-1] != len(normal):
        raise ValueError("the pieces do not spell out the normalized text")
    if not len(ids):
        return stop, stop
    return begin[stop - size], end[stop - 1]


def _with_unknown(normal: bytes, ids: np.ndarray, size: np.ndarray, model_file: str) -> np.ndarray:
    """Lengths with those of unknown pieces, which run to where the next piece is found."""
    model, size, at = sentencepiece_model(model_file), size.copy(), 0
    for i, n in enumerate(size):
        if n == 0:
            following = model.id_to_piece(int(ids[i + 1])).encode() if i + 1 < len(ids) else None
            size[i] = (normal.index(following, at + 1) if following else len(normal)) - at
        at += size[i]
    return size


def _digest(texts: list[str], ids: list[bytes], model_file: str) -> list[list]:
    model, (_, decimal) = sentencepiece_model(model_file), _piece_bytes(model_file)
    n, sha, decoded = [], [], []
    for raw in ids:
        numbers = np.frombuffer(raw, "<u4").tolist()
        n.append(len(numbers))
        sha.append(hashlib.sha256(",".join([decimal[i] for i in numbers]).encode()).hexdigest())
        decoded.append(hashlib.sha256((model.decode(numbers) if numbers else "").encode()).hexdigest())
    return [n, sha, decoded]


def encode_documents(
    docs: DataFrame, model_file: str, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(id, ids, begins, ends, decoded)`` of every whole text."""
    schema = pa.schema(
        [("ids", pa.list_(pa.int32())), ("begins", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("decoded", pa.string())]
    )

    def encode(texts: list[str]) -> list[list]:
        rows = []
        for t, raw in zip(texts, piece_ids(texts, model_file)):
            numbers = np.frombuffer(raw, "<u4").astype("i4")
            begin, end = spans(t, numbers, model_file)
            rows.append((numbers, begin.astype("i4"), end.astype("i4"), sentencepiece_model(model_file).decode(numbers.tolist())))
        return [list(c) for c in zip(*rows)]

    return _map_texts(docs, id, text, encode, schema, "ids array<int>, begins array<int>, ends array<int>, decoded string")


def encoding_digests(
    docs: DataFrame, model_file: str, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256, covered_bytes)`` of every whole text.

    Made in the tasks from the same ids and spans as :func:`encode_documents`, so
    that token arrays do not leave them. ``covered_bytes`` is what the pieces' spans
    cover; it equals the text's bytes, or the span record is wrong.
    """
    schema = pa.schema(
        [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("covered_bytes", pa.int64())]
    )

    def digest(texts: list[str]) -> list[list]:
        ids = list(piece_ids(texts, model_file))
        covered = []
        for t, raw in zip(texts, ids):
            begin, end = spans(t, np.frombuffer(raw, "<u4").astype("i4"), model_file)
            # Spans come in order; a span adds what lies beyond those before it.
            reach = np.maximum.accumulate(end) if len(end) else end
            before = np.concatenate([[0], reach[:-1]]) if len(end) else end
            covered.append(int(np.maximum(reach - np.maximum(before, begin), 0).sum()))
        return [*_digest(texts, ids, model_file), covered]

    kinds = "n_tokens long, ids_sha256 string, decoded_sha256 string, covered_bytes long"
    return _map_texts(docs, id, text, digest, schema, kinds)


def _map_texts(docs: DataFrame, id: str, text: str, fn, schema: pa.Schema, kinds: str) -> DataFrame:
    """Run ``fn`` over short runs of texts; it returns one list per column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                made = [pa.array(c, f.type) for c, f in zip(fn(texts), schema)]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], names=[id, *schema.names])

    kind = dict(docs.dtypes)[id]
    return docs.select(id, text).mapInArrow(run, f"`{id}` {kind}, {kinds}")
