"""Exact tokenizer ids through a memo of text segments.

A text is cut at blanks where no merge can cross, and the ids of a segment are
remembered, since words repeat. The library encodes every segment that is not in the
memo, many at a time. The memo is bounded and belongs to a worker process.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np

MEMO_SEGMENTS = 500_000
CHUNK_CHARS = 1_000_000
BLANK_BYTE = "Ġ"  # how byte-level vocabularies write a blank


class Memo:
    """Segment to ids (unsigned 32-bit, in the machine's order).

    Two generations of at most ``most`` segments: a full young one becomes the old
    one, and what is used from the old one moves to the young one again.
    """

    def __init__(self, encode_many: Callable, most: int = MEMO_SEGMENTS):
        self.encode_many, self.most = encode_many, most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def hold(self, segments: set[str]) -> dict[str, bytes]:
        """The memo, with all of these segments in it."""
        missing = segments.difference(self.young)
        if len(self.young) + len(missing) > self.most:
            self.old, self.young = self.young, {}
            missing = segments
        young, old = self.young, self.old
        young.update({s: old[s] for s in missing if s in old})
        missing = list(missing.difference(young))
        if missing:
            young.update(zip(missing, self.encode_many(missing)))
        return young


def encode_apart(words: list[str], encode: Callable, begins: np.ndarray, mark: str) -> list[bytes]:
    """Ids of every word as if it followed a blank.

    Words are encoded a thousand at a time as one text. ``begins`` tells the ids of
    pieces that begin with a blank, so it tells where the next word begins; words that
    hold a blank or ``mark`` themselves are encoded one by one.
    """
    out: dict[str, bytes] = {}
    odd = [w for w in words if " " in w or mark in w or not w]
    for w in odd:
        out[w] = array("I", encode([w])[0]).tobytes()
    plain = [w for w in words if w not in out] if odd else words
    texts = [plain[at : at + 1000] for at in range(0, len(plain), 1000)]
    for part, ids in zip(texts, encode([" ".join(t) for t in texts])):
        ids = np.array(ids, np.uint32)
        at = np.flatnonzero(begins[ids]) * 4
        if len(at) != len(part):
            raise ValueError("a word has no piece of its own at its start")
        raw, ends = ids.tobytes(), [*at[1:].tolist(), 4 * len(ids)]
        out.update(zip(part, [raw[a:b] for a, b in zip(at.tolist(), ends)]))
    return [out[w] for w in words]


def chunks(texts: list[str]) -> Iterator[list[str]]:
    """Runs of consecutive texts of about ``CHUNK_CHARS`` characters."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= CHUNK_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode_segments(texts: list[str], cut: Callable, first: Memo, rest: Memo) -> Iterator[bytes]:
    """Ids of every text. ``cut`` gives a text's segments; the first stands at the
    text's start, the others follow a blank that is not part of them."""
    for part in chunks(texts):
        cuts = [cut(t) if t else [] for t in part]
        heads = first.hold({c[0] for c in cuts if c})
        wanted: set[str] = set()
        for c in cuts:
            wanted.update(islice(c, 1, None))
        tail = rest.hold(wanted).__getitem__
        for c in cuts:
            yield heads[c[0]] + b"".join(map(tail, islice(c, 1, None))) if c else b""


# White space other than the blank, by Unicode and by Python.
_OTHER_SPACE = [chr(c) for c in (*range(9, 14), *range(28, 32), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
# The byte-level pattern always begins a new piece at a single blank between two
# characters that are not white space, and looks at nothing beyond it.
_BYTE_LEVEL_CUT = re.compile(r"(?<=\S) (?=\S)")


def cut_byte_level(text: str) -> list[str]:
    beside = "  " in text or any(c in text and (c + " " in text or " " + c in text) for c in _OTHER_SPACE)
    if beside or text[0] == " " or text[-1] == " ":
        return _BYTE_LEVEL_CUT.split(text)
    return text.split(" ")


@lru_cache(maxsize=2)
def _byte_level(path: str) -> tuple[Memo, Memo]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    begins = np.zeros(tokenizer.get_vocab_size(), bool)
    begins[[i for piece, i in tokenizer.get_vocab().items() if piece.startswith(BLANK_BYTE)]] = True
    behind = lambda texts: encode([" " + t for t in texts])
    return (
        Memo(lambda texts: [array("I", ids).tobytes() for ids in encode(texts)], 20_000),
        Memo(lambda words: encode_apart(words, behind, begins, BLANK_BYTE)),
    )


def byte_level_ids(texts: list[str], path: str) -> Iterator[bytes]:
    """Ids of whole texts, as unsigned 32-bit integers."""
    return encode_segments(texts, cut_byte_level, *_byte_level(path))


# Pieces hold the blank mark only at their start, so no merge crosses a blank that
# follows something else. A blank at the very end stays with what it follows.
_PIECE_CUT = re.compile("(?<=[^ ▁]) (?=[\\s\\S])")


def cut_pieces(text: str) -> list[str]:
    if "  " in text or "▁" in text or text[0] == " " or text[-1] == " ":
        return _PIECE_CUT.split(text)
    return text.split(" ")


@lru_cache(maxsize=2)
def sentencepiece_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def _pieces(path: str) -> tuple[Memo, Memo]:
    model = sentencepiece_model(path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any("▁" in p.lstrip("▁") for p in pieces):
        raise ValueError("a piece holds a blank mark inside; texts cannot be cut at blanks")
    # A segment's own dummy prefix stands for the blank that was cut away.
    encode = lambda texts: model.encode(texts, num_threads=1)
    begins = np.array([p.startswith("▁") for p in pieces])
    return (
        Memo(lambda texts: [array("I", ids).tobytes() for ids in encode(texts)], 20_000),
        Memo(lambda words: encode_apart(words, encode, begins, "▁")),
    )


def piece_ids(texts: list[str], path: str) -> Iterator[bytes]:
    """SentencePiece ids of whole texts, as unsigned 32-bit integers."""
    return encode_segments(texts, cut_pieces, *_pieces(path))
