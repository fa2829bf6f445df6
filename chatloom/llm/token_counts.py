"""Token counts under a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton lists all vocabulary matches by where they end. Dynamic
programming keeps, for every end, the best score of a path to it and that path's
number of pieces. Ties follow the tokenizers library's unigram model: of equal scores
the path whose last piece begins first wins, so longer matches come first and only a
strictly better one replaces them. A character that is no piece of its own is unknown,
at a fixed penalty below the lowest score; unknown characters count as their bytes with
byte fallback, and as one token per run without.

Blanks become the blank mark and a mark is put in front. Where no piece holds a mark
after another character and all scores are multiples of 2**-16, sums are exact and no
piece crosses a blank, so the best path of a text is made of the best paths of its
words: counts of words are remembered and added up. Other vocabularies are searched
over whole texts.

Defined results: a null or empty text has no tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame

from chatloom.llm.bpe import Memo, chunks, cut_pieces, sentencepiece_model

MARK = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value: how far below the lowest score an unknown character is


class UnigramCounter:
    """Counts of one vocabulary: ``(piece, score)`` pairs, one of them unknown."""

    def __init__(self, vocabulary: list[tuple[str, float]], unknown: int = 0, byte_fallback: bool = True):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        pieces = {piece for piece, _ in vocabulary}
        self.single = {piece for piece in pieces if len(piece) == 1}
        self.penalty = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.as_bytes = byte_fallback and all(f"<0x{b:02X}>" in pieces for b in range(256))
        self.by_word = (
            MARK in pieces
            and not any(MARK in p.lstrip(MARK) for p in pieces)
            and all(float(score * 65536).is_integer() for _, score in vocabulary)
        )

    def count(self, text: str) -> int:
        """Pieces on the best path of a normalized text."""
        size = len(text)
        best: list[float | None] = [None] * (size + 1)
        best[0] = 0.0
        pieces = [0] * (size + 1)
        unknown_end = [False] * (size + 1)
        at = 0
        # Matches come by end, and of one end from the longest to the shortest.
        matches = self.automaton.iter(text)
        match = next(matches, None)
        for end in range(1, size + 1):
            score, n, unknown = None, 0, False
            while match is not None and match[0] == end - 1:
                length, value = match[1]
                start = end - length
                value += best[start]
                if score is None or value > score:
                    score, n = value, pieces[start] + 1
                match = next(matches, None)
            last = text[end - 1]
            if last not in self.single:
                value = best[end - 1] + self.penalty
                if score is None or value > score:
                    score, unknown = value, True
                    if self.as_bytes:
                        n = pieces[end - 1] + len(last.encode("utf-8", "surrogatepass"))
                    else:
                        n = pieces[end - 1] + (not unknown_end[end - 1])
            best[end], pieces[end], unknown_end[end] = score, n, unknown
            at = end
        return pieces[at]

    def count_texts(self, texts: list[str]) -> Iterator[int]:
        """Counts of whole raw texts."""
        if not self.by_word:
            for text in texts:
                yield self.count(MARK + text.replace(" ", MARK)) if text else 0
            return
        for part in chunks(texts):
            cuts = [cut_pieces(t) if t else [] for t in part]
            wanted: set[str] = set()
            for c in cuts:
                wanted.update(c)
            counts = self.memo.hold(wanted).__getitem__
            for c in cuts:
                yield sum(map(counts, islice(c, None)))

    @property
    def memo(self) -> Memo:
        if not hasattr(self, "_memo"):
            self._memo = Memo(lambda words: [self.count(MARK + w.replace(" ", MARK)) for w in words])
        return self._memo


def model_vocabulary(model_file: str) -> list[tuple[str, float]]:
    """Pieces and scores of a model file, control pieces left out, unknown first."""
    model = sentencepiece_model(model_file)
    ids = [i for i in range(model.get_piece_size()) if not model.is_control(i)]
    ids.sort(key=lambda i: not model.is_unknown(i))
    return [(model.id_to_piece(i), model.get_score(i)) for i in ids]


@lru_cache(maxsize=2)
def model_counter(model_file: str) -> UnigramCounter:
    return UnigramCounter(model_vocabulary(model_file))


def count_tokens(docs: DataFrame, model_file: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_tokens)`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = model_counter(model_file)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            made = pa.array(counter.count_texts(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), made], names=[id, "n_tokens"])

    kind = dict(docs.dtypes)[id]
    return docs.select(id, text).mapInArrow(run, f"`{id}` {kind}, n_tokens long")
