"""A quality score from document statistics.

Each text is described by statistics of its characters, words and lines. Random
Fourier features turn the standardized statistics into an inner-product form of a
Gaussian kernel; ridge regression on labelled documents is fitted from normal equations
summed over partitions; isotonic regression on labelled documents of another fold
turns its raw output into a probability.

The statistics of a text depend on that text alone. What reaches the driver has a
fixed size: sums of the statistics, the normal equations, and label counts in
``BINS`` bins of raw output.

Defined results: a null text is scored like an empty one; labels other than 0 and 1
are left out, several labels of one id are each used; repeated rows are scored each;
without labels of both kinds the score is the share of label 1, or 0.5 without any; an
empty table gives an empty result. Labels, language, source and id are never inputs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import materialize
from chatloom.llm.sums import array_sum

FOLDS = 5
HELD_OUT, CALIBRATION = 0, 1
FEATURES = 256
RIDGE = 1e-3
SEED = 20240601
BINS = 2000
LOW, HIGH = -0.5, 1.5

# What each statistic is, in the order of `statistics`.
NAMES = (
    "log words", "mean word length", "word length spread", "upper-case share", "digit share",
    "bar share", "exclamation share", "odd symbol share", "full stop share", "comma share",
    "other punctuation share", "non-ASCII share", "blank share", "log lines", "words per line",
    "distinct word share", "commonest word share", "distinct pair share", "commonest pair share",
    "distinct line share", "shouted word share", "repeated neighbour share",
    "longest word", "words with marks inside",
)


def _classes() -> np.ndarray:
    """A class number for every byte."""
    kind = np.zeros(256, np.int64)
    kind[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8)] = 1
    kind[np.frombuffer(b"0123456789", np.uint8)] = 2
    kind[ord("|")], kind[ord("!")] = 3, 4
    kind[np.frombuffer(b"#$%&*@^~<>{}[]\\=+_", np.uint8)] = 5
    kind[ord(".")], kind[ord(",")] = 6, 7
    kind[np.frombuffer(b"\"'()-/:;?`", np.uint8)] = 8
    kind[128:] = 9
    kind[np.frombuffer(b" \t\n\r\v\f", np.uint8)] = 10
    return kind


CLASS = _classes()


def statistics(text: str | None) -> list[float]:
    """The numbers named in ``NAMES``; whole texts, whatever their length."""
    data = (text or "").encode()
    words = data.split()
    n, size = len(words), max(len(data), 1)
    share = np.bincount(CLASS[np.frombuffer(data, np.uint8)], minlength=11) / size
    lines = [line for line in data.split(b"\n") if line.strip()]
    lengths = np.array([len(w) for w in words]) if words else np.zeros(1)
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    per_word, per_pair = 1 / max(n, 1), 1 / max(n - 1, 1)
    marked = sum(1 for w in words if not w.isalnum() and not w[:-1].isalnum())
    return [
        np.log1p(n),
        lengths.mean(),
        lengths.std(),
        *share[1:11],
        np.log1p(len(lines)),
        np.log1p(n / max(len(lines), 1)),
        len(counts) * per_word,
        max(counts.values(), default=0) * per_word,
        len(pairs) * per_pair,
        max(pairs.values(), default=0) * per_pair,
        len(set(lines)) / max(len(lines), 1),
        sum(1 for w in words if len(w) > 1 and w.isupper()) * per_word,
        sum(1 for a, b in zip(words, words[1:]) if a == b) * per_pair,
        np.log1p(lengths.max()),
        marked * per_word,
    ]


def describe(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, stats)`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [statistics(t) for t in batch.column(1).to_pylist()]
            made = pa.array(made, pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), made], names=[id, "stats"])

    kind = dict(docs.dtypes)[id]
    return docs.select(id, text).mapInArrow(run, f"`{id}` {kind}, stats array<float>")


def stats_of(batch: pa.RecordBatch, name: str = "stats") -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, len(NAMES))


def fold(id: str) -> Column:
    return F.pmod(F.crc32(F.col(id).cast("string").cast("binary")), F.lit(FOLDS)).cast("int")


@dataclass(frozen=True)
class QualityModel:
    """Everything needed to score statistics."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray  # raw outputs, ascending
    levels: np.ndarray  # calibrated scores at the steps, never descending

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        waves = np.cos(z @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.column_stack([waves, np.ones(len(z))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.steps, self.levels)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The never descending sequence nearest to ``values`` (pool adjacent violators)."""
    blocks: list[list[float]] = []  # mean, weight, length
    for value, weight in zip(values, weights):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, n = blocks.pop()
            u, x, m = blocks[-1]
            blocks[-1] = [(u * x + v * w) / (x + w), x + w, m + n]
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.zeros(0)


def fit(labelled: DataFrame, features: int = FEATURES, ridge: float = RIDGE) -> QualityModel:
    """Fit on rows ``(stats, label, fold)``; folds of 0 are ignored."""
    width = len(NAMES)
    usable = labelled.where(f"label in (0, 1) and fold <> {HELD_OUT}").select("stats", "label", "fold")

    def labels_of(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column(batch.schema.get_field_index("label")).to_numpy(zero_copy_only=False).astype(float)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x, y = stats_of(batch), labels_of(batch)
        return np.stack([x.sum(0), (x * x).sum(0), np.full(width, len(x)), np.full(width, y.sum())])

    total, squares, n, ones = array_sum(usable, moments, (4, width))
    mean = total / max(n[0], 1)
    scale = np.sqrt(np.maximum(squares / max(n[0], 1) - mean**2, 1e-9))
    rng = np.random.default_rng(SEED)
    frequencies = rng.normal(0, 1 / np.sqrt(width), (width, features))
    phases = rng.uniform(0, 2 * np.pi, features)
    prior = ones[0] / n[0] if n[0] else 0.5
    edges = np.array([LOW, HIGH])
    model = QualityModel(mean, scale, frequencies, phases, np.zeros(features + 1), edges, np.full(2, prior))
    if not 0 < ones[0] < n[0]:
        return model

    def normal_equations(batch: pa.RecordBatch) -> np.ndarray:
        x, y = model.features(stats_of(batch)), labels_of(batch)
        return np.column_stack([x.T @ x, x.T @ y])

    sums = array_sum(usable.where(f"fold <> {CALIBRATION}"), normal_equations, (features + 1, features + 2))
    left, right = sums[:, :-1], sums[:, -1]
    rows = max(left[-1, -1], 1)
    penalty = ridge * rows * np.diag([1.0] * features + [0.0])
    weights = np.linalg.lstsq(left + penalty + 1e-9 * np.eye(features + 1), right, rcond=None)[0]
    model = QualityModel(mean, scale, frequencies, phases, weights, edges, np.full(2, prior))

    def binned(batch: pa.RecordBatch) -> np.ndarray:
        at = (np.clip((model.raw(stats_of(batch)) - LOW) / (HIGH - LOW), 0, 1) * (BINS - 1)).astype(int)
        y = labels_of(batch)
        return np.stack([np.bincount(at, minlength=BINS), np.bincount(at, y, minlength=BINS)])

    seen, good = array_sum(usable.where(f"fold = {CALIBRATION}"), binned, (2, BINS))
    used = np.flatnonzero(seen)
    if not len(used):
        return QualityModel(mean, scale, frequencies, phases, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    levels = isotonic(good[used] / seen[used], seen[used])
    steps = LOW + (used + 0.5) * (HIGH - LOW) / BINS
    return QualityModel(mean, scale, frequencies, phases, weights, steps, np.clip(levels, 0, 1))


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    threshold: float = 0.3,
) -> DataFrame:
    """``(id, held_out, score, predicted)`` of every document.

    Statistics are made once and stored; training joins them with the labels, and
    scoring reads them again. Rows whose id's CRC-32, as text, divides by 5 teach nothing.
    """
    stats = materialize(describe(docs, id, text), "statistics")
    marks = labels.select(F.col(id).alias("_id"), F.col(label).cast("int").alias("label"))
    labelled = stats.join(marks, F.col(id) == F.col("_id")).select("stats", "label", fold(id).alias("fold"))
    model = fit(materialize(labelled, "labelled"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(model.scores(stats_of(batch)), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), score], names=[id, "score"])

    kind = dict(docs.dtypes)[id]
    scored = stats.select(id, "stats").mapInArrow(run, f"`{id}` {kind}, score double")
    return scored.select(
        id,
        F.coalesce(fold(id) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = 0.3
) -> DataFrame:
    """The documents that are not rejected, all columns kept.

    Rejection is by id; repeated rows of one id go only if every text of it is rejected.
    Rows with a null id are kept.
    """
    scored = score_documents(docs, labels, id, text, threshold=threshold)
    rejected = scored.groupBy(id).agg(F.max("predicted").alias("best")).where("best = 0").select(id)
    return docs.join(rejected, id, "left_anti")
