"""Sums of fixed-size arrays over all rows of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 8


def array_sum(df: DataFrame, part_sum: Callable[[pa.RecordBatch], np.ndarray], shape: tuple) -> np.ndarray:
    """The sum over all batches of what ``part_sum`` makes of each, in doubles.

    Every task adds up its batches, ``FAN`` tasks add up the partial sums, and the
    driver adds the last ``FAN`` arrays; their size is fixed by ``shape``.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += part_sum(batch)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                total += np.frombuffer(blob).reshape(shape)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    partials = df.mapInArrow(partial, "sums binary")
    spread = partials.repartition(FAN, F.xxhash64("sums")).mapInArrow(add, "sums binary")
    total = np.zeros(shape)
    for row in spread.collect():
        total += np.frombuffer(row.sums).reshape(shape)
    return total
