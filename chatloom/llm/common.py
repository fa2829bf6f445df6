"""Small helpers the operators share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from chatloom.session import scratch_path

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write to a new table below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: what follows neither repeats the work before it nor loses
    it with an executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective mix of 64-bit values (xor-shift-multiply rounds), wrapping."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def ship_package(spark: SparkSession) -> None:
    """Let Spark hand this package to the executors' Python, once per application."""
    context = spark.sparkContext
    if getattr(context, "_chatloom_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="chatloom-")) / "chatloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._chatloom_shipped = True
