"""What the operators share: input columns, stored steps, word hashes."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import shared_path

SPACES = " \t\n\u000b\u000c\r"
ARROW_ROWS = "512"


def tune(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so that a batch of very long texts fits into a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_column() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


class Steps:
    """Stored intermediate tables of one run, in the folder that all executors share.

    A stored step cuts the lineage and survives lost executors. ``drop`` deletes a
    step that no later step or result reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = shared_path(spark, name)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.option("compression", "zstd").parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved._step = path
        return saved

    def drop(self, *saved: DataFrame) -> None:
        for df in saved:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(df._step)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit words."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of BASE and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for slot, factor in enumerate((BASE, inverse)):
            factors = np.full(size, factor, np.uint64)
            factors[0] = 1
            _powers[slot] = np.multiply.accumulate(factors)
    return _powers[0][:n], _powers[1][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums of bytes; see :func:`span_hashes`."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes in each span, equal for equal bytes at any place."""
    _, down = powers(len(sums))
    return mix(
        (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * BASE
    )


_is_space = np.zeros(256, bool)
_is_space[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without white space."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_is_space[data]
    steps = np.diff(inside)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of a text, A-Z lowered."""
    data = np.frombuffer(text.lower(), np.uint8)
    starts, ends = word_spans(data)
    return span_hashes(prefix_hashes(data), starts, ends), starts, ends


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words; a shorter text has one, an empty one none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    n = min(n, len(words))
    total = np.full(len(words) - n + 1, np.uint64(n), np.uint64)
    for i in range(n):
        total = mix(total * BASE + words[i : i + len(total)])
    return total
