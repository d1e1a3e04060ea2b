"""Small helpers shared by the operators: tables, row keys, words as hashes, links."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.session import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Rows and bytes in one Arrow batch: a worker holds a few of them at once, and texts
# may be long.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def small_batches(spark: SparkSession) -> None:
    """Bound what Python workers receive at once. This holds for the session, as
    DataFrames run later than they are made."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fingerprint(text: Column) -> list[Column]:
    """Two independent 64-bit hashes of a text, as a pair of key columns."""
    return [F.xxhash64(text), F.xxhash64(F.lit("second"), text)]


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def batches(frames: Iterator[pd.DataFrame], column: str, limit: int = 1 << 19):
    """Cut incoming frames so that one piece holds about ``limit`` characters.

    A text longer than that is a piece of its own; no text is ever cut.
    """
    for frame in frames:
        sizes = frame[column].str.len().fillna(0).to_numpy(dtype=np.int64)
        group = (np.cumsum(sizes) - sizes) // limit
        start = 0
        for cut in [*(np.flatnonzero(np.diff(group)) + 1), len(frame)]:
            if cut > start:
                yield frame.iloc[start:cut]
            start = cut


def slices(frames: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches in pieces of few rows, so that few texts are held as objects."""
    for frame in frames:
        for at in range(0, frame.num_rows, rows):
            yield frame.slice(at, rows)


def release() -> None:
    """Give memory that a finished task has freed back to the system.

    A worker waits for the next task in the same process; what it keeps is missing
    to the JVM beside it.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library; nothing to do


# Odd multipliers of a 64-bit polynomial hash and the finaliser that follows it.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX[0]
        x = (x ^ (x >> np.uint64(27))) * _MIX[1]
        return x ^ (x >> np.uint64(31))


def byte_values(separators: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(value of each byte in a hash, whether it separates words); A-Z count as a-z."""
    fold = np.arange(256)
    fold[65:91] += 32
    values = mix((fold.astype(np.uint64) + np.uint64(1)) * _STEP)
    is_separator = np.zeros(256, dtype=bool)
    is_separator[list(separators)] = True
    return values, is_separator


class WordHasher:
    """Hashes of the words of many texts at once.

    A word is a run of bytes outside ``separators``. Equal words have equal hashes
    wherever they stand; the hash is a polynomial in the bytes, then mixed.
    """

    def __init__(self, separators: bytes):
        self.values, self.is_separator = byte_values(separators)
        self.powers = np.ones(1, dtype=np.uint64)
        self.inverse = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if n <= len(self.powers):
            return
        step = np.full(n, _STEP, dtype=np.uint64)
        step[0] = 1
        back = np.full(n, np.uint64(pow(int(_STEP), -1, 1 << 64)), dtype=np.uint64)
        back[0] = 1
        with np.errstate(over="ignore"):
            self.powers, self.inverse = np.cumprod(step), np.cumprod(back)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words in order, for each text the index of its first word; one more at the end)."""
        raw = [(t or "").encode() for t in texts]
        data = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
        ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
        self._grow(len(data) + 1)
        inside = np.concatenate(([False], ~self.is_separator[data], [False]))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edge[0::2], edge[1::2]
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])
            hashes = mix((sums[last] - sums[first]) * self.inverse[first])
        starts = np.searchsorted(first, np.concatenate(([0], ends)))
        return hashes, starts


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` word hashes; shorter input gives none."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        factor = _STEP
        for i in range(width):
            total += hashes[i : i + n] * factor
            factor = np.uint64((int(factor) * int(_STEP)) % (1 << 64))
    return mix(total)


def look_up(rows: DataFrame, values: DataFrame, on: list[str], hot: DataFrame, name: str) -> DataFrame:
    """``rows`` joined with ``values`` by ``on``, all rows kept.

    ``hot`` holds the rows of ``values`` whose keys have many rows; the caller bounds
    their number. They are broadcast, and the other rows are shuffled without them.
    """
    hot = written(hot.select(*values.columns), name)
    many = rows.join(F.broadcast(hot), on)
    few = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(values, on, "left")
    return many.unionByName(few)


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, component): smallest node reachable over undirected ``links`` (a, b).

    Each round gives every node the smallest label among its neighbours, then
    follows that label once more, so the rounds grow with the logarithm of the
    longest path. Labels are written to the shared folder between rounds; nodes
    without a link are not in the result. It ends when a round changes no label.
    """
    both = written(
        links.where("a != b").select("a", "b").union(links.where("a != b").select("b", "a")).distinct(),
        f"{name}-links",
    )
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")),
        f"{name}-labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("near")), "b")
            .groupBy("a")
            .agg(F.min("near").alias("near"))
        )
        nearest = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("label")
        )
        # Every label is a node of the same component: its own label is a shortcut.
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = written(
            nearest.join(jump, "label").select("node", "was", F.least("label", "far").alias("label")),
            f"{name}-labels",
        )
        labels = new.select("node", "label")
        if new.where("label != was").isEmpty():
            return labels.withColumnRenamed("label", "component")
