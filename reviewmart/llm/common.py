"""What several operators share: table access, folds, whole-text word hashing."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of text that are hashed at once; longer texts are taken alone.
CHUNK_BYTES = 4 << 20
#: Bytes whose prefix sums are held at once while their words are hashed; a longer word is held whole.
HASHED_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster whose machines hold no copy there, ship it with ``--py-files`` instead.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo: the fold of a row. A null falls in fold 0."""
    crc = F.crc32(column.cast("string").cast("binary"))
    return F.coalesce(crc % F.lit(modulus), F.lit(0))


def least_hashed(rows: DataFrame, by: str, count: int) -> DataFrame:
    """Of each value of ``by``, the ``count`` rows (doc_id, by) of least hash, with their rank.

    Rows whose hash is too great for their class are dropped where they lie, so only about twice
    the wanted number of rows is ranked, whatever the size of a class.
    """
    spread = 1 << 30
    place = F.pmod(F.xxhash64("doc_id"), F.lit(spread))
    sizes = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    near = rows.join(F.broadcast(sizes), by).where(place * F.col("n") < spread * (2 * count + 100)).drop("n")
    order = F.row_number().over(Window.partitionBy(by).orderBy(place, "doc_id"))
    return near.withColumn("rank", order).where(F.col("rank") <= count)


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(count: int, seed: int) -> np.ndarray:
    """Odd 64-bit multipliers, the same on every machine."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(seed)) | np.uint64(1)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_chunks(
    batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``size`` bytes: first row, row after the last, bytes, offsets."""
    data, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < size:
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        _powers = (tables[0], tables[1])
    return _powers


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of the words of all rows, and each row's first word.

    Words are runs of bytes other than 0x20 and 0x09-0x0D.
    """
    n = len(data)
    if not n:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, np.zeros(len(offsets), np.int64)
    solid = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = ~solid[:-1] | edge[1:n]
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = before[1:] | ~solid[1:]
    starts = np.flatnonzero(solid & before)
    return starts, np.flatnonzero(solid & after) + 1, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans, with A-Z lower-cased.

    A span's hash is the difference of two prefix sums of a polynomial, so no Python object is
    made for a word.
    """
    hashes = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        base = starts[low]
        high = max(int(np.searchsorted(ends, base + HASHED_BYTES, "right")), low + 1)
        block = data[base : ends[high - 1]]
        powers, inverses = _power_tables(len(block) + 1)
        sums = np.empty(len(block) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((_LOWER[block] + np.uint64(1)) * powers[: len(block)], out=sums[1:])
        s, e = starts[low:high] - base, ends[low:high] - base
        hashes[low:high] = mix((sums[e] - sums[s]) * inverses[s])
        low = high
    return hashes


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows, and each row's first word."""
    starts, ends, first = word_spans(data, offsets)
    return hash_spans(data, starts, ends), first
