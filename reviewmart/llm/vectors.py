"""What the vector operators share: valid rows, matrices, runs of equal keys in a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_valid(vector: Column) -> Column:
    """Whether a vector has only finite components, and one that is not zero."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths, as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows divided by their lengths; scaled first, so no square overflows."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def same_length(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose vectors have one length each."""
    lengths = batch.column(batch.schema.get_field_index(column)).value_lengths().to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        yield batch if (lengths == length).all() else batch.filter(pa.array(lengths == length))


def over_runs(keys: list[str], work: Callable[[pa.Table], pa.RecordBatch | None]):
    """Apply ``work`` to each run of rows of equal ``keys`` in a stream sorted by them.

    Groups of a few rows cost no more than their rows, where a grouped function would start
    anew for each; one group at a time is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
            new = np.zeros(batch.num_rows, bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            first = tuple(c[0] for c in columns)
            if rest and first != last:
                yield from filter(None, [work(pa.Table.from_batches(rest))])
                rest = []
            last = tuple(c[-1] for c in columns)
            cuts = [0, *np.flatnonzero(new).tolist()]
            for a, b in zip(cuts[:-1], cuts[1:]):
                rest.append(batch.slice(a, b - a))
                yield from filter(None, [work(pa.Table.from_batches(rest))])
                rest = []
            rest.append(batch.slice(cuts[-1]))
        if rest:
            yield from filter(None, [work(pa.Table.from_batches(rest))])

    return run


def block_pairs(members: DataFrame, key: str, block: int) -> DataFrame:
    """Members (key, node) of groups, dealt to all pairs of blocks of about ``block`` of their group.

    Rows (key, lo, hi, first, node): whoever holds one (key, lo, hi) can compare the nodes of
    block ``lo`` (first) with those of ``hi``. A group of any size becomes tasks of bounded size.
    """
    sizes = members.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("blocks"))
    members = members.join(sizes, key).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    return members.withColumn("other", other).select(
        key,
        F.least("block", "other").alias("lo"),
        F.greatest("block", "other").alias("hi"),
        (F.col("block") <= F.col("other")).alias("first"),
        "node",
    )
