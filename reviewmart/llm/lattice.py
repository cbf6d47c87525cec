"""Near-duplicate embeddings: E8 lattice hashing, multi-probe, exact cosine."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.llm.common import constants, find_package, mix, table
from reviewmart.llm.components import components
from reviewmart.llm.vectors import block_pairs, is_valid, matrix, over_runs, same_length, unit_rows
from reviewmart.operators.lookup import lookup_join
from reviewmart.session import stage

LEAST_COSINE = 0.93
#: Tables of one random projection to 8 dimensions each, and neighbouring cells probed in each.
TABLES, PROBES = 12, 6
#: Lattice units that a distance of one spans after projection. At cosine 0.93 (distance 0.374)
#: two vectors then lie about 1 apart, where cells have an inner radius of 0.707: in a table 0.77
#: of such pairs have a cell in common, own or probed, in all tables together all but some 10^-8.
SCALE = 1.0 / (0.374 * 8**0.5)
#: Rows of a block. A larger bucket or component is compared block against block.
BLOCK = 1024


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8: two of +-1, or eight of +-1/2 with an even number of minus."""
    rows = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            row = np.zeros(8)
            row[i], row[j] = a, b
            rows.append(row)
    rows += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(rows)


_ROOTS = _roots()
_COORDINATE = constants(8, 41)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest points of D8: whole numbers of even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    off = (x - near)[odd]
    worst = np.abs(off).argmax(axis=1)
    near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8, which is D8 and D8 moved by a half in all coordinates."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


def _names(points: np.ndarray, seed: np.uint64) -> np.ndarray:
    doubled = np.rint(points * 2).astype(np.int64).view(np.uint64)
    return mix((doubled * _COORDINATE).sum(axis=-1, dtype=np.uint64) + seed)


def cells(units: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each table: the cell of each unit vector, and its probed neighbours."""
    dimension = units.shape[1]
    for t in range(TABLES):
        rng = np.random.default_rng([dimension, t])
        projected = units @ rng.normal(0, SCALE, (dimension, 8)) + rng.uniform(0, 2, 8)
        point = nearest_e8(projected)
        nearness = (projected - point) @ _ROOTS.T
        probes = np.argpartition(-nearness, PROBES, axis=1)[:, :PROBES]
        seed = np.uint64(dimension * 1000 + t)
        yield _names(point, seed), _names(point[:, None, :] + _ROOTS[probes], seed)


def _cell_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in same_length(whole, "embedding"):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            labels = mix(batch.column(1).cast(pa.int64()).to_numpy(zero_copy_only=False).view(np.uint64))
            for own, probed in cells(unit_rows(matrix(batch.column(2)))):
                keys = np.concatenate([own[:, None], probed], axis=1) ^ labels[:, None]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(ids, keys.shape[1]))],
                    names=["key", "node"],
                )


def _in_runs(blocks: DataFrame, vectors: DataFrame, key: str, work, schema: str) -> DataFrame:
    keys = [key, "lo", "hi"]
    joined = blocks.join(vectors, "node").repartition(*keys).sortWithinPartitions(*keys, "node")
    return joined.mapInArrow(over_runs(keys, work), schema)


def _linked(run: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of a block pair, their multiplicities, and which are linked."""
    nodes, times = run["node"].to_numpy(), run["times"].to_numpy()
    units = unit_rows(matrix(run["embedding"]))
    linked = units @ units.T >= LEAST_COSINE
    np.fill_diagonal(linked, False)
    labels = run["label"].to_numpy()
    linked &= labels[:, None] == labels[None, :]
    first = run["first"].to_numpy()
    if run["lo"][0].as_py() != run["hi"][0].as_py():
        linked &= first[:, None] != first[None, :]
    return nodes, times, linked


def _spanning_links(run: pa.Table) -> pa.RecordBatch | None:
    """Links that connect whatever all links of a block pair connect."""
    if run.num_rows < 2:
        return None
    nodes, _, linked = _linked(run)
    a, b = [], []
    todo = linked.any(axis=1)
    while todo.any():
        front = [int(todo.argmax())]
        todo[front[0]] = False
        while front:
            x = front.pop()
            new = np.flatnonzero(linked[x] & todo)
            todo[new] = False
            front.extend(new.tolist())
            a.extend([nodes[x]] * len(new))
            b.extend(nodes[new].tolist())
    if not a:
        return None
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _link_counts(run: pa.Table) -> pa.RecordBatch:
    nodes, times, linked = _linked(run)
    return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(linked @ times)], names=["node", "n"])


def near_duplicate_vectors(rows: DataFrame) -> DataFrame:
    """Links of ``rows`` (vec_id, embedding, label; others are ignored) at cosine ``LEAST_COSINE``.

    Returns (vec_id, n_links, component_id, kept) per row. Equal vectors of one label are one
    class, hashed once whatever their number. Classes that have a cell in common, their own or
    a probed one, are compared exactly, in blocks; only links that hold a bucket together are
    handed on. Components follow from these, and since all links of a vector lie in its
    component, the links are counted there, again in blocks and exactly.

    Null labels, and vectors that are null, empty, zero or not finite, link with nothing;
    vectors of different lengths do not link. A null vec_id links with nothing and is kept.
    Rows that share a vec_id but not label and vector are vectors of their own: each has the links
    of its own vector, and the id counts in the component of each.
    """
    find_package(rows.sparkSession)
    rows = rows.select("vec_id", "embedding", "label")
    part = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & is_valid(F.col("embedding"))
    classes = stage(
        rows.where(part)
        .groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("times"))
        # A vec_id may stand in several classes, so these have numbers of their own.
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    vectors = classes.select("node", "label", "embedding", "times")
    found = stage(
        classes.select("node", "label", "embedding").mapInArrow(_cell_batches, "key long, node long"),
        "cells",
    )
    shared = found.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("y"))
    buckets = stage(
        found.join(shared.where("x <> y").select("key"), "key", "left_semi").select("key", "node").distinct(),
        "buckets",
    )
    links = _in_runs(block_pairs(buckets, "key", BLOCK), vectors, "key", _spanning_links, "a long, b long")
    named = stage(components(links), "components")
    counts = _in_runs(block_pairs(named, "component", BLOCK), vectors, "component", _link_counts, "node long, n long")
    counted = stage(
        classes.join(named, "node", "left")
        .join(counts.groupBy("node").agg(F.sum("n").alias("n")), "node", "left")
        .select(
            "label",
            "embedding",
            "least",
            "component",
            (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"),
        ),
        "counted",
    )
    least = stage(
        counted.where("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("component_id")), "least"
    )
    columns = ("label", "embedding", "component_id", "n_links")
    by_class = stage(
        lookup_join(counted.where("component IS NOT NULL"), least, ["component"])
        .select(*columns)
        .unionByName(counted.where("component IS NULL").withColumn("component_id", F.col("least")).select(*columns)),
        "classes",
    )
    alone = rows.where(~part).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    joined = rows.where(part).join(by_class, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    return joined.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op4_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links of all embeddings."""
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {"op4_lattice": op4_lattice}
ORACLES: dict[str, str] = {}
