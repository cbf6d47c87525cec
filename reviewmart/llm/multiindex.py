"""Approximate nearest neighbours by an inverted multi-index."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmart.llm.common import find_package, table
from reviewmart.llm.vectors import is_valid, matrix, over_runs
from reviewmart.session import stage

NEIGHBOURS = 20
#: Vectors of least hash that the centroids are fitted on.
SAMPLE = 8192
#: Vectors a cell should hold on average, and the most centroids of a half.
PER_CELL, MOST_CENTROIDS = 8, 256
#: A query visits cells, nearest first, until they hold this share of all vectors (and LEAST at
#: least). Random directions in 64 dimensions have no close neighbours, so the share that gives
#: a recall over 0.9 on them is large; on clustered vectors a few hundredths do.
SHARE, LEAST = 0.65, 1000
#: Vectors and queries that meet in one matrix product.
BLOCK, QUERY_BLOCK = 4096, 2048


@dataclass
class Codebook:
    """Centroids of the two halves. Vectors get one more coordinate that makes them all equally
    long, so the nearest by distance is the one of largest inner product."""

    halves: tuple[np.ndarray, np.ndarray]
    longest: float

    def split(self, rows: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray]:
        cut = rows.shape[1] // 2
        squares = (rows * rows).sum(axis=1)
        lift = np.zeros(len(rows)) if query else np.sqrt(np.maximum(self.longest**2 - squares, 0))
        return rows[:, :cut], np.concatenate([rows[:, cut:], lift[:, None]], axis=1)

    def distances(self, rows: np.ndarray, query: bool) -> list[np.ndarray]:
        return [_squared(part, c) for part, c in zip(self.split(rows, query), self.halves)]


def _squared(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (rows * rows).sum(1)[:, None] - 2 * rows @ centroids.T + (centroids * centroids).sum(1)[None, :]


def _k_means(rows: np.ndarray, count: int) -> np.ndarray:
    rng = np.random.default_rng(5)
    centroids = rows[rng.choice(len(rows), count, replace=False)]
    for _ in range(12):
        nearest = _squared(rows, centroids).argmin(axis=1)
        for k in range(count):
            own = rows[nearest == k]
            centroids[k] = own.mean(axis=0) if len(own) else rows[rng.integers(len(rows))]
    return centroids


def fit(sample: np.ndarray, longest: float, count: int) -> Codebook:
    book = Codebook((np.zeros((0, 0)), np.zeros((0, 0))), longest)
    count = min(count, len(sample))
    book.halves = tuple(_k_means(part, count) for part in book.split(sample, query=False))
    return book


def visit(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int) -> list[tuple[int, int]]:
    """Pairs of centroids by growing sum of their distances, until their cells hold ``wanted``."""
    rows, columns = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[rows].tolist(), second[columns].tolist()
    rows, columns = rows.tolist(), columns.tolist()
    heap, reached, out, held = [(a[0] + b[0], 0, 0)], [0] * len(a), [], 0
    while heap and held < wanted:
        _, x, y = heapq.heappop(heap)
        cell = (rows[x], columns[y])
        out.append(cell)
        held += sizes[cell]
        # (x, y + 1) follows once (x - 1, y + 1) was taken, and (x + 1, y) once (x + 1, y - 1) was.
        reached[x] = y + 1
        if y + 1 < len(b) and (x == 0 or reached[x - 1] > y + 1):
            heapq.heappush(heap, (a[x] + b[y + 1], x, y + 1))
        if x + 1 < len(a) and reached[x + 1] == y:
            heapq.heappush(heap, (a[x + 1] + b[y], x + 1, y))
    return out


def _assign(book: Codebook):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = [d.argmin(axis=1).astype(np.int32) for d in book.distances(matrix(batch.column(1)), False)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(near[0]), pa.array(near[1])], names=["node", "embedding", "i", "j"]
                )

    return run


def _visits(book: Codebook, sizes: np.ndarray, wanted: int):
    """For each query and first centroid, the second centroids whose cells it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at, i, j = [], [], []
            for row, (a, b) in enumerate(zip(*book.distances(matrix(batch.column(1)), True))):
                by_first: dict[int, list[int]] = {}
                for x, y in visit(a, b, sizes, wanted):
                    if sizes[x, y]:
                        by_first.setdefault(x, []).append(y)
                at.extend([row] * len(by_first))
                i.extend(by_first)
                j.extend(by_first.values())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at, pa.int64())),
                    batch.column(1).take(pa.array(at, pa.int64())),
                    pa.array(i, pa.int32()),
                    pa.array(j, pa.list_(pa.int32())),
                ],
                names=["node", "embedding", "i", "visited"],
            )

    return run


def _best_of_run(centroids: int, keep: int):
    def work(run: pa.Table) -> pa.RecordBatch | None:
        asks = run["is_query"].to_numpy()
        queries, entries = run.filter(pa.array(asks)), run.filter(pa.array(~asks))
        if not queries.num_rows or not entries.num_rows:
            return None
        q, e = matrix(queries["embedding"]), matrix(entries["embedding"])
        allowed = np.zeros((len(q), centroids), bool)
        visited = queries["visited"].combine_chunks()
        allowed[np.repeat(np.arange(len(q)), visited.value_lengths().to_numpy()), visited.flatten().to_numpy()] = True
        products = np.where(allowed[:, entries["j"].to_numpy()], q @ e.T, -np.inf)
        best = np.argpartition(-products, keep, axis=1)[:, :keep] if keep < len(e) else np.tile(np.arange(len(e)), (len(q), 1))
        row = np.repeat(np.arange(len(q)), best.shape[1])
        best = best.ravel()
        real = np.isfinite(products[row, best])
        row, best = row[real], best[real]
        # Summed pair by pair, so a score does not depend on the block it was found in.
        scores = (q[row] * e[best]).sum(axis=1)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(queries["node"].to_numpy()[row]),
                pa.array(entries["node"].to_numpy()[best]),
                pa.array(scores),
            ],
            names=["query", "node", "score"],
        )

    return work


def _search(entries: DataFrame, asking: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` best entries found of each asking node, as (query, node, score)."""
    kind = entries.schema["embedding"].dataType.simpleString()
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    n, longest = entries.agg(F.count(F.lit(1)), F.max(norm)).first()
    sample = entries.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("embedding").toArrow()
    centroids = int(min(MOST_CENTROIDS, max(1, (n / PER_CELL) ** 0.5)))
    book = fit(matrix(sample["embedding"]), longest, centroids)
    centroids = len(book.halves[0])
    placed = stage(entries.mapInArrow(_assign(book), f"node long, embedding {kind}, i int, j int"), "placed")
    sizes = np.zeros((centroids, centroids), np.int64)
    for r in placed.groupBy("i", "j").count().collect():
        sizes[r["i"], r["j"]] = r["count"]
    wanted = max(LEAST, int(np.ceil(SHARE * n)))
    queries = asking.join(placed, "node").select("node", "embedding")
    visits = stage(
        queries.mapInArrow(
            _visits(book, sizes, wanted), f"node long, embedding {kind}, i int, visited array<int>"
        ),
        "visits",
    )
    asked = max(1, -(-asking.count() // QUERY_BLOCK))
    parts = F.element_at(F.array(*(F.lit(max(1, -(-int(s) // BLOCK))) for s in sizes.sum(axis=1))), F.col("i") + 1)
    hashed = F.xxhash64("node")

    def others(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), count.cast("int") - 1))

    left = placed.withColumns({"part": F.pmod(hashed, parts).cast("int"), "is_query": F.lit(False)}).withColumn(
        "block", others(F.lit(asked))
    )
    right = visits.withColumns({"block": F.pmod(hashed, F.lit(asked)).cast("int"), "is_query": F.lit(True)}).withColumn(
        "part", others(parts)
    )
    names = ["i", "part", "block", "is_query", "node", "embedding", "j", "visited"]
    both = left.withColumn("visited", F.array().cast("array<int>")).select(names).unionAll(
        right.withColumn("j", F.lit(-1)).select(names)
    )
    keys = ["i", "part", "block"]
    met = both.repartition(*keys).sortWithinPartitions(*keys, "is_query", "node")
    found = met.mapInArrow(over_runs(keys, _best_of_run(centroids, keep)), "query long, node long, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "node"))
    return found.withColumn("rank", rank).where(F.col("rank") <= keep).drop("rank")


def nearest(rows: DataFrame, asks: Column, neighbours: int = NEIGHBOURS) -> DataFrame:
    """For each row of ``rows`` (vec_id, embedding) where ``asks``: the nearest others found.

    Returns (query_id, rank, vec_id, score): largest inner product first, in double precision on
    the given vectors, ties to the smaller vec_id. Equal vectors are indexed and searched once;
    of each, the ``neighbours`` + 1 least ids are kept, and no answer can hold more. Null ids,
    and vectors that are null, empty, zero or not finite, take no part; vectors meet those of
    their own length only. Repeated rows of one id count once.
    """
    find_package(rows.sparkSession)
    keep = neighbours + 1
    rows = (
        rows.select("vec_id", "embedding", asks.alias("asks"))
        .where(F.col("vec_id").isNotNull() & is_valid(F.col("embedding")))
        .dropDuplicates(["vec_id", "embedding"])
    )
    nodes = stage(rows.groupBy("embedding").agg(F.min("vec_id").alias("node")), "entries").select("node", "embedding")
    named = stage(rows.join(nodes, "embedding").select("vec_id", "asks", "node"), "named")
    least = F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))
    members = named.withColumn("r", least).where(F.col("r") <= keep).select("node", "vec_id")
    asking = named.where("asks").select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"))
    found = None
    for length in sorted(r[0] for r in nodes.select(F.size("embedding")).distinct().collect()):
        entries = nodes.where(F.size("embedding") == length)
        part = _search(entries, asking.select(F.col("query").alias("node")).distinct(), keep)
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = asking.select("query", F.col("query").alias("node"), F.lit(0.0).alias("score")).limit(0)
    found = stage(found, "found")
    by_query = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    answers = stage(
        found.join(members, "node").withColumn("r", F.row_number().over(by_query)).where(F.col("r") <= keep).drop("r", "node"),
        "answers",
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        asking.join(answers, "query")
        .where("query_id <> vec_id")
        .withColumn("rank", rank)
        .where(F.col("rank") <= neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )


def op3_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth embedding among all others."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES = {"op3_multi_index": op3_multi_index}
ORACLES: dict[str, str] = {}
