"""Near-duplicate documents by fast similarity sketches, banding and exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.llm.common import constants, mix, table, text_chunks, word_hashes
from reviewmart.llm.components import components
from reviewmart.llm.vectors import block_pairs, over_runs
from reviewmart.session import stage

WORDS = 5
#: Linked: NUMERATOR * union <= 100 * intersection.
NUMERATOR = 75
BANDS, ROWS = 64, 6
COORDINATES = BANDS * ROWS
#: Sketches are compared by one byte of each coordinate. A pair of similarity 0.75 has this many
#: equal ones but for one case in 30,000; only such pairs have their sets fetched.
LEAST_EQUAL = int(COORDINATES * 0.75 - 4 * (COORDINATES * 0.75 * 0.25) ** 0.5)
#: The same by one bit, at six standard deviations: a cheap first look.
LEAST_BITS = int(COORDINATES * 0.875 - 6 * (COORDINATES * 0.875 * 0.125) ** 0.5)
#: Nodes of a bucket that are compared with as many others at once.
BLOCK = 512
#: Candidate ids up to this count (16 MB) are sent to all tasks; beyond it texts are shuffled.
BROADCAST_IDS = 1_000_000

_WORDS = tuple(f"bits{k}" for k in range(COORDINATES // 64))
_SKETCHED = "doc_id long, n_shingles long, digest binary, bands array<long>, sketch binary, " + ", ".join(f"{w} long" for w in _WORDS)

_SHINGLE = constants(WORDS, 11)
_SEEDS = constants(2 * COORDINATES, 23)
_FOLD = constants(ROWS, 31)
_BAND = constants(BANDS, 37)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    words, first = word_hashes(data, offsets)
    windows = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
    for k in range(WORDS):
        windows += words[k : k + len(windows)] * _SHINGLE[k]
    windows = mix(windows)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= WORDS:
            yield np.unique(windows[a : b - WORDS + 1])
        elif b > a:
            short = np.add.reduce(words[a:b] * _SHINGLE[: b - a], dtype=np.uint64)
            yield mix(np.array([short + np.uint64(b - a)], np.uint64))
        else:
            yield windows[:0]


def fast_sketch(items: np.ndarray) -> np.ndarray:
    """The fast similarity sketch of a non-empty set of hashes.

    Round i throws every item into a random bin with a random value; a bin keeps its least
    (round, value). In the second half of the rounds all items go to bin i - COORDINATES, so
    every bin is filled at last; almost always a few rounds suffice, and later rounds cannot
    change a filled bin, so the rounds stop there.
    """
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    bins = np.full(COORDINATES, empty, np.uint64)
    done, step = 0, max(1, min(2048 // len(items), COORDINATES))
    while done < 2 * COORDINATES:
        upto = min(done + step, COORDINATES if done < COORDINATES else 2 * COORDINATES)
        thrown = mix(items[None, :] ^ _SEEDS[done:upto, None])
        rounds = np.arange(done, upto, dtype=np.uint64)[:, None]
        value = (rounds << np.uint64(48)) | (thrown >> np.uint64(16))
        if done < COORDINATES:
            np.minimum.at(bins, (thrown % np.uint64(COORDINATES)).astype(np.int64).ravel(), value.ravel())
        else:
            at = np.arange(done, upto) - COORDINATES
            bins[at] = np.minimum(bins[at], value.min(axis=1))
        done = upto
        if (bins != empty).all():
            break
    return mix(bins)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One key per band of ROWS coordinates, of their bytes as they are compared later."""
    folded = (sketch.reshape(BANDS, ROWS) + np.uint64(1)) * _FOLD
    return mix(folded.sum(axis=1, dtype=np.uint64) + _BAND)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, offsets in text_chunks(batch):
            sizes, digests, bands, sketches = [], [], [], []
            for items in shingle_sets(data, offsets):
                sizes.append(len(items))
                if not len(items):
                    digests.append(None)
                    bands.append(None)
                    sketches.append((None, [None] * len(_WORDS)))
                    continue
                digests.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                sketch = fast_sketch(items).astype(np.uint8)
                bands.append(band_keys(sketch).view(np.int64))
                sketches.append((sketch.tobytes(), np.packbits(sketch & 1).view(np.int64).tolist()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[low:high],
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array([s[0] for s in sketches], pa.binary()),
                    *(pa.array([s[1][k] for s in sketches], pa.int64()) for k in range(len(_WORDS))),
                ],
                names=["doc_id", "n_shingles", "digest", "bands", "sketch", *_WORDS],
            )


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, offsets in text_chunks(batch):
            sets = [items.view(np.int64) for items in shingle_sets(data, offsets)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[low:high], pa.array(sets, pa.list_(pa.int64()))], names=["node", "items"]
            )


def _equal_bits(left: str, right: str):
    return F.lit(COORDINATES) - sum(
        F.bit_count(F.col(f"{left}{k}").bitwiseXOR(F.col(f"{right}{k}"))) for k in range(len(_WORDS))
    )


def _likely(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs whose set sizes allow a link and whose sketches make one likely."""
    side = nodes.select("node", "n_shingles", *_WORDS)
    for end in ("a", "b"):
        pairs = pairs.join(side.toDF(end, f"n{end}", *(f"{end}{k}" for k in range(len(_WORDS)))), end)
    return (
        pairs.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * NUMERATOR)
        .where(_equal_bits("a", "b") >= LEAST_BITS)
        .select("a", "b", "na", "nb")
    )


def _verified(docs: DataFrame, likely: DataFrame) -> DataFrame:
    """The likely pairs whose full shingle sets are similar enough."""
    ends = likely.select(F.col("a").alias("node")).distinct().unionAll(likely.select("b").distinct())
    ids = stage(ends.distinct(), "wanted")
    few = ids.count() <= BROADCAST_IDS
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(
        F.broadcast(ids) if few else ids, "node", "left_semi"
    )
    sets = stage(texts.mapInArrow(_set_batches, "node long, items array<long>"), "sets")
    common = F.size(F.array_intersect("ia", "ib"))
    return (
        likely.join(sets.toDF("b", "ib"), "b")
        .join(sets.toDF("a", "ia"), "a")
        .where(common * 100 >= (F.col("na") + F.col("nb") - common) * NUMERATOR)
        .select("a", "b")
    )


def _open_buckets(entries: DataFrame, found: DataFrame) -> DataFrame:
    """Rows (key, node, component) of the buckets that hold several components."""
    named = entries.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ends = named.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    return named.join(ends.where("x <> y").select("key"), "key", "left_semi")


def _apart_but_alike(run: pa.Table) -> pa.RecordBatch | None:
    """Pairs of one block pair that lie in different components and have like sketches.

    A pair is given by the first bucket that both are in, and by no other.
    """
    rows, first = run.num_rows, run["first"].to_numpy(zero_copy_only=False)
    node, component, size = (run[c].to_numpy() for c in ("node", "component", "n_shingles"))
    sketch = np.frombuffer(b"".join(run["sketch"].to_pylist()), np.uint8).reshape(rows, COORDINATES)
    bits = np.packbits(sketch & 1, axis=1).view(np.uint64)
    same = run["lo"][0].as_py() == run["hi"][0].as_py()
    left = np.arange(rows) if same else np.flatnonzero(first)
    right = np.arange(rows) if same else np.flatnonzero(~first)
    key, pairs = np.int64(run["key"][0].as_py()), []
    for i in left.tolist():
        j = right[right > i] if same else right
        j = j[component[j] != component[i]]
        j = j[np.minimum(size[j], size[i]) * 100 >= np.maximum(size[j], size[i]) * NUMERATOR]
        j = j[COORDINATES - np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64) >= LEAST_BITS]
        equal = sketch[j] == sketch[i]
        alike = equal.sum(axis=1) >= LEAST_EQUAL
        j, equal = j[alike], equal[alike]
        if len(j):
            shared = equal.reshape(len(j), BANDS, ROWS).all(axis=2).argmax(axis=1)
            j = j[band_keys(sketch[i]).view(np.int64)[shared] == key]
            pairs.extend((node[i], x, size[i], n) for x, n in zip(node[j].tolist(), size[j].tolist()))
    if not pairs:
        return None
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs)], names=["a", "b", "na", "nb"])


def _remaining(nodes: DataFrame, entries: DataFrame, found: DataFrame) -> DataFrame:
    """All pairs (a, b, na, nb) that share a bucket, lie in different components and look alike."""
    open_ = stage(_open_buckets(entries, found), "open")
    about = open_.select("node", "component").distinct().join(nodes.select("node", "n_shingles", "sketch"), "node")
    keys = ["key", "lo", "hi"]
    met = block_pairs(open_.select("key", "node"), "key", BLOCK).join(about, "node")
    return met.repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(
        over_runs(keys, _apart_but_alike), "a long, b long, na long, nb long"
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Classes of near-duplicate documents of ``docs`` (doc_id, text; others are ignored).

    Returns (doc_id, n_shingles, component_id, kept), one row per input row. Documents of equal
    shingle sets are one class, whatever their number, and only classes are compared. In a
    bucket, the least node is compared with all others. Where a bucket then still holds several
    components, in blocks, every two nodes of different ones are looked at, and verified where
    their sketches are alike. So copies never make all their pairs, and no pair that could join
    two components is left out.

    Null and empty texts have no shingles and stand alone. A null doc_id stands alone and is
    kept. Rows of the same doc_id count as one document.
    """
    sketches = stage(docs.select("doc_id", "text").mapInArrow(_sketch_batches, _SKETCHED), "sketches")
    nodes = stage(
        sketches.where("digest IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min_by(F.struct("n_shingles", "bands", "sketch", *_WORDS), "doc_id").alias("s"), F.min("doc_id").alias("node"))
        .select("digest", "node", "s.*"),
        "nodes",
    )
    entries = nodes.select(F.explode("bands").alias("key"), "node").distinct()
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    entries = stage(entries.join(shared, "key", "left_semi"), "entries")
    pivots = entries.groupBy("key").agg(F.min("node").alias("pivot"))
    pairs = entries.join(pivots, "key").where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    links = _verified(docs, stage(_likely(nodes, pairs.distinct()), "likely"))
    found = stage(components(links), "components")
    remaining = stage(_remaining(nodes, entries, found), "remaining")
    if not remaining.isEmpty():
        links = _verified(docs, remaining)
        found = stage(components(links.unionAll(found.select("node", "component"))), "components")
    classes = nodes.join(found.toDF("node", "component_id"), "node", "left").select(
        "digest", F.coalesce("component_id", "node").alias("component_id")
    )
    classes = stage(classes, "classes")
    rows = sketches.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op9_minhash": op9_minhash}
ORACLES: dict[str, str] = {}
