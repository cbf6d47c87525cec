"""Toxicity by class-conditional Kneser-Ney models with shared backoff counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from reviewmart.llm.common import find_package, least_hashed, mix, remainder, table, text_chunks, word_hashes
from reviewmart.session import stage

#: Labelled rows of each class that are learned from; every FIFTH of them calibrates.
ROWS_PER_CLASS = 4000
FIFTH = 5
#: From each count of a class is taken what the counts of both classes lead to expect of it and so many
#: standard errors more, of a word's and of a pair's, but DISCOUNT at least. What is taken goes to the shared
#: distribution, so words that are as frequent in both classes tell nothing, however many there are.
DISCOUNT = 0.75
WORD_ERRORS, PAIR_ERRORS = 2.5, 3.0
THRESHOLD = 0.3
#: Bytes of text scored at once.
SCORED_BYTES = 1 << 20

_PAIR = np.uint64(0xD6E8FEB86659FD93)
_BEGIN = np.uint64(0x243F6A8885A308D3)
_BITS = 22


def _pairs(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word before each word (a mark at the begin of a row) and the key of both."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[first[:-1][first[:-1] < first[1:]]] = _BEGIN
    return before, mix(before * _PAIR + words)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that hold a word, or a word pair, of rows (text, toxic)."""
    for batch in batches:
        for low, high, data, offsets in text_chunks(batch):
            toxic = batch.column(1)[low:high].to_numpy(zero_copy_only=False).astype(bool)
            words, first = word_hashes(data, offsets)
            before, key = _pairs(words, first)
            row = np.repeat(np.arange(len(toxic)), np.diff(first))
            columns: list[list[np.ndarray]] = [[], [], [], [], []]
            for context, name in ((np.zeros_like(words), words), (before, key)):
                order = np.lexsort((row, name))
                sorted_name, sorted_row = name[order], row[order]
                new = np.ones(len(order), bool)
                new[1:] = (sorted_name[1:] != sorted_name[:-1]) | (sorted_row[1:] != sorted_row[:-1])
                names, at, group = np.unique(sorted_name[new], return_index=True, return_inverse=True)
                kind = toxic[sorted_row[new]]
                columns[0].append(context[order][new][at])
                columns[1].append(words[order][new][at])
                columns[2].append(names)
                columns[3].append(np.bincount(group, weights=~kind, minlength=len(names)))
                columns[4].append(np.bincount(group, weights=kind, minlength=len(names)))
            joined = [np.concatenate(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([False, True], [len(c) for c in columns[0]])),
                    pa.array(joined[0].view(np.int64)),
                    pa.array(joined[1].view(np.int64)),
                    pa.array(joined[2].view(np.int64)),
                    pa.array(joined[3].astype(np.int64)),
                    pa.array(joined[4].astype(np.int64)),
                ],
                names=["is_pair", "before", "word", "name", "c0", "c1"],
            )


class _Table:
    """Sorted keys with a bit filter in front, so most unknown keys cost one lookup."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.filter = np.zeros(1 << _BITS, bool)
        self.filter[(self.keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def find(self, keys: np.ndarray, missing: float) -> np.ndarray:
        out = np.full(len(keys), missing)
        maybe = np.flatnonzero(self.filter[(keys >> np.uint64(64 - _BITS)).astype(np.int64)])
        at = np.searchsorted(self.keys, keys[maybe])
        hit = at < len(self.keys)
        hit[hit] = self.keys[at[hit]] == keys[maybe][hit]
        out[maybe[hit]] = self.values[at[hit]]
        return out


@dataclass
class ToxicityModel:
    """Kneser-Ney models of both classes, as log p(toxic) minus log p(ordinary).

    A pair of which a class keeps a count has a ratio of its own. Any other token has that of its
    word and that of the weights with which the word before it backs off; a word of which no class
    keeps a count, also one never seen, has that of the weights of the shared distribution.
    """

    words: _Table
    pairs: _Table
    contexts: _Table
    other: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def ratios(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Toxic minus ordinary log likelihood of each row of a chunk, over its words."""
        words, first = word_hashes(data, offsets)
        if not len(words):
            return np.zeros(len(offsets) - 1)
        before, key = _pairs(words, first)
        logs = self.words.find(words, self.other) + self.contexts.find(before, 0.0)
        known = self.pairs.find(key, np.nan)
        gain = np.concatenate([[0.0], np.cumsum(np.where(np.isnan(known), logs, known))])
        return (gain[first[1:]] - gain[first[:-1]]) / np.maximum(np.diff(first), 1)

    def scores(self, ratios: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * ratios + self.shift, -500, 500)))


def _kept(count, expected, errors: float):
    """What absolute discounting leaves of a count; the discount grows with what is expected."""
    discount = F.greatest(F.lit(DISCOUNT), expected + F.lit(errors) * F.sqrt(expected + 1))
    return F.greatest(count - discount, F.lit(0.0))


def _calibrate(ratios: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Platt's logistic curve over the ratios, with smoothed targets, by Newton's method."""
    ones, zeros = int(toxic.sum()), int((~toxic).sum())
    if not ones or not zeros:
        return (1.0, 4.0 if ones else -4.0)
    target = np.where(toxic, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    scale = ratios.std() or 1.0
    x = np.stack([ratios / scale, np.ones(len(ratios))], 1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target))
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); null labels are left out.

    The ``ROWS_PER_CLASS`` labelled documents of least hash in each class are the sample. A
    document that has both labels counts as toxic, and so does a text; equal texts count once.
    Without labelled documents of both classes every score is the same.
    """
    find_package(docs.sparkSession)
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = least_hashed(known, "toxic", ROWS_PER_CLASS)
    texts = stage(
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")
        .groupBy("text")
        .agg((F.max("toxic") > 0).alias("toxic"), F.min("rank").alias("rank"))
        .withColumn("held", F.col("rank") % FIFTH == 0),
        "sample",
    )
    counted = stage(
        texts.where("NOT held")
        .select("text", "toxic")
        .mapInArrow(_count_batches, "is_pair boolean, before long, word long, name long, c0 long, c1 long")
        .groupBy("is_pair", "before", "word", "name")
        .agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")),
        "counted",
    )
    model = _models(counted)
    held = texts.where("held").select("text", "toxic").mapInArrow(_ratio_batches(model), "toxic boolean, ratio double")
    held = held.toPandas().sort_values(["toxic", "ratio"])
    model.slope, model.shift = _calibrate(held["ratio"].to_numpy(float), held["toxic"].to_numpy(bool))
    return model


def _models(counted: DataFrame) -> ToxicityModel:
    """Class models of all words and pairs, from their documents of each class (``c0, c1``).

    A word counts once for each document, but no more often than it has different words before
    it: words of a passage that many documents repeat always follow the same word, so copies of a
    document tell nothing. Shares are taken relative to those of the shared distribution.
    """
    pairs = counted.where("is_pair")
    follows = pairs.groupBy(F.col("word").alias("name")).agg(
        *(F.sum((F.col(f"c{y}") > 0).cast("long")).alias(f"n{y}") for y in (0, 1))
    )
    words = counted.where("NOT is_pair").join(follows, "name").select(
        "name", *(F.least(f"c{y}", f"n{y}").cast("double").alias(f"m{y}") for y in (0, 1))
    )
    size = words.agg(*(F.coalesce(F.sum(f"m{y}"), F.lit(0.0)) for y in (0, 1))).first()
    if not size[0] or not size[1]:
        none = _Table(np.zeros(0, np.uint64), np.zeros(0))
        return ToxicityModel(none, none, none)
    share = (F.col("m0") + F.col("m1")) / F.lit(size[0] + size[1])
    words = stage(
        words.withColumn("share", share).withColumns(
            {f"k{y}": _kept(F.col(f"m{y}"), F.col("share") * F.lit(size[y]), WORD_ERRORS) for y in (0, 1)}
        ),
        "words",
    )
    kept = words.agg(F.sum("k0"), F.sum("k1")).first()
    back = [max(1 - kept[y] / size[y], 1e-6) for y in (0, 1)]
    gains = {f"g{y}": F.col(f"k{y}") / (F.col("share") * F.lit(size[y])) + F.lit(back[y]) for y in (0, 1)}
    words = words.withColumns(gains).withColumn("ratio", F.log("g1") - F.log("g0"))

    totals = pairs.groupBy("before").agg(*(F.sum(f"c{y}").alias(f"t{y}") for y in (0, 1)))
    pool = (F.col("c0") + F.col("c1")) / (F.col("t0") + F.col("t1"))
    pairs = (
        pairs.join(words.select(F.col("name").alias("word"), "g0", "g1"), "word")
        .join(totals, "before")
        .withColumn("pool", pool)
        .withColumns(
            {f"k{y}": _kept(F.col(f"c{y}"), F.col(f"t{y}") * F.col("pool") * F.col(f"g{y}"), PAIR_ERRORS) for y in (0, 1)}
        )
        .where("k0 > 0 OR k1 > 0")
    )
    pairs = stage(pairs.select("before", "name", "pool", "g0", "g1", "t0", "t1", "k0", "k1"), "pairs")

    def weight(y: int):
        return F.greatest(1 - F.sum(f"k{y}") / F.greatest(F.max(f"t{y}"), F.lit(1)), F.lit(1e-6)).alias(f"b{y}")

    contexts = pairs.groupBy("before").agg(weight(0), weight(1))
    own = {
        f"q{y}": F.col(f"k{y}") / (F.greatest(f"t{y}", F.lit(1)) * F.col("pool")) + F.col(f"b{y}") * F.col(f"g{y}")
        for y in (0, 1)
    }
    pairs = pairs.join(contexts, "before").withColumns(own)
    return ToxicityModel(
        _collected(words.where("k0 > 0 OR k1 > 0").select("name", "ratio")),
        _collected(pairs.select("name", F.log("q1") - F.log("q0"))),
        _collected(contexts.select("before", F.log("b1") - F.log("b0"))),
        float(np.log(back[1] / back[0])),
    )


def _collected(ratios: DataFrame) -> _Table:
    """Keys and ratios as a table; the sample bounds their number."""
    found = ratios.toPandas()
    return _Table(found.iloc[:, 0].to_numpy(np.int64).view(np.uint64), found.iloc[:, 1].to_numpy(float))


def _ratio_batches(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_chunks(batch):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1)[low:high], pa.array(model.ratios(data, offsets))], names=["toxic", "ratio"]
                )

    return run


def scored(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` (text and others) with a column ``score`` in 0 to 1 put after its own.

    Only the text is looked at, all of it. Null and empty texts have a ratio of 0. A column of
    the same name gives way.
    """
    find_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_chunks(batch, size=SCORED_BYTES):
                found = shared.value.scores(shared.value.ratios(data, offsets))
                rows = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(found)], names=[*batch.schema.names, "score"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("score", DoubleType())]))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from three quarters of the labels."""
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


QUERIES = {"op7_toxicity": op7_toxicity}
ORACLES: dict[str, str] = {}
