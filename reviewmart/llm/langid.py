"""Language identification: sparse multinomial logistic regression on TF-IDF of characters."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from reviewmart.llm.common import find_package, least_hashed, remainder, table, text_chunks

#: Character n-grams of 1 to ORDER code points, hashed to FEATURES places.
ORDER = 3
FEATURES = 1 << 14
#: Labelled rows per language that the weights and the temperature are fitted on.
FIT_ROWS, CALIBRATION_ROWS = 300, 100
#: Follow-the-regularised-leader: step size, its smoothing, elastic-net penalties, passes.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.02, 0.01, 3
UNKNOWN = "und"
#: Bytes of text whose n-grams are hashed at once; they take some 50 times as much memory.
CHUNK_BYTES = 512 << 10

_GRAM = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint64)
_GAP = 32
_tables: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Lower-case letter of each code point, a blank for every other sign."""
    if not _tables:
        fold = np.full(0x110000, _GAP, np.uint32)
        for code in range(0x110000):
            if 0xD800 <= code <= 0xDFFF:
                continue
            sign = chr(code)
            if sign.isalpha():
                low = sign.lower()
                fold[code] = ord(low) if len(low) == 1 else code
        _tables.append(fold)
    return _tables[0]


def _rows(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed n-grams of each row of a chunk, as (features, counts); of whole texts."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    if begins[-1] != len(points):  # bytes that are not UTF-8 were replaced: row by row
        raw = data.tobytes()
        parts = [
            np.frombuffer(raw[a:b].decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())
        ]
        begins = np.cumsum([0, *map(len, parts)])
        points = np.concatenate(parts)
    signs = _letters()[points]
    del points
    shift = np.uint64(64 - (FEATURES.bit_length() - 1))
    mixed = signs.astype(np.uint64)
    grams, real = [], []
    total = np.zeros(len(signs), np.uint64)
    code = np.empty(len(signs), np.uint64)
    solid = signs != _GAP
    for n in range(ORDER):
        size = max(len(signs) - n, 0)
        total, code = total[:size], code[:size]
        np.multiply(mixed[n:], _GRAM[n], out=code)
        total += code
        total *= np.uint64(0x9E3779B97F4A7C15)
        np.right_shift(total, np.uint64(29), out=code)
        code ^= total
        code *= np.uint64(0xBF58476D1CE4E5B9)
        code >>= shift
        grams.append(code.astype(np.int32))
        # A gram counts if it begins or ends with a letter.
        real.append(solid[:size] | solid[n:])
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        if not solid[a:b].any():
            yield np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        found = [g[a : b - n][r[a : b - n]] for n, (g, r) in enumerate(zip(grams, real)) if b - n > a]
        counts = np.bincount(np.concatenate(found), minlength=FEATURES)
        features = np.flatnonzero(counts)
        yield features, counts[features]


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, rows = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for _, _, data, offsets in text_chunks(batch, size=CHUNK_BYTES):
            for features, _ in _rows(data, offsets):
                seen[features] += 1
                rows += 1
    found = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(found, -1), pa.int32()), pa.array(np.append(seen[found], rows), pa.int64())],
        names=["feature", "n"],
    )


def _sparse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, offsets in text_chunks(batch, size=CHUNK_BYTES):
            found = list(_rows(data, offsets))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1)[low:high],
                    batch.column(2)[low:high],
                    pa.array([f.astype("<u2").tobytes() for f, _ in found], pa.binary()),
                    pa.array([c.astype("<u4").tobytes() for _, c in found], pa.binary()),
                ],
                names=["lang", "rank", "features", "counts"],
            )


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def _logits(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return _tfidf(features, counts, self.idf) @ self.weights[features]

    def predict(self, features: np.ndarray, counts: np.ndarray) -> tuple[str, float]:
        if not len(features) or not self.languages:
            return UNKNOWN, 0.0
        p = _softmax(self._logits(features, counts) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max())
    return e / e.sum()


def _tfidf(features: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[features]
    return x / max(np.sqrt(x @ x), 1e-12)


def _follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray]], truth: list[int], classes: int) -> np.ndarray:
    """Per-coordinate FTRL-proximal with L1 and L2; returns the weights of all features."""
    z = np.zeros((FEATURES, classes))
    n = np.zeros((FEATURES, classes))

    def weights(f):
        shrunk = np.sign(z[f]) * L1 - z[f]
        return np.where(np.abs(z[f]) <= L1, 0.0, shrunk / ((BETA + np.sqrt(n[f])) / ALPHA + L2))

    order = np.random.default_rng(7)
    for _ in range(PASSES):
        for i in order.permutation(len(rows)).tolist():
            f, x = rows[i]
            if not len(f):
                continue
            w = weights(f)
            error = _softmax(x @ w)
            error[truth[i]] -= 1
            g = x[:, None] * error
            sigma = (np.sqrt(n[f] + g * g) - np.sqrt(n[f])) / ALPHA
            z[f] += g - sigma * w
            n[f] += g * g
    return weights(slice(None))


def _best_temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of least log loss on rows that the weights have not seen.

    The targets are smoothed by one row's worth of doubt, as in Platt's method, so rows that are
    all right do not make the scores certain.
    """
    if not len(truth):
        return 1.0
    rows, classes = logits.shape
    target = np.full((rows, classes), 1 / (rows + classes))
    target[np.arange(rows), truth] += 1 - classes / (rows + classes)
    best = (np.inf, 1.0)
    for t in np.geomspace(0.02, 5, 80):
        scaled = logits / t
        scaled = scaled - scaled.max(axis=1, keepdims=True)
        loss = -(target * (scaled - np.log(np.exp(scaled).sum(axis=1, keepdims=True)))).sum(axis=1).mean()
        best = min(best, (loss, float(t)))
    return best[1]


def fit(docs: DataFrame) -> LanguageModel:
    """Learn from ``docs`` (doc_id, text, lang): rows of null lang teach nothing.

    Document frequencies are of all these rows. The weights are fitted on the ``FIT_ROWS`` rows
    of least hash of each language, the temperature on the ``CALIBRATION_ROWS`` next ones; these
    alone come to the driver, as hashed features. An id may stand in several languages; of rows
    with one id and language, the least text teaches.
    """
    find_package(docs.sparkSession)
    known = docs.where("lang IS NOT NULL")
    seen = (
        known.select("text")
        .mapInArrow(_document_frequencies, "feature int, n long")
        .groupBy("feature")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    total = int(seen.loc[seen["feature"] < 0, "n"].sum())
    counts = np.zeros(FEATURES)
    real = seen[seen["feature"] >= 0]
    counts[real["feature"].to_numpy()] = real["n"].to_numpy()
    idf = np.log((1 + total) / (1 + counts)) + 1

    ids = known.where("doc_id IS NOT NULL").select("doc_id", "lang").distinct()
    chosen = least_hashed(ids, "lang", FIT_ROWS + CALIBRATION_ROWS)
    rows = (
        known.select("doc_id", "lang", "text")
        .join(F.broadcast(chosen), ["doc_id", "lang"])
        .groupBy("lang", "rank")
        .agg(F.min("text").alias("text"))
        .select("text", "lang", "rank")
        .mapInArrow(_sparse_rows, "lang string, rank int, features binary, counts binary")
        .collect()
    )
    rows.sort(key=lambda r: (r["lang"], r["rank"], bytes(r["features"]), bytes(r["counts"])))
    languages = sorted({r["lang"] for r in rows})
    truth = [languages.index(r["lang"]) for r in rows]
    sparse = []
    for r in rows:
        f = np.frombuffer(r["features"], "<u2").astype(np.int64)
        sparse.append((f, _tfidf(f, np.frombuffer(r["counts"], "<u4"), idf)))
    fitted = [i for i, r in enumerate(rows) if r["rank"] <= FIT_ROWS]
    held = [i for i, r in enumerate(rows) if r["rank"] > FIT_ROWS and len(sparse[i][0])]
    if not languages:
        return LanguageModel([], idf, np.zeros((FEATURES, 0)), 1.0)
    w = _follow_the_leader([sparse[i] for i in fitted], [truth[i] for i in fitted], len(languages))
    logits = np.array([sparse[i][1] @ w[sparse[i][0]] for i in held]).reshape(len(held), len(languages))
    return LanguageModel(languages, idf, w, _best_temperature(logits, np.array([truth[i] for i in held], np.int64)))


def predicted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` (text and others) with ``lang_pred`` and ``score`` put after its columns.

    Only the text is looked at. Without a letter (null and empty texts too), or where the model
    learned no language, the language is ``und`` and the score 0. Columns of the same names
    give way.
    """
    find_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_chunks(batch, size=CHUNK_BYTES):
                found = [shared.value.predict(f, c) for f, c in _rows(data, offsets)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.slice(low, high - low).columns,
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                    ],
                    names=[*batch.schema.names, "lang_pred", "score"],
                )

    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *added]))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 3) == 1
    model = fit(docs.where(~held_out))
    return predicted(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


QUERIES = {"op6_language_id": op6_language_id}
ORACLES: dict[str, str] = {}
