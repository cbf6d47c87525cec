"""Runs (maximal periodic stretches of words) by recompression and grammar LCE queries."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from reviewmart.llm.common import find_package, mix, table, text_chunks

#: Bytes of text whose words share one grammar; a longer text has one of its own.
CHUNK_BYTES = 1 << 20
#: A run has at least so many words, and at least two periods.
LEAST_LENGTH = 12


@dataclass(frozen=True)
class _Level:
    """One step of the grammar: a sequence of symbols, and how the next level groups them."""

    symbols: np.ndarray
    blocks: bool  # whether equal neighbours are merged, else pairs of a left and a right symbol
    right: np.ndarray  # pairs: which places hold a right symbol
    up: np.ndarray  # place of the symbol of the next level that covers each place
    first: np.ndarray  # first place of each symbol of the next level, and the end


def _grouped(symbols: np.ndarray, blocks: bool, right: np.ndarray, starts: np.ndarray, names: np.ndarray):
    """A level and the symbols above it; equal names of groups become equal symbols."""
    up = np.cumsum(starts, dtype=np.int64) - 1
    first = np.append(np.flatnonzero(starts), len(symbols))
    return _Level(symbols, blocks, right, up, first), np.unique(names, return_inverse=True)[1]


def _blocks(symbols: np.ndarray):
    starts = np.ones(len(symbols), bool)
    starts[1:] = symbols[1:] != symbols[:-1]
    if starts.all():
        return None
    begin = np.flatnonzero(starts)
    length = np.diff(np.append(begin, len(symbols)))
    return _grouped(symbols, True, starts, starts, symbols[begin] * np.int64(len(symbols) + 1) + length)


def _pairs(symbols: np.ndarray, round_: int):
    """Merge every left symbol with a right one after it.

    Which symbols are left or right is a hash of the symbol, so it is the same wherever the symbol
    stands; of the two ways round, the one that merges more is taken.
    """
    side = mix(np.arange(int(symbols.max()) + 1, dtype=np.uint64) + np.uint64(round_ << 40)) & np.uint64(1)
    right = side[symbols].astype(bool)
    one, other = ~right[:-1] & right[1:], right[:-1] & ~right[1:]
    if other.sum() > one.sum():
        right, one = ~right, other
    if not one.any():
        return None
    starts = np.ones(len(symbols), bool)
    starts[1:] = ~one
    begin = np.flatnonzero(starts)
    second = np.where(np.append(one, False)[begin], np.append(symbols[1:], -1)[begin], -1)
    return _grouped(symbols, False, right, starts, symbols[begin] * np.int64(int(symbols.max()) + 2) + second + 1)


def grammar(symbols: np.ndarray) -> list[_Level]:
    """The levels of a recompression of ``symbols`` up to a single one.

    Blocks of equal neighbours are merged first, then pairs, in turn. What a level merges depends
    on neighbouring symbols only, so equal words are merged equally wherever they stand.
    """
    levels = []
    round_ = 0
    while len(symbols) > 1:
        made = _blocks(symbols)
        if made is not None:
            levels.append(made[0])
            symbols = made[1]
        if len(symbols) > 1:
            round_ += 1
            made = _pairs(symbols, round_)
            if made is not None:
                levels.append(made[0])
                symbols = made[1]
    return levels


def _left_in_block(level: _Level, at: np.ndarray, step: int) -> np.ndarray:
    """Equal symbols from a place on, itself included, in the direction of ``step``."""
    return level.first[level.up[at] + 1] - at if step > 0 else at - level.first[level.up[at]] + 1


def extension(levels: list[_Level], i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
    """How many symbols from places ``i`` and ``j`` (i < j) on are equal, forward or backward.

    All queries climb together while their symbols agree: before it climbs, a query steps over
    what the next level groups with a symbol behind it, so both places are edges there too. Where
    symbols differ it descends again, over at most one group a level, to the first unequal words.
    The word sequence must end, both ways, in symbols that occur once.
    """
    begin = i
    which = np.arange(len(i))
    halted: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for level in levels:
        same = level.symbols[i] == level.symbols[j]
        out = (which[~same], i[~same], j[~same])
        which, i, j = which[same], i[same], j[same]
        if level.blocks:
            a, b = _left_in_block(level, i, step), _left_in_block(level, j, step)
            n = np.minimum(a, b)
            i, j = i + step * n, j + step * n
            even = a == b
            out = tuple(np.concatenate(p) for p in zip(out, (which[~even], i[~even], j[~even])))
            which, i, j = which[even], i[even], j[even]
        else:
            over = level.right[i] == (step > 0)
            i, j = i + step * over, j + step * over
        halted.append(out)
        if not len(which):
            break
        i, j = level.up[i], level.up[j]
    which = i = j = np.zeros(0, np.int64)
    for level, (more, more_i, more_j) in zip(levels[len(halted) - 1 :: -1], halted[::-1]):
        if len(which):
            below = level.first[i] if step > 0 else level.first[i + 1] - 1
            below_j = level.first[j] if step > 0 else level.first[j + 1] - 1
            same = level.symbols[below] == level.symbols[below_j]
            if level.blocks:
                n = np.minimum(_left_in_block(level, below, step), _left_in_block(level, below_j, step))
            else:
                n = np.ones(len(which), np.int64)
            n = np.where(same, step * n, 0)
            i, j = below + n, below_j + n
        which, i, j = (np.concatenate(p) for p in ((which, more), (i, more_i), (j, more_j)))
    length = np.empty(len(begin), np.int64)
    length[which] = np.abs(i - begin[which])
    return length


def _find(symbols: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, length, smallest period) of all runs of a word sequence, by start and period.

    Words a period apart agree over at least g = max(period, LEAST_LENGTH - period) neighbouring
    places of a run, so one place of every grid of that spacing lies among them. Each grid place
    where the words agree is extended both ways.
    """
    levels = grammar(symbols)
    left, right = [], []
    for period in range(1, longest // 2 + 1):
        spacing = max(period, LEAST_LENGTH - period)
        a, b = symbols[: len(symbols) - period : spacing], symbols[period::spacing]
        at = np.flatnonzero(a == b) * spacing
        if len(at):
            left.append(at)
            right.append(at + period)
    if not left:
        return np.zeros((0, 3), np.int64)
    i, j = np.concatenate(left), np.concatenate(right)
    forward = extension(levels, i, j, 1)
    backward = extension(levels, i - 1, j - 1, -1)
    period = j - i
    length = period + forward + backward
    real = (length >= LEAST_LENGTH) & (length >= 2 * period)
    # A stretch has one entry for each multiple of its smallest period that fits twice.
    found = np.stack([(i - backward)[real], length[real], period[real]], 1)
    found = found[np.lexsort(found.T[::-1])]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[new]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def find_runs(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each word list, as rows (start, length, smallest period).

    All lists share one grammar, with a symbol of its own before, between and after them.
    """
    sizes = np.array([len(words) for words in texts], np.int64)
    words = pa.array([w for t in texts for w in t], pa.large_binary()).dictionary_encode()
    codes = words.indices.to_numpy().astype(np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)]) + 1
    total = int(begins[-1])
    symbols = np.arange(total, dtype=np.int64) + len(words.dictionary)
    solid = np.ones(total, bool)
    solid[begins - 1] = False
    symbols[solid] = codes
    symbols = np.unique(symbols, return_inverse=True)[1]
    found = _find(symbols, int(sizes.max(initial=0)))
    owner = np.searchsorted(begins, found[:, 0], "right") - 1
    found[:, 0] -= begins[owner]
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [found[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that any run holds beyond its first period."""
    if not len(runs):
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


_RUN = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])
_ADDED = (StructField("runs", ArrayType(_RUN, False)), StructField("collapsed", StringType()))


def _rewritten(words: list[bytes], crc: int | None) -> list[bytes]:
    """For one in ten hashes, the words from some place on repeat with some period."""
    if crc is None or crc % 10 or not words:
        return words
    n, g = len(words), crc // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def periodic_runs(docs: DataFrame, rewrite: str | None = None) -> DataFrame:
    """``docs`` (text and others) with ``runs`` and ``collapsed`` put after its columns.

    ``runs`` are all maximal stretches of words with their smallest period, of at least
    ``LEAST_LENGTH`` words and two periods, by start and then period. ``collapsed`` is the text of
    the words that no run holds beyond its first period, joined by single blanks.

    ``rewrite`` names a column with a hash: where it is a multiple of ten, the words first repeat
    from some place on, as the query's contract says; null leaves a text as it is. Null and empty
    texts have no run and an empty ``collapsed``. Rows stand for themselves, so repeated rows and
    null ids are nothing special. Columns of the added names give way.
    """
    find_package(docs.sparkSession)
    docs = docs.drop(*(field.name for field in _ADDED))
    names = [*docs.columns, *(field.name for field in _ADDED)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_chunks(batch, size=CHUNK_BYTES):
                raw = data.tobytes()
                texts = [raw[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                rows = batch.slice(low, high - low)
                if rewrite is not None:
                    crcs = rows.column(rows.schema.get_field_index(rewrite)).to_pylist()
                    texts = [_rewritten(words, crc) for words, crc in zip(texts, crcs)]
                found = find_runs(texts)
                cells = np.concatenate(found)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum([len(r) for r in found])]), pa.int32()),
                    pa.StructArray.from_arrays(
                        [pa.array(np.ascontiguousarray(cells[:, k])) for k in range(3)], names=_RUN.fieldNames()
                    ),
                )
                kept = [b" ".join(collapsed(words, runs)) for words, runs in zip(texts, found)]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, lists, pa.array(kept, pa.binary()).cast(pa.string())], names=names
                )

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *_ADDED]))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, a tenth of them made periodic first."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", crc.alias("crc"))
    found = periodic_runs(docs, rewrite="crc")
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    )
    lines = F.transform(
        "runs", lambda r: F.concat_ws(",", *(r[n].cast("string") for n in ("start", "length", "period")))
    )
    told = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return (
        found.withColumn("best", best)
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            (-F.col("best.start")).alias("start"),
            F.col("best.length").alias("length"),
            (-F.col("best.period")).alias("period"),
            F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
            F.sha2(told.cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        )
    )


QUERIES = {"op13_runs": op13_runs}
ORACLES: dict[str, str] = {}
