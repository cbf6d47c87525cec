"""Quality rules as a short-circuit cascade, ordered by what a sample says of cost and rejection."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from reviewmart.llm.common import find_package, table, text_chunks, word_spans

#: Bytes of text judged at once, and rows (about) that costs and rejections are estimated on.
CHUNK_BYTES = 1 << 20
SAMPLE_ROWS = 4000
WINDOW = 8

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True


class _View:
    """Some rows of a chunk, with every feature that was asked of them so far."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.known: dict[str, np.ndarray] = {}
        self._parts: dict[str, object] = {}

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def feature(self, name: str) -> np.ndarray:
        if name not in self.known:
            self.known[name] = FEATURES[name](self)
        return self.known[name]

    def part(self, name: str, make: Callable[[], object]):
        """A step that several features share."""
        if name not in self._parts:
            self._parts[name] = make()
        return self._parts[name]

    def kept(self, rows: np.ndarray) -> _View:
        """The marked rows alone; what is known of them comes along."""
        sizes = np.diff(self.offsets)
        view = _View(self.data[np.repeat(rows, sizes)], np.concatenate([[0], np.cumsum(sizes[rows])]))
        view.known = {name: values[rows] for name, values in self.known.items()}
        return view

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.part("spans", lambda: word_spans(self.data, self.offsets))

    def sums(self, flags: np.ndarray) -> np.ndarray:
        """Per row, how many of its bytes are marked."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def _n_words(view: _View) -> np.ndarray:
    return np.diff(view.spans()[2])


def _word_chars(view: _View) -> np.ndarray:
    starts, ends, first = view.spans()
    total = np.concatenate([[0], np.cumsum((view.data & 0xC0) != 0x80, dtype=np.int64)])
    sums = np.concatenate([[0], np.cumsum(total[ends] - total[starts])])
    return sums[first[1:]] - sums[first[:-1]]


def _n_letterless(view: _View) -> np.ndarray:
    """Words without an ASCII letter or a sign beyond ASCII."""
    starts, ends, first = view.spans()
    total = np.concatenate([[0], np.cumsum(_LETTER[view.data], dtype=np.int64)])
    sums = np.concatenate([[0], np.cumsum(total[ends] == total[starts])])
    return sums[first[1:]] - sums[first[:-1]]


def _repeated(values: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    _, names, counts = np.unique(values, return_inverse=True, return_counts=True)
    return counts[names] > 1


def _lines(view: _View) -> tuple[np.ndarray, np.ndarray]:
    """Row and content code of every line that holds a word."""

    def make():
        raw = view.data.tobytes()
        lines, rows = [], []
        for row, (a, b) in enumerate(zip(view.offsets[:-1].tolist(), view.offsets[1:].tolist())):
            found = [line for line in raw[a:b].split(b"\n") if line.strip()]
            lines += found
            rows.append(len(found))
        codes = pa.array(lines, pa.large_binary()).dictionary_encode().indices.to_numpy()
        return np.repeat(np.arange(len(view)), rows), codes.astype(np.int64)

    return view.part("lines", make)


def _n_lines(view: _View) -> np.ndarray:
    return np.bincount(_lines(view)[0], minlength=len(view))


def _n_dup_lines(view: _View) -> np.ndarray:
    rows, codes = _lines(view)
    different = np.unique(codes * max(len(view), 1) + rows) % max(len(view), 1)
    return _n_lines(view) - np.bincount(different, minlength=len(view))


def _n_repeat_words(view: _View) -> np.ndarray:
    """Words in windows of eight words that their row holds twice or more.

    Windows get names by doubling: two words, then four, then eight, so equal names mean equal
    words, not equal hashes.
    """
    starts, ends, first = view.spans()
    if not len(starts):
        return np.zeros(len(view), np.int64)
    raw = view.data.tobytes()
    words = []
    for a, b in zip(view.offsets[:-1].tolist(), view.offsets[1:].tolist()):
        words += raw[a:b].split()
    names = pa.array(words, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(view)), np.diff(first))
    at = np.arange(len(names))
    size = 1
    while size < WINDOW:
        whole = at + 2 * size <= first[row + 1]
        at, row = at[whole], row[whole]
        left = np.full(len(words), -1)
        left[at] = names[at] * np.int64(len(words) + 1) + names[at + size]
        names = np.full(len(words), -1)
        names[at] = np.unique(left[at], return_inverse=True)[1]
        size *= 2
    again = at[_repeated(names[at] * len(view) + row)]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    total = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    return total[first[1:]] - total[first[:-1]]


FEATURES: dict[str, Callable[[_View], np.ndarray]] = {
    "n_words": _n_words,
    "word_chars": _word_chars,
    "n_symbols": lambda view: view.sums(_SYMBOLS[view.data]),
    "n_lines": _n_lines,
    "n_dup_lines": _n_dup_lines,
    "n_repeat_words": _n_repeat_words,
    "n_letterless": _n_letterless,
    "n_letters": lambda view: view.sums(_LETTER[view.data]),
    "n_upper": lambda view: view.sums(_UPPER[view.data]),
    "n_exclamations": lambda view: view.sums(view.data == 33),
}


@dataclass(frozen=True)
class Rule:
    """A reason to reject a text: a test over some of its features."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[..., np.ndarray]


BASE_RULES = (
    Rule("few_words", ("n_words",), lambda n: n < 20),
    Rule("repeats", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 30 * n),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 4 * s > n),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < 2 * n) | (c > 20 * n)),
    Rule("same_lines", ("n_dup_lines", "n_lines"), lambda d, n: 100 * d > 60 * n),
    Rule("letterless", ("n_letterless", "n_words"), lambda w, n: 100 * w > 40 * n),
    Rule("shouting", ("n_upper", "n_letters"), lambda u, n: 2 * u > n),
    Rule("exclamations", ("n_exclamations", "n_words"), lambda e, n: 2 * e > n),
)


def _judge(rule: Rule, view: _View) -> np.ndarray:
    return rule.rejects(*(view.feature(name) for name in rule.needs))


@dataclass(frozen=True)
class Estimate:
    """What a sample says: nanoseconds a byte of each feature, rows by the rules that reject them.

    ``verdicts`` maps a set of rules, as bits in the order of the rules, to its number of rows.
    """

    cost: dict[str, float]
    verdicts: dict[int, int]


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> Estimate:
    """Measure every feature and rule on about ``rows`` rows, picked by a hash of their place.

    Only sums come to the driver: one for each feature, one for each set of rules that some
    sampled row fails.
    """
    find_package(docs.sparkSession)
    total = docs.count()
    spread = 1 << 40
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(spread))
    share = min(spread, spread * rows // max(total, 1))
    features = list(dict.fromkeys(name for rule in rules for name in rule.needs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent = np.zeros(len(features) + 1, np.int64)
        found: dict[int, int] = {}
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch, size=CHUNK_BYTES):
                view = _View(data, offsets)
                spent[-1] += len(data)
                for k, name in enumerate(features):
                    begin = time.thread_time_ns()
                    view.feature(name)
                    spent[k] += time.thread_time_ns() - begin
                bits = np.zeros(len(view), np.int64)
                for k, rule in enumerate(rules):
                    bits |= _judge(rule, view).astype(np.int64) << k
                for key, n in zip(*(x.tolist() for x in np.unique(bits, return_counts=True))):
                    found[key] = found.get(key, 0) + n
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([True] * len(spent) + [False] * len(found)),
                pa.array([*range(len(spent)), *found], pa.int64()),
                pa.array([*spent.tolist(), *found.values()], pa.int64()),
            ],
            names=["is_cost", "key", "n"],
        )

    sums = (
        docs.select("text")
        .where(place < share)
        .mapInArrow(run, "is_cost boolean, key long, n long")
        .groupBy("is_cost", "key")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    spent = {r["key"]: r["n"] for r in sums if r["is_cost"]}
    size = max(spent.get(len(features), 0), 1)
    cost = {name: spent.get(k, 0) / size for k, name in enumerate(features)}
    return Estimate(cost, {r["key"]: r["n"] for r in sums if not r["is_cost"]})


def ordered(rules: Sequence[Rule], seen: Estimate, known: Sequence[str] = ()) -> list[Rule]:
    """The rules by rejections per cost, the best first.

    A rule is judged by the sampled rows that the rules before it let pass, and pays only for
    features that neither they nor ``known`` have measured. Rules that would reject nothing more
    come last, the cheapest first; ties keep the given order.
    """
    paid, left, order = set(known), dict(seen.verdicts), []
    waiting = list(range(len(rules)))

    def worth(k: int) -> tuple[float, float]:
        rejected = sum(n for bits, n in left.items() if bits >> k & 1)
        cost = sum(seen.cost[name] for name in rules[k].needs if name not in paid) + 1e-3
        return rejected / cost, -cost

    while waiting:
        best = max(waiting, key=worth)
        waiting.remove(best)
        order.append(rules[best])
        paid.update(rules[best].needs)
        left = {bits: n for bits, n in left.items() if not bits >> best & 1}
    return order


def judged(docs: DataFrame, order: Sequence[Rule], report: Sequence[str] = ()) -> DataFrame:
    """``docs`` (text and others) with ``report``, ``failed_rule`` and ``kept`` put after its columns.

    The rules run in the given order; a text that one rejects is not looked at by those after
    it, and ``failed_rule`` names that one (null: the text is kept). Whether a text is kept does
    not depend on the order. ``report`` are features of every text, as longs.

    Null and empty texts have no word and no line. Every row stands for itself, so repeated rows
    and null ids are nothing special. Columns of the added names give way.
    """
    find_package(docs.sparkSession)
    added = [*report, "failed_rule", "kept"]
    docs = docs.drop(*added)

    def one(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        view = _View(data, offsets)
        shown = [view.feature(name).astype(np.int64) for name in report]
        failed = np.full(len(view), -1)
        alive = np.arange(len(view))
        for k, rule in enumerate(order):
            rejected = _judge(rule, view)
            if rejected.any():
                failed[alive[rejected]] = k
                alive = alive[~rejected]
                view = view.kept(~rejected)
            if not len(alive):
                break
        return shown, failed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*(rule.name for rule in order), None], object)
        for batch in batches:
            found = [one(data, offsets) for _, _, data, offsets in text_chunks(batch, size=CHUNK_BYTES)]
            failed = np.concatenate([np.zeros(0, np.int64), *(f for _, f in found)])
            shown = [np.concatenate([np.zeros(0, np.int64), *(s[k] for s, _ in found)]) for k in range(len(report))]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    *(pa.array(s, pa.int64()) for s in shown),
                    pa.array(names[failed], pa.string()),
                    pa.array(failed < 0),
                ],
                names=[*batch.schema.names, *added],
            )

    kinds = [LongType()] * len(report) + [StringType(), BooleanType()]
    schema = [*docs.schema.fields, *(StructField(n, k) for n, k in zip(added, kinds))]
    return docs.mapInArrow(run, StructType(schema))


def cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, report: Sequence[str] = ()) -> DataFrame:
    """Estimate the rules on a sample of ``docs``, then judge all of it in the order that follows."""
    return judged(docs, ordered(rules, estimate(docs, rules), report), report)


_REPORT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the cascade for all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words, repeats = F.col("n_words"), F.col("n_repeat_words")
    return cascade(docs, report=_REPORT).select(
        "doc_id",
        *_REPORT,
        ((words < 20) | (100 * repeats > 30 * words)).alias("base_failed"),
        "kept",
    )


# Spark's words are runs of anything but these six bytes; so are they here.
_WORD = r"[^\x20\x09-\x0D]+"
_SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce("text", '') AS body FROM documents),
w AS (SELECT rid, unnest(ws) AS word, unnest(range(len(ws))) AS i
  FROM (SELECT rid, regexp_extract_all(body, '{_WORD}') AS ws FROM t)),
win AS (SELECT rid, i, word,
  list(word) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS ws FROM w),
rep AS (SELECT rid, i, word, len(ws) = 8 AND count(*) OVER (PARTITION BY rid, ws) > 1 AS twice FROM win),
cov AS (SELECT rid, word, bool_or(twice) OVER (PARTITION BY rid ORDER BY i
  ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS covered FROM rep),
per_word AS (SELECT rid, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars,
  count(*) FILTER (covered) AS n_repeat_words,
  count(*) FILTER (NOT regexp_matches(word, '[A-Za-z]|[^\x00-\x7F]')) AS n_letterless
  FROM cov GROUP BY rid),
l AS (SELECT rid, unnest(string_split(body, chr(10))) AS line FROM t),
per_line AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM l WHERE regexp_matches(line, '{_WORD}') GROUP BY rid),
f AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
  length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_letterless, 0) AS n_letterless,
  length(regexp_replace(body, '[^A-Z]', '', 'g')) AS n_upper,
  strlen(regexp_replace(body, '[\x00-@\[-`\{{-\x7F]', '', 'g')) AS n_letters,
  length(regexp_replace(body, '[^!]', '', 'g')) AS n_exclamations
  FROM t LEFT JOIN per_word USING (rid) LEFT JOIN per_line USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 4 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR 100 * n_dup_lines > 60 * n_lines OR 100 * n_letterless > 40 * n_words
    OR 2 * n_upper > n_letters OR 2 * n_exclamations > n_words) AS kept
FROM b
"""

QUERIES = {"op11_quality": op11_quality}
ORACLES = {"op11_quality": _SQL}
