"""Language-model scoring with sharded Elias-Fano n-gram tries."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.llm.common import find_package, mix, remainder, table, text_chunks, word_hashes
from reviewmart.llm.elias_fano import EliasFano
from reviewmart.llm.vectors import over_runs
from reviewmart.session import stage

#: Word positions of a shard; the number of shards grows with the corpus.
SHARD_POSITIONS = 1_000_000
#: Positions a task gathers before it sends them to the shards.
FLUSH_POSITIONS = 1_000_000
#: Positions of a shard that are worked on at once; one word's training positions are taken together.
BLOCK_POSITIONS = 1 << 18
#: The most frequent words, whose counts every task knows (1 MB).
USUAL = 65_535
#: Distinct words a task holds before it sends on their counts.
HELD_WORDS = 3_000_000
DISCOUNT = 0.75
_LEVELS = 256

_END = np.uint64(0x5851F42D4C957F2D)
_BEGIN = np.uint64(0x14057B7EF767814F)
_SALT = np.uint64(0xDA942042E4DD58B5)


@dataclass
class Usual:
    """The most frequent training words by hash, and totals of the training tokens."""

    hashes: np.ndarray
    counts: np.ndarray
    tokens: int
    words: int
    shards: int

    def __post_init__(self):
        share = SHARD_POSITIONS // 2
        self.salts = np.maximum(1, -(-self.counts * 5 // 4 // share))

    @property
    def norm(self) -> float:
        return self.tokens + 0.5 * (self.words + 1)

    @property
    def split(self) -> np.ndarray:
        """Places of the words whose positions go to several shards; the end has no positions."""
        return np.flatnonzero((self.salts > 1) & (self.hashes != _END))

    def code(self, words: np.ndarray) -> np.ndarray:
        """1 + the place of a word among the usual ones, 0 for any other."""
        if not len(self.hashes):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        return np.where(self.hashes[at] == words, at + 1, 0)

    def log_unigram(self, codes: np.ndarray) -> np.ndarray:
        """log10 of the unigram probability of the coded words, nan for others."""
        held = np.log10((np.append(self.counts, 0) + 0.5) / self.norm)
        return np.where(codes > 0, held[codes - 1], np.nan)

    def shard(self, words: np.ndarray, codes: np.ndarray, before: np.ndarray) -> np.ndarray:
        """A word's shard. A word too frequent for one is split by the word before it (its upper
        32 bits, as in a trie), so every context is whole; what follows the word in any context
        is counted over all parts, by ``_count_pairs``."""
        salts = np.append(self.salts, 1)[codes - 1]
        salt = np.where(salts > 1, mix(before >> np.uint64(32)) % salts.astype(np.uint64), np.uint64(0))
        return (mix(words + salt * _SALT) % np.uint64(self.shards)).astype(np.int32)


def _pack(arrays: list[np.ndarray]) -> bytes:
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tobytes()
    return zstandard.compress(head + b"".join(a.tobytes() for a in arrays), 1)


def _unpack(payload: bytes | pa.Buffer, kinds: list) -> list[np.ndarray]:
    raw = zstandard.decompress(payload)
    count = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, count, 8)
    out, at = [], 8 * (count + 1)
    for size, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(raw[at : at + size], kind))
        at += size
    return out


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        names, inverse = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        return names, np.bincount(inverse, weights=np.concatenate([c for _, c in held])).astype(np.int64)

    def rows(names: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(names), 1 << 16):
            part = slice(low, low + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[part].view(np.int64)), pa.array(counts[part])], names=["word", "n"]
            )

    for batch in batches:
        for low, high, data, offsets in text_chunks(batch):
            words, _ = word_hashes(data, offsets)
            names, counts = np.unique(words, return_counts=True)
            held.append((np.append(names, _END), np.append(counts, high - low)))
            size += len(names)
        if size > HELD_WORDS:
            one = merged()
            held, size = [one], len(one[0])
            if size > HELD_WORDS // 2:
                yield from rows(*one)
                held, size = [], 0
    if held:
        yield from rows(*merged())


def _neighbours(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words before and after each word of some rows."""
    filled = np.diff(first) > 0
    before, after = np.empty_like(words), np.empty_like(words)
    before[1:], after[:-1] = words[:-1], words[1:]
    before[first[:-1][filled]] = _BEGIN
    after[first[1:][filled] - 1] = _END
    return before, after


#: Code of a split word; next word and word before it, 32 bits each; whether training holds them.
_CONTEXTS = [np.uint16, np.uint64, np.uint8]
#: Code of a split word, next word, number of different contexts.
_PAIRS = [np.uint16, np.uint32, np.int64]


def _distinct(code: np.ndarray, key: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (code, key), and whether any row of each is to be learned from."""
    if not len(code):
        return code, key, learn
    order = np.lexsort((key, code))
    code, key, learn = code[order], key[order], learn[order]
    first = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (key[1:] != key[:-1])))
    return code[first], key[first], np.maximum.reduceat(learn, first)


def _split_contexts(usual: Usual, buckets: int):
    """Send each different (split word, next, word before) to the bucket of its pair of words."""
    split = usual.split

    def send(parts: list) -> Iterator[pa.RecordBatch]:
        code, key, learn = _distinct(*(np.concatenate([p[k] for p in parts]) for k in range(3)))
        pair = mix((key >> np.uint64(32)) + code.astype(np.uint64) * _SALT)
        bucket = (pair % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[at[:1]]), pa.array([_pack([code[at], key[at], learn[at]])], pa.binary())],
                    names=["bucket", "payload"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for low, high, data, offsets in text_chunks(batch):
                words, first = word_hashes(data, offsets)
                place = np.minimum(np.searchsorted(usual.hashes[split], words), len(split) - 1)
                at = np.flatnonzero(usual.hashes[split][place] == words)
                before, after = _neighbours(words, first)
                held = batch.column(2)[low:high].to_numpy(zero_copy_only=False).astype(bool)
                learn = ~np.repeat(held, np.diff(first))[at]
                key = (after[at] >> np.uint64(32) << np.uint64(32)) | (before[at] >> np.uint64(32))
                parts.append(((split[place[at]] + 1).astype(np.uint16), key, learn.astype(np.uint8)))
                size += len(at)
                if size >= FLUSH_POSITIONS // 2:
                    yield from send(parts)
                    parts, size = [], 0
        if parts:
            yield from send(parts)

    return run


def _count_pairs(usual: Usual):
    """In how many different contexts each next word of a bucket follows its split word in training:
    a row for every shard that holds a position of the pair, and totals of each split word."""

    def work(run: pa.Table) -> pa.RecordBatch:
        pieces = [_unpack(p, _CONTEXTS) for p in run["payload"].to_pylist()]
        code, key, learn = _distinct(*(np.concatenate([p[k] for p in pieces]) for k in range(3)))
        after = (key >> np.uint64(32)).astype(np.uint32)
        first = np.append(True, (code[1:] != code[:-1]) | (after[1:] != after[:-1]))
        start = np.flatnonzero(first)
        kinds = np.add.reduceat(learn.astype(np.int64), start)
        pair = np.cumsum(first) - 1
        shard = usual.shard(usual.hashes[code.astype(np.int64) - 1], code.astype(np.int64), key << np.uint64(32))
        seen = kinds[pair] > 0
        wanted = np.unique((shard[seen].astype(np.int64) << 32) | pair[seen])
        target, pair = (wanted >> 32).astype(np.int32), wanted & 0xFFFFFFFF
        rows = []
        for at in np.split(np.arange(len(wanted)), np.flatnonzero(np.diff(target)) + 1):
            if len(at):
                own = start[pair[at]]
                rows.append((int(target[at[0]]), None, None, None, _pack([code[own], after[own], kinds[pair[at]]])))
        for c in np.unique(code).tolist():
            own = kinds[code[start] == c]
            rows.append((None, c, int(own.sum()), int((own > 0).sum()), None))
        types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        columns = [pa.array(list(column), kind) for column, kind in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "code", "mass", "degree", "payload"])

    return work


def _route(usual: Usual):
    """Send each word position (word before, word, word after) to the shard of its word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Bytes of a row key: the task's partition, and the how-manieth flush of it.
        base = TaskContext.get().partitionId() << 24
        flush, docs, parts, size = 0, [], [], 0

        def send() -> Iterator[pa.RecordBatch]:
            yield from _flush(usual, base + flush, docs, parts)

        for batch in batches:
            for low, high, data, offsets in text_chunks(batch):
                words, first = word_hashes(data, offsets)
                counts = np.diff(first)
                row = np.repeat(np.arange(high - low), counts) + sum(len(d[0]) for d in docs)
                held = batch.column(2)[low:high].to_numpy(zero_copy_only=False).astype(bool)
                docs.append((batch.column(0)[low:high], held, counts, words[np.minimum(first[:-1], max(len(words) - 1, 0))] if len(words) else np.zeros(high - low, np.uint64)))
                before, after = _neighbours(words, first)
                parts.append((row, np.repeat(held, counts), before, words, after))
                size += len(words)
                if size >= FLUSH_POSITIONS:
                    yield from send()
                    flush, docs, parts, size = flush + 1, [], [], 0
        if docs:
            yield from send()

    return run


_SEGMENT = [np.uint32, np.uint8, np.uint64, np.uint32, np.uint16, np.uint16, np.uint32, np.uint32, np.uint32]
_DOCS = [np.int64, np.uint8, np.uint8, np.int64, np.float64, np.int64, np.uint64]


def _flush(usual: Usual, name: int, docs: list, parts: list) -> Iterator[pa.RecordBatch]:
    keys = pa.concat_arrays([d[0] for d in docs])
    held, counts, opening = (np.concatenate([d[k] for d in docs]) for k in (1, 2, 3))
    opening_code = usual.code(opening)
    start = usual.log_unigram(opening_code)
    rare = np.flatnonzero((counts > 0) & np.isnan(start))
    # What needs no shard: the first word, of unigram probability, and the end's unigram count.
    score = np.where((counts > 0) & ~np.isnan(start), start, 0.0)
    end = usual.log_unigram(usual.code(np.array([_END])))[0]
    if np.isnan(end):
        end = np.log10(0.5 / usual.norm)
    score[counts == 0] += end
    about = _pack(
        [
            keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
            keys.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
            held.astype(np.uint8),
            counts.astype(np.int64) + 1,
            score,
            rare.astype(np.int64),
            opening[rare],
        ]
    )
    shards, payloads = [-1 - name % usual.shards], [about]
    row, held_out, before, words, after = (np.concatenate([p[k] for p in parts]) for k in range(5))
    if len(words):
        codes = usual.code(words)
        new = np.ones(len(words), bool)
        new[1:] = row[1:] != row[:-1]
        before_code = np.where(new, 0, np.concatenate([[0], codes[:-1]]))
        last = np.append(new[1:], True)
        after_code = np.where(last, usual.code(np.array([_END]))[0], np.append(codes[1:], 0))
        shard = usual.shard(words, codes, before)
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order])) + 1
        for at in np.split(order, cuts):
            own, word = np.unique(words[at], return_inverse=True)
            a, c, out = before_code[at], after_code[at], held_out[at]
            rare_a, rare_c = before[at][a == 0], after[at][c == 0]
            shards.append(int(shard[at[0]]))
            payloads.append(
                _pack(
                    [
                        np.diff(row[at], prepend=0).astype(np.uint32),
                        np.packbits(out),
                        own,
                        word.astype(np.uint32),
                        a.astype(np.uint16),
                        c.astype(np.uint16),
                        (rare_a >> np.uint64(32)).astype(np.uint32),
                        (rare_c >> np.uint64(32)).astype(np.uint32),
                        rare_c[out[c == 0]].astype(np.uint32),
                    ]
                )
            )
    for low in range(0, len(shards), 64):
        part = slice(low, low + 64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(shards[part], pa.int32()), pa.array([name] * len(shards[part]), pa.int64()), pa.array(payloads[part], pa.binary())],
            names=["shard", "flush", "payload"],
        )


def _quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte per value and the level it stands for, never above the value, so that quantised
    probabilities still sum to one at most."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1)
    levels = np.unique(np.quantile(values, np.linspace(0, 1, _LEVELS), method="lower"))
    return (np.searchsorted(levels, values, "right") - 1).astype(np.uint8), levels


@dataclass
class Shared:
    """Successors of split words, counted over all parts: word, next word, log10 unigram
    probability of it, number of different contexts; and the word's sums over all successors."""

    word: np.ndarray
    after: np.ndarray
    unigram: np.ndarray
    kinds: np.ndarray
    mass: np.ndarray
    degree: np.ndarray


def _word_blocks(word: np.ndarray, before: np.ndarray, after: np.ndarray, unigram: np.ndarray, shared: Shared | None):
    """Positions and shared successors by blocks of whole words, in the order of words; at least one
    block. Words are independent in a trie, so only a block's intermediate arrays are held at once."""
    order = np.argsort(word, kind="stable")
    at, n = 0, len(word)
    own = None if shared is None else np.argsort(shared.word, kind="stable")
    told = 0
    while True:
        stop = n
        if at + BLOCK_POSITIONS < n:
            # The words that end within the block, or else the one that begins it.
            stop = int(np.searchsorted(word, word[order[at + BLOCK_POSITIONS]], "left", order))
            if stop <= at:
                stop = int(np.searchsorted(word, word[order[at]], "right", order))
        held = order[at:stop]
        part = None
        if shared is not None:
            upto = len(own) if stop == n else int(np.searchsorted(shared.word, word[order[stop]], "left", own))
            some = own[told:upto]
            told = upto
            if len(some):
                part = Shared(*(getattr(shared, f.name)[some] for f in fields(Shared)))
        yield word[held], before[held], after[held], unigram[held], part
        at = stop
        if at >= n:
            return


def _counted(word: np.ndarray, before: np.ndarray, after: np.ndarray, unigram: np.ndarray, shared: Shared | None) -> dict:
    """The levels of a trie of some words, and the probabilities and weights of their nodes."""
    size = len(word)
    if shared is not None:
        word, after, unigram = (
            np.concatenate(x) for x in ((word, shared.word), (after, shared.after), (unigram, shared.unigram))
        )
    names, rank = np.unique(word, return_inverse=True)
    parent = rank.astype(np.uint64) << np.uint64(32)
    successors, first, succ = np.unique(parent | after.astype(np.uint64), return_index=True, return_inverse=True)
    also, rank, parent, succ = succ[size:], rank[:size], parent[:size], succ[:size]
    contexts, ctx = np.unique(parent | before.astype(np.uint64), return_inverse=True)
    heads = np.arange(len(names) + 1, dtype=np.uint64) << np.uint64(32)
    to_successors, to_contexts = np.searchsorted(successors, heads), np.searchsorted(contexts, heads)
    degree = np.diff(to_successors)
    base = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.diff(to_contexts) * degree)])
    place = base[rank] + (ctx - to_contexts[rank]) * degree[rank] + succ - to_successors[rank]
    thirds, one, times = np.unique(place, return_index=True, return_counts=True)

    lower = np.nan_to_num(10.0 ** unigram[first])
    owner = (successors >> np.uint64(32)).astype(np.int64)
    kinds = np.bincount(succ[one], minlength=len(successors))
    mass = np.bincount(owner, weights=kinds, minlength=len(names))
    spread = degree.copy()
    if shared is not None:
        kinds[also] = shared.kinds
        mass[owner[also]], spread[owner[also]] = shared.mass, shared.degree
    weight = DISCOUNT * spread / np.maximum(mass, 1)
    second = (kinds - DISCOUNT) / mass[owner] + weight[owner] * lower
    total = np.bincount(ctx, minlength=len(contexts))
    weight3 = DISCOUNT * np.bincount(ctx[one], minlength=len(contexts)) / np.maximum(total, 1)
    third = (times - DISCOUNT) / total[ctx[one]] + weight3[ctx[one]] * second[succ[one]]
    return {
        "words": names,
        "counts": np.bincount(rank, minlength=len(names)),
        "successors": successors,
        "contexts": contexts,
        "thirds": thirds,
        "to_successors": to_successors,
        "to_contexts": to_contexts,
        "base": base,
        "second": second,
        "third": third,
        "weight": weight,
        "weight3": weight3,
    }


class Trie:
    """A model of what follows the words of one shard.

    Levels: words; successors (word, next); contexts (word, word before); and for each context
    the next words. Every level is one Elias-Fano sequence whose parent is in the high part, so
    a child is found by successor search relative to its context. A next word of a context is
    written as its place among the successors of the word alone, which it always is one of.
    Pointers are monotone sequences of the same kind; interpolated Kneser-Ney probabilities and
    backoff weights are one byte each. The arrays lie in an unnamed file that is mapped.
    """

    def __init__(self, word: np.ndarray, before: np.ndarray, after: np.ndarray, unigram: np.ndarray, shared: Shared | None = None):
        """Counts of positions: hashes of the word (64 bits), of the neighbours (32 bits), and
        log10 unigram probability of the next word (nan where it is not known here). ``shared``
        replaces what the positions of split words would say about their successors."""
        parts = [_counted(*one) for one in _word_blocks(word, before, after, unigram, shared)]
        places, pairs, contexts, words = 0, 0, 0, 0
        for part in parts:
            # Of the block, then of the shard.
            part["successors"] += np.uint64(words << 32)
            part["contexts"] += np.uint64(words << 32)
            part["thirds"] += places
            for name, add in (("to_successors", pairs), ("to_contexts", contexts), ("base", places)):
                part[name] = part[name] + add
            words += len(part["words"])
            pairs, contexts, places = (int(part[k][-1]) for k in ("to_successors", "to_contexts", "base"))
            if part is not parts[-1]:
                for name in ("to_successors", "to_contexts", "base"):
                    part[name] = part[name][:-1]

        def whole(name: str) -> np.ndarray:
            return np.concatenate([part.pop(name) for part in parts])

        self.counts = whole("counts")
        self.bytes: dict[str, np.ndarray] = {}
        self.levels: dict[str, np.ndarray] = {}
        for name in ("second", "third", "weight", "weight3"):
            self.bytes[name], self.levels[name] = _quantised(np.log10(np.maximum(whole(name), 1e-300)))
        names = ("words", "successors", "contexts", "thirds", "to_successors", "to_contexts", "base")
        self.sequences = {name: EliasFano(whole(name)) for name in names}
        self._map()

    def _map(self) -> None:
        """Move the arrays to a file without a name, which ends with the process or the trie."""
        with tempfile.TemporaryFile() as file:
            places = []
            held = [(s, k, a) for s in self.sequences.values() for k, a in s.arrays().items()]
            held += [(self.bytes, k, a) for k, a in self.bytes.items()]
            for owner, name, array in held:
                file.write(b"\0" * (-file.tell() % 8))
                places.append((owner, name, array.dtype, len(array), file.tell()))
                file.write(array.tobytes())
            file.flush()
            for owner, name, kind, size, at in places:
                mapped = np.memmap(file, kind, "r", at, (size,)) if size else np.zeros(0, kind)
                if isinstance(owner, dict):
                    owner[name] = mapped
                else:
                    setattr(owner, name, mapped)

    def _level(self, name: str, at: np.ndarray) -> np.ndarray:
        return self.levels[name][self.bytes[name][at]]

    def score(self, rank: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each next word, and whether its unigram probability is still to be
        added. ``rank`` is the word's place in this trie, -1 for a word that training lacks."""
        out, unigram = np.zeros(len(rank)), np.ones(len(rank), bool)
        at = np.flatnonzero(rank >= 0)
        if not len(at):
            return out, unigram
        r = rank[at]
        parent = r.astype(np.uint64) << np.uint64(32)
        succ = self.sequences["successors"].find(parent | after[at].astype(np.uint64))
        ctx = self.sequences["contexts"].find(parent | before[at].astype(np.uint64))
        both = np.flatnonzero((succ >= 0) & (ctx >= 0))
        third = np.full(len(at), -1, np.int64)
        rb = r[both]
        begin = self.sequences["to_successors"][rb].astype(np.int64)
        degree = self.sequences["to_successors"][rb + 1].astype(np.int64) - begin
        relative = succ[both] - begin
        node = ctx[both] - self.sequences["to_contexts"][rb].astype(np.int64)
        third[both] = self.sequences["thirds"].find(
            self.sequences["base"][rb] + (node * degree + relative).astype(np.uint64)
        )
        value = np.zeros(len(at))
        hit, backed = third >= 0, (third < 0) & (ctx >= 0)
        value[hit] = self._level("third", third[hit])
        value[backed] = self._level("weight3", ctx[backed])
        known = ~hit & (succ >= 0)
        value[known] += self._level("second", succ[known])
        unknown = ~hit & (succ < 0)
        value[unknown] += self._level("weight", r[unknown])
        out[at], unigram[at] = value, unknown
        return out, unigram


#: Stands for the flush in rows of pairs; they come before all flushes of their shard.
_PAIR_FLUSH = -1
_PARTIAL = [np.int64, np.float64, np.float64, np.int64, np.int64, np.uint64]


def _shared(usual: Usual, pairs: list, own_code: np.ndarray, after: np.ndarray, unigram: np.ndarray) -> Shared:
    """What a shard is told of its split words; the positions tell the unigram of next words."""
    code, following, kinds = (np.concatenate([p[k] for p in pairs]) for k in range(3))
    code = code.astype(np.int64)
    at = np.flatnonzero(np.append(usual.salts, 1)[own_code - 1] > 1)
    keys, first = np.unique((own_code[at] << 32) | after[at].astype(np.int64), return_index=True)
    place = at[first[np.searchsorted(keys, (code << 32) | following.astype(np.int64))]]
    return Shared(usual.hashes[code - 1], following, unigram[place], kinds, usual.mass[code], usual.degree[code])


def _emptied(column: list[np.ndarray]) -> list[np.ndarray]:
    """The arrays of a list, which holds them no longer."""
    held = column[:]
    column.clear()
    return held


def _trained(
    usual: Usual, pairs: list, word: np.ndarray, before: np.ndarray, after: np.ndarray, code: np.ndarray, learn: np.ndarray
) -> Trie:
    """The trie of the positions to be learned from; all of them tell the unigrams of shared pairs."""
    unigram, own_code = np.empty(len(word)), np.empty(len(word), np.int64)
    for at in range(0, len(word), BLOCK_POSITIONS):
        part = slice(at, at + BLOCK_POSITIONS)
        unigram[part] = usual.log_unigram(code[part].astype(np.int64))
        own_code[part] = usual.code(word[part])
    shared = _shared(usual, pairs, own_code, after, unigram) if pairs else None
    del own_code
    return Trie(word[learn], before[learn], after[learn], unigram[learn], shared)


def _score_shard(usual: Usual):
    """Build a shard's trie from its training positions and score all its positions by it."""

    def work(run: pa.Table) -> pa.RecordBatch:
        if run["shard"][0].as_py() < 0:
            return pa.RecordBatch.from_arrays(
                [run["flush"].combine_chunks(), pa.array([True] * run.num_rows), run["payload"].combine_chunks()],
                names=["flush", "about", "payload"],
            )
        flushes_in, payloads_in = run["flush"].to_pylist(), [p.as_buffer() for p in run["payload"]]
        pairs = [_unpack(p, _PAIRS) for f, p in zip(flushes_in, payloads_in) if f == _PAIR_FLUSH]
        flushes_in, payloads_in = flushes_in[len(pairs) :], payloads_in[len(pairs) :]
        usual_high = np.append((usual.hashes >> np.uint64(32)).astype(np.uint32), np.uint32(0))
        deltas, lows = [], []
        columns: list[list[np.ndarray]] = [[], [], [], [], []]
        for payload in payloads_in:
            delta, bits, own, word, a, c, rare_a, rare_c, low_c = _unpack(payload, _SEGMENT)
            out = np.unpackbits(bits, count=len(word)).astype(bool)
            before, after = usual_high[a.astype(np.int64) - 1], usual_high[c.astype(np.int64) - 1]
            before[a == 0], after[c == 0] = rare_a, rare_c
            deltas.append(delta)
            lows.append(low_c)
            for target, value in zip(columns, (out, own[word], before, after, c)):
                target.append(value)
        out, word, before, after, code = (np.concatenate(_emptied(column)) for column in columns)
        trie = _trained(usual, pairs, word, before, after, code, ~out)
        value, wanting = np.empty(len(word)), np.empty(len(word), bool)
        count = np.empty(len(word), np.int64)
        for at in range(0, len(word), BLOCK_POSITIONS):
            part = slice(at, at + BLOCK_POSITIONS)
            rank = trie.sequences["words"].find(word[part])
            value[part], open_ = trie.score(rank, before[part], after[part])
            codes = code[part].astype(np.int64)
            value[part] += np.where(open_ & (codes > 0), usual.log_unigram(codes), 0.0)
            wanting[part] = open_ & (codes == 0)
            own_code = usual.code(word[part])
            count[part] = np.where(own_code > 0, np.append(usual.counts, 0)[own_code - 1], np.append(trie.counts, 0)[rank])
        flushes, payloads, at = [], [], 0
        for flush, delta, low_c in zip(flushes_in, deltas, lows):
            part = slice(at, at + len(delta))
            at += len(delta)
            row = np.cumsum(delta.astype(np.int64))
            low = np.zeros(len(row), np.uint32)
            low[(code[part] == 0) & out[part]] = low_c
            names, place = np.unique(row, return_inverse=True)
            lack = np.flatnonzero(wanting[part])
            flushes.append(flush)
            payloads.append(
                _pack(
                    [
                        names,
                        np.bincount(place, weights=value[part]),
                        np.bincount(place, weights=np.log10(count[part] + 0.5)),
                        np.bincount(place, weights=count[part] > 0).astype(np.int64),
                        row[lack],
                        (after[part][lack].astype(np.uint64) << np.uint64(32)) | low[lack],
                    ]
                )
            )
        return pa.RecordBatch.from_arrays(
            [pa.array(flushes, pa.int64()), pa.array([False] * len(flushes)), pa.array(payloads, pa.binary())],
            names=["flush", "about", "payload"],
        )

    return work


def _gather(usual: Usual):
    """Sum what the shards found of the documents of one flush."""

    def work(run: pa.Table) -> pa.RecordBatch:
        about = run["about"].to_pylist()
        payloads = run["payload"].to_pylist()
        keys, nulls, held, tokens, score, rare_row, rare_word = _unpack(payloads[about.index(True)], _DOCS)
        score, base, known = score.copy(), np.zeros(len(keys)), np.zeros(len(keys), np.int64)
        rows, words = [rare_row], [rare_word]
        for is_about, payload in zip(about, payloads):
            if is_about:
                continue
            names, value, gain, count, row, word = _unpack(payload, _PARTIAL)
            score[names] += value
            base[names] += gain
            known[names] += count
            rows.append(row)
            words.append(word)
        end_code = usual.code(np.array([_END]))
        end_count = np.append(usual.counts, 0)[end_code - 1][0]
        base += np.log10(end_count + 0.5) - tokens * np.log10(usual.norm)
        known += int(end_count > 0)
        row, word = np.concatenate(rows), np.concatenate(words)
        order = np.argsort(row, kind="stable")
        upto = np.searchsorted(row[order], np.arange(len(keys) + 1))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys, mask=nulls.astype(bool)),
                pa.array(held.astype(bool)),
                pa.array(tokens),
                pa.array(known),
                pa.array(base),
                pa.array(score),
                pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(word[order].view(np.int64))),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare"],
        )

    return work


def score(docs: DataFrame) -> DataFrame:
    """Trigram log10 probabilities of ``docs`` (doc_id, text, held_out), learned from the others.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, one row per
    row. A null text is empty: its end alone is a token. Words are lower-cased (A-Z) runs
    without white space.

    Training words are counted first. Then every word position goes to the shard of its word;
    there the training positions become a trie and all positions are scored by it. For words
    split over shards, the contexts of each next word are counted over all parts before. A word whose
    successor was never seen after it backs off to the successor's unigram probability, which is
    joined from the table of all words. What the shards find is summed per document.
    """
    spark = docs.sparkSession
    find_package(spark)
    docs = docs.select("doc_id", "text", "held_out")
    counted = docs.where("NOT held_out").select("doc_id", "text").mapInArrow(_count_words, "word long, n long")
    vocabulary = stage(counted.groupBy("word").agg(F.sum("n").alias("n")).where("n > 0"), "vocabulary")
    totals = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    usual_rows = vocabulary.orderBy(F.desc("n"), "word").limit(USUAL).toArrow()
    hashes = usual_rows["word"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    shards = max(1, -(-int(totals["n"]) * 5 // 4 // SHARD_POSITIONS))
    usual = Usual(hashes[order], usual_rows["n"].to_numpy().astype(np.int64)[order], int(totals["n"]), int(totals["v"]), shards)

    routed = docs.mapInArrow(_route(usual), "shard int, flush long, payload binary")
    if len(usual.split):
        routed = routed.unionByName(_pairs_of_split_words(docs, usual))
    scored = (
        routed.repartition(_partitions(spark, shards), "shard")
        .sortWithinPartitions("shard", "flush")
        .mapInArrow(over_runs(["shard"], _score_shard(usual)), "flush long, about boolean, payload binary")
    )
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, rare array<long>"
    )
    gathered = stage(
        scored.repartition("flush").sortWithinPartitions("flush").mapInArrow(over_runs(["flush"], _gather(usual)), schema)
        .withColumn("row", F.monotonically_increasing_id()),
        "scores",
    )
    lacking = gathered.select("row", F.explode("rare").alias("word"))
    unigram = F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(usual.norm))
    added = (
        lacking.groupBy("row", "word")
        .agg(F.count(F.lit(1)).alias("times"))
        .join(vocabulary, "word", "left")
        .groupBy("row")
        .agg(F.sum(unigram * F.col("times")).alias("more"))
    )
    return gathered.join(added, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(usual.tokens).cast("long").alias("train_tokens"),
        "base_score",
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
    )


def _pairs_of_split_words(docs: DataFrame, usual: Usual) -> DataFrame:
    """Rows (shard, flush, payload) of counted pairs; sums of each split word are put in ``usual``."""
    tokens = int(usual.counts[usual.split].sum())
    buckets = max(1, -(-tokens * 5 // 4 // SHARD_POSITIONS))
    counted = stage(
        docs.mapInArrow(_split_contexts(usual, buckets), "bucket int, payload binary")
        .repartition(_partitions(docs.sparkSession, buckets), "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(
            over_runs(["bucket"], _count_pairs(usual)), "shard int, code int, mass long, degree long, payload binary"
        ),
        "pairs",
    )
    usual.mass, usual.degree = np.zeros((2, len(usual.hashes) + 1), np.int64)
    sums = counted.where("payload IS NULL").groupBy("code").agg(F.sum("mass"), F.sum("degree"))
    for code, mass, degree in sums.collect():
        usual.mass[code], usual.degree[code] = mass, degree
    return counted.where("payload IS NOT NULL").select("shard", F.lit(_PAIR_FLUSH).cast("long").alias("flush"), "payload")


def _partitions(spark: SparkSession, shards: int) -> int:
    """A few shards per task, and no fewer tasks than the session deals its shuffles to."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shards // 4))


def op1_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    return score(docs.withColumn("held_out", remainder(F.col("doc_id"), 5) == 1))


QUERIES = {"op1_ngrams": op1_ngrams}
ORACLES: dict[str, str] = {}
