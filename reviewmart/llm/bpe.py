"""Byte-level BPE encoding and decoding over length-bucketed numpy matrices."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from reviewmart.llm.common import mix, table

#: Padded widths of the matrices, in bytes.
WIDTHS = (4, 6, 8, 10, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256)
#: Rows of a matrix that are merged at once.
BLOCK_ROWS = 1 << 15
#: Distinct pieces a worker remembers per generation; two generations are held.
REMEMBERED = 120_000
#: Characters of text that are split into pieces before unseen ones are encoded.
CHUNK_CHARS = 1 << 21
_NONE = np.int32(2**31 - 1)


class PairTable:
    """Open-addressed hash table from a pair of ids to the rank of their merge."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        size = 1 << max(4, int(len(rank) * 2 - 1).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys = np.full(size, -1, np.int64)
        self.ranks = np.full(size, _NONE, np.int32)
        self.longest = 0
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slots = (mix(keys.view(np.uint64)) & self.mask).astype(np.int64)
        rest = np.arange(len(keys))
        while len(rest):
            self.longest += 1
            free = rest[self.keys[slots[rest]] < 0]
            _, first = np.unique(slots[free], return_index=True)
            put = free[first]
            self.keys[slots[put]] = keys[put]
            self.ranks[slots[put]] = rank[put]
            placed = np.zeros(len(keys), bool)
            placed[put] = True
            rest = rest[~placed[rest]]
            slots[rest] = (slots[rest] + 1) & int(self.mask)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, ``_NONE`` where there is no merge. Ids below 0 are padding."""
        shape = left.shape
        keys = ((left.astype(np.int64) << 32) | (right.astype(np.int64) & 0xFFFFFFFF)).ravel()
        out = np.full(len(keys), _NONE, np.int32)
        at = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slot = (mix(keys[at].view(np.uint64)) & self.mask).astype(np.int64)
        for _ in range(self.longest):
            if not len(at):
                break
            held = self.keys[slot]
            hit = held == keys[at]
            out[at[hit]] = self.ranks[slot[hit]]
            on = ~hit & (held >= 0)
            at, slot = at[on], (slot[on] + 1) & int(self.mask)
        return out.reshape(shape)


class BytePairs:
    """Encoder and decoder of one vocabulary of byte strings and ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.single = np.full(256, -1, np.int32)
        left, right, rank = [], [], []
        for token, value in ranks.items():
            if len(token) == 1:
                self.single[token[0]] = value
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(value)
        self.pairs = PairTable(*(np.array(x, np.int64) for x in (left, right)), np.array(rank, np.int32))
        self.lookup = {(a, b): r for a, b, r in zip(left, right, rank)}

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece: always the leftmost pair of least rank is merged next."""
        out: list[list[int]] = [[]] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        bucket = np.searchsorted(WIDTHS, lengths)
        for k in np.unique(bucket).tolist():
            rows = np.flatnonzero(bucket == k)
            if k == len(WIDTHS):
                for i in rows.tolist():
                    out[i] = self._encode_long(pieces[i])
                continue
            for low in range(0, len(rows), BLOCK_ROWS):
                some = rows[low : low + BLOCK_ROWS].tolist()
                for i, ids in self._encode_block(some, [pieces[i] for i in some], WIDTHS[k]):
                    out[i] = ids
        return out

    def _encode_block(self, names: list[int], pieces: list[bytes], width: int) -> Iterator[tuple[int, list[int]]]:
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = np.where(np.arange(width) < length[:, None], self.single[raw], np.int32(-1))
        ranks = np.concatenate(
            [self.pairs.find(ids[:, :-1], ids[:, 1:]), np.full((len(ids), 1), _NONE, np.int32)], axis=1
        )
        name = np.asarray(names)
        while len(ids):
            best = ranks.argmin(axis=1)
            row = np.arange(len(ids))
            value = ranks[row, best]
            done = value == _NONE
            if done.any():
                for i, line, n in zip(name[done].tolist(), ids[done].tolist(), length[done].tolist()):
                    yield i, line[:n]
                on = ~done
                ids, ranks, name, length, best, value = (x[on] for x in (ids, ranks, name, length, best, value))
                row = np.arange(len(ids))
                if not len(ids):
                    break
            ids[row, best] = value
            keep = np.arange(ids.shape[1] - 1)[None, :]
            ids = np.take_along_axis(ids, keep + (keep > best[:, None]), axis=1)
            ranks = np.take_along_axis(ranks, keep + (keep >= best[:, None]), axis=1)
            length = length - 1
            last = ids.shape[1] - 1
            after = np.where(best < last, ids[row, np.minimum(best + 1, last)], -1)
            ranks[row, best] = self.pairs.find(ids[row, best], after)
            before = best > 0
            ranks[row[before], best[before] - 1] = self.pairs.find(
                ids[row[before], best[before] - 1], ids[row[before], best[before]]
            )
            ranks[:, -1] = _NONE

    def _encode_long(self, piece: bytes) -> list[int]:
        """The same merges by a heap over a linked list, for a piece wider than any matrix."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = self.lookup.get
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := pair((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prev[nxt[i]] = i
            for x in (prev[i], i):
                if x >= 0 and nxt[x] < n and (s := pair((ids[x], ids[nxt[x]]))) is not None:
                    heapq.heappush(heap, (s, x, ids[x], ids[nxt[x]]))
        return [i for i in ids if i >= 0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


_loaded: dict[tuple[str, str], tuple[BytePairs, Callable]] = {}
_remembered: dict[tuple, list[dict]] = {}


def _codec(path: str, pattern: str) -> tuple[BytePairs, Callable]:
    """The worker's encoder and splitter, read once."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = (BytePairs(read_ranks(path)), regex.compile(pattern).findall)
    return _loaded[path, pattern]


def _entries(codec: BytePairs, memory: list[dict], wanted: set[str], entry: Callable) -> dict:
    """A dict that has an entry for each wanted piece. Two generations bound its memory."""
    if len(memory[0]) > REMEMBERED:
        memory[1], memory[0] = memory[0], {}
    young, old = memory
    new = []
    for piece in wanted:
        if piece not in young:
            if piece in old:
                young[piece] = old[piece]
            else:
                new.append(piece)
    for piece, ids in zip(new, codec.encode([p.encode() for p in new])):
        young[piece] = entry(codec, ids)
    return young


def _plain(codec: BytePairs, ids: list[int]) -> list[int]:
    return ids


def _digested(codec: BytePairs, ids: list[int]) -> tuple[str, int, bytes]:
    return ",".join(map(str, ids)), len(ids), codec.decode(ids)


def _split_chunks(
    batches: Iterator[pa.RecordBatch], path: str, pattern: str, entry: Callable
) -> Iterator[tuple[pa.Array, list[list]]]:
    """Runs of rows: their keys, and for each row the entries of its pieces."""
    codec, split = _codec(path, pattern)
    memory = _remembered.setdefault((path, pattern, entry.__name__), [{}, {}])
    for batch in batches:
        keys, texts = batch.column(0), batch.column(1).to_pylist()
        low = 0
        while low < len(texts):
            high, size = low, 0
            while high < len(texts) and (high == low or size + len(texts[high] or "") <= CHUNK_CHARS):
                size += len(texts[high] or "")
                high += 1
            pieces = [split(t or "") for t in texts[low:high]]
            known = _entries(codec, memory, set().union(*pieces), entry)
            yield keys[low:high], [[known[p] for p in row] for row in pieces]
            low = high


def _digest_batches(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, rows in _split_chunks(batches, path, pattern, _digested):
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array([sum([f[1] for f in row]) for row in rows], pa.int64()),
                    pa.array([hashlib.sha256(",".join([f[0] for f in row]).encode()).hexdigest() for row in rows]),
                    pa.array([hashlib.sha256(b"".join([f[2] for f in row])).hexdigest() for row in rows]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _id_batches(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, rows in _split_chunks(batches, path, pattern, _plain):
            ids = [[i for found in row for i in found] for row in rows]
            yield pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return run


def _byte_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in read_ranks(path).items()}
        for batch in batches:
            texts = [b"".join(map(tokens.__getitem__, ids or [])) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["doc_id", "bytes"])

    return run


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of each row of ``docs`` (doc_id, text; others are ignored).

    ``path`` names a file of base64 tokens and ranks, ``pattern`` splits a text into pieces;
    each piece is encoded alone. Null and empty texts have no ids. Repeated rows and null
    doc_ids come out as they came in. Text of any length is one row, held by one task.
    """
    return docs.select("doc_id", "text").mapInArrow(_id_batches(path, pattern), "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, bytes) of each row of ``tokens`` (doc_id, ids). Null ids decode to no bytes."""
    return tokens.select("doc_id", "ids").mapInArrow(_byte_batches(path), "doc_id long, bytes binary")


def round_trip_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encode`` then ``decode``, returned as digests: both happen piece by piece in one pass."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(_digest_batches(path, pattern), schema)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and round trip of all documents under the 50k multilingual byte vocabulary."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip_digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


QUERIES = {"op5_bpe": op5_bpe}
ORACLES: dict[str, str] = {}
