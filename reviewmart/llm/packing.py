"""Best-fit packing of tokenised documents, certified by dual-feasible lower bounds."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewmart.llm.common import hash_spans, table, text_chunks, word_spans
from reviewmart.session import stage

CAPACITY = 4096
END_ID = 1
#: Pieces that one task packs at a time. Their number of partitions grows with the input.
PARTITION_PIECES = 1 << 14
#: Rounds in which partitions that miss their bound exchange documents.
ROUNDS = 3
#: Partitions with gaps that meet in one task of a round.
MEETING = 8
#: Distinct pieces a worker remembers per generation; two are held.
REMEMBERED = 300_000

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: What the vocabulary never cuts: letters up to U+017F, a digit, other signs of ASCII.
_RUN = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[!-&(-/:-@\[-`{-~]+").fullmatch
_BLANK, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[33:127] = _SIGN
_KIND[ord("'")] = _ODD
_KIND[[9, 10, 11, 12, 13, 32]] = _BLANK
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _LETTER


class WordIds:
    """Ids of texts as the tokenizers library gives them, looked up piece by piece.

    No merge crosses white space or the edge of a run of letters, a digit, or a run of other
    signs. Words of ASCII and Latin letters are cut into these runs here and merged by the
    library's model; any other word, and any with an apostrophe, goes through the library whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # The byte-level alphabet: a printable byte stands for itself, the others follow U+00FF.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = (chr(256 + k) for k in range(256))
        self.letters = [chr(b) if b in plain else next(others) for b in range(256)]
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _piece(self, piece: bytes) -> bytes:
        known = self.old.get(piece)
        if known is None:
            text = piece.decode().lower()
            if _RUN(text):
                spelled = text if text.isascii() else "".join([self.letters[b] for b in text.encode()])
                ids = [t.id for t in self.tokenizer.model.tokenize(spelled)]
            else:
                ids = self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids
            known = struct.pack(f"<{len(ids)}I", *ids)
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        self.young[piece] = known
        return known

    def encode_rows(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """Ids of each row of a chunk. A piece is looked up once, however often it occurs."""
        starts, ends, first = _pieces(data, offsets)
        _, sample, piece = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        raw, known = data.tobytes(), self.young.get
        spans = zip(starts[sample].tolist(), ends[sample].tolist())
        found = [known(p := raw[s:e].lower()) or self._piece(p) for s, e in spans]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), "<u4")
        begin = np.cumsum(size) - size
        taken = size[piece]
        upto = np.concatenate([[0], np.cumsum(taken)])
        flat = ids[np.repeat(begin[piece] - upto[:-1], taken) + np.arange(upto[-1])]
        bounds = upto[first].tolist()
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield flat[a:b]


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of the pieces of all rows, and each row's first piece."""
    starts, ends, _ = word_spans(data, offsets)
    if not len(starts):
        return starts, ends, np.zeros(len(offsets), np.int64)
    kind = _KIND[data]
    lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5))
    follows = data[lead + 1]
    sign = (data[lead] == 0xC3) & ((follows == 0x97) | (follows == 0xB7))
    dotted = (data[lead] == 0xC4) & (follows == 0xB0)
    lead = lead[~(sign | dotted)]
    kind[lead] = kind[lead + 1] = _LETTER
    whole = np.zeros(len(starts), bool)
    whole[np.searchsorted(starts, np.flatnonzero(kind == _ODD), "right") - 1] = True
    cut = kind == _DIGIT
    cut[1:] |= kind[1:] != kind[:-1]
    cut &= kind != _BLANK
    cut[starts] = True
    at = np.flatnonzero(cut)
    word = np.searchsorted(starts, at, "right") - 1
    keep = ~whole[word] | (at == starts[word])
    at, word = at[keep], word[keep]
    end = ends[word]
    end[:-1] = np.minimum(end[:-1], at[1:])
    return at, end, np.searchsorted(at, offsets)


_loaded: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def _piece_batches(path: str, capacity: int):
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(path)
        for batch in batches:
            for low, high, data, offsets in text_chunks(batch):
                rows = []
                for key, ids in zip(batch.column(0)[low:high].to_pylist(), words.encode_rows(data, offsets)):
                    whole = ids.tobytes() + end
                    for piece, at in enumerate(range(0, len(whole), 4 * capacity)):
                        part = whole[at : at + 4 * capacity]
                        rows.append((key, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of ``docs`` (doc_id, text): ids, then ``END_ID``.

    Only a longer document is cut. A null text is empty and has the end alone.
    """
    return docs.select("doc_id", "text").mapInArrow(_piece_batches(path, capacity), _PIECE)


def lower_bound(lengths: np.ndarray, capacity: int, times: np.ndarray | None = None) -> int:
    """A number of sequences below which no packing of the lengths exists.

    The greatest over two families of dual-feasible functions: the threshold functions (large
    pieces alone, middle ones by size, pieces below the threshold not at all) and the rounding
    functions f_k(x) = floor((k + 1) x / C) / k, with x itself where (k + 1) x / C is whole.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, weights=times, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    total = count * size
    n_upto, s_upto = np.cumsum(count), np.cumsum(total)
    best = -(-int(s_upto[-1]) // capacity)
    half = capacity // 2
    threshold = np.arange(0, half + 1)
    alone = n_upto[-1] - n_upto[capacity - threshold]
    middle_n = n_upto[capacity - threshold] - n_upto[half]
    middle_s = s_upto[capacity - threshold] - s_upto[half]
    little_s = s_upto[half] - np.where(threshold > 0, s_upto[threshold - 1], 0)
    over = np.maximum(little_s - (middle_n * capacity - middle_s), 0)
    best = max(best, int((alone + middle_n - (-over // capacity)).max()))
    for k in range(1, 21):
        scaled = (k + 1) * size
        whole = scaled % capacity == 0
        numerator = np.where(whole, k * size, (scaled // capacity) * capacity)
        best = max(best, -(-int((count * numerator).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: bin and offset of each length, and the number of bins.

    The bins with a given room left lie on one stack, and one wide integer has a bit for each
    room that some bin has, so the tightest bin that fits is found by a shift.
    """
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, used = 0, 0
    for at, length in zip(order.tolist(), lengths[order].tolist()):
        fits = open_rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            stack = stacks[room]
            name = stack.pop()
            if not stack:
                open_rooms ^= 1 << room
        else:
            room, name = capacity, used
            used += 1
        bins[at], offsets[at] = name, capacity - room
        left = room - length
        if left:
            stacks[left].append(name)
            open_rooms |= 1 << left
    return bins, offsets, used


def _assign(group: pd.DataFrame, capacity: int, turn: int, own: bool) -> pd.DataFrame:
    """Pack one group, keep its present sequences unless that saves some, and mark what moves.

    Where the bound leaves a gap, the worst-filled sequences move on to the next round, as many
    as a MEETING-th of a partition's pieces, so the groups that meet stay as small as these.
    """
    group = group.sort_values(["doc_id", "piece", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
    lengths = group["length"].to_numpy()
    bins, offsets, used = best_fit(lengths, capacity)
    old, present = np.unique(group["sequence_id"].to_numpy(), return_inverse=True)
    if own or used < len(old):
        base = (int(group["home"].iloc[0]) * (ROUNDS + 1) + turn) << 24
        group["sequence_id"], group["offset"] = base + bins, offsets
    else:
        bins, used = present, len(old)
    group["moves"] = False
    if used > lower_bound(lengths, capacity):
        fill = np.bincount(bins, weights=lengths, minlength=used)
        size = np.bincount(bins, minlength=used)
        by_room = np.argsort(fill, kind="stable")
        chosen = by_room[(np.cumsum(size[by_room]) <= PARTITION_PIECES // MEETING) & (fill[by_room] < capacity)]
        group["moves"] = np.isin(bins, chosen)
    return group


def _grouped(rows: DataFrame, capacity: int, turn: int) -> DataFrame:
    return rows.groupBy("home").applyInPandas(
        lambda group: _assign(group, capacity, turn, own=turn == 0), _PACKED
    )


_PACKED = _PIECE + ", home long, sequence_id long, offset long, moves boolean"


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pack ``pieces`` (as of ``token_pieces``) into sequences of at most ``capacity`` tokens.

    Returns the pieces with sequence_id and offset. Pieces are dealt to partitions of about
    ``PARTITION_PIECES``; each is packed best-fit decreasing, and the dual-feasible bound tells
    which partitions nothing can improve. From the others, the worst-filled sequences meet in
    groups of ``MEETING`` partitions and are packed again; the new packing replaces the old
    where it needs fewer sequences. An empty table gives an empty table; repeated rows and null
    doc_ids are packed like any other.
    """
    pieces = stage(pieces, "pieces")
    parts = max(1, -(-pieces.count() // PARTITION_PIECES))
    dealt = pieces.withColumns(
        {
            "home": F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)),
            "sequence_id": F.lit(0).cast("long"),
            "offset": F.lit(0).cast("long"),
            "moves": F.lit(False),
        }
    )
    packed = stage(_grouped(dealt, capacity, 0), "packed")
    for turn in range(1, ROUNDS + 1):
        if parts == 1:
            break
        parts = -(-parts // MEETING)
        met = packed.withColumn("home", F.floor(F.col("home") / MEETING))
        again = _grouped(met.where("moves"), capacity, turn)
        packed = stage(met.where("NOT moves").unionByName(again), f"packed{turn}")
    return packed.drop("home", "moves")


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """Sequences used, and the bound of all pieces together. Only counts per length are fetched."""
    used = packed.select("sequence_id").distinct().count()
    counts = packed.groupBy("length").count().collect()
    lengths = np.array([r["length"] for r in counts], np.int64)
    return used, lower_bound(lengths, capacity, np.array([r["count"] for r in counts], np.int64))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    docs = table(spark, sf_dir, "documents")
    return pack(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


QUERIES = {"op2_packing": op2_packing}
ORACLES: dict[str, str] = {}
