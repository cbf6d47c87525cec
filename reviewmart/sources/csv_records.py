"""CSV files cut anywhere: records with line breaks inside cells, read by many tasks.

Where a cut falls inside a quoted cell, only the file before it can tell. So each split is read
once for what it does to either state (inside a quoted cell, or not); chained along the file,
these give every split its first state. A second pass then joins lines to records, stitches the
few records that lie across cuts, and leaves the cells to Spark's own CSV parser.
"""

from __future__ import annotations

import csv
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmart.operators.lookup import MAX_BROADCAST_ROWS, is_small
from reviewmart.session import find_package, stage

#: Where a record lies: its file, the split it begins in, and its number there.
PLACE = ("_file", "_start", "_position")

# A line begun at the start of a record: whether it ends inside a quoted cell.
_ENDS_INSIDE = r'(?:(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|),)*+"(?:[^"]++|"")*+\Z'
# A line begun inside a quoted cell: as far as the end of that cell.
_CLOSES = r'(?:[^"]++|"")*+"[^,]*+'
# A line of cells with no quotes but those round a cell: begun outside a quoted cell, it ends outside.
_PLAIN = r'\A(?:"[^"]*"[^",]*|[^",]*)(?:,(?:"[^"]*"[^",]*|[^",]*))*\z'


def _ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open at the end of a line, given whether one was at its begin."""
    at = 0
    if inside:
        closed = re.match(_CLOSES, line)
        if closed is None:
            return True
        if closed.end() == len(line):
            return False
        at = closed.end() + 1
    return re.compile(_ENDS_INSIDE).match(line, at) is not None


def read_header(spark: SparkSession, file: str) -> list[str]:
    """The cells of a file's first record; only this much of it is read.

    An empty name becomes ``_c0`` by its place, and repeated ones get their place as a suffix.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines: list[str] = []
        inside = False
        while inside or not "".join(lines).strip():
            line = reader.readLine()
            if line is None:
                break
            inside = _ends_inside(line, inside)
            lines.append(line)
    finally:
        stream.close()
    cells = next(csv.reader(["\n".join(lines).lstrip("\ufeff\n")]), [])
    lowered = [c.lower() for c in cells]
    return [f"_c{k}" if not c else f"{c}{k}" if lowered.count(c.lower()) > 1 else c for k, c in enumerate(cells)]


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Array, dict]]:
    """Runs of lines of one split: its (file, start), the lines, and its other columns' first row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rest = [n for n in batch.schema.names if n != "value"]
        file, start = (batch.column(batch.schema.get_field_index(n)) for n in ("_file", "_start"))
        starts = start.to_numpy()
        codes = file.dictionary_encode().indices.to_numpy()
        new = np.flatnonzero((starts[1:] != starts[:-1]) | (codes[1:] != codes[:-1])) + 1
        bounds = [0, *new.tolist(), batch.num_rows]
        for a, b in zip(bounds[:-1], bounds[1:]):
            row = {n: batch.column(batch.schema.get_field_index(n))[a].as_py() for n in rest}
            yield (row["_file"], row["_start"]), batch.column(batch.schema.get_field_index("value")).slice(a, b - a), row


def _flips(lines: pa.Array, *states: bool) -> list[list[int]]:
    """For each first state, the lines at whose end a quoted cell is opened or closed.

    Only lines with a quote can change the state. Those that are plain, found for all lines at once,
    are looked at no further unless a cell is open before them.
    """
    at = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    quoted = lines.take(pa.array(at))
    hard = np.flatnonzero(~pc.match_substring_regex(quoted, _PLAIN).to_numpy(zero_copy_only=False)).tolist()
    found = []
    for inside in states:
        flips, k = [], 0
        while k < len(at):
            if not inside:
                # A cell can only be opened by the next line that is not plain.
                next_hard = bisect_left(hard, k)
                if next_hard == len(hard):
                    break
                k = hard[next_hard]
            if _ends_inside(quoted[k].as_py(), inside) != inside:
                flips.append(int(at[k]))
                inside = not inside
            k += 1
        found.append(flips)
    return found


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split, the state it ends in after either first state."""
    found: dict[tuple, list[bool]] = {}
    for place, lines, _ in _splits(batches):
        state = found.setdefault(place, [False, True])
        first = state if state[0] != state[1] else state[:1]
        after = [s ^ bool(len(flips) % 2) for s, flips in zip(first, _flips(lines, *first))]
        state[:] = after if len(after) == 2 else after * 2
    if found:
        columns = ([p[0] for p in found], [p[1] for p in found], [s[0] for s in found.values()], [s[1] for s in found.values()])
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["_file", "_start", "after_outside", "after_inside"]
        )


_HEAD, _WHOLE, _TAIL = 0, 1, 2


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records, and of each split the end of one begun before it and the begin of an open one."""
    now, inside, kind, open_, count = None, False, _WHOLE, [], 0

    def made(records: list[tuple[int, str]], place: tuple) -> pa.RecordBatch:
        nonlocal count
        kept = [(k, text.removesuffix("\r") if k == _WHOLE else text) for k, text in records]
        kept = [(k, text) for k, text in kept if text or k != _WHOLE]
        first, count = count, count + len(kept)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([place[0]] * len(kept), pa.string()),
                pa.array([place[1]] * len(kept), pa.int64()),
                pa.array(range(first, count), pa.int64()),
                pa.array([k for k, _ in kept], pa.int32()),
                pa.array([text for _, text in kept], pa.string()),
            ],
            names=[*PLACE, "kind", "record"],
        )

    def lines_made(lines: pa.Array, place: tuple) -> pa.RecordBatch:
        """Lines that are a record each."""
        nonlocal count
        if pc.any(pc.ends_with(lines, "\r")).as_py():
            lines = pc.replace_substring_regex(lines, r"\r\z", "")
        lines = lines.filter(pc.greater(pc.binary_length(lines), 0))
        first, count = count, count + len(lines)
        return pa.RecordBatch.from_arrays(
            [
                pa.repeat(pa.scalar(place[0], pa.string()), len(lines)),
                pa.repeat(pa.scalar(place[1], pa.int64()), len(lines)),
                pa.array(np.arange(first, count, dtype=np.int64)),
                pa.repeat(pa.scalar(_WHOLE, pa.int32()), len(lines)),
                lines,
            ],
            names=[*PLACE, "kind", "record"],
        )

    def closed() -> Iterator[pa.RecordBatch]:
        if open_:
            yield made([(_HEAD if kind == _HEAD else _TAIL, "\n".join(open_))], now)

    for place, lines, row in _splits(batches):
        if place != now:
            yield from closed()
            now, inside, open_, count = place, row["inside"], [], 0
            kind = _HEAD if inside else _WHOLE
        (flips,) = _flips(lines, inside)
        if not (flips or inside or open_):
            kind = _WHOLE
            yield lines_made(lines, place)
            continue
        texts = lines.to_pylist()
        changed = np.zeros(len(texts) + 1, np.int64)
        changed[np.array(flips, np.int64) + 1] = 1
        before = (np.cumsum(changed) + inside) % 2 == 1
        before, inside = before[:-1], bool(before[-1])
        begins = np.flatnonzero(~before).tolist()
        found: list[tuple[int, str]] = []
        if not begins:
            open_ += texts
            continue
        if begins[0] or open_:
            found.append((kind, "\n".join([*open_, *texts[: begins[0]]])))
            open_ = []
        kind = _WHOLE
        ends = [*begins[1:], len(texts)]
        if inside:
            open_ = texts[begins[-1] :]
            begins, ends = begins[:-1], ends[:-1]
        found += [(_WHOLE, texts[a] if b == a + 1 else "\n".join(texts[a:b])) for a, b in zip(begins, ends)]
        yield made(found, place)
    if now is not None:
        yield from closed()


def _first_states(lines: DataFrame) -> DataFrame:
    """(_file, _start, inside) of every split, from the effects of those before it in its file."""
    effects = lines.mapInArrow(_effects, "_file string, _start long, after_outside boolean, after_inside boolean")
    # A split's lines lie in one task, so one row each.
    chain = effects.groupBy("_file").agg(F.array_sort(F.collect_list(F.struct("_start", "after_outside", "after_inside"))).alias("splits"))
    zero = F.struct(F.lit(False).alias("inside"), F.expr("cast(array() as array<struct<_start: bigint, inside: boolean>>)").alias("seen"))

    def step(acc, split):
        after = F.when(acc["inside"], split["after_inside"]).otherwise(split["after_outside"])
        seen = F.array_append(acc["seen"], F.struct(split["_start"].alias("_start"), acc["inside"].alias("inside")))
        return F.struct(after.alias("inside"), seen.alias("seen"))

    return chain.select("_file", F.inline(F.aggregate("splits", zero, step, lambda acc: acc["seen"])))


def _with_states(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Lines with their split's first state, each split's in one task and in order."""
    split = ["_file", "_start"]
    if is_small(states, MAX_BROADCAST_ROWS):
        return lines.join(F.broadcast(states), split)
    numbered = lines.withColumn("_line", F.monotonically_increasing_id())
    return numbered.join(states.hint("shuffle_merge"), split).sortWithinPartitions(*split, "_line").drop("_line")


def _stitched(parts: DataFrame) -> DataFrame:
    """Records across cuts: the open end of a split with what the splits after it add to it."""
    order = Window.partitionBy("_file").orderBy("_start", "kind")
    begun = F.when(F.col("kind") == _TAIL, F.col("_start"))
    owner = F.last(begun, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    pieces = F.array_sort(F.collect_list(F.struct("_start", "record")))
    return (
        parts.withColumn("owner", owner)
        .groupBy("_file", F.col("owner").alias("_start"))
        .agg(
            F.min(F.when(F.col("kind") == _TAIL, F.col("_position"))).alias("_position"),
            F.regexp_replace(F.array_join(F.transform(pieces, lambda p: p["record"]), "\n"), r"\r\z", "").alias("record"),
        )
    )


def read_csv_records(spark: SparkSession, files: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The records of CSV files that begin with one header: ``columns`` as strings, and ``PLACE``.

    Quoted cells may hold line breaks, delimiters and doubled quotes; a quote inside an unquoted
    cell is a character like any other. Lines end in LF or CR LF. Rows are the same at any split
    size; a record with its line breaks, and one split's share of a longer one, must fit in memory.
    """
    find_package(spark)
    lines = spark.read.text(list(files), lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")
    )
    states = stage(_first_states(lines), "csv-states")
    schema = "_file string, _start long, _position long, kind int, record string"
    found = stage(_with_states(lines, states).mapInArrow(_records, schema), "csv-records")
    whole = found.where(F.col("kind") == _WHOLE).select(*PLACE, "record")
    records = whole.unionByName(_stitched(found.where(F.col("kind") != _WHOLE)))
    ddl = ", ".join("`" + c.replace("`", "``") + "` STRING" for c in columns)
    cells = F.from_csv("record", ddl, {"escape": '"', "multiLine": "true"})
    is_header = (F.col("_start") == 0) & (F.col("_position") == 0)
    return records.where(~is_header).select(*PLACE, cells.alias("cells")).select(*PLACE, "cells.*")
