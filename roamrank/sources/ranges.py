"""Records of CSV files whose quoted fields hold line breaks, read by all cores.

Which line ends a record depends on the quotes before it, so such a file is usually one
task. Here its lines are read as text, in byte ranges. What a line does to the state, in
a quoted field or not, is a function of two values; a first pass composes those of a
range's lines, a running composition over a file's ranges tells the state that each
begins in, and a second pass cuts the ranges at the true ends. A record that crosses
ranges leaves a piece in each, and the pieces are put together afterwards.

A quote opens a field only where the field begins, and closes it if no other quote
follows; what stands between that and the next delimiter is part of the field, as in
Spark's reader. Lines end with \\n or \\r\\n. Compressed files are one range each.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Kinds of pieces: a whole record, the beginning of one, its end, and what lies between.
WHOLE, BEGINS, ENDS, BETWEEN = range(4)
# Says that a range was read, with its size as text.
RANGE = 4
# Ranges that begin inside a field are told to the tasks; a range is megabytes long.
MOST_OPEN_RANGES = 200_000


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, start, size, line): lines in the order of their range, and which range that is."""
    read = spark.read.option("lineSep", "\n").text(path)
    place = [F.col(f"_metadata.{own}").alias(name) for own, name in _PLACE]
    return read.select(*place, F.col("value").alias("line"))


_PLACE = [("file_path", "file"), ("file_block_start", "start"), ("file_block_length", "size")]


# A field up to its delimiter: quoted, with what may follow its closing quote, or plain.
# Nothing is tried twice (possessive), so a line takes time in proportion to its length.
_QUOTED = '[^"]*+(?:""[^"]*+)*+"[^,]*+'
_FIELD = f'(?:"{_QUOTED}|(?!")[^,]*+)'
# Lines that end outside of a field, if they begin outside of one, and if inside.
FROM_OUTSIDE = re.compile(f"{_FIELD}(?:,{_FIELD})*+")
FROM_INSIDE = re.compile(f"{_QUOTED}(?:,{_FIELD})*+")


def _stepper() -> Callable:
    """What a line does to the state; nested, so that it travels by value."""
    outside, inside_match = FROM_OUTSIDE.fullmatch, FROM_INSIDE.fullmatch

    def inside_after(line: str, inside: bool) -> bool:
        """Whether the line's end is in a quoted field, if its beginning is ``inside`` one or not."""
        return (inside_match if inside else outside)(line) is None

    return inside_after


def _runs() -> Callable:
    """The ranges in a batch: each one's (file, start, size), and its rows; travels by value."""

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
        if not batch.num_rows:
            return
        new = np.ones(batch.num_rows, bool)
        new[1:] = False
        for name in ("file", "start", "size"):
            column = batch.column(name)
            new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        bounds = [*np.flatnonzero(new).tolist(), batch.num_rows]
        for low, high in zip(bounds, bounds[1:]):
            yield tuple(batch.column(c)[low].as_py() for c in ("file", "start", "size")), low, high

    return runs


def states(read: DataFrame) -> DataFrame:
    """(file, start, size, inside): each range, and whether it begins in a quoted field."""
    inside_after, runs = _stepper(), _runs()

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, within = None, False, True
        for batch in batches:
            done = []
            for place, low, high in runs(batch):
                if place != now:
                    if now is not None:
                        done.append((*now, out, within))
                    now, out, within = place, False, True
                for line in batch.column("line")[low:high].drop_null().to_pylist():
                    same = out == within
                    out = inside_after(line, out)
                    within = out if same else inside_after(line, within)
            yield told(done)
        if now is not None:
            yield told([(*now, out, within)])

    def told(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(kind.names, row)) for row in rows], kind)

    kind = pa.schema(
        [("file", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("out", pa.bool_()), ("within", pa.bool_())]
    )
    # A line without a quote changes nothing, but the last range may have no other.
    some = read.withColumn("line", F.when(F.contains("line", F.lit('"')), F.col("line")))
    ranges = some.mapInArrow(compose, "file string, start bigint, size bigint, out boolean, within boolean")
    # The state after a range is what the last one makes that doesn't hand on what it got.
    sets = F.when(F.col("out") == F.col("within"), F.col("out"))
    flips = F.when(F.col("out") & ~F.col("within"), 1).otherwise(0)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    since = Window.partitionBy("file", "sets").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ordered = ranges.withColumn("set", sets).withColumn("flip", flips)
    ordered = ordered.withColumn("sets", F.coalesce(F.count("set").over(before), F.lit(0)))
    ordered = ordered.withColumn("from", F.last("set", ignorenulls=True).over(before))
    # Swaps since the range that set the state; that range itself is before the group.
    swaps = F.coalesce(F.sum("flip").over(since), F.lit(0)) % 2 == 1
    base = F.coalesce("from", F.lit(False))
    inside = F.when(swaps, ~base).otherwise(base)
    return ordered.select("file", "start", "size", inside.alias("inside"))


def pieces(spark: SparkSession, path: str | list[str], header: list[str], found: DataFrame) -> DataFrame:
    """(file, start, piece, text): records, parts of those that cross ranges, and a row for each range.

    ``found`` holds the files' stored ``states``. A file's first record must be the
    ``header``; it and empty lines are left out.
    """
    read = lines(spark, path)
    begun = found.where("inside").select("file", "start", "size").limit(MOST_OPEN_RANGES + 1).collect()
    if len(begun) > MOST_OPEN_RANGES:
        raise ValueError(f"more than {MOST_OPEN_RANGES} ranges begin inside a quoted field")
    told = spark.sparkContext.broadcast({tuple(row) for row in begun})
    inside_after, runs = _stepper(), _runs()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The range, whether the place in it is in a field, whether the header is still to
        # come, the lines of the record begun, and whether it began in this range.
        now, inside, first, parts, whole = None, False, False, [], True
        for batch in batches:
            marked, texts = [], []
            for place, low, high in runs(batch):
                if place != now:
                    marked += unfinished(now, parts, whole)
                    now, parts = place, []
                    marked.append((now[0], now[1], RANGE, str(now[2])))
                    inside = now in told.value
                    whole, first = not inside, now[1] == 0
                column = batch.column("line")[low:high]
                lines = column.to_pylist()
                quoted = np.flatnonzero(pc.match_substring(column, '"').to_numpy(zero_copy_only=False)).tolist()
                at = 0
                for next_at in [*quoted, len(lines)]:
                    # Lines without quotes change nothing: records of their own, or all in one field.
                    plain = lines[at:next_at]
                    if inside:
                        parts += plain
                    elif first and plain:
                        begun = next((n for n, line in enumerate(plain) if stripped(line)), len(plain))
                        if begun < len(plain):
                            checked(now[0], stripped(plain[begun]))
                            first = False
                        texts += plain[begun + 1 :]
                    else:
                        texts += plain
                    if next_at == len(lines):
                        break
                    parts.append(lines[next_at])
                    inside = inside_after(lines[next_at], inside)
                    if not inside:
                        text = "\n".join(parts)
                        if first:
                            checked(now[0], stripped(text))
                            first = False
                        elif whole:
                            texts.append(text)
                        else:
                            marked.append((now[0], now[1], ENDS, stripped(text)))
                        parts, whole = [], True
                    at = next_at + 1
            yield listed(marked, [text for text in map(stripped, texts) if text])
        yield listed(unfinished(now, parts, whole), [])

    def stripped(text: str) -> str:
        return text[:-1] if text.endswith("\r") else text

    def unfinished(now: tuple | None, parts: list[str], whole: bool) -> list[tuple]:
        return [(now[0], now[1], BEGINS if whole else BETWEEN, "\n".join(parts))] if parts else []

    def checked(file: str, text: str) -> None:
        names = next(csv.reader([text.removeprefix("\ufeff")]), [])
        if names != header:
            raise ValueError(f"header of {file} has {names}, not {header}")

    def listed(marked: list[tuple], texts: list[str]) -> pa.RecordBatch:
        files, starts, sorts, own = zip(*marked) if marked else ((), (), (), ())
        none = [None] * len(texts)
        columns = [[*files, *none], [*starts, *none], [*sorts, *[WHOLE] * len(texts)], [*own, *texts]]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, ["file", "start", "piece", "text"])

    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
    return read.mapInArrow(cut, "file string, start bigint, piece int, text string")


def check_ranges(found: DataFrame, read: DataFrame) -> None:
    """An error if the second pass had other ranges than the first, as after a change of the cluster's size."""
    first = found.select("file", "start", F.col("size").cast("string").alias("text"))
    second = read.where(F.col("piece") == RANGE).select("file", "start", "text")
    if not first.exceptAll(second).unionByName(second.exceptAll(first)).isEmpty():
        raise RuntimeError("files were cut into other ranges the second time: read them again")


def joined(parts: DataFrame) -> DataFrame:
    """(text): records put together from their pieces (file, start, piece, text), two for each range at most."""
    along = Window.partitionBy("file").orderBy("start", F.desc("piece"))
    record = F.sum(F.when(F.col("piece") == BEGINS, 1).otherwise(0)).over(along)
    placed = F.sort_array(F.collect_list(F.struct("start", F.col("text"))))
    rows = parts.withColumn("record", record).groupBy("file", "record").agg(placed.alias("placed"))
    return rows.select(F.concat_ws("\n", "placed.text").alias("text"))
