"""Array files read in parallel: files are cut into byte ranges, and each range gives the records that begin in it.

A place in a JSON file cannot be understood without what stands before it: it may lie in a string, at any depth.  So a file is read twice.
The first read (``_borders``) takes every range by itself and says, for both cases "starts outside a string" and "starts inside one",
how the range ends: outside or inside, how much deeper or shallower, and how many commas stand at which depth relative to its start.  That is
one row of numbers per range, and running sums over a file's rows give every range its true start.  The second read
(``_members``) then gives each member of the array from the range its leading ``[`` or ``,`` lies in, and reads on behind the range
only to finish its last member.

Strings, escapes and nesting are followed exactly; a backslash before a range's first byte is looked up in the file.  Ranges are dealt to
tasks by size, so that many small files do not become many tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.sources.work import saved, work_path

# Executors get this module inside the task closure, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGE_BYTES = 32 << 20
BLOCK = 1 << 20  # bytes looked at together
QUOTE, BACKSLASH, COMMA, OPEN, CLOSE = 34, 92, 44, (91, 123), (93, 125)
_DELTA = np.zeros(256, np.int8)
_DELTA[list(OPEN)], _DELTA[list(CLOSE)] = 1, -1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 13, 32]] = True


def open_file(path: str) -> pa.NativeFile:
    """A file by its address; those of object stores go by their plain scheme."""
    scheme, _, rest = path.partition(":")
    if not _ or "/" in scheme:
        return pafs.LocalFileSystem().open_input_file(path)
    if scheme == "file":
        return pafs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    fs, at = pafs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest)
    return fs.open_input_file(at)


def escaped_at(file: pa.NativeFile, start: int) -> bool:
    """Whether the byte at `start` follows an odd number of backslashes."""
    run, at = 0, start
    while at > 0:
        size = min(at, 4096)
        tail = file.read_at(size, at - size)
        held = len(tail) - len(tail.rstrip(b"\\"))
        run, at = run + held, at - size
        if held < size:
            break
    return run % 2 == 1


def structure(data: np.ndarray, escaped: bool, inside: bool) -> tuple[np.ndarray, np.ndarray, bool, bool]:
    """(places of brackets and commas outside strings, the depth change of each, whether the byte after is escaped, whether it is inside)."""
    slash = data == BACKSLASH
    place = np.arange(len(data))
    last = np.maximum.accumulate(np.where(slash, -1, place)) if len(data) else place
    # The run of backslashes that ends at a place; one that reaches back over the start has the one before it too.
    run = place - last + np.where((last < 0) & escaped, 1, 0)
    run[~slash] = 0
    before = np.append(int(escaped), run[:-1])
    quote = (data == QUOTE) & (before % 2 == 0)
    parity = np.cumsum(quote) + int(inside)
    outside = ((parity - quote) % 2 == 0) & ~quote
    at = np.flatnonzero(outside & ((_DELTA[data] != 0) | (data == COMMA)))
    return at, _DELTA[data[at]].astype(np.int64), bool(len(run) and run[-1] % 2), bool(parity[-1] % 2) if len(data) else inside


def blocks(file: pa.NativeFile, start: int, end: int, size: int | None = None) -> Iterator[np.ndarray]:
    """The bytes from start to end; then those up to size, if asked for, in steps that begin small: few are looked at for a member's rest."""
    step = 1 << 10
    while start < max(end, size or 0):
        if start < end:
            data = file.read_at(min(BLOCK, end - start), start)
        else:
            data = file.read_at(min(BLOCK, step, size - start), start)
            step *= 2
        if not data:
            return
        yield np.frombuffer(data, np.uint8)
        start += len(data)


def summary(file: pa.NativeFile, start: int, end: int, inside: bool) -> dict:
    """How a range ends if it starts outside (or inside) a string, in numbers relative to its start."""
    escaped, depth, marks, commas = escaped_at(file, start), 0, 0, {}
    for data in blocks(file, start, end):
        at, delta, escaped, inside = structure(data, escaped, inside)
        depths = depth + np.cumsum(delta)
        marks += int(np.count_nonzero(delta))
        for d, n in zip(*np.unique(depths[(delta == 0) & (depths <= 1)], return_counts=True)):
            commas[str(d)] = commas.get(str(d), 0) + int(n)
        depth = int(depths[-1]) if len(depths) else depth
    return {"inside": inside, "depth": depth, "marks": marks, "commas": commas}


@dataclass
class Range:
    """Bytes start to end of a file, and how they start: in a string, at which depth, after how many members, the array opened or not."""
    path: str
    start: int
    end: int
    size: int
    inside: bool = False
    depth: int = 0
    members: int = 0
    opened: bool = False


def resolved(ranges: list[tuple[Range, list[dict]]]) -> list[Range]:
    """Ranges of one file in order, each with its summaries for a start outside and inside of a string: their true starts."""
    out, inside, depth, members, opened = [], False, 0, 0, False
    for r, ends in ranges:
        out.append(Range(r.path, r.start, r.end, r.size, inside, depth, members, opened))
        end = ends[int(inside)]
        members += end["commas"].get(str(1 - depth), 0)
        opened = opened or end["marks"] > 0
        inside, depth = end["inside"], depth + end["depth"]
    return out


def members(file: pa.NativeFile, r: Range) -> Iterator[tuple[int, bytes | None]]:
    """(number, text) of the members that begin in a range; (-1, None) where the file is found not to be one array."""
    escaped, inside, depth, number, opened = escaped_at(file, r.start), r.inside, r.depth, r.members, r.opened
    held: list[bytes] = []  # what is read so far of the member that is open, if it began in this range
    mine, at_block, first = False, r.start, True

    def stray(part: np.ndarray) -> bool:
        return not _SPACE[part].all()

    for data in blocks(file, r.start, r.end, r.size):
        at, delta, escaped, inside = structure(data, escaped, inside)
        depths = depth + np.cumsum(delta)
        before = np.append(depth, depths[:-1])
        cut = np.flatnonzero((delta == 0) & (depths == 1) | (delta == 1) & (before == 0) | (delta == -1) & (depths <= 0))
        done = 0
        for k in cut.tolist():
            place, here = int(at[k]), at_block + int(at[k]) < r.end
            if delta[k] == 1:  # the array's opening
                if stray(data[done:max(done, min(place, r.end - at_block))]) or here and (opened or data[place] != OPEN[0]):
                    yield -1, None
                if not here:
                    return
                opened, mine, held, done = True, True, [], place + 1
                continue
            if mine:
                text = b"".join([*held, data[done:place].tobytes()])
                closing = delta[k] == -1
                if not (closing and first and number == 0 and not text.strip(b" \t\r\n")):  # [] has no member
                    yield number, text
            elif here and depth == 0 and not opened:
                yield -1, None
            first, held, done = False, [], place + 1
            if delta[k] == 0:
                number += 1
                mine = here
                if not here:
                    return
            else:
                mine = False
                if here and (data[place] != CLOSE[0] or depths[k] < 0):
                    yield -1, None
        depth = int(depths[-1]) if len(depths) else depth
        rest = data[done:]
        if mine:
            held.append(rest.tobytes())
        elif depth <= 0:  # before the array or behind it
            if stray(rest[:max(0, r.end - at_block - done)]):
                yield -1, None
        at_block += len(data)
        if at_block >= r.end and not mine:
            break
    if at_block >= r.size and (mine or r.end == r.size and (depth != 0 or inside or not opened)):
        yield -1, None  # the file ends within the array, or before it


def _rows(path: str, held: list[tuple[int, bytes | None]]) -> pa.RecordBatch:
    values = [None if text is None else _decoded(text) for _, text in held]
    return pa.RecordBatch.from_arrays([pa.repeat(path, len(held)), pa.array([n for n, _ in held], pa.int64()), pa.array(values, pa.string())],
                                      names=["file", "position", "value"])


def _decoded(text: bytes) -> str | None:
    """Text that is no UTF-8 is no JSON either."""
    try:
        return text.decode()
    except UnicodeDecodeError:
        return None


_SUMMARY = pa.struct([("inside", pa.bool_()), ("depth", pa.int64()), ("marks", pa.int64()), ("commas", pa.map_(pa.int64(), pa.int64()))])
_BORDERS = pa.schema([("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("size", pa.int64()), ("outside", _SUMMARY), ("within", _SUMMARY)])
BORDERS = ("path string, start long, end long, size long, " + ", ".join(
    f"{c} struct<inside: boolean, depth: long, marks: long, commas: map<long, long>>" for c in ("outside", "within")))


def _numbers(file: pa.NativeFile, start: int, end: int, inside: bool) -> dict:
    told = summary(file, start, end, inside)
    return told | {"commas": [(int(d), n) for d, n in told["commas"].items()]}


def _borders(range_bytes: int):
    """Pieces of files to the borders of their ranges; a piece is opened once."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in batch.to_pylist():
                rows, size = [], piece["size"]
                with open_file(piece["path"]) as file:
                    for at in range(piece["start"], piece["end"], range_bytes):
                        end = min(at + range_bytes, size)
                        rows.append({"path": piece["path"], "start": at, "end": end, "size": size,
                                     "outside": _numbers(file, at, end, False), "within": _numbers(file, at, end, True)})
                yield pa.RecordBatch.from_pylist(rows, schema=_BORDERS)
    return read


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges with their true starts to the members that begin in them; ranges of one file that follow each other share one opening."""
    path, file = None, None
    try:
        for batch in batches:
            for row in batch.to_pylist():
                r = Range(**row)
                if r.path != path:
                    if file is not None:
                        file.close()
                    path, file = r.path, open_file(r.path)
                held, size = [], 0
                for number, text in members(file, r):
                    held.append((number, text))
                    size += len(text or b"")
                    if size > 4 * BLOCK or len(held) >= 4096:
                        yield _rows(r.path, held)
                        held, size = [], 0
                if held:
                    yield _rows(r.path, held)
    finally:
        if file is not None:
            file.close()


def true_starts(borders: DataFrame) -> DataFrame:
    """``resolved`` as running sums over each file's ranges: (path, start, end, size, inside, depth, members, opened)."""
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    told = borders.withColumn("inside", total(F.col("outside.inside").cast("int")) % 2 == 1)
    told = told.withColumn("told", F.when(F.col("inside"), F.col("within")).otherwise(F.col("outside"))).drop("outside", "within")
    told = told.withColumn("depth", total("told.depth"))
    found = F.coalesce(F.try_element_at("told.commas", 1 - F.col("depth")), F.lit(0))
    told = told.withColumn("found", found)
    return told.withColumns({"members": total("found"), "opened": total("told.marks") > 0}).select(
        "path", "start", "end", "size", "inside", "depth", "members", "opened")


def read_members(spark: SparkSession, paths: str | list[str], range_bytes: int = RANGE_BYTES, task_bytes: int | None = None) -> DataFrame:
    """(file, position, value): the text of every member of the array in each file.  Where a file is found not to be one array, it has a row
    without a value; which members are JSON is not looked at.

    Files are cut into pieces of about task_bytes, pieces are dealt to as many tasks as their bytes ask for, and a task reads on range
    by range (of at most range_bytes), some megabytes at a time.  Ranges and their numbers are rows of a stored table; all that comes to the
    driver is the number of bytes.
    """
    in_piece = range_bytes * max(1, (task_bytes or range_bytes) // range_bytes)
    files = spark.read.format("binaryFile").load(paths).filter("length > 0").select("path", F.col("length").alias("size"))
    tasks = -(-(files.agg(F.sum("size")).first()[0] or 1) // in_piece)
    pieces = files.withColumn("start", F.explode(F.expr(f"sequence(0L, size - 1, {in_piece}L)"))).withColumn("end", F.least(F.col("start") + in_piece, "size"))
    borders = pieces.repartitionByRange(tasks, "path", "start").mapInArrow(_borders(range_bytes), BORDERS)
    ranges = saved(true_starts(borders), work_path(spark, "array-ranges"))
    # Ranges that follow each other go to one task, in order.
    dealt = ranges.repartitionByRange(tasks, "path", "start").sortWithinPartitions("path", "start")
    return dealt.mapInArrow(_members, "file string, position long, value string")
