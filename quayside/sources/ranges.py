"""Text files whose records may hold line feeds in quotes, read by many tasks.

A file is cut into byte ranges at line starts. Whether such a place is inside
quotes depends on all that stands before it, so the first pass says of each
range in which state it ends for every state it could begin in; the ranges'
answers, put one after the other, give each its true beginning. The second pass
lets each range hand on the records that begin in it, the last one to its end,
however far that lies beyond the range. Both passes are spread over the ranges;
in between stands one small row per range.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quayside.operators.spread import shuffle_partitions
from quayside.session import sent_with_jobs
from quayside.sources.files import open_seekable

sent_with_jobs(__name__)

RANGE = 64 << 20  # bytes
CHUNK = 4 << 20


def line_start(file, at: int, size: int) -> int:
    """The first place from `at` on where a line begins; the file's end if none does."""
    if at <= 0:
        return 0
    file.seek(at - 1)
    at -= 1
    while at < size:
        chunk = file.read(1 << 16)
        found = chunk.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(chunk)
    return size


# CSV: a record ends with a line outside of quotes. States: 0 outside, 1 inside.

def record_ends(data: bytes, inside: int) -> tuple:
    """Places behind the records' line feeds, and the state at the end."""
    import numpy as np

    raw = np.frombuffer(data, np.uint8)
    quotes, feeds = np.flatnonzero(raw == 34), np.flatnonzero(raw == 10)
    before = np.searchsorted(quotes, feeds) + inside
    return feeds[before % 2 == 0] + 1, (len(quotes) + inside) % 2


def _csv_states(file, start: int, end: int) -> list[int]:
    odd = 0
    file.seek(start)
    while start < end:
        chunk = file.read(min(CHUNK, end - start))
        odd ^= chunk.count(b'"') & 1
        start += len(chunk)
    return [odd, 1 - odd]


def _csv_records(file, start: int, end: int, size: int, state: int) -> Iterator[tuple[bytes, list[int]]]:
    """(bytes, where each record in them ends) of the records that begin in [start, end)."""
    file.seek(start)
    at, inside, held, ours = start, state, [], state == 0
    while at < size:
        chunk = file.read(CHUNK)
        ends, inside = record_ends(chunk, inside)
        last = int(ends.searchsorted(end - at))  # the first record end from the range's end on is the last one of ours
        done = last < len(ends)
        ends = ends[:last + 1]
        if not ours and len(ends):  # the record that began in an earlier range
            if at + int(ends[0]) >= end:
                return
            held, chunk, at, ends, ours = [], chunk[int(ends[0]):], at + int(ends[0]), ends[1:] - ends[0], True
        if ours and len(ends):
            data = b"".join([*held, chunk[:int(ends[-1])]])
            yield data, (ends + sum(map(len, held))).tolist()
            held = []
        at += len(chunk)
        if done:
            return
        if ours:
            held.append(chunk[int(ends[-1]):] if len(ends) else chunk)
    rest = b"".join(held)
    if rest:
        yield rest, [len(rest)]


# SQL: a statement ends with a semicolon at the end of a line, outside of quotes. States: 0 before a statement, 1 in one,
# 2 in one and inside quotes.

_OUTSIDE = re.compile(rb"'|;[ \t]*\r?\n|`[^`\n]*`|(?:(?<=\n)|\A)--[^\n]*")
_INSIDE = re.compile(rb"[^'\\]*+(?:\\.[^'\\]*+)*+'", re.S)
_NOTHING = re.compile(rb"(?:\s++|--[^\n]*+\n?)*+")


def statement_end(data: bytes, at: int, inside: bool) -> tuple[int, int, bool]:
    """(where the running statement ends, or -1; from where to look on; whether that is inside quotes)."""
    while True:
        found = (_INSIDE.match if inside else _OUTSIDE.search)(data, at)
        if not found:
            return -1, at if inside else len(data), inside
        if not inside and data[found.start()] == 59:  # a semicolon
            return found.end(), found.end(), False
        if inside or found[0] == b"'":
            inside = not inside
        at = found.end()


def _sql_states(file, start: int, end: int) -> list[int]:
    file.seek(start)
    data = file.read(end - start)

    def after(inside: bool, begun: bool) -> int:
        at = last = 0
        found = 0
        while found >= 0:
            found, at, inside = statement_end(data, at, inside)
            if found >= 0:
                last, begun = found, False
        if inside:
            return 2
        return 1 if begun or _NOTHING.match(data, last).end() < len(data) else 0

    outside = after(False, False)
    return [outside, after(False, True), after(True, True)]


def _sql_statements(file, start: int, end: int, size: int, state: int) -> Iterator[tuple[bytes, list[int]]]:
    """(bytes of a statement, [their number]) of the statements that begin in [start, end)."""
    file.seek(start)
    data, upto = file.read(end - start), end
    begin, at, inside, ours, more = 0, 0, state == 2, state == 0, CHUNK
    while True:
        if ours and not inside:
            begin = max(begin, _NOTHING.match(data, begin).end() if at <= begin else begin)
            if start + begin >= end:
                return
            at = max(at, begin)
        found, at, inside = statement_end(data, at, inside)
        if found >= 0:
            if ours:
                yield data[begin:found], [found - begin]
            begin, ours = found, True
            if start + found >= end:
                return
        elif upto < size:  # the statement goes on: read on, in larger and larger steps, to a line's end
            last, upto = upto, line_start(file, upto + more, size)
            file.seek(last)
            data += file.read(upto - last)
            more *= 2
        else:
            if ours and data[begin:].strip():
                yield data[begin:], [len(data) - begin]
            return


_KINDS: dict[str, tuple[Callable, Callable]] = {"csv": (_csv_states, _csv_records), "sql": (_sql_states, _sql_statements)}


def states_after(states: Column) -> Column:
    """An array of (path, low, high, size, states), in order -> (path, low, high, size, state): the state each range begins in."""
    row = lambda r, state: F.struct(r["path"].alias("path"), r["low"].alias("low"), r["high"].alias("high"),
                                    r["size"].alias("size"), state.alias("state"))
    none = F.array().cast("array<struct<path:string,low:bigint,high:bigint,size:bigint,state:int>>")
    return F.aggregate(states, F.struct(F.lit(0).alias("state"), none.alias("done")), lambda seen, r: F.struct(
        F.get(r["states"], seen["state"]).alias("state"), F.concat(seen["done"], F.array(row(r, seen["state"]))).alias("done")),
        lambda seen: seen["done"])


def records(spark: SparkSession, path: str, kind: str, range_bytes: int = RANGE, head: bool = False) -> DataFrame:
    """record: the text of each record ("csv") or statement ("sql") of the files at `path`, its line feed or semicolon included.

    With `head`, a file's first record is left out. Bytes that are no UTF-8 become the replacement character.
    """
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size")).filter("size > 0")
    ways = shuffle_partitions(files)
    starts = files.withColumn("start", F.explode(F.sequence(F.lit(0), F.col("size") - 1, F.lit(range_bytes).cast("bigint"))))
    find, hand_on = _KINDS[kind]

    def surveyed(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                with open_seekable(path) as file:
                    low, high = line_start(file, start, size), line_start(file, min(size, start + range_bytes), size)
                    if low < high:
                        rows.append((path, low, high, size, find(file, low, high)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "low", "high", "size", "states"])

    def read(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for path, low, high, size, state in zip(*(c.to_pylist() for c in batch.columns)):
                with open_seekable(path) as file:
                    for data, ends in hand_on(file, low, high, size, state):
                        yield pa.RecordBatch.from_arrays([texts(data, ends)[int(head and not low):]], names=["record"])
                        low = low or 1  # the head, if any, is behind

    found = starts.repartition(ways, "path", "start").mapInArrow(surveyed, "path string, low long, high long, size long, states array<int>")
    ordered = found.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("path", "low", "high", "size", "states"))).alias("ranges"))
    known = ordered.select(F.explode(states_after(F.col("ranges"))).alias("r")).select("r.*")
    return known.repartition(ways, "path", "low").mapInArrow(read, "record string")


def texts(data: bytes, ends: list[int], on_bad_utf8: str = "replace"):
    """An Arrow array of the pieces of `data` that end at `ends`; no byte is looked at twice unless some are no UTF-8."""
    import pyarrow as pa

    try:
        data.decode()
    except UnicodeDecodeError:
        if on_bad_utf8 == "fail":
            raise
        return pa.array([data[a:b].decode(errors=on_bad_utf8) for a, b in zip([0, *ends], ends)], pa.string())
    offsets = pa.array([0, *ends], pa.int32())
    return pa.StringArray.from_buffers(len(ends), offsets.buffers()[1], pa.py_buffer(data))
