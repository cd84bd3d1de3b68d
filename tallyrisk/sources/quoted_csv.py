"""CSV records of files that are read in ranges, line breaks inside quotes included.

Spark gives a file with quoted line breaks to one task.  Here the lines of a
file are read in ranges, like any text, and a range learns where its first
record begins from the ranges before it:

1. *Ends.*  Every range is read under both assumptions, that it begins with a
   record or inside a quoted value, and tells in which of the two it would end.
   Only lines that hold a quote are looked at.
2. *Begins.*  The ranges' ends are chained by file: a range that ends the same
   way under both assumptions settles it, the others pass it on or turn it
   round.  This gives the true state at the begin of every range: some bytes a
   range of input.
3. *Records.*  Every range joins its lines to records from its true state.  A
   record that goes over the end of a range is put out in fragments, which
   meet by file and place; there is at most one a range.

The records are those of the reader with ``multiLine`` (lines end in ``\\n`` or
``\\r\\n``).  Results do not depend on where the ranges are cut.
"""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyrisk.session import ship_package

# Values up to the next comma: in quotes (a doubled quote stands for one; what follows the end quote belongs to the value),
# or not (a quote after the first character is a character like any other).  Every text has one reading at most.
_QUOTED = r'"(?:[^"]|"")*"(?:[^",][^,]*)?'
_PLAIN = r'(?:[^",][^,]*)?'
_OPEN = r'"(?:[^"]|"")*'
#: A line that ends inside quotes, if it begins with a value (of a record), or inside quotes.
ENDS_OPEN = rf"^(?:(?:{_QUOTED}|{_PLAIN}),)*{_OPEN}$"
STAYS_OPEN = rf'^(?:[^"]|"")*(?:"(?:[^",][^,]*)?,(?:(?:{_QUOTED}|{_PLAIN}),)*{_OPEN})?$'

#: Row kinds of the last pass: a record, and the fragments of one that a range's end cuts.
RECORD, TAIL, MORE, HEAD = 0, 1, 2, 3


def line_ends(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line with a quote ends inside a quoted value: if it begins with a record, if inside quotes."""
    read = lines.cast(pa.binary())  # quotes and commas are single bytes
    return tuple(pc.match_substring_regex(read, p).to_numpy(zero_copy_only=False) for p in (ENDS_OPEN, STAYS_OPEN))


def ends_open(line: str, begins_open: bool) -> bool:
    return bool(line_ends(pa.array([line]))[begins_open][0])


def states_after(plain: np.ndarray, inside: np.ndarray, begins_open: bool) -> np.ndarray:
    """The state after each of some lines, by their ends: a line settles it, turns it round or leaves it."""
    turns = np.cumsum(plain & ~inside)
    settled = np.maximum.accumulate(np.where(plain == inside, np.arange(len(plain)), -1))
    base = np.where(settled < 0, begins_open, plain[settled])
    return base ^ ((turns - np.where(settled < 0, 0, turns[settled])) % 2 == 1)


def _runs(b: pa.RecordBatch) -> Iterator[tuple[int, int, int, int]]:
    """(file, place, from, to) of the ranges whose lines the batch holds."""
    file, place = (b.column(c).to_numpy(zero_copy_only=False) for c in ("file", "place"))
    if len(file):
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (place[1:] != place[:-1])) + 1
        for start, end in itertools.pairwise([0, *cuts.tolist(), len(file)]):
            yield int(file[start]), int(place[start]), start, end


def text_lines(spark: SparkSession, path) -> DataFrame:
    """(line, quoted, file, name, place): the lines of each range in order; ``place`` is the range's first byte."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("value").alias("line"), F.col("value").contains('"').alias("quoted"),
                        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"),
                        F.col("_metadata.file_block_start").alias("place"))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, place, end from a record's begin, end from inside quotes) of the task's ranges."""
    found: dict[tuple[int, int], tuple[bool, bool]] = {}
    for b in batches:
        plain, inside = line_ends(b.column("line"))
        for file, place, start, end in _runs(b):
            found[file, place] = tuple(bool(states_after(plain[start:end], inside[start:end], begins)[-1])
                                       for begins in found.get((file, place), (False, True)))
    rows = [(*key, *ends) for key, ends in found.items()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.bool_(), pa.bool_()))],
        ["file", "place", "plain", "inside"])


def open_ranges(lines: DataFrame) -> dict[int, tuple[list[int], list[bool]]]:
    """By file: the places of ranges, in order, whose end changes the state, and the state after each.

    A file that is nowhere cut inside quotes has no entry.
    """
    ends = lines.filter("quoted").select("file", "place", "line").mapInArrow(
        _ends, "file long, place long, plain boolean, inside boolean")
    so_far = Window.partitionBy("file").orderBy("place")
    turns = F.sum(F.col("plain").cast("int") * (~F.col("inside")).cast("int")).over(so_far)
    settles = F.when(F.col("plain") == F.col("inside"), F.struct("plain", "turns"))
    chained = ends.withColumn("turns", turns).withColumn("settled", F.last(settles, ignorenulls=True).over(so_far))
    state = F.when(F.col("settled").isNull(), F.col("turns") % 2 == 1).otherwise(
        F.col("settled.plain") != ((F.col("turns") - F.col("settled.turns")) % 2 == 1))
    states = chained.select("file", "place", state.alias("open"))
    before = Window.partitionBy("file").orderBy("place")
    changes = states.withColumn("before", F.lag("open", 1, False).over(before)).filter("open <> before")
    out: dict[int, tuple[list[int], list[bool]]] = {}
    for r in changes.orderBy("file", "place").collect():
        places, opens = out.setdefault(r["file"], ([], []))
        places.append(r["place"])
        opens.append(r["open"])
    return out


class _Range:
    """The lines of one range, coming in batches, made into records and fragments."""

    def __init__(self, file: int, place: int, begins_open: bool):
        self.file, self.place, self.open = file, place, begins_open
        self.cut = begins_open          # the open lines belong to a record of an earlier range
        self.first = place == 0         # the next record is the file's header
        self.held: list[str] = []

    def add(self, lines: pa.Array, plain: np.ndarray, inside: np.ndarray, records: bool = True) -> tuple[pa.Array | None, str | None]:
        """The whole records (if wanted), and the fragment that ends a record of an earlier range."""
        states = states_after(plain, inside, self.open)
        self.open = bool(states[-1])
        ends = np.flatnonzero(~states) + 1
        if not len(ends):
            self.held += lines.to_pylist()
            return None, None
        begun = self.held + lines.slice(0, int(ends[0])).to_pylist()
        self.held = lines.slice(int(ends[-1])).to_pylist()
        cut, header = self.cut, self.first
        self.cut = self.first = False
        head = "\n".join(begun) if cut else None
        if not records:
            return None, head
        whole = [] if cut or header else [pa.array(["\n".join(begun)], pa.string())]
        if len(ends) == int(ends[-1] - ends[0]) + 1:
            whole.append(lines.slice(int(ends[0]), len(ends) - 1))
        else:
            whole.append(pc.binary_join(pa.ListArray.from_arrays(
                pa.array(ends - ends[0], pa.int32()), lines.slice(int(ends[0]), int(ends[-1] - ends[0]))), "\n"))
        return pa.concat_arrays(whole), head

    def end(self) -> list[tuple[int, str]]:
        """What the range leaves open."""
        if not self.open:
            return []
        return [(MORE if self.cut else TAIL, "\n".join(self.held))]


def _records(batches: Iterator[pa.RecordBatch], begins: dict[int, tuple[list[int], list[bool]]], fragments: bool) -> Iterator[pa.RecordBatch]:
    """Whole records (kind 0), or the fragments of cut ones; a fragment of a file's header is marked by a negative kind."""
    now: _Range | None = None
    name = ""

    def put(kinds: list[int] | np.ndarray, texts: pa.Array) -> pa.RecordBatch:
        n = len(texts)
        return pa.RecordBatch.from_arrays(
            [texts, pa.repeat(pa.scalar(name, pa.string()), n), pa.repeat(pa.scalar(now.file, pa.int64()), n),
             pa.repeat(pa.scalar(now.place, pa.int64()), n), pa.array(kinds, pa.int32())], ["record", "name", "file", "place", "kind"])

    def pieces(found: list[tuple[int, str]]) -> Iterator[pa.RecordBatch]:
        if fragments and found:
            yield put([-k if now.first and k == TAIL else k for k, _ in found], pa.array([t for _, t in found], pa.string()))

    for b in batches:
        lines = b.column("line").cast(pa.string())
        # A line without a quote leaves the state as it is.
        quoted = b.column("quoted").to_numpy(zero_copy_only=False)
        plain, inside = np.zeros(len(lines), bool), np.ones(len(lines), bool)
        plain[quoted], inside[quoted] = line_ends(lines.filter(b.column("quoted")))
        for file, place, start, end in _runs(b):
            if now is None or (now.file, now.place) != (file, place):
                if now is not None:
                    yield from pieces(now.end())
                places, opens = begins.get(file, ([], []))
                before = bisect.bisect_left(places, place)
                now, name = _Range(file, place, before > 0 and opens[before - 1]), b.column("name")[start].as_py()
            whole, head = now.add(lines.slice(start, end - start), plain[start:end], inside[start:end], not fragments)
            if whole is not None and len(whole):
                yield put(np.full(len(whole), RECORD), whole)
            yield from pieces([] if head is None else [(HEAD, head)])
    if now is not None:
        yield from pieces(now.end())


_SCHEMA = "record string, name string, file long, place long, kind int"


def csv_records(spark: SparkSession, path) -> DataFrame:
    """(record, source_file) of headered CSV files: every record but each file's first, as text, empty lines left out.

    Plans a small job at once (the ranges' ends).  Files are read a second time
    for the records, and a third time only where a range's end cuts one.
    """
    ship_package(spark)
    lines = text_lines(spark, path)
    begins = open_ranges(lines)
    whole = lines.mapInArrow(lambda b: _records(b, begins, False), _SCHEMA).select("record", "name")
    if begins:
        # A cut record is its tail and what follows up to the next tail of the file: some rows a cut.
        cut = lines.mapInArrow(lambda b: _records(b, begins, True), _SCHEMA)
        begun = F.sum((F.abs("kind") == TAIL).cast("int")).over(Window.partitionBy("file").orderBy("place", F.desc("kind")))
        joined = cut.withColumn("begun", begun).groupBy("file", "begun").agg(
            F.min("kind").alias("least"), F.any_value("name").alias("name"),
            F.array_sort(F.collect_list(F.struct("place", (-F.col("kind")).alias("order"), "record"))).alias("parts"))
        record = F.concat_ws("\n", F.transform("parts", lambda p: p["record"]))
        whole = whole.unionByName(joined.filter(F.col("least") > 0).select(record.alias("record"), "name"))
    # A line's end may be \r\n; inside quotes it stays as it is.
    return whole.select(F.regexp_replace("record", "\r$", "").alias("record"), F.col("name").alias("source_file")).filter(
        F.col("record") != "")
