"""Delimited files with line breaks in quoted cells, cut into records by many tasks.

Spark's text reader splits a file into ranges at line ends. Whether a line ends a record depends on
all quotes before it, so three steps are taken, each in every range at once: what a range does to
either state it may begin in (outside or inside a quoted cell); the states that ranges begin in, from
the results of those before (a row a range); and the records. A record that goes on
in later ranges is put together from its parts, at most two for each range.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from longhouse.session import stage

class Quotes:
    """How quotes of one line change the state. A quote is doubled inside a quoted cell."""

    def __init__(self, delim: str, quote: str):
        d, q = (re.escape(mark.encode()) for mark in (delim, quote))
        other = rb"(?:(?!" + d + rb").)"
        self.quote = quote
        # text after a closing quote belongs to the cell, up to the delimiter
        rest = rb"(?:[^" + q + rb"]|" + q + q + rb")*+(?:(?P<open>\Z)|" + q + other + rb"*+)"
        self.cell = re.compile(q + rest + rb"|" + other + rb"*+", re.DOTALL)
        self.rest = re.compile(rest, re.DOTALL)
        self.width = len(delim.encode())

    def after(self, line: bytes, inside: bool) -> bool:
        """Whether the line ends inside a quoted cell."""
        at, cell = 0, self.rest if inside else self.cell
        while True:
            found = cell.match(line, at)
            if found["open"] is not None:
                return True
            at = found.end() + self.width
            if at > len(line):
                return False
            cell = self.cell


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the range they begin in, told by a hash of its file and its first byte."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"),
    )


def _by_range(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """The lines of a batch by range; those of a range follow each other."""
    if not batch.num_rows:
        return
    file, start = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
    for first, last in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield (int(file[first]), int(start[first])), batch.slice(first, last - first)


def _quoted(lines: pa.Array, quote: str) -> np.ndarray:
    return np.flatnonzero(pc.match_substring(lines.cast(pa.binary()), quote).to_numpy(zero_copy_only=False))


def _effects(lines: DataFrame, quotes: Quotes) -> DataFrame:
    """(file, start, out0, out1, ends1, crlf): the state behind a range that begins outside and inside,
    whether a record ends in it if it begins inside, and whether its first line ends with CR."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], list[bool]] = {}
        for batch in batches:
            for key, own in _by_range(batch):
                texts = own.column(2)
                if key not in seen:
                    seen[key] = [False, True, False, texts[0].as_py().endswith(b"\r")]
                state = seen[key]
                for k in _quoted(texts, quotes.quote):
                    line = texts[k].as_py()
                    same = state[0] == state[1]
                    state[0] = quotes.after(line, state[0])
                    state[1] = state[0] if same else quotes.after(line, state[1])
                    state[2] |= not state[1]
        columns = zip(*[(*key, *state) for key, state in seen.items()]) if seen else [[]] * 6
        types = [pa.int64(), pa.int64(), *[pa.bool_()] * 4]
        names = ["file", "start", "out0", "out1", "ends1", "crlf"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    texts = lines.withColumn("line", F.col("line").cast("binary"))
    return texts.mapInArrow(run, "file long, start long, out0 boolean, out1 boolean, ends1 boolean, crlf boolean")


def _states(effects: DataFrame) -> DataFrame:
    """(file, start, inside, opened, crlf): the state a range begins in, where the record open there began,
    and whether the file's lines end with CR and LF, as its first one tells.

    A range either fixes the state behind it or keeps or turns it, so the state is that of the last
    one that fixed it, turned as often as there were turns since.
    """
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fixes = F.col("out0") == F.col("out1")
    turned = F.coalesce(F.sum((~fixes & F.col("out0")).cast("int")).over(before), F.lit(0))
    rows = effects.withColumn("turns", turned)
    fixed = F.last(F.when(fixes, F.struct("out0", "turns")), ignorenulls=True).over(before)
    rows = rows.withColumn("fixed", fixed)
    since = F.col("turns") - F.coalesce(F.col("fixed.turns"), F.lit(0))
    inside = F.coalesce(F.col("fixed.out0"), F.lit(False)) != (since % 2 == 1)
    rows = rows.withColumn("inside", inside)
    opens = F.when(F.col("inside"), F.col("out1") & F.col("ends1")).otherwise(F.col("out0"))
    opened = F.last(F.when(opens, F.col("start")), ignorenulls=True).over(before)
    crlf = F.first("crlf").over(Window.partitionBy("file").orderBy("start"))
    return rows.select("file", "start", "inside", F.when(F.col("inside"), opened).alias("opened"), crlf.alias("crlf"))


class _Cutter:
    """The records of one range, fed with its lines in order."""

    def __init__(self, start: int, inside: bool, quotes: Quotes):
        self.start, self.inside, self.quotes = start, inside, quotes
        self.header = start == 0  # the first record of a file
        self.part: list[bytes] = []  # lines of the record that is open
        self.head: bytes | None = None  # the end of a record that an earlier range opened
        self.whole_head = inside

    def feed(self, lines: pa.Array) -> pa.Array:
        """Records that begin and end in the range, in order, but for the header."""
        quoted = _quoted(lines, self.quotes.quote)
        if not len(quoted) and not self.inside and not self.header and not self.part:
            return lines
        ends = np.empty(len(lines), bool)
        at, inside = 0, self.inside
        for k in quoted:
            ends[at:k] = not inside
            inside = self.quotes.after(lines[k].as_py(), inside)
            ends[k], at = not inside, k + 1
        ends[at:] = not inside
        self.inside = inside
        records, first = [], 0
        texts = lines.to_pylist()
        for last in np.flatnonzero(ends):
            record = texts[first] if first == last and not self.part else b"\n".join([*self.part, *texts[first : last + 1]])
            self.part, first = [], last + 1
            if self.whole_head:
                self.head, self.whole_head = record, False
            elif self.header:
                self.header = False
            else:
                records.append(record)
        self.part += texts[first:]
        return pa.array(records, pa.binary())

    def parts(self) -> list[tuple[bytes, bool, bool]]:
        """Pieces of records of several ranges: text, whether it opens the record, whether it is the header's."""
        found = []
        if self.head is not None:
            found.append((self.head, False, False))
        if self.part:
            found.append((b"\n".join(self.part), not self.whole_head, self.header and not self.whole_head))
        return found


def _cut(lines: DataFrame, states: DataFrame, quotes: Quotes, parts: bool) -> DataFrame:
    """Whole records, or the parts of those that lie in several ranges."""
    # a row for each range of the files
    known = lines.join(F.broadcast(states), ["file", "start"])
    line = F.when(F.col("crlf"), F.regexp_replace("line", r"\r\z", "")).otherwise(F.col("line"))
    known = known.withColumn("line", line.cast("binary"))
    names = ["file", "start", "line", "inside", "opened"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = cutter = opened = None
        for batch in batches:
            for now, own in _by_range(batch):
                if now != key:
                    if parts and cutter:
                        yield pieces(key, opened, cutter)
                    key, opened = now, own.column(4)[0].as_py()
                    cutter = _Cutter(now[1], own.column(3)[0].as_py(), quotes)
                records = cutter.feed(own.column(2).cast(pa.binary()))
                if not parts:
                    yield pa.RecordBatch.from_arrays([records], ["value"])
        if parts and cutter:
            yield pieces(key, opened, cutter)

    def pieces(key, opened, cutter: _Cutter) -> pa.RecordBatch:
        found = cutter.parts()
        columns = [
            pa.array([key[0]] * len(found), pa.int64()),
            pa.array([key[1] if opens else opened for _, opens, _ in found], pa.int64()),
            pa.array([key[1]] * len(found), pa.int64()),
            pa.array([header for _, _, header in found], pa.bool_()),
            pa.array([text for text, _, _ in found], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["file", "opened", "start", "header", "value"])

    rows = known.select(*names)
    if not parts:
        return rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    return rows.mapInArrow(run, "file long, opened long, start long, header boolean, value binary")


def range_states(spark: SparkSession, path: str, delim: str, quote: str) -> DataFrame:
    """What ``records`` must know of each range; staged, a row a range."""
    effects = _effects(_lines(spark, path), Quotes(delim, quote))
    return stage(_states(effects), "csv-ranges")


def records(spark: SparkSession, path: str, delim: str, quote: str, states: DataFrame) -> DataFrame:
    """The records of delimited files without their headers, as text in ``value``.

    A record ends at a line end outside quoted cells: LF, or CRLF where the file's first line ends so; then breaks
    inside cells become LF. Empty records are left out. A file is read by as many tasks as it has
    splits. Records that lie in one range keep their order.
    """
    quotes = Quotes(delim, quote)
    lines = _lines(spark, path)
    whole = _cut(lines, states, quotes, parts=False)
    pieces = F.array_sort(F.collect_list(F.struct("start", F.col("value").cast("string").alias("value"))))
    joined = (
        _cut(lines, states, quotes, parts=True)
        .groupBy("file", "opened")
        .agg(F.bool_or("header").alias("header"), pieces.alias("pieces"))
        .where("NOT header")
        .select(F.array_join(F.transform("pieces", lambda p: p["value"]), "\n").alias("value"))
    )
    return whole.unionByName(joined).where("value != ''")
