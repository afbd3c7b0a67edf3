"""Records of files that cannot be cut at line ends, read by many tasks.

A file is read as pieces between single-byte separators, in the byte ranges (blocks) that Spark deals out.
Whether a separator ends a record depends on what lies before it: on being inside quotes, and on a depth.
Every piece has its effect under both hypotheses: the quote state it ends in and the depth it adds, if it
begins outside or inside quotes. One pass composes the pieces of a block into the effect of the block; a
scan over the blocks of a file, one row each, gives the state at every block's start; another pass cuts the
blocks into records at known states. Records that cross blocks are put together from their parts.

A compressed file is one block. Separators inside a record are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomset.session import BROADCAST_BYTES, materialize

# A block's start is a path and some numbers.
START_BYTES = 400
WHOLE, BEGIN, MIDDLE, END = 0, 1, 2, 3
CUT = "file string, number bigint, place bigint, kind int, first boolean, last boolean, text string"
_EFFECT = ["end0", "end1", "add0", "add1"]


def pieces(spark: SparkSession, path: str, separator: str, effect: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(file, block, seq, size, value, end0, end1, add0, add1) of every piece.

    ``effect`` adds the quote states (0 or 1) that a piece ends in, separator included, and the depths it adds,
    for a start outside and inside quotes.
    """
    read = spark.read.option("lineSep", separator).text(path)
    placed = read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("_metadata.file_size").alias("size"),
        "value",
    )
    return effect(placed).select(*placed.columns, *[F.col(c).cast("int").alias(c) for c in _EFFECT])


def states_of(end0: np.ndarray, end1: np.ndarray, start: int) -> np.ndarray:
    """Quote state before every piece, and after the last."""
    fixed = end0 == end1
    flips = np.cumsum(~fixed & (end0 == 1))
    places = np.where(fixed, np.arange(len(end0)), -1)
    last = np.maximum.accumulate(places) if len(places) else places
    since = flips - np.where(last >= 0, flips[last], 0)
    base = np.where(last >= 0, end0[last], start)
    return np.concatenate([[start], (base + since) % 2]).astype(np.int64)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Consecutive rows of one block, batch by batch; the first two columns are its file and start."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        files, blocks = batch.column(0), batch.column(1).to_numpy()
        other = pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False) | (blocks[1:] != blocks[:-1])
        edges = [0, *(np.flatnonzero(other) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges[:-1], edges[1:]):
            yield (files[start].as_py(), int(blocks[start])), batch.slice(start, end - start)


def block_effects(table: DataFrame) -> DataFrame:
    """One row per block: its effect under both hypotheses, its bytes and pieces."""
    columns = ["file", "block", "size", "bytes", "pieces", *_EFFECT]

    def run(batches):
        at, row = None, None
        for here, part in _stretches(batches):
            if here != at:
                if at is not None:
                    yield pa.RecordBatch.from_pylist([dict(zip(columns, (*at, *row)))], schema)
                at, row = here, [part.column(2)[0].as_py(), 0, 0, 0, 1, 0, 0]
            end0, end1, add0, add1 = (part.column(i).to_numpy().astype(np.int64) for i in range(4, 8))
            row[1] += int(part.column(3).to_numpy().sum()) + part.num_rows
            row[2] += part.num_rows
            for side in (0, 1):
                states = states_of(end0, end1, row[3 + side])
                row[5 + side] += int(np.where(states[:-1] == 0, add0, add1).sum())
                row[3 + side] = int(states[-1])
        if at is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(columns, (*at, *row)))], schema)

    schema = pa.schema([("file", pa.string()), *[(c, pa.int64()) for c in columns[1:]]])
    slim = table.select("file", "block", "size", F.octet_length("value").cast("long").alias("bytes"), *_EFFECT)
    return slim.mapInArrow(run, "file string, " + ", ".join(f"{c} long" for c in columns[1:]))


def block_starts(effects: DataFrame) -> DataFrame:
    """State at the start of every block: (file, block, state, depth, number, last, closed).

    ``number`` counts blocks over all files by path; ``closed`` says that a file ends with a separator.
    """
    # One row per block: a file's blocks meet in one task, and thousands of small files need no Python call each.
    whole = Window.partitionBy("file")
    to_here = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    fixed, zero = F.col("end0") == F.col("end1"), F.lit(0).cast("long")
    flips = effects.withColumn("flip", F.when(~fixed, F.col("end0")).otherwise(zero)).withColumn("flips", F.sum("flip").over(to_here))
    base = flips.withColumn("base", F.when(fixed, F.col("end0") - F.col("flips")))
    turned = F.coalesce(F.last("base", ignorenulls=True).over(before), zero) + F.coalesce(F.sum("flip").over(before), zero)
    stated = base.withColumn("state", F.pmod(turned, F.lit(2)))
    added = F.when(F.col("state") == 0, F.col("add0")).otherwise(F.col("add1"))
    over = F.sum("bytes").over(whole) - F.col("size")  # 0 with a last separator, 1 without; 3 less after a byte order mark
    scanned = stated.select(
        "file", "block", "state", F.coalesce(F.sum(added).over(before), zero).alias("depth"),
        F.lead("block").over(whole.orderBy("block")).isNull().alias("last"), over.isin(0, -3).alias("closed"),
    )
    # One row per block of a file, however large the files are.
    return scanned.withColumn("number", F.row_number().over(Window.orderBy("file", "block")).cast("long") - 1)


def cut_blocks(table: DataFrame, separator: str, level: int) -> DataFrame:
    """``CUT``: the records of every block, and the parts of records that cross blocks."""
    starts = materialize(block_starts(block_effects(table)), "blocks")
    slim = table.select("file", "block", "seq", "value", *_EFFECT)
    if starts.count() * START_BYTES <= BROADCAST_BYTES:
        placed = slim.join(F.broadcast(starts), ["file", "block"])
    else:  # behind a shuffle, too, blocks stay whole and in order
        placed = slim.join(starts, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "seq")
    placed = placed.select("file", "block", "value", *_EFFECT, "state", "depth", "number", "last", "closed")
    names = [c.split()[0] for c in CUT.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string()]

    class Block:
        """Where a task is in a block: the state, the records so far, and pieces of the record that goes on."""

        def __init__(self, here: tuple[str, int], part: pa.RecordBatch):
            self.here, self.file, self.top, self.place, self.held = here, here[0], here[1] == 0, 0, []
            self.state, self.depth, self.number, self.last, self.closed = (part.column(i)[0].as_py() for i in range(7, 12))
            self.within = not self.top and (self.state, self.depth) != (0, level)  # a record of an earlier block goes on

        def row(self, whole: int, part: int, text: str, last: bool = False) -> tuple:
            kind = part if self.within else whole
            return self.file, self.number, self.place, kind, self.top and self.place == 0 and not self.within, last, text

        def cut(self, part: pa.RecordBatch) -> list[tuple]:
            texts = part.column(2).to_pylist()
            end0, end1, add0, add1 = (part.column(i).to_numpy().astype(np.int64) for i in range(3, 7))
            states = states_of(end0, end1, self.state)
            depths = self.depth + np.cumsum(np.where(states[:-1] == 0, add0, add1))
            out, done = [], 0
            for end in (np.flatnonzero((states[1:] == 0) & (depths == level)) + 1).tolist():
                out.append(self.row(WHOLE, END, separator.join([*self.held, *texts[done:end], ""])))
                self.place += not self.within
                self.held, self.within, done = [], False, end
            self.held += texts[done:]
            self.state, self.depth = int(states[-1]), int(depths[-1])
            return out

        def rest(self) -> list[tuple]:
            """The file's end, or the beginning of a record that goes on."""
            if self.last:
                text = separator.join([*self.held, ""] if self.closed and self.held else self.held)
                return [self.row(WHOLE, END, text, True)]
            return [self.row(BEGIN, MIDDLE, separator.join([*self.held, ""]))] if self.held else []

    def run(batches):
        block = None
        for here, part in _stretches(batches):
            out = []
            if block is None or block.here != here:
                out += block.rest() if block else []
                block = Block(here, part)
            out += block.cut(part)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
        if block and (out := block.rest()):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return placed.mapInArrow(run, CUT)


def records(table: DataFrame, separator: str, level: int) -> DataFrame:
    """(file, number, place, first, last, text): the records of every file, each with its separator.

    A record ends at a separator outside quotes at depth ``level``. What follows the last such separator of a
    file is a row of its own with ``last``, which may be empty; ``first`` marks the file's first row. Rows are
    in the order of (number, place) in the files.
    """
    cut = materialize(cut_blocks(table, separator, level), "records")  # read twice here, and as often as its users do
    whole = cut.where(F.col("kind") == WHOLE).select("file", "number", "place", "first", "last", "text")
    # Two parts per block at most. The end of one record comes before the beginning of the next.
    begins = F.col("kind") == BEGIN
    in_order = Window.partitionBy("file").orderBy("number", begins)
    parts = cut.where(F.col("kind") != WHOLE).withColumn("at", F.max(F.when(begins, F.struct("number", "place"))).over(in_order))
    crossing = parts.groupBy("file", "at").agg(
        F.max("first").alias("first"),
        F.max("last").alias("last"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "text"))), lambda p: p["text"]), "").alias("text"),
    )
    return whole.unionByName(crossing.select("file", "at.number", "at.place", "first", "last", "text"))


def file_order() -> Column:
    """A number that rises in the order of files and records; a block begins fewer than 2^32 records."""
    return F.shiftleft(F.col("number"), 32) + F.col("place")
