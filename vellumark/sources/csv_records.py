"""Records of large CSV files whose quoted cells hold line breaks, read by many tasks.

Spark splits text files at line breaks wherever they stand. Whether a line
begins inside quotes depends on all lines before it, so every line is taken as a
map of the two states "between records" and "inside quotes": it keeps them,
swaps them, or sets one. Maps compose, so each block of a file gives one map, a
prefix over a file's blocks gives the state in which each block begins, and the
blocks are then cut into records side by side. Only records that reach over a
block's end are put together from their parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellumark.operators.skew import fits_broadcast
from vellumark.session import stored

# A cell: quoted with doubled quotes inside, or not beginning with a quote. After a
# closing quote, what follows up to the comma belongs to the cell.
_QUOTED_REST = '[^"]*+(?:""[^"]*+)*+"(?:[^",][^,]*+)?+'
_CELL = f'(?:"{_QUOTED_REST}|(?:[^",][^,]*+)?+)'
_ENDS_OUTSIDE = rf"^{_CELL}(?:,{_CELL})*+\z"  # of a line that begins a record
_ENDS_QUOTED = rf"^{_QUOTED_REST}(?:,{_CELL})*+\z"  # of a line that begins inside quotes

KEEP, SWAP, OUTSIDE, INSIDE = 0, 1, 2, 3  # what a line does to the state
_WHOLE, _HEAD, _TAIL, _MIDDLE = 0, 1, 2, 3  # parts of records in a block

BLOCKS = "key bigint, block bigint, does tinyint"
PARTS = "_file string, _block bigint, _line bigint, part tinyint, record string"


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """_file, _block, _line (ascending in a block), line, does."""
    read = spark.read.option("lineSep", "\n").text(path)
    line = F.col("value")
    outside, quoted = line.rlike(_ENDS_OUTSIDE), line.rlike(_ENDS_QUOTED)
    does = (
        F.when(~F.contains(line, F.lit('"')), KEEP)
        .when(outside & quoted, OUTSIDE)
        .when(outside, KEEP)
        .when(quoted, SWAP)
        .otherwise(INSIDE)
    )
    return read.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
        line.alias("line"),
        does.cast("tinyint").alias("does"),
    )


def _resolved(does: np.ndarray, start: int) -> np.ndarray:
    """State (1 inside quotes) before each line and after the last, from the state before the first."""
    sets = np.concatenate([[True], does >= OUTSIDE])
    value = np.concatenate([[start], does == INSIDE]).astype(np.int64)
    swaps = np.concatenate([[0], np.cumsum(does == SWAP)])
    last = np.maximum.accumulate(np.where(sets, np.arange(len(sets)), 0))
    return (value[last] + swaps - swaps[last]) % 2


def _pieces(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple[int, int]]:
    """Row ranges in which the columns do not change."""
    new = np.zeros(batch.num_rows, bool)
    for c in columns:
        values = batch.column(c).to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    bounds = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
    return zip(bounds[:-1], bounds[1:]) if batch.num_rows else iter(())


def _block_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block does to the state."""
    now, ends, done = None, None, []
    for batch in batches:
        key, block, does = (batch.column(c).to_numpy() for c in ("key", "block", "does"))
        for at, end in _pieces(batch, "key", "block"):
            if now != (key[at], block[at]):
                if now is not None:
                    done.append((*now, ends))
                now, ends = (key[at], block[at]), (0, 1)
            ends = tuple(int(_resolved(does[at:end], e)[-1]) for e in ends)
    if now is not None:
        done.append((*now, ends))
    kinds = {(0, 1): KEEP, (1, 0): SWAP, (0, 0): OUTSIDE, (1, 1): INSIDE}
    columns = zip(*[(k, b, kinds[e]) for k, b, e in done]) if done else [()] * 3
    types = [pa.int64(), pa.int64(), pa.int8()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["key", "block", "does"])


def breaks(read: DataFrame) -> tuple[bool, bool]:
    """Does any line leave quotes open? Does any hold a lone carriage return, which may end a line by itself?"""
    lone = F.instr(F.rtrim(F.col("line"), F.lit("\r")), "\r") > 0
    opened, alone = read.agg(F.max(F.col("does") % 2 == 1), F.max(lone)).first()
    return bool(opened), bool(alone)


def block_maps(read: DataFrame) -> DataFrame:
    """key (hash of the file), block, does: a row per block."""
    few = read.select(F.xxhash64("_file").alias("key"), F.col("_block").alias("block"), "does")
    return few.mapInArrow(_block_maps, BLOCKS)


def block_starts(blocks: DataFrame) -> DataFrame:
    """key, block, inside: does the block begin inside quotes? A prefix over the blocks of each file."""
    order = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.coalesce(F.sum((F.col("does") == SWAP).cast("int")).over(order), F.lit(0))
    counted = blocks.withColumn("swaps", swaps)
    # a block that sets the state, with the swaps before it: those after it are what remains
    fixed = F.when(F.col("does") >= OUTSIDE, F.struct((F.col("does") == INSIDE).cast("int").alias("state"), "swaps"))
    last = F.last(fixed, ignorenulls=True).over(order)
    state = F.coalesce(last["state"], F.lit(0)) + F.col("swaps") - F.coalesce(last["swaps"], F.lit(0))
    return counted.select("key", "block", (state % 2 == 1).alias("inside"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of blocks, in order, to records and parts of records."""
    now, state, number, held, file = None, 0, 0, [], None

    def part(kind: int) -> pa.RecordBatch:
        nonlocal number, held
        made = ([file], [now[1]], [number], [kind], ["\n".join(held)])
        number, held = number + 1, []
        return batch_of(*made)

    def batch_of(files, blocks, numbers, kinds, records) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int64(), pa.int8(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) if not isinstance(v, pa.Array) else v for v, t in zip((files, blocks, numbers, kinds, records), types)], names=["_file", "_block", "_line", "part", "record"])

    opened = False  # does the held part begin a record?
    for batch in batches:
        key, block = (batch.column(c).to_numpy() for c in ("key", "_block"))
        text, does = batch.column("line"), batch.column("does").to_numpy()
        inside = batch.column("inside").to_numpy(zero_copy_only=False)
        for at, end in _pieces(batch, "key", "_block"):
            if now != (key[at], block[at]):
                if held:
                    yield part(_TAIL if opened else _MIDDLE)
                now, state, number, file = (key[at], block[at]), int(inside[at]), 0, batch.column("_file")[at].as_py()
                opened = not state
            states = _resolved(does[at:end], state)
            begins = np.flatnonzero(states[:-1] == 0)
            state = int(states[-1])
            own = text.slice(at, end - at)
            if not len(begins):
                held += own.to_pylist()
                continue
            if held or begins[0]:
                held += own.slice(0, begins[0]).to_pylist()
                yield part(_WHOLE if opened else _HEAD)
            last = len(own) if not state else int(begins[-1])  # the last record may go on
            whole = begins[begins < last]
            if len(whole):
                bounds = np.append(whole, last).astype(np.int32)
                records = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), own), "\n")
                records = records if records.null_count == 0 else records.fill_null("")
                n = len(whole)
                yield batch_of([file] * n, np.full(n, now[1]), np.arange(number, number + n), np.zeros(n, np.int8), records)
                number += n
            opened = True
            held = own.slice(last).to_pylist()
    if held:
        yield part(_TAIL if opened else _MIDDLE)


def _glued(parts: DataFrame) -> DataFrame:
    """Records that reach over the ends of blocks. A group is the parts of one record."""
    order = Window.partitionBy("_file").orderBy("_block", "_line")
    numbered = parts.withColumn("of", F.sum((F.col("part") == _TAIL).cast("int")).over(order))
    pieces = F.sort_array(F.collect_list(F.struct("_block", "_line", "record")))
    return numbered.groupBy("_file", "of").agg(pieces.alias("p")).select(
        "_file", F.col("p")[0]["_block"].alias("_block"), F.col("p")[0]["_line"].alias("_line"),
        F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"),
    )


def whole_records(read: DataFrame) -> DataFrame:
    """_file, _block, _line, record: the records of `lines`, headers and empty lines left out.

    A record has the block in which it begins and its number there. The cut
    records are stored, so that what follows does not cut them again.
    """
    starts = stored(block_starts(block_maps(read)), "csv-starts").withColumnRenamed("block", "_block")
    rows = read.withColumn("key", F.xxhash64("_file"))
    if fits_broadcast(starts):
        rows = rows.join(F.broadcast(starts), ["key", "_block"])  # keeps the order of the lines
    else:  # a row per block: beyond the limit, lines meet them by block, the size of which the session sets
        rows = rows.join(starts.hint("shuffle_merge"), ["key", "_block"]).sortWithinPartitions("key", "_block", "_line")
    rows = rows.select("key", "_file", "_block", "line", "does", "inside")
    cut = stored(rows.mapInArrow(_cut, PARTS), "csv-records")
    whole = cut.where(F.col("part") == _WHOLE).drop("part").unionByName(_glued(cut.where(F.col("part") != _WHOLE)))
    text = F.regexp_replace("record", r"\r\z", "")
    first = (F.col("_block") == 0) & (F.col("_line") == 0)
    return whole.where(~first).withColumn("record", text).where("record <> ''")


def cells(record: Column, columns: int) -> Column:
    """Cells of a record, c0, c1, ..., null where it has none."""
    schema = ", ".join(f"c{i} string" for i in range(columns))
    return F.from_csv(record, schema, {"escape": '"'})
