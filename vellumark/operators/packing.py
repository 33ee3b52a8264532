"""Exact greedy packing of ordered rows into size- and count-bounded packages.

A package takes rows in order and closes before the row that would make it too
large or too long. Where the next package starts depends only on where this one
started, so a block of rows is a function from "offset of the first package
start in this block" to "offset of the first package start in the next block"
(and a number of starts). Blocks are solved in parallel for every possible
entry offset; the functions are composed level by level, also on Spark.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumark.operators.row_numbers import number_rows
from vellumark.session import stored

RECORDS_PER_PACKAGE = 20
PACKAGE_KB = 102_400
RECORD_OVERHEAD = 2048  # bytes of XML assumed per record
BLOCK_ROWS = 100_000
FAN_IN = 1000  # blocks composed by one task per level
COMPOSED_ENTRIES = 4_000_000  # entry offsets such a task holds


def record_size(attachment_bytes):
    """Size a record is packed with."""
    return F.coalesce(attachment_bytes, F.lit(0)) + F.lit(RECORD_OVERHEAD)


def _next_starts(sizes: np.ndarray, max_bytes: int, max_rows: int) -> np.ndarray:
    """For every row, the row that starts the package after one starting here."""
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    at = np.arange(len(sizes))
    fits = np.searchsorted(total, total[:-1] + max_bytes, side="right") - 1
    return np.clip(fits, at + 1, at + max_rows)


def _block_function(pdf: pd.DataFrame, block_rows: int, max_bytes: int, max_rows: int) -> pd.DataFrame:
    """exit offset and start count of one block for each entry offset."""
    pdf = pdf.sort_values("offset")
    own = int((pdf["offset"] < block_rows).sum())
    jump = _next_starts(pdf["size"].to_numpy(), max_bytes, max_rows).tolist()
    exits, starts = [0] * own, [0] * own
    for i in range(own - 1, -1, -1):
        j = jump[i]
        inside = j < own
        exits[i] = exits[j] if inside else j - block_rows
        starts[i] = starts[j] + 1 if inside else 1
    width = min(max_rows, own)
    # Entries past a short last block meet no row of it.
    past = range(width, max_rows)
    return pd.DataFrame(
        {
            "block": [pdf["block"].iloc[0]],
            "exits": [exits[:width] + list(past)],
            "starts": [starts[:width] + [0] * (max_rows - width)],
        }
    )


def _compose(pdf: pd.DataFrame) -> pd.DataFrame:
    """The function of a run of blocks."""
    pdf = pdf.sort_values("block")
    offsets = np.arange(len(pdf["exits"].iloc[0]))
    counts = np.zeros(len(offsets), dtype=np.int64)
    for exits, starts in zip(pdf["exits"], pdf["starts"]):
        counts = counts + np.asarray(starts)[offsets]
        offsets = np.asarray(exits)[offsets]
    return pd.DataFrame(
        {"block": [pdf["parent"].iloc[0]], "exits": [offsets.tolist()], "starts": [counts.tolist()]}
    )


def _enter(pdf: pd.DataFrame) -> pd.DataFrame:
    """Entry offset and first package number of each block of a run."""
    pdf = pdf.sort_values("block")
    offset, first = int(pdf["parent_entry"].iloc[0]), int(pdf["parent_first"].iloc[0])
    entries, firsts = [], []
    for exits, starts in zip(pdf["exits"], pdf["starts"]):
        entries.append(offset)
        firsts.append(first)
        offset, first = int(exits[offset]), first + int(starts[offset])
    return pd.DataFrame({"block": pdf["block"].to_numpy(), "entry": entries, "first_package": firsts})


_FUNCTION = "block bigint, exits array<bigint>, starts array<bigint>"


def _block_entries(functions: DataFrame, blocks: int, fan_in: int) -> DataFrame:
    """block, entry, first_package, by composing up and walking down the levels."""
    levels = [functions]
    while blocks > fan_in:
        parents = levels[-1].withColumn("parent", F.expr(f"block div {fan_in}"))
        levels.append(stored(parents.groupBy("parent").applyInPandas(_compose, _FUNCTION), "pack-level"))
        blocks = -(-blocks // fan_in)
    entries = None
    for level in reversed(levels):
        runs = level.withColumn("parent", F.expr(f"block div {fan_in}"))
        if entries is None:  # the top level is one run, entered at its first row
            runs = runs.withColumns({"parent_entry": F.lit(0), "parent_first": F.lit(0)})
        else:
            above = entries.select(
                F.col("block").alias("parent"),
                F.col("entry").alias("parent_entry"),
                F.col("first_package").alias("parent_first"),
            )
            runs = runs.join(above, "parent")
        entries = runs.groupBy("parent").applyInPandas(
            _enter, "block bigint, entry bigint, first_package bigint"
        )
    return entries


def pack_positions(
    numbered: DataFrame,
    max_bytes: int = PACKAGE_KB * 1024,
    max_rows: int = RECORDS_PER_PACKAGE,
    block_rows: int = BLOCK_ROWS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """position, package_id for rows (position 0..n-1, size)."""
    block_rows = max(block_rows, max_rows)
    fan_in = max(2, min(fan_in, COMPOSED_ENTRIES // max_rows))
    block = F.expr(f"position div {block_rows}")
    offset = F.col("position") % block_rows
    # A block also sees the first rows of the next one, to close its last package.
    own = F.struct(block.alias("block"), offset.cast("bigint").alias("offset"))
    halo = F.struct((block - 1).alias("block"), (offset + block_rows).cast("bigint").alias("offset"))
    placed = F.when((offset < max_rows) & (block > 0), F.array(own, halo)).otherwise(F.array(own))
    rows = (
        numbered.select("position", F.col("size").cast("bigint").alias("size"), F.explode(placed).alias("at"))
        .select("position", "size", "at.block", "at.offset")
    )
    functions = stored(
        rows.groupBy("block").applyInPandas(
            lambda pdf: _block_function(pdf, block_rows, max_bytes, max_rows), _FUNCTION
        ),
        "pack-blocks",
    )
    entries = _block_entries(functions, functions.count(), fan_in)

    def label(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values("offset")
        own = left[left["offset"] < block_rows]
        jump = _next_starts(left["size"].to_numpy(), max_bytes, max_rows).tolist()
        begins = np.zeros(len(own), dtype=np.int64)
        at = int(right["entry"].iloc[0])
        while at < len(own):
            begins[at] = 1
            at = jump[at]
        package = int(right["first_package"].iloc[0]) - 1 + np.cumsum(begins)
        return pd.DataFrame({"position": own["position"].to_numpy(), "package_id": package})

    return (
        rows.groupBy("block").cogroup(entries.groupBy("block"))
        .applyInPandas(label, "position bigint, package_id bigint")
    )


def pack_greedy(
    df: DataFrame,
    order_by: list[str],
    size: str,
    max_bytes: int = PACKAGE_KB * 1024,
    max_rows: int = RECORDS_PER_PACKAGE,
    block_rows: int = BLOCK_ROWS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """order_by columns, position, size, package_id; only keys and sizes take part."""
    numbered = stored(
        number_rows(df.select(*order_by, F.col(size).cast("bigint").alias("size")), order_by), "pack-rows"
    )
    packed = pack_positions(numbered, max_bytes, max_rows, block_rows, fan_in)
    return numbered.join(packed, "position")


def package_summary(packed: DataFrame) -> DataFrame:
    return packed.groupBy("package_id").agg(
        F.count("*").alias("records"), F.sum("size").alias("bytes")
    )

