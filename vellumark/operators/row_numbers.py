"""Contiguous row positions and row chunks without sorting into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumark.session import stored

CHUNK_ROWS = 5000
SOURCE_ORDER = ("_file", "_block", "_line")  # columns added by the CSV source
_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition above these


def number_rows(
    df: DataFrame, order_by: Sequence[str] | None = None, label: str = "numbered", name: str = "position"
) -> DataFrame:
    """Add `position` (or `name`), 0..n-1, in key order or, without keys, in source order.

    One range shuffle (none for source order), one written table, then a count
    per piece; only the counts, one row per piece, meet in a single task.
    """
    if name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"there is a column {name} already")
    if order_by:
        ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
        piece = ["_piece"]
        written = stored(
            ranged.withColumn("_at", F.monotonically_increasing_id()).withColumn(
                "_piece", F.shiftright("_at", _LOCAL_BITS)
            ),
            label,
        )
    else:
        piece = ["_file", "_block"]
        written = stored(df.withColumnRenamed("_line", "_at"), label)
    sizes = written.groupBy(*piece).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = Window.orderBy(*piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    # A row per range partition, of which the session sets the number; a row per
    # file block grows with the data, so its written size decides about the join.
    starts = F.broadcast(starts) if order_by else stored(starts, "starts")
    return (
        written.join(starts, piece)
        .withColumn(name, F.col("_start") + F.col("_at") - F.col("_first"))
        .drop("_start", "_first", "_at", *piece)
    )


def chunk_of(position: Column, chunk_rows: int = CHUNK_ROWS) -> Column:
    return F.floor(position / F.lit(chunk_rows)).cast("bigint")


def assign_chunks(
    df: DataFrame, order_by: Sequence[str] | None = None, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Add `position` and `chunk_id`; every chunk but the last has `chunk_rows` rows."""
    numbered = number_rows(df, order_by)
    return numbered.withColumn("chunk_id", chunk_of(F.col("position"), chunk_rows))


def chunk_count(rows: Column, chunk_rows: int = CHUNK_ROWS) -> Column:
    return F.ceil(rows / F.lit(chunk_rows)).cast("bigint")
