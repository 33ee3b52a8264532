"""Term counts of texts in blocks: a block holds the counts of some thousand texts and each of its terms once.

What a term has over all texts, a frequency or weights, goes to a block once and not once a text, and what is
computed of it stays in the block's task. A block has a bounded number of words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumark.operators.row_numbers import number_rows
from vellumark.session import bounded_batches, stored

BLOCK_WORDS = 1 << 21


@dataclass
class Cells:
    """The counts of a block: `of` and `at` say which part and which of the block's terms, in this order."""

    keys: pa.RecordBatch  # the key columns and `part` (its place in its row) of each part
    sizes: np.ndarray  # terms of each part
    at: np.ndarray
    n: np.ndarray
    sequence: np.ndarray | None = None  # of each word which term it is, -1 after each part; of ordered blocks

    @property
    def of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)


def _packed(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def unpacked(body: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(body) as stream:
        return stream.read_next_batch()


def _sequence(codes: np.ndarray, sizes: np.ndarray) -> bytes:
    sequence = np.full(len(codes) + len(sizes), -1, np.int32)
    sequence[np.arange(len(codes)) + np.repeat(np.arange(len(sizes)), sizes)] = codes
    return sequence.tobytes()


def _block(number: int, rows: pa.Table, keys: list[str], ordered: bool) -> Iterator[pa.RecordBatch]:
    """A row per term of the block, then one with its cells."""
    words = rows.column("words").combine_chunks()
    words = pa.concat_arrays(words.chunks) if isinstance(words, pa.ChunkedArray) else words
    parts_of_row = pc.fill_null(pc.list_value_length(words), 0).to_numpy()
    parts = words.flatten()
    sizes = pc.fill_null(pc.list_value_length(parts), 0).to_numpy()
    coded = pc.dictionary_encode(parts.flatten())
    order = pc.array_sort_indices(coded.dictionary)  # by their bytes, as Spark sorts
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    codes = rank[coded.indices.to_numpy()]
    terms = coded.dictionary.take(order)
    wide = max(1, len(terms))
    met, n = np.unique(np.repeat(np.arange(len(sizes)), sizes) * wide + codes, return_counts=True)
    part, at = met // wide, met % wide
    row = np.repeat(np.arange(len(parts_of_row)), parts_of_row)
    in_rows = at  # of a row of one part
    if len(parts_of_row) and parts_of_row.max() > 1:
        again = np.sort(row[part] * wide + at)
        in_rows = again[np.append(True, again[1:] != again[:-1])[: len(again)]] % wide
    schema = pa.schema([("block", pa.int64()), ("at", pa.int32()), ("term", pa.string()), ("rows", pa.int64()), ("n", pa.int64()), ("counted_rows", pa.int64()), ("keys", pa.binary()), ("cells", pa.binary()), ("sequence", pa.binary())])
    own = [np.full(len(terms), number), np.arange(len(terms), dtype=np.int32), terms, np.bincount(in_rows, minlength=len(terms)), np.bincount(at, n, len(terms)).astype(np.int64)]
    own = [pa.array(x) if isinstance(x, np.ndarray) else x for x in own]
    table = pa.RecordBatch.from_arrays([*own, *(pa.nulls(len(terms), f.type) for f in list(schema)[5:])], schema=schema)
    for begin in range(0, len(terms), 1 << 16):
        yield table.slice(begin, 1 << 16)
    place = np.arange(len(row)) - np.repeat(np.cumsum(parts_of_row) - parts_of_row, parts_of_row)
    held = rows.select(keys).combine_chunks().take(pa.array(row))
    columns = [c.combine_chunks() if c.num_chunks else pa.array([], c.type) for c in held.columns]
    filled = np.bincount(part, minlength=len(sizes))
    of_parts = pa.RecordBatch.from_arrays([*columns, pa.array(place), pa.array(filled)], names=[*keys, "part", "size"])
    cells = pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))], names=["at", "n"])
    counted = np.count_nonzero(np.bincount(row[filled > 0]))
    yield pa.RecordBatch.from_pylist([{"block": number, "counted_rows": counted, "keys": _packed(of_parts), "cells": _packed(cells), "sequence": _sequence(codes, sizes) if ordered else None}], schema)


def term_blocks(rows: DataFrame, words: str, keys: list[str], ordered: bool = False) -> tuple[DataFrame, DataFrame]:
    """(block, at, term, rows, n) for each term of each block, and (block, counted_rows, keys, cells) for each block.

    `words` is an array of words, or an array of such arrays, the parts of a
    row; `rows` counts the rows of the block that have the term, `n` its uses.
    Blocks that are `ordered` have the order of their words, too (`sequence`).
    """
    bounded_batches(rows.sparkSession)
    nested = rows.schema[words].dataType.simpleString().startswith("array<array")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += len(batch.column("words").flatten().flatten())
            if size >= BLOCK_WORDS:
                yield from _block(number, pa.Table.from_batches(held), keys, ordered)
                number, held, size = number + 1, [], 0
        if held:
            yield from _block(number, pa.Table.from_batches(held), keys, ordered)

    chosen = rows.select(*keys, (F.col(words) if nested else F.array(words)).alias("words"))
    columns = "block bigint, at int, term string, rows bigint, n bigint, counted_rows bigint, keys binary, cells binary, sequence binary"
    made = stored(chosen.mapInArrow(run, columns), "term-blocks")
    again = made.sparkSession.read.schema(made.schema).parquet(made.stored_at)  # of its own, so that the two can meet
    blocks = again.where("cells is not null").select("block", "counted_rows", "keys", "cells", *(["sequence"] if ordered else []))
    return made.where("cells is null").select("block", "at", "term", "rows", "n"), blocks


def per_block(values: DataFrame, blocks: DataFrame, run: Callable[[pa.Table, Cells], pa.Table], columns: str) -> DataFrame:
    """`run(values of the block, its cells)` for each block; `values` has the blocks' numbers, too."""

    def meet(own: pa.Table, block: pa.Table) -> pa.Table:
        made = [run(own, read_cells(row)) for row in block.to_pylist()]
        return pa.concat_tables(made) if made else empty

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    empty = to_arrow_schema(StructType.fromDDL(columns)).empty_table()
    return values.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(meet, columns)


def read_cells(row: dict) -> Cells:
    if "cells" not in row:  # only the order of the words was read
        none = np.zeros(0, np.int64)
        return Cells(pa.RecordBatch.from_pydict({}), none, none, none, np.frombuffer(row["sequence"], np.int32))
    keys, cells = unpacked(row["keys"]), unpacked(row["cells"])
    sizes = keys.column("size").to_numpy()
    return Cells(keys.drop_columns(["size"]), sizes, cells.column("at").to_numpy(), cells.column("n").to_numpy())


def inverse_frequency(terms: DataFrame, blocks: DataFrame) -> DataFrame:
    """block, at, idf = ln(rows with any term / rows with the term) for each term of each block."""
    total = blocks.agg(F.sum("counted_rows")).scalar()
    per_term = terms.groupBy("term").agg(F.sum("rows").alias("df"))
    idf = stored(per_term.select("term", F.log(total / F.col("df")).alias("idf")), "idf")
    return terms.select("block", "at", "term").join(idf, "term")


def numbered_terms(terms: DataFrame, blocks: DataFrame) -> DataFrame:
    """term, id, idf, uses: each term once, ids 0..n-1 in the terms' order."""
    total = blocks.agg(F.sum("counted_rows")).scalar()
    per_term = terms.groupBy("term").agg(F.sum("rows").alias("df"), F.sum("n").alias("uses"))
    found = per_term.select("term", F.log(total / F.col("df")).alias("idf"), "uses")
    return stored(number_rows(found, ["term"], "ordered-terms", "id"), "numbered-terms")
