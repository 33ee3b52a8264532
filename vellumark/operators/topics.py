"""Topics of texts: a fixed number of EM rounds over all (text, term, count), block by block."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumark.operators.term_blocks import Cells, per_block, read_cells, term_blocks
from vellumark.session import discard, stored

SMOOTHING = 0.1  # added to every count of a topic in a text and of a term in a topic
STEP = 1 << 17  # counts that a task works on at a time


def _round(own: pa.Table, cells: Cells, k: int) -> pa.Table:
    """New weights of the block's terms and, in a row of their own, the topics' counts in its texts."""
    of_texts = own.filter(own.column("has").is_valid())
    own = own.filter(own.column("id").is_valid())
    at = own.column("at").to_numpy()
    wide = int(max(cells.at.max(initial=-1), at.max(initial=-1))) + 1
    share = np.zeros((wide, k))
    share[at] = np.stack([own.column(f"p{i}").to_numpy() for i in range(k)], axis=1)
    texts = len(cells.sizes)
    old = None
    if of_texts.num_rows:
        old = np.frombuffer(of_texts.column("has")[0].as_py()).reshape(texts, k) + SMOOTHING
    has, weights, of = np.zeros((texts, k)), np.zeros((k, wide)), cells.of
    for begin in range(0, len(of), STEP):
        o, t, n = (x[begin : begin + STEP] for x in (of, cells.at, cells.n))
        p = share[t] if old is None else share[t] * old[o]
        total = p.sum(axis=1)
        counted = total > 0  # a term that does not count has no share
        p *= np.divide(n, total, out=np.zeros(len(n)), where=counted)[:, None]
        first = np.flatnonzero(np.diff(o, prepend=-1))
        has[o[first]] += np.add.reduceat(p, first, axis=0)
        for i in range(k):
            weights[i] += np.bincount(t, p[:, i], wide)
    made = [own.column("id"), *(pa.array(weights[i][at]) for i in range(k)), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.binary())]
    names = ["id", *(f"w{i}" for i in range(k)), "block", "has"]
    table = pa.table(made, names=names)
    block = own.column("block")[0].as_py() if own.num_rows else None
    last = pa.table([pa.nulls(1, f.type) for f in list(table.schema)[:-2]] + [pa.array([block], pa.int64()), pa.array([has.tobytes()], pa.binary())], schema=table.schema)
    return pa.concat_tables([table, last]) if own.num_rows else table


def topic_model(
    rows: DataFrame, words: str, k: int, rounds: int, seed: int = 42, min_documents: int = 1
) -> tuple[DataFrame, DataFrame] | None:
    """_row, topic (0 to k - 1) of the rows with counted terms; and term, weights (k numbers) of all these terms.

    `rows` is a stored table with a unique `_row`. Every term of at least
    `min_documents` rows counts, in every row and every round. The first weights
    come from the terms' hashes, so places of rows do not matter. The counts
    stay in blocks of rows; a round sends every block the shares of its terms.
    The driver holds k totals. None where no term is left to count.
    """
    of_blocks, blocks = term_blocks(rows, words, ["_row"])
    counted = of_blocks.groupBy("term").agg(F.sum("n").alias("n"), F.sum("rows").alias("df")).where(F.col("df") >= min_documents)
    draws = [F.pmod(F.xxhash64("term", F.lit(seed), F.lit(i)), F.lit(1 << 20)) + 1 for i in range(k)]
    first = [(F.col("n") * d / sum(draws[1:], draws[0])).alias(f"w{i}") for i, d in enumerate(draws)]
    terms = stored(counted.select(F.monotonically_increasing_id().alias("id"), "term", *first), "topic-terms")
    if terms.isEmpty():
        return None
    places = stored(of_blocks.join(terms.select("id", "term"), "term").select("block", "at", "id"), "topic-places")
    weights, texts, made = terms.drop("term"), None, None
    columns = ["id bigint", *(f"w{i} double" for i in range(k)), "block bigint", "has binary"]
    for _ in range(rounds):
        size, *totals = weights.agg(F.count("*"), *[F.sum(f"w{i}") for i in range(k)]).first()
        share = [((F.col(f"w{i}") + SMOOTHING) / F.lit(totals[i] + SMOOTHING * size)).alias(f"p{i}") for i in range(k)]
        sent = places.join(weights.select("id", *share), "id").withColumn("has", F.lit(None).cast("binary"))
        if texts is not None:
            sent = sent.unionByName(texts, allowMissingColumns=True)
        new = stored(per_block(sent, blocks, lambda own, cells: _round(own, cells, k), ", ".join(columns)), "topic-round")
        sums = new.where("id is not null").groupBy("id").agg(*[F.sum(f"w{i}").alias(f"w{i}") for i in range(k)])
        summed = stored(sums, "topic-weights")
        if made is not None:
            discard(made, weights)
        made, weights, texts = new, summed, new.where("id is null").select("block", "has")

    def main(batches):
        for batch in batches:
            for row in batch.to_pylist():
                cells = read_cells(row)
                has = np.round(np.frombuffer(row["has"]).reshape(len(cells.sizes), k), 6)
                some = np.flatnonzero(has.any(axis=1))
                own = cells.keys.column("_row").take(pa.array(some))
                yield pa.RecordBatch.from_arrays([own, pa.array(has[some].argmax(axis=1).astype(np.int32))], names=["_row", "topic"])

    found = blocks.join(texts, "block").mapInArrow(main, f"_row {rows.schema['_row'].dataType.simpleString()}, topic int")
    together = F.array(*[F.col(f"w{i}") for i in range(k)])
    return stored(found, "topic-found"), terms.select("id", "term").join(weights, "id").select("term", together.alias("weights"))


def strongest_terms(terms: DataFrame, k: int, top: int = 3) -> list[str]:
    """The `top` terms of most weight of each topic, equal ones by name, with spaces between."""
    each = terms.select("term", F.posexplode("weights").alias("topic", "weight")).withColumn("weight", F.round("weight", 6))
    place = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("weight"), "term"))
    found: list[list[str]] = [[] for _ in range(k)]
    for row in each.withColumn("r", place).filter(F.col("r") <= top).orderBy("topic", "r").collect():
        found[row["topic"]].append(row["term"])
    return [" ".join(f) for f in found]
