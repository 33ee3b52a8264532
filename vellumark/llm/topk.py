"""Exact top-k search by the threshold algorithm over sorted per-dimension lists.

The vectors lie in blocks. A block keeps one list of its rows per dimension,
sorted by that component, and one by id. A batch of queries walks the lists
together from the ends its weights ask for, ever deeper; each row met is scored
against the batch (random access). What no list has shown yet cannot score more
than the threshold, the sum of the weighted components at the depth reached, so
a query ends once its threshold is below its k-th score. A threshold equal to
that score walks on: a row with a smaller id may follow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1024
BLOCK_ROWS = 1 << 18  # most rows of a block
LEAST_ROWS = 1 << 13  # fewer rows are not split any further
BATCH = 128  # queries that walk a block's lists together
FIRST_DEPTH = 16
SCORED_ROWS = 1 << 14  # rows scored at once
_EXACT = 1 << 53
_SPAN = -(1 << 63), (1 << 63) - 1


def whole_components(vector: str | Column) -> Column:
    """floor(1024 * x) of every component, as bigint (beyond its range the nearest); null for a vector that takes no part."""
    column = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(column, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.when(finite, F.transform(column, lambda x: F.floor(x.cast("double") * SCALE)))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of a list column as one int64 matrix, shorter ones filled with zeros."""
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _width(columns: list[pa.ListArray]) -> int:
    return max((int(np.diff(c.offsets.to_numpy()).max(initial=0)) for c in columns), default=0)


class Block:
    """Sorted lists over the rows of a block. Equal components stand in the order of their ids, null ids last."""

    def __init__(self, ids: np.ndarray, absent: np.ndarray, rows: np.ndarray):
        order = np.lexsort((ids, absent))
        self.ids, self.absent, self.rows = ids[order], absent[order], rows[order]
        self.order = [np.argsort(c, kind="stable").astype(np.int32) for c in self.rows.T]
        self.most = int(np.abs(self.rows, dtype=object).max()) if self._huge(self.rows) else int(np.abs(self.rows).max(initial=0))
        self.accessed = 0  # rows scored, over all queries

    @staticmethod
    def _huge(rows: np.ndarray) -> bool:
        return bool(rows.size) and int(rows.min()) == np.iinfo(np.int64).min  # abs would overflow

    def _arithmetic(self, queries: np.ndarray) -> type:
        """A number type in which every score is exact."""
        most = int(np.abs(queries, dtype=object).max()) if self._huge(queries) else int(np.abs(queries).max(initial=0))
        bound = self.most * most * max(1, self.rows.shape[1])
        return np.float64 if bound < _EXACT else np.int64 if bound < 1 << 62 else object

    def _met(self, depth: int, till: int, up: np.ndarray, down: np.ndarray) -> np.ndarray:
        """Rows at places depth:till of the lists, from the high end where `up`, from the low end where `down`."""
        n = len(self.ids)
        seen = [np.arange(depth, till, dtype=np.int32)]  # the list by id
        for d, order in enumerate(self.order):
            if up[d]:
                seen.append(order[n - till : n - depth])
            if down[d]:
                seen.append(order[depth:till])
        return np.concatenate(seen)

    def search(self, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query its index, and the places and scores of its best k rows, best first, ties by id."""
        n, kind = len(self.ids), self._arithmetic(queries)
        weights, rows = queries.astype(kind), self.rows.astype(kind, copy=False)
        places = [np.zeros(0, np.int64)] * len(queries)
        scores = [np.zeros(0, kind)] * len(queries)
        fresh = np.ones(n, bool)
        live, depth, step = np.arange(len(queries)), 0, FIRST_DEPTH
        while len(live) and depth < n:
            till = min(n, depth + step)
            q = weights[live]
            met = self._met(depth, till, (q > 0).any(axis=0), (q < 0).any(axis=0))
            new = np.zeros(n, bool)
            new[met] = True
            new = np.flatnonzero(new & fresh)
            fresh[new] = False
            for at in range(0, len(new), SCORED_ROWS):
                part = new[at : at + SCORED_ROWS]
                found = q @ rows[part].T
                if kind is object:
                    found = np.clip(found, *_SPAN)
                self.accessed += found.size
                for i, row in zip(live, found, strict=True):
                    if len(scores[i]) == k:
                        better = np.flatnonzero(row >= scores[i][-1])
                        if not len(better):
                            continue
                    elif len(row) > 4 * k and kind is not object:
                        better = np.flatnonzero(row >= np.partition(row, -k)[-k])
                    else:
                        better = np.arange(len(row))
                    score = np.concatenate([scores[i], row[better]])
                    place = np.concatenate([places[i], part[better]])  # places follow the ids
                    best = np.lexsort((place, -score))[:k] if kind is not object else np.array(sorted(range(len(score)), key=lambda j: (-score[j], place[j]))[:k])  # noqa: B023
                    scores[i], places[i] = score[best], place[best]
            depth, step = till, depth + step
            if depth < n:
                top = np.array([self.rows[o[n - 1 - depth], d] for d, o in enumerate(self.order)], kind)
                low = np.array([self.rows[o[depth], d] for d, o in enumerate(self.order)], kind)
                bound = np.where(q > 0, q * top, q * low).sum(axis=1)
                bound = np.clip(bound, *_SPAN) if kind is object else bound
                going = [len(scores[i]) < k or not b < scores[i][-1] for i, b in zip(live, bound, strict=True)]
                live = live[np.array(going, bool)]
        for i in range(len(queries)):
            yield i, places[i], scores[i]


def _answers(batches: Iterator[pa.RecordBatch], k: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of a block (query null) come before the queries that ask it."""
    at, held, asked, block = None, [], [], None

    def flush(asked):
        nonlocal block, held
        table = pa.Table.from_batches(asked).combine_chunks().to_batches()[0]
        rows = [c.column("components") for c in held] if held else []
        width = max(_width(rows), _width([table.column("components")]), block.rows.shape[1] if block else 0)
        if held:
            ids = pa.chunked_array([c.column("vec_id") for c in held]).combine_chunks()
            absent = ids.is_null().to_numpy(zero_copy_only=False)
            block = Block(ids.fill_null(0).to_numpy(zero_copy_only=False), absent, np.concatenate([_matrix(c, width) for c in rows]))
            held = []
        if block is None:
            return
        queries = _matrix(table.column("components"), width)[:, : block.rows.shape[1]]  # beyond it all rows are zero
        out = {name: [] for name in schema.names}
        for i, place, score in block.search(queries, k):
            out["query"] += [table.column("query")[i].as_py()] * len(place)
            out["vec_id"] += [None if block.absent[p] else int(block.ids[p]) for p in place]
            out["score"] += [int(s) for s in score]
        yield pa.RecordBatch.from_pydict(out, schema)

    for batch in batches:
        while batch.num_rows:
            blocks = batch.column("block").to_numpy(zero_copy_only=False)
            if at != blocks[0]:
                if asked:
                    yield from flush(asked)
                at, held, asked, block = blocks[0], [], [], None
            same = int(np.searchsorted(blocks, at, "right"))
            rows = int(batch.column("query").slice(0, same).null_count)  # nulls first
            if rows:
                held.append(batch.slice(0, rows))
            for start in range(rows, same, BATCH):
                asked.append(batch.slice(start, min(BATCH, same - start)))
                if sum(a.num_rows for a in asked) >= BATCH:
                    yield from flush(asked)
                    asked = []
            batch = batch.slice(same)
    if asked:
        yield from flush(asked)


def threshold_topk(vectors: DataFrame, asks: Column, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best rows for every row of `vectors` where `asks` holds.

    `vectors` has vec_id and components (whole numbers). All rows but the
    query's own are candidates, ties go to the smaller vec_id (null last);
    queries of one vec_id are answered each on their own. A missing component
    counts as zero, a score beyond 64 bits counts as the nearest that fits. Rows with
    null components take no part; no rows give none; fewer than k candidates are
    all returned. Other columns are not read. Queries, not rows, are copied to
    the blocks: blocks hold up to BLOCK_ROWS rows, dealt out by row, so equal
    vectors or ids do not meet in one task. Rows are told apart by their place
    in the input, which a re-read must repeat, as files do.
    """
    spark = vectors.sparkSession
    rows = vectors.where("components is not null").select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("components").cast("array<bigint>").alias("components"),
        F.coalesce(asks, F.lit(False)).alias("asks"),
        F.monotonically_increasing_id().alias("row"),
    )
    n = vectors.where("components is not null").count()
    parallel = 2 * spark.sparkContext.defaultParallelism
    blocks = max(1, -(-n // BLOCK_ROWS), min(parallel, -(-n // LEAST_ROWS)))
    held = rows.select(F.pmod("row", F.lit(blocks)).cast("int").alias("block"), F.lit(None).cast("bigint").alias("query"), "vec_id", "components")
    asking = rows.where("asks").select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.col("row").alias("query"), "vec_id", "components"
    )
    dealt = held.unionByName(asking).repartitionById(blocks, F.col("block")).sortWithinPartitions("block", F.col("query").asc_nulls_first())
    schema = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    found = dealt.mapInArrow(lambda batches: _answers(batches, k + 1, schema), "query bigint, vec_id bigint, score bigint")

    # the query's own row is among its best k + 1, or is no better than those: one row of its id and score goes
    own = F.aggregate("components", F.lit(0).cast("decimal(38,0)"), lambda s, x: (s + x.cast("decimal(19,0)") * x.cast("decimal(19,0)")).cast("decimal(38,0)"))
    own = F.least(own, F.lit(2**63 - 1).cast("decimal(38,0)")).cast("bigint")
    ids = rows.where("asks").select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), own.alias("own"))
    best = [F.col("score").desc(), F.col("vec_id").asc_nulls_last()]
    same = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own"))
    ranked = found.join(ids, "query").withColumn("same", F.coalesce(same, F.lit(False)))
    ranked = ranked.withColumn("mine", F.row_number().over(Window.partitionBy("query", "same").orderBy(*best)) == 1)
    ranked = ranked.where(~(F.col("same") & F.col("mine"))).withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*best)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_of_hundredths(embeddings: DataFrame, k: int = 10) -> DataFrame:
    """The best k rows for every vector whose vec_id is divisible by 100, by the inner product of floor(1024 * x)."""
    vectors = embeddings.select("vec_id", whole_components("embedding").alias("components"))
    return threshold_topk(vectors, F.col("vec_id") % 100 == 0, k)
