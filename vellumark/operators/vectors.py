"""Embeddings, vector points, quantization and cosine search, exact or by buckets of random planes."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumark.functions.names import uuid_shaped
from vellumark.session import bounded_batches, stored
from vellumark.sinks.collections import write_version

DIMENSIONS = 256
WORD = r"[\p{L}\p{N}_]+"
QUERY_BLOCK = 256  # query vectors a task answers at a time
POINT_BLOCK = 1 << 14  # points of a block
LEAST_BLOCK = 1 << 10  # fewer points are not split any further
LSH_BITS = 8
POINTS = "id string, vector array<float>, text string, source_file string"


def _bucket(word: Column, dimensions: int) -> Column:
    """Dimension of a word, by 32 bits of its MD5, which other engines have, too."""
    return F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint") % dimensions


def embed(chunks: DataFrame, text: str = "text", dimensions: int = DIMENSIONS) -> DataFrame:
    """Add `vector`: normalised hashed TF-IDF with 6 digits, zeros for an empty or null text.

    One pass counts the texts that have each dimension; the rest is map-only.
    Words become dimensions in columns, a batch of texts is weighed as one matrix.
    """
    bounded_batches(chunks.sparkSession)
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD), F.lit(0))
    found = F.transform(words, lambda w: _bucket(w, dimensions))
    rows = chunks.select(F.explode(F.array_distinct(found)).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    seen = {r["term"]: r["df"] for r in rows.collect()}  # a row per dimension
    texts = chunks.count()
    idf = np.array([math.log((texts + 1) / (seen.get(d, 0) + 1)) for d in range(dimensions)])

    @F.arrow_udf("array<double>")
    def unit(buckets: pa.Array) -> pa.Array:
        of = np.repeat(np.arange(len(buckets)), pc.list_value_length(buckets).to_numpy(zero_copy_only=False))
        counts = np.bincount(of * dimensions + buckets.flatten().to_numpy(), minlength=len(buckets) * dimensions)
        weighed = counts.reshape(len(buckets), dimensions) * idf
        length = np.sqrt(np.cumsum(weighed * weighed, axis=1)[:, -1:])  # in the order of the dimensions
        made = np.divide(weighed, length, out=np.zeros_like(weighed), where=length > 0)
        ends = np.arange(len(buckets) + 1, dtype=np.int32) * np.int32(dimensions)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(made.ravel()))

    return chunks.withColumn("vector", F.transform(unit(found), lambda x: F.round(x, 6).cast("float")))


def embed_with(
    chunks: DataFrame, model: Callable[[list[str]], list[list[float]]], text: str = "text"
) -> DataFrame:
    """Add `vector` from a caller's model, batch by batch; a missing vector is an error."""

    @F.pandas_udf("array<float>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = model(batch.tolist())
            if len(found) != len(batch) or any(v is None or len(v) == 0 for v in found):
                raise ValueError("the model gave no vector for a chunk")
            yield pd.Series([np.asarray(v, dtype="float32") for v in found])

    return chunks.withColumn("vector", vectors(text))


def points(embedded: DataFrame, source: str, ordinal: str, text: str = "text") -> DataFrame:
    """id, vector, text, source_file; ids derive from the content, so reruns agree."""
    key = uuid_shaped(F.col(source).cast("string"), F.col(ordinal).cast("string"), F.col(text))
    return embedded.select(
        key.alias("id"), "vector", F.col(text).alias("text"), F.col(source).cast("string").alias("source_file")
    )


def upsert_points(new: DataFrame, collection: str, version: str, previous: str | None = None) -> DataFrame:
    """Write the collection version that holds `new` and the points of `previous` it does not replace; `new` alone is written."""
    columns = [f.split(" ")[0] for f in POINTS.split(", ")]
    return write_version(new.select(*columns).dropDuplicates(["id"]), collection, version, ["id"], previous)


def quantize_int8(df: DataFrame, vector: str = "vector") -> DataFrame:
    """Add `code` (array of tinyint) and `max_error`: the collection's range in 256 steps."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    span = df.agg(F.struct(F.min(F.array_min(wide)).alias("low"), F.max(F.array_max(wide)).alias("high"))).scalar()
    ranged = df.withColumns({"_v": wide, "_low": span["low"], "_high": span["high"]})
    step = F.when(F.col("_high") > F.col("_low"), (F.col("_high") - F.col("_low")) / 255).otherwise(F.lit(1.0))
    coded = ranged.withColumn("_step", step).withColumn(
        "code",
        F.transform("_v", lambda x: (F.floor((x - F.col("_low")) / F.col("_step") + 0.5) - 128).cast("tinyint")),
    )
    back = F.zip_with(
        "_v", "code", lambda x, c: F.abs(x - ((c.cast("double") + 128) * F.col("_step") + F.col("_low")))
    )
    return coded.withColumn("max_error", F.array_max(back)).drop("_v", "_low", "_high", "_step")


def _unit_rows(vectors: pa.ListArray) -> np.ndarray:
    """Rows of length 1; a null or a null component counts as zero, a zero vector stays one."""
    filled = vectors.fill_null([]) if vectors.null_count else vectors
    lengths = np.diff(filled.offsets.to_numpy()) if len(filled) else np.zeros(0, np.int64)
    flat = np.nan_to_num(filled.flatten().cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False))
    m = np.zeros((len(filled), int(lengths.max(initial=0))))
    m[np.arange(m.shape[1]) < lengths[:, None]] = flat
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


def _best(similar: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest, equal ones by position."""
    if len(similar) > k:
        floor = np.partition(similar, -k)[-k]
        keep = np.flatnonzero(similar >= floor)
    else:
        keep = np.arange(len(similar))
    return keep[np.argsort(-similar[keep], kind="stable")[:k]]


def _pad(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m


def _search_blocks(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Best k points of a block for every query that visits it. Points come first, ordered by id; queries follow."""
    now, ids, held, matrix = None, [], [], np.zeros((0, 0))
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        bounds = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
        for at, end in zip(bounds[:-1], bounds[1:]) if len(blocks) else ():
            part = batch.slice(at, end - at)
            if blocks[at] != now:
                now, ids, held, matrix = blocks[at], [], [], np.zeros((0, 0))
            asks = part.column("asks").to_numpy(zero_copy_only=False)
            points = int((~asks).sum())
            if points:
                own = part.slice(0, points)
                ids.append(own.column("id"))
                held.append(_unit_rows(own.column("v")))
            if points == len(part) or not held:
                continue
            if len(held) > 1 or len(matrix) == 0:
                width = max(h.shape[1] for h in held)
                matrix = np.concatenate([_pad(h, width) for h in held])
                held, ids = [matrix], [pa.concat_arrays(ids)]
            queries = part.slice(points)
            for start in range(0, len(queries), QUERY_BLOCK):
                some = queries.slice(start, QUERY_BLOCK)
                asked = _unit_rows(some.column("v"))
                width = max(asked.shape[1], matrix.shape[1])
                similar = np.round(_pad(asked, width) @ _pad(matrix, width).T, 6)
                found = [_best(row, k) for row in similar]
                rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
                places = np.concatenate(found) if found else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [some.column("query_id").take(pa.array(rows)), ids[0].take(pa.array(places)), pa.array(similar[rows, places])],
                    names=["query_id", "id", "similarity"],
                )


def _search(points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Best k of (block, id, v) for (block, query_id, v): both meet by block, in one shuffle."""
    p_type, q_type = points.schema["id"].dataType, queries.schema["query_id"].dataType
    both = points.select("block", F.lit(False).alias("asks"), "id", F.lit(None).cast(q_type).alias("query_id"), "v").unionByName(
        queries.select("block", F.lit(True).alias("asks"), F.lit(None).cast(p_type).alias("id"), "query_id", "v")
    )
    met = both.repartition("block").sortWithinPartitions("block", "asks", "id")
    schema = f"query_id {q_type.simpleString()}, id {p_type.simpleString()}, similarity double"
    found = met.mapInArrow(lambda batches: _search_blocks(batches, k), schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "id", "similarity")


def _sides(points, queries, point_id, vector, query_id, query_vector) -> tuple[DataFrame, DataFrame]:
    return (
        points.select(F.col(point_id).alias("id"), F.col(vector).alias("v")),
        queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("v")),
    )


def cosine_topk(
    points: DataFrame,
    queries: DataFrame,
    k: int,
    point_id: str = "id",
    vector: str = "vector",
    query_id: str = "query_id",
    query_vector: str = "vector",
    block: int = POINT_BLOCK,
) -> DataFrame:
    """query_id, rank, id, similarity (6 digits): exact, equal similarities by id.

    Points lie in blocks of about `block` rows, and every query, by a column of
    blocks, visits all of them: both sides are shuffled, neither passes through
    the driver. A block keeps its best k for a query. Query ids are unique.
    """
    chosen, asked = _sides(points, queries, point_id, vector, query_id, query_vector)
    cores = points.sparkSession.sparkContext.defaultParallelism
    n = points.count()
    blocks = max(-(-n // block), min(cores, -(-n // LEAST_BLOCK)), 1)
    dealt = chosen.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).cast("int"))
    visits = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return _search(dealt, visits, k)


def _planes(width: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(width, bits))


def _projected(column: pa.ListArray, bits: int, seed: int) -> np.ndarray:
    unit = _unit_rows(column)
    return unit @ _planes(unit.shape[1], bits, seed)  # one width for all, or buckets do not compare


def _with_buckets(df: DataFrame, vector: str, bits: int, seed: int) -> DataFrame:
    """Add `bucket`: a bit per random plane, on which side of it the vector lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = _projected(batch.column(vector), bits, seed) > 0 if len(batch) else np.zeros((0, bits), bool)
            yield batch.append_column("bucket", pa.array(sides @ (1 << np.arange(bits)), pa.int32()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{schema}, bucket int")


def _probe_order(projections: np.ndarray) -> np.ndarray:
    """Buckets of each query by how far it lies from them: the sum of the margins of the planes that would have to flip."""
    bits = projections.shape[1]
    sides = (np.arange(1 << bits)[:, None] >> np.arange(bits)) & 1
    margins = np.abs(projections)
    flips = sides[None] != (projections > 0)[:, None]
    return np.argsort((flips * margins[:, None]).sum(axis=2), axis=1, kind="stable")


def _with_probes(df: DataFrame, vector: str, probes: int, bits: int, seed: int) -> DataFrame:
    """Add `probed`: the nearest `probes` buckets of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), QUERY_BLOCK):
                some = batch.slice(at, QUERY_BLOCK)
                order = _probe_order(_projected(some.column(vector), bits, seed))[:, :probes].astype(np.int32)
                offsets = pa.array(np.arange(len(some) + 1) * order.shape[1], pa.int32())
                yield some.append_column("probed", pa.ListArray.from_arrays(offsets, pa.array(order.ravel())))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{schema}, probed array<int>")


def probes_for_recall(
    points: DataFrame, queries: DataFrame, k: int, recall: float = 0.95, sample: int = 200, bits: int = LSH_BITS, seed: int = 1, **names: str
) -> int:
    """How many buckets a query must visit so that it finds `recall` of its true best k.

    `sample` queries, chosen by a hash, are answered exactly; each true
    neighbour has a place in its query's order of buckets, and the answer is the
    quantile of those places.
    """
    names = {"point_id": "id", "vector": "vector", "query_id": "query_id", "query_vector": "vector", **names}
    chosen, asked = _sides(points, queries, **names)
    asked = stored(asked.orderBy(F.xxhash64("query_id")).limit(sample), "lsh-sample")
    true = cosine_topk(chosen, asked, k, "id", "v", "query_id", "v").select("query_id", "id")
    where = _with_buckets(chosen.join(F.broadcast(true.select("id").distinct()), "id", "left_semi"), "v", bits, seed).select("id", "bucket")
    ordered = _with_probes(asked, "v", 1 << bits, bits, seed).select("query_id", "probed")
    place = F.array_position("probed", F.col("bucket"))
    found = true.join(where, "id").join(ordered, "query_id").groupBy(place.alias("place")).count().orderBy("place").collect()
    total, so_far = sum(r["count"] for r in found), 0
    for row in found:  # at most a row per bucket
        so_far += row["count"]
        if so_far >= recall * total:
            return int(row["place"])
    return 1


def cosine_topk_lsh(
    points: DataFrame,
    queries: DataFrame,
    k: int,
    probes: int,
    point_id: str = "id",
    vector: str = "vector",
    query_id: str = "query_id",
    query_vector: str = "vector",
    bits: int = LSH_BITS,
    seed: int = 1,
    block: int = POINT_BLOCK,
) -> DataFrame:
    """As `cosine_topk`, but a query visits only its `probes` nearest of 2**bits buckets of random planes.

    `probes_for_recall` tells how many are needed; all of them give the exact
    answer. A bucket of more than `block` points is split, so equal vectors do
    not meet in one task. All vectors have one length.
    """
    chosen, asked = _sides(points, queries, point_id, vector, query_id, query_vector)
    bucketed = _with_buckets(chosen, "v", bits, seed)
    sizes = bucketed.groupBy("bucket").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("parts"))
    sizes = F.broadcast(stored(sizes, "lsh-buckets"))  # at most 2**bits rows
    salt = F.pmod(F.monotonically_increasing_id(), F.col("parts"))
    dealt = bucketed.join(sizes, "bucket").select(F.struct("bucket", salt.cast("int").alias("part")).alias("block"), "id", "v")
    probed = _with_probes(asked, "v", probes, bits, seed).select("query_id", "v", F.explode("probed").alias("bucket"))
    parts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    visits = probed.join(sizes, "bucket").select("query_id", "v", "bucket", parts)
    number = F.xxhash64("b.bucket", "b.part")
    dealt = dealt.select(F.col("block").alias("b"), "id", "v").select(number.alias("block"), "id", "v")
    visits = visits.select(F.struct("bucket", "part").alias("b"), "query_id", "v").select(number.alias("block"), "query_id", "v")
    return _search(dealt, visits, k)
