"""N-gram Jaccard join: candidates must share prefix tokens under two global token orders.

A document is the set of its distinct shingles. If two sets of sizes n and m
have a Jaccard index of t or more, they share a token among the first
n - ceil(t n) + 1 and m - ceil(t m) + 1 of them, under any order of all tokens.
Both orders put frequent shingles last and go by a hash otherwise, each its own.
A pair is a candidate if its prefixes meet under the first order and under the
second; candidates are verified on the whole sets. Between the two orders a
third filter, exact like them, compares parity sketches: bit i of a set's sketch
is the parity of its tokens that fall on i, so two sketches never differ in more
bits than the sets in tokens.

What is asked for is the components of the links, so a bucket (the sets with one
prefix token) is worked off in two steps that never write down all its pairs:
first every set of a bucket is compared with the bucket's smallest document,
and links found that way are joined to components; then, only where a bucket
still holds more than one component, its sets are compared across components,
in buckets of many sets by their sketches, before a pair is written.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumark.llm.components import components
from vellumark.llm.scan import KeyFilter, bounded_batches, filtered, id_hash, in_slices, key_filter, mix, shingles, string_array, without_removed
from vellumark.session import discard, stored

LATE_TOKENS = 300_000  # shingles known as frequent; they only move to the end of the orders
LATE_COUNT = 3  # texts counted together that make a shingle worth counting
COUNTED_TOKENS = 3 << 20  # shingles that a task counts together, whatever the batches and texts
SKETCH = 16  # longs of a parity sketch; larger sets are told apart less often, and then verified
BITS = [f"b{i}" for i in range(SKETCH)]
FEW_SETS = 16  # buckets of more sets carry sketches into their join, so that pairs are compared before they are made
SALTS = (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))


def _frequent(docs: DataFrame, size: int, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Shingles found in many texts, ascending, and their place by frequency; at most LATE_TOKENS."""

    def counted(sets):
        made, times = np.unique(np.concatenate(sets), return_counts=True)
        many = times >= LATE_COUNT
        return pa.RecordBatch.from_arrays([pa.array(made[many].view(np.int64)), pa.array(times[many])], names=["token", "n"])

    def count(batches):
        sets, held = [], 0
        for batch in batches:
            for made, _ in in_slices(string_array(batch.column("text")), lambda a: shingles(a, size, lower)):
                sets.append(made)
                held += len(made)
                if held >= COUNTED_TOKENS:
                    yield counted(sets)
                    sets, held = [], 0
        if sets:
            yield counted(sets)

    def packed(batches):
        for batch in batches:
            made = batch.column("token").to_numpy(zero_copy_only=False).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["tokens"])

    found = docs.select("text").mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    rows = found.orderBy(F.desc("n"), "token").limit(LATE_TOKENS).mapInArrow(packed, "tokens binary").collect()
    tokens = np.frombuffer(b"".join(r["tokens"] for r in rows), np.int64).view(np.uint64)
    place = np.arange(len(tokens))[::-1]  # the most frequent one last
    order = np.argsort(tokens)
    return tokens[order], place[order]


def _prefixes(
    made: np.ndarray, bounds: np.ndarray, percent: int, late: tuple[np.ndarray, np.ndarray], salt: np.uint64
) -> pa.ListArray:
    """The first tokens of each set under one order."""
    n = np.diff(bounds)
    of = np.repeat(np.arange(len(n)), n)
    key = mix(made ^ salt) >> np.uint64(1)
    tokens, place = late
    if len(tokens):
        at = np.minimum(np.searchsorted(tokens, made), len(tokens) - 1)
        known = tokens[at] == made
        key[known] = (np.uint64(1) << np.uint64(63)) + place[at[known]].astype(np.uint64)
    order = np.lexsort((key, of))
    rank = np.arange(len(made)) - np.repeat(bounds[:-1], n)
    length = np.where(n > 0, n + (-percent * n // 100) + 1, 0)  # n - ceil(percent n / 100) + 1
    chosen = made[order][rank < np.repeat(length, n)]
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.array(chosen.view(np.int64)))


def _sketches(made: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    """Parity of the tokens on each of 64 * SKETCH bits, as SKETCH columns."""
    n = len(bounds) - 1
    of = np.repeat(np.arange(n), np.diff(bounds))
    longs = np.zeros(n * SKETCH, np.uint64)
    word = ((made >> np.uint64(6)) % np.uint64(SKETCH)).astype(np.int64)
    np.bitwise_xor.at(longs, of * SKETCH + word, np.uint64(1) << (made & np.uint64(63)))
    return [pa.array(np.ascontiguousarray(column).view(np.int64)) for column in longs.reshape(n, SKETCH).T]


def _map_parts(docs: DataFrame, schema: str, work) -> DataFrame:
    """`work` makes columns of each slice of texts; doc_id goes along."""
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches):
        for batch in batches:
            at = 0
            for columns, n in in_slices(string_array(batch.column("text")), lambda a: (work(a), len(a))):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, n).cast(pa.int64()), *columns], names=names)
                at += n

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def document_keys(docs: DataFrame, size: int, lower: bool) -> DataFrame:
    """doc_id, n (shingles) and key, a digest of the set, null if it is empty."""

    def work(texts):
        made, bounds = shingles(texts, size, lower)
        keys = [
            hashlib.blake2b(made[a:b].tobytes(), digest_size=16).digest() if b > a else None
            for a, b in zip(bounds[:-1], bounds[1:], strict=True)
        ]
        return [pa.array(np.diff(bounds)), pa.array(keys, pa.binary())]

    return _map_parts(docs, "doc_id bigint, n bigint, key binary", work)


def document_prefixes(docs: DataFrame, size: int, percent: int, lower: bool) -> DataFrame:
    """doc_id, n, the set's prefixes p1, p2 under both orders, and its sketch."""
    late = docs.sparkSession.sparkContext.broadcast(_frequent(docs, size, lower))  # at most LATE_TOKENS

    def work(texts):
        made, bounds = shingles(texts, size, lower)
        prefixes = [_prefixes(made, bounds, percent, late.value, s) for s in SALTS]
        return [pa.array(np.diff(bounds)), *prefixes, *_sketches(made, bounds)]

    sketch = ", ".join(f"{b} bigint" for b in BITS)
    return _map_parts(docs, f"doc_id bigint, n bigint, p1 array<bigint>, p2 array<bigint>, {sketch}", work)


def _whole_sets(docs: DataFrame, keys: KeyFilter, size: int, lower: bool) -> DataFrame:
    """doc_id and tokens of the documents that may be in the filter."""
    docs = filtered(docs.select("doc_id", "text"), id_hash(), keys)

    def run(batches):
        for batch in batches:
            at = 0
            for part in in_slices(string_array(batch.column("text")), lambda a: a):
                made, bounds = shingles(part, size, lower)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(part)).cast(pa.int64()),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(made.view(np.int64)))],
                    names=["doc_id", "tokens"],
                )
                at += len(part)

    return docs.mapInArrow(run, "doc_id bigint, tokens array<bigint>")


def _shared_postings(sets: DataFrame, keys: KeyFilter) -> DataFrame:
    """token, doc_id, n of the first order's prefix tokens that may be in the filter."""
    return filtered(sets.select(F.explode("p1").alias("token"), "doc_id", "n"), F.col("token"), keys)


def _sizes_fit(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _sketches_fit(percent: int) -> Column:
    """False only if the sketches of sides a and b differ in more bits than linked sets of their sizes can in tokens."""
    differ = sum(F.bit_count(F.col(f"{b}_a").bitwiseXOR(F.col(f"{b}_b"))) for b in BITS)
    return (100 + percent) * differ <= (100 - percent) * (F.col("n_a") + F.col("n_b"))


def _near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches fit."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    known = filtered(sets.select("doc_id", "n", *BITS), id_hash(), key_filter(ids, id_hash()))
    a, b = (known.select(F.col("doc_id").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in ("n", *BITS)]) for k in "ab")
    return stored(pairs.join(a, "a").join(b, "b").where(_sketches_fit(percent)).select("a", "b"), "near")


def _linked(near: DataFrame, docs: DataFrame, sets: DataFrame, size: int, percent: int, lower: bool) -> DataFrame:
    """The pairs (a, b) of fitting sizes that meet under the second order too and whose whole sets are alike.

    Written down; `near` is discarded.
    """
    pairs = near
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    second = filtered(sets.select("doc_id", "n", "p2"), id_hash(), key_filter(ids, id_hash()))
    a, b = (second.select(F.col("doc_id").alias(c), F.col("n").alias(f"n{c}"), F.col("p2").alias(f"p{c}")) for c in "ab")
    meet = _sizes_fit(F.col("na"), F.col("nb"), percent) & F.arrays_overlap("pa", "pb")
    pairs = stored(pairs.join(a, "a").join(b, "b").where(meet).select("a", "b").distinct(), "candidates")
    discard(near)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    whole = stored(_whole_sets(docs, key_filter(ids, id_hash()), size, lower), "sets")
    a, b = (whole.select(F.col("doc_id").alias(c), F.col("tokens").alias(f"s{c}")) for c in "ab")
    common = F.size(F.array_intersect("sa", "sb"))
    alike = 100 * common >= percent * (F.size("sa") + F.size("sb") - common)
    links = stored(pairs.join(a, "a").join(b, "b").where(alike).select("a", "b"), "links")
    discard(pairs, whole)
    return links


def _across(rest: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) of sets with a common token and different components, and n and `columns` of both."""
    x, y = (rest.select("token", F.col("doc_id").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in ("n", "component", *columns)]) for k in "ab")
    return x.join(y, "token").where((F.col("a") < F.col("b")) & (F.col("component_a") != F.col("component_b")))


def link_documents(docs: DataFrame, size: int = 5, percent: int = 80, lower: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: the smallest doc_id reachable by links, itself included.

    Two documents link if 100 * shingles in common >= percent * shingles in
    either. A text of fewer than `size` words is one shingle; a null text or one
    without words has none and links with nothing. Rows with the same doc_id
    are one document. A row without doc_id gets its twin's component, or null,
    and links nothing. An empty table gives no rows; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    keys = stored(document_keys(docs, size, lower), "keys")
    known = keys.where(F.col("key").isNotNull() & F.col("doc_id").isNotNull())
    classes = stored(known.groupBy("key").agg(F.min("doc_id").alias("first")), "classes")
    copies = known.join(classes, "key").where(F.col("doc_id") != F.col("first")).select("doc_id")
    firsts = classes.select(F.col("first").alias("doc_id"))
    copies = stored(copies.distinct().join(firsts, "doc_id", "left_anti"), "copies")
    single = without_removed(docs.where(F.col("doc_id").isNotNull()), copies)  # a document of each class
    sets = stored(document_prefixes(single, size, percent, lower), "prefixes")
    postings = sets.select(F.struct("doc_id", "n").alias("at"), F.explode("p1").alias("token"))
    buckets = postings.groupBy("token").agg(F.min("at").alias("head"), F.max("at.doc_id").alias("last")).where("head.doc_id < last")
    buckets = stored(buckets.select("token", F.col("head.doc_id").alias("head"), F.col("head.n").alias("head_n")), "buckets")
    shared = _shared_postings(sets, key_filter(buckets, F.col("token")))
    shared = stored(shared.join(buckets, "token"), "postings")
    discard(buckets)
    pairs = shared.where((F.col("head") != F.col("doc_id")) & _sizes_fit(F.col("n"), F.col("head_n"), percent)).select(F.col("head").alias("a"), F.col("doc_id").alias("b")).distinct()
    pairs = stored(pairs, "pairs")
    links = _linked(_near(pairs, sets, percent), single, sets, size, percent, lower)
    found = components(links)
    placed = shared.select("token", "doc_id", "n").join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    placed = stored(placed.withColumn("component", F.coalesce("component", "doc_id")), "placed")
    discard(shared)
    mixed = placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("sets"))
    rest = stored(placed.join(mixed.where("low < high").select("token", "sets"), "token"), "mixed")
    discard(placed)
    sketched = rest.where(F.col("sets") > FEW_SETS).join(sets.select("doc_id", *BITS), "doc_id")
    across = _across(rest.where(F.col("sets") <= FEW_SETS), []).where(_sizes_fit(F.col("n_a"), F.col("n_b"), percent))
    sketched = stored(sketched, "sketched")
    many = _across(sketched, BITS).where(_sizes_fit(F.col("n_a"), F.col("n_b"), percent) & _sketches_fit(percent))
    across = across.select("a", "b").unionByName(many.select("a", "b")).distinct()
    across = stored(across.join(pairs, ["a", "b"], "left_anti"), "pairs")
    discard(rest, sketched, pairs)
    if across.take(1):
        more = _linked(_near(across, sets, percent), single, sets, size, percent, lower)
        found = components(links.unionByName(more)) if more.take(1) else found
    discard(sets, copies, across)
    rows = keys.join(classes, "key", "left").join(found, F.col("first") == F.col("id"), "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "first", "doc_id").alias("component_id"))


def one_of_each_group(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that link, over any steps, to one with a smaller id.

    Of rows with the same doc_id one stays. Rows without words, and rows
    without doc_id, stay.
    """
    made = stored(link_documents(docs, size, percent), "components")
    removed = made.where(F.col("doc_id") != F.col("component_id")).select("doc_id")
    kept = without_removed(docs, removed)
    twice = made.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select("doc_id")
    twice = stored(twice, "repeated-ids")
    if not twice.take(1):
        return kept
    single = without_removed(kept, twice)
    return single.unionByName(kept.join(twice, "doc_id", "left_semi").select(*kept.columns).dropDuplicates(["doc_id"]))
