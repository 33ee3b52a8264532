"""Document fingerprints by one-permutation MinHash, in DataFrame functions alone.

The shingle hashes of a text fall into BINS bins by their upper bits, each bin
keeps its smallest hash, an empty bin takes the value of the first filled one
on its own fixed tour of the bins (optimal densification), and BITS low bits of
every bin's value, hashed once more with the bin, are packed into a hex string. Two fingerprints' likeness is the share
of equal bins, corrected for the 2**-BITS of them that agree by chance.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
BINS = 256
BITS = 4
PROBES = 32  # bins of a tour that are tried one by one; beyond them the filled bins are ranked
RANGE_ROWS = 500  # documents of one range in which neighbours are found

_LOW = 64 - BINS.bit_length() + 1  # bits of a hash below its bin number


def _tours() -> tuple[list[list[int]], list[list[int]]]:
    """For each bin its first PROBES stops, and every bin's rank on its tour."""
    draw = random.Random(11)
    stops, ranks = [], []
    for _ in range(BINS):
        tour = list(range(BINS))
        draw.shuffle(tour)
        rank = [0] * BINS
        for at, b in enumerate(tour):
            rank[b] = at
        stops.append(tour[:PROBES])
        ranks.append(rank)
    return stops, ranks


def _table(rows: list[list[int]]) -> Column:
    return F.expr("array(" + ", ".join("array(" + ", ".join(map(str, r)) + ")" for r in rows) + ")")


def shingle_hashes(df: DataFrame, text: str, out: str, size: int = SHINGLE_WORDS) -> DataFrame:
    """Add an array of the hashes of all runs of `size` words; fewer words are one shingle, none are none."""
    words, hashed = f"_w_{out}", f"_h_{out}"
    split = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    df = df.withColumn(words, split).withColumn(hashed, F.transform(words, lambda w: F.xxhash64(w)))
    run = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(hashed) - (size - 1), F.lit(1))),
        lambda i: F.xxhash64(*[F.element_at(hashed, (i + k).cast("int")) for k in range(size)]),
    )
    whole = F.array(F.xxhash64(F.concat_ws(" ", words)))
    none = F.expr("cast(array() as array<bigint>)")
    return df.withColumn(
        out, F.when(F.size(hashed) >= size, run).when(F.size(hashed) > 0, whole).otherwise(none)
    ).drop(words, hashed)


def bin_values(df: DataFrame, hashes: str, out: str) -> DataFrame:
    """Add BINS numbers below 2**BITS; null if there are no hashes."""
    stops, ranks = _tours()
    sorted_, first, own, full = (f"_{k}_{out}" for k in ("sorted", "first", "own", "full"))
    mask = (1 << _LOW) - 1
    # a filler for every bin stands behind the bin's hashes, so each bin has a first element
    fillers = F.expr(f"transform(sequence(0, {BINS - 1}), b -> shiftleft(cast(b - {BINS // 2} as bigint), {_LOW}) | {mask}L)")
    number = lambda x: F.shiftright(x, _LOW)
    df = df.withColumn(sorted_, F.sort_array(F.concat(F.col(hashes), fillers)))
    df = df.withColumn(
        first,
        F.filter(
            sorted_, lambda x, i: (i == 0) | (number(x) != number(F.get(sorted_, F.greatest(i - 1, F.lit(0)))))
        ),
    )
    low = lambda x: x.bitwiseAND(F.lit(mask))
    df = df.withColumn(own, F.transform(first, lambda x: F.when(low(x) != mask, x)))
    df = df.withColumn(
        full, F.filter(F.transform(own, lambda v, i: F.when(v.isNotNull(), i)), lambda i: i.isNotNull())
    )

    def filled(stop: Column, b: Column) -> Column:
        ranked = F.transform(full, lambda j: F.struct(F.get(F.get(_table(ranks), b), j).alias("r"), F.get(own, j).alias("v")))
        value = F.coalesce(F.get(own, b), *[F.get(own, F.get(stop, F.lit(k))) for k in range(PROBES)], F.array_min(ranked)["v"])
        # hashed with the bin, so that one value in many bins meets another one's bits by chance in each on its own
        return F.xxhash64(value, b.cast("bigint")).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")

    dense = F.transform(_table(stops), filled)
    return df.withColumn(out, F.when(F.size(full) > 0, dense)).drop(sorted_, first, own, full)


def packed(values: Column) -> Column:
    """Hex string of the bins' bits, BINS * BITS / 4 digits; zeros for a text without words."""
    digit = F.transform(values, lambda v: F.substring(F.lit("0123456789abcdef"), v + 1, 1))
    return F.coalesce(F.array_join(digit, ""), F.lit("0" * (BINS * BITS // 4)))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard index of two lists of bin values, 0 to 1; texts without words are alike and unlike all others."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(BINS))
    chance = 2.0**-BITS
    corrected = F.least(F.greatest((equal - chance) / (1 - chance), F.lit(0.0)), F.lit(1.0))
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(corrected)


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the packed fingerprint of every whole text. Nulls count as empty texts; equal texts get equal fingerprints."""
    made = bin_values(shingle_hashes(docs, text, "_shingles"), "_shingles", "_bins").drop("_shingles")
    return made.withColumn(out, packed(F.col("_bins"))).drop("_bins")


def _ranges(docs: DataFrame) -> DataFrame:
    """Add `_range`, ascending with doc_id: which of the quantiles the id lies above.

    The quantiles are one aggregate, an array of rows / RANGE_ROWS ids (at most
    a few thousand); a binary search over it places each id. Null ids come lowest.
    """
    rows = docs.agg(F.count("doc_id")).first()[0]
    ranges = max(1, min(4096, -(-rows // RANGE_ROWS)))
    shares = [k / ranges for k in range(1, ranges)]
    at = docs.agg(F.percentile_approx("doc_id", shares, 10 * ranges)).first()[0] if shares and rows else []
    bounds = F.expr("array(" + ", ".join(f"{b}L" for b in sorted(set(at))) + ")") if at else F.expr("cast(array() as array<bigint>)")
    steps = F.expr("array(" + ", ".join(str(1 << k) for k in range(12, -1, -1)) + ")")
    place = F.aggregate(
        steps,
        F.lit(0),
        lambda low, step: F.when(F.get(bounds, low + step - 1) <= F.col("doc_id"), low + step).otherwise(low),
    )
    return docs.withColumn("_range", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(place))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Add `_next_<c>` for each column: the value of the next document in descending doc_id, after the last the first.

    One shuffle by range of ids. The first row of every range also goes to the
    range before it, as the row that follows its last one; those rows, one a
    range, are found by an aggregate over ids. Equal ids are ordered by text.
    """
    ranged = _ranges(docs)
    tops = ranged.groupBy("_range").agg(F.max("doc_id").alias("_top")).collect()  # a row per range, ids only
    above = sorted((r["_range"] for r in tops), reverse=True)
    follows = {r: above[k - 1] for k, r in enumerate(above)}  # of which range a range's first row is the row after
    guests = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(t).alias("t")) for r, t in follows.items()]) if above else None
    if guests is None:
        return docs.select("*", *[F.col(c).alias(f"_next_{c}") for c in columns])
    target = F.element_at(F.map_from_entries(guests), F.col("_range"))
    top_of = F.element_at(F.map_from_entries(F.array(*[F.struct(F.lit(r["_range"]), F.lit(r["_top"]).cast("bigint")) for r in tops])), F.col("_range"))
    homes = ranged.withColumn("_guest", F.lit(False)).withColumn("_home", F.col("_range"))
    visits = (
        ranged.where(F.col("doc_id").eqNullSafe(top_of)).withColumn("_guest", F.lit(True)).withColumn("_home", target)
    )
    order = Window.partitionBy("_home").orderBy("_guest", F.col("doc_id").desc_nulls_last(), "text")
    both = homes.unionByName(visits)
    for c in columns:
        both = both.withColumn(f"_next_{c}", F.lead(c).over(order))
    return both.where(~F.col("_guest")).drop("_guest", "_home", "_range")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses.

    The edited text has its last floor(n/2) code points replaced by the first
    as many (or all) of the next document in descending doc_id. A null text is
    an empty one; the next document of a single one is itself; an empty table
    gives no rows; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    own = bin_values(shingle_hashes(docs, "text", "_shingles"), "_shingles", "_bins").drop("_shingles")
    both = with_next(own, ["text", "_bins"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, n_chars - _half)"), F.expr("substring(_next_text, 1, _half)"))
    both = both.withColumn("n_chars", n).withColumn("_half", half).withColumn("_edited", edited)
    both = bin_values(shingle_hashes(both, "_edited", "_shingles"), "_shingles", "_edited_bins").drop("_shingles")
    return both.select(
        "doc_id",
        F.col("n_chars").cast("bigint").alias("n_chars"),
        F.sha2(F.encode("_edited", "UTF-8"), 256).alias("edited_sha256"),
        packed(F.col("_bins")).alias("fingerprint"),
        packed(F.col("_edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("_bins"), F.col("_edited_bins")).alias("near_edited"),
        likeness(F.col("_bins"), F.col("_next__bins")).alias("near_next"),
    )
