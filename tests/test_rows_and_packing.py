import random

import pytest
from pyspark.sql import functions as F

from vellumark.operators import packing
from vellumark.operators.row_numbers import assign_chunks, number_rows
from vellumark.operators.skew import hot_keys, join_unique


def greedy(sizes, max_bytes, max_rows):
    out, package, used, rows = [], 0, 0, 0
    for s in sizes:
        if rows and (used + s > max_bytes or rows >= max_rows):
            package, used, rows = package + 1, 0, 0
        out.append(package)
        used, rows = used + s, rows + 1
    return out


@pytest.mark.parametrize("n,chunk", [(0, 5), (1, 5), (5, 5), (1003, 10)])
def test_chunks_are_contiguous(spark, n, chunk):
    df = spark.range(n).select((F.lit(n) - F.col("id")).alias("key"), F.lit("x").alias("v"))
    rows = assign_chunks(df, ["key"], chunk).orderBy("key").collect()
    assert [r.position for r in rows] == list(range(n))
    assert [r.chunk_id for r in rows] == [i // chunk for i in range(n)]


def test_rows_with_equal_first_key(spark):
    df = spark.range(5000).select(F.lit(1).alias("a"), F.col("id").alias("b"))
    rows = number_rows(df, ["a", "b"]).orderBy("b").collect()
    assert [r.position for r in rows] == list(range(5000))


@pytest.mark.parametrize(
    "seed,n,max_bytes,max_rows,block,fan_in",
    [
        (1, 500, 50, 7, 16, 4),
        (2, 333, 30, 1, 10, 3),
        (3, 64, 1000, 20, 20, 2),
        (4, 45, 40, 20, 20, 2),  # last block shorter than a package
        (5, 3, 10, 20, 1000, 10),
        (6, 700, 60, 13, 13, 2),
    ],
)
def test_packing_equals_sequential(spark, seed, n, max_bytes, max_rows, block, fan_in):
    rnd = random.Random(seed)
    sizes = [rnd.choice([0, 1, 5, 9, 20, 29, 80]) for _ in range(n)]
    df = spark.createDataFrame(list(enumerate(sizes)), "id long, size long")
    got = packing.pack_greedy(df, ["id"], "size", max_bytes, max_rows, block, fan_in)
    assert [r.package_id for r in got.orderBy("id").collect()] == greedy(sizes, max_bytes, max_rows)


def test_packing_levels_shrink_for_long_packages(spark, monkeypatch):
    monkeypatch.setattr(packing, "COMPOSED_ENTRIES", 60)
    sizes = [(i * 7) % 13 for i in range(400)]
    df = spark.createDataFrame(list(enumerate(sizes)), "id long, size long")
    got = packing.pack_greedy(df, ["id"], "size", 90, 20, 20)
    assert [r.package_id for r in got.orderBy("id").collect()] == greedy(sizes, 90, 20)


def test_join_unique_spreads_a_hot_key(spark):
    left = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("k")
    )
    right = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    assert [r.k for r in hot_keys(left, ["k"], 10).filter("k is not null").collect()] == [7]
    got = join_unique(left, right, "k")
    want = left.join(right, "k", "left")
    assert got.count() == 3000
    assert got.select("id", "k", "w").exceptAll(want.select("id", "k", "w")).isEmpty()
