"""The threshold algorithm against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellumark.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, query bigint, components string, block string"


def best(rows, k, asks):
    """rank rows by plain Python integers."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in e]) for i, e in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for at, (i, q) in enumerate(kept):
        if asks(i):
            scored = [(-sum(a * b for a, b in zip(q, e)), j is None, j or 0, j) for o, (j, e) in enumerate(kept) if o != at]
            out += [(i, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k])]
    return sorted(out, key=repr)


def run(spark, rows, k=10):
    df = spark.createDataFrame([(i, e, 1, "clash", 5, "clash", "clash") for i, e in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in topk.nearest_of_hundredths(df, k).collect()), key=repr)


def hundredth(i):
    return i is not None and i % 100 == 0


def made(n, d, seed, spread=1.0):
    draw = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in draw.normal(0, spread, d)]) for i in range(n)]


@pytest.mark.parametrize("n,d", [(1, 3), (7, 2), (350, 5), (900, 16)])
def test_equals_all_pairs(spark, n, d):
    rows = made(n, d, n)
    assert run(spark, rows) == best(rows, 10, hundredth)


def test_nulls_ties_repeats_and_odd_lengths(spark):
    rows = made(130, 4, 1)
    rows += [(200, [0.5] * 4)] * 30 + [(201, [0.5] * 4)] * 25  # one vector and one id, many times
    rows += [(300, None), (400, [0.1, None, 0.2, 0.3]), (500, [float("nan")] * 4), (600, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(700, []), (800, [0.25]), (-100, [0.1, -0.2, 0.3, 0.4, 0.5, 0.6]), (None, [0.9] * 4), (None, [0.9] * 4), (0, [0.0] * 4)]
    assert run(spark, rows) == best(rows, 10, hundredth)
    assert run(spark, rows, 1) == best(rows, 1, hundredth)


def test_few_rows_and_none(spark):
    assert run(spark, []) == []
    assert run(spark, [(100, [0.5])]) == []
    assert run(spark, [(100, None)]) == []
    assert run(spark, [(101, [0.5]), (102, [0.4])]) == []


def test_huge_components_stay_exact(spark):
    rows = [(0, [1e9, 1.0]), (1, [1e9, 0.5]), (2, [1e9, 0.25]), (3, [-3e30, 0.0]), (4, [3e12, 5.0])]
    got = run(spark, rows)
    kept = [(i, [max(min(math.floor(1024 * float(np.float32(x))), 2**63 - 1), -(2**63)) for x in e]) for i, e in rows]
    scored = sorted((-max(min(sum(a * b for a, b in zip(kept[0][1], e)), 2**63 - 1), -(2**63)), i) for i, e in kept[1:])
    want = [(0, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    assert got == sorted(want, key=repr)


def test_any_rows_may_ask_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "LEAST_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    rows = made(700, 6, 5)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    vectors = df.select("vec_id", topk.whole_components("embedding").alias("components"))
    got = topk.threshold_topk(vectors, F.col("vec_id") % 7 == 3, 4).collect()
    kept = [(i, [math.floor(1024 * x) for x in e]) for i, e in rows]
    want = []
    for i, q in kept:
        if i % 7 == 3:
            scored = sorted((-sum(a * b for a, b in zip(q, e)), j) for j, e in kept if j != i)
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:4])]
    assert sorted(map(tuple, got)) == sorted(want)


def test_walk_stops_before_the_ends_of_the_lists():
    """Vectors along few axes: the bound falls below the k-th score early, so most rows are never scored."""
    draw = np.random.default_rng(3)
    rows = (draw.pareto(1.2, (20_000, 3)) * 50).astype(np.int64)
    block = topk.Block(np.arange(20_000), np.zeros(20_000, bool), rows)
    (_, places, scores), = block.search(np.array([[3, 1, 2]]), 10)
    want = sorted(((-int(s), i) for i, s in enumerate(rows @ np.array([3, 1, 2]))))[:10]
    assert [(-int(s), int(block.ids[p])) for p, s in zip(places, scores)] == want
    assert block.accessed < 2000
