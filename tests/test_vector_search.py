"""Cosine search by blocks and by buckets of random planes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellumark.operators import vectors


def frame(spark, matrix, name="id"):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(matrix)], f"{name} long, vector array<float>").repartition(4)


def nearest(points, query, k):
    p = points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12)
    similar = np.round(p @ (query / np.linalg.norm(query)), 6)
    return sorted(range(len(p)), key=lambda i: (-similar[i], i))[:k]


@pytest.fixture(scope="module")
def clustered():
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(40, 24))
    points = np.concatenate([c + draw.normal(scale=0.25, size=(60, 24)) for c in centres]).astype(np.float32)
    return points, (points[::40] + draw.normal(scale=0.1, size=(60, 24))).astype(np.float32)


def test_many_queries_without_a_collect(spark, clustered):
    points, asked = clustered
    many = np.repeat(asked, 6, axis=0)  # more than a block of queries
    got = vectors.cosine_topk(frame(spark, points), frame(spark, many, "query_id"), 3, block=500).collect()
    assert len(got) == 3 * len(many)
    for q in (0, 100, 359):
        assert [r.id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == nearest(points.astype(float), many[q].astype(float), 3)


def test_buckets_reach_the_recall_asked_for(spark, clustered):
    points, asked = clustered
    p, q = frame(spark, points), frame(spark, asked, "query_id")
    probes = vectors.probes_for_recall(p, q, 10, 0.95, sample=30)
    assert probes < 128  # less than half of the buckets
    exact = {(r.query_id, r.id) for r in vectors.cosine_topk(p, q, 10).collect()}
    found = {(r.query_id, r.id) for r in vectors.cosine_topk_lsh(p, q, 10, probes).collect()}
    assert len(exact & found) >= 0.95 * len(exact)
    fewer = {(r.query_id, r.id) for r in vectors.cosine_topk_lsh(p, q, 10, 1).collect()}
    assert len(exact & fewer) < len(exact & found)


def test_all_buckets_give_the_exact_answer(spark, clustered):
    points, asked = clustered
    same = np.concatenate([points[:300], np.repeat(points[:1], 200, axis=0)])  # one vector in two fifths of the rows
    p, q = frame(spark, same), frame(spark, asked[:20], "query_id")
    exact = sorted(map(tuple, vectors.cosine_topk(p, q, 8).collect()))
    assert sorted(map(tuple, vectors.cosine_topk_lsh(p, q, 8, 1 << vectors.LSH_BITS, block=50).collect())) == exact


def test_odd_vectors_and_empty_sides(spark):
    p = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [2.0, 0.0])], "id long, vector array<float>")
    q = spark.createDataFrame([("x", [3.0, 0.0])], "query_id string, vector array<float>")
    got = [(r.id, r.similarity) for r in vectors.cosine_topk(p, q, 9).orderBy("rank").collect()]
    assert got == [(1, 1.0), (4, 1.0), (5, 1.0), (2, 0.0), (3, 0.0)]
    assert vectors.cosine_topk(p.limit(0), q, 9).count() == 0
    assert vectors.cosine_topk(p, q.where(F.lit(False)), 9).count() == 0
    assert vectors.cosine_topk_lsh(p.limit(0), q, 9, 4).count() == 0
