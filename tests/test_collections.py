"""Versions of keyed tables: what is written, what is read, what a broken run leaves."""

import os

import pytest
from pyspark.sql import functions as F

from vellumark.sinks import collections
from vellumark.sinks.collections import read_version, upsert_version, write_version


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def points(spark, *ids, tag="a"):
    return spark.createDataFrame([(f"p{i}", i, tag) for i in ids], "id string, n long, tag string")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_versions(spark, tmp_path):
    root = str(tmp_path / "c")
    one = write_version(points(spark, 1, 2, 3), root, "v1", ["id"], buckets=4)
    two = write_version(points(spark, 3, 4, tag="b"), root, "v2", ["id"], "v1", merge_share=9)
    three = write_version(points(spark, 4, 5, tag="c"), root, "v3", ["id"], "v2", merge_share=9)
    want = [("p1", 1, "a"), ("p2", 2, "a"), ("p3", 3, "b"), ("p4", 4, "c"), ("p5", 5, "c")]
    assert rows(three) == want == rows(read_version(spark, root, "v3"))
    assert rows(read_version(spark, root, "v1")) == rows(one) == [("p1", 1, "a"), ("p2", 2, "a"), ("p3", 3, "a")]
    assert rows(two) == rows(read_version(spark, root, "v2"))
    merged = write_version(points(spark, 1, tag="d"), root, "v4", ["id"], "v3", merge_share=0)
    assert rows(merged) == [("p1", 1, "d"), *want[1:]]
    assert rows(write_version(points(spark), root, "v5", ["id"], "v4")) == rows(merged)


def test_an_increment_writes_its_own_share(spark, tmp_path):
    root = str(tmp_path / "c")
    big = spark.range(200_000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    write_version(big, root, "v1", ["id"], buckets=4)
    before = size(root)
    hundredth = big.where("id % 100 = 7").withColumn("text", F.reverse("text"))
    after = write_version(hundredth, root, "v2", ["id"], "v1")
    assert size(root) - before < 0.02 * before
    assert after.count() == 200_000
    assert after.join(hundredth, ["id", "text"]).count() == 2000


def test_a_broken_run_leaves_the_old_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "c")
    write_version(points(spark, 1, 2), root, "v1", ["id"], buckets=2)

    def broken(*args):
        raise OSError("broken off")

    with monkeypatch.context() as m:
        m.setattr(collections, "_write_manifest", broken)
        with pytest.raises(OSError):
            write_version(points(spark, 9), root, "v2", ["id"], "v1")
    assert rows(read_version(spark, root, "v1")) == [("p1", 1, "a"), ("p2", 2, "a")]
    with pytest.raises(FileNotFoundError):
        read_version(spark, root, "v2")
    again = write_version(points(spark, 9), root, "v2b", ["id"], "v1")
    assert [r[0] for r in rows(again)] == ["p1", "p2", "p9"]
    with pytest.raises(Exception):  # a version is written once
        write_version(points(spark, 10), root, "v2b", ["id"], "v1")
    assert [r[0] for r in rows(read_version(spark, root, "v2b"))] == ["p1", "p2", "p9"]


def test_upsert_modes_on_a_stored_table(spark, tmp_path):
    root = str(tmp_path / "c")
    schema = "id long, name string, created string"
    current = spark.createDataFrame([(1, "a", "c1"), (2, "b", "c2"), (3, "c", "c3")], schema)
    incoming = spark.createDataFrame([(2, "b2", "c9", 1), (2, "b3", "c9", 2), (4, "d", "c4", 1)], schema + ", seq int")
    write_version(current, root, "v1", ["id"], buckets=2)
    made = {
        mode: rows(upsert_version(incoming, root, mode, "v1", mode, "seq", keep=["created"])) for mode in ("update", "ignore", "replace")
    }
    assert made["update"] == [(1, "a", "c1"), (2, "b3", "c2"), (3, "c", "c3"), (4, "d", "c4")]
    assert made["ignore"] == [(1, "a", "c1"), (2, "b", "c2"), (3, "c", "c3"), (4, "d", "c4")]
    assert made["replace"] == [(1, "a", "c1"), (2, "b3", "c9"), (3, "c", "c3"), (4, "d", "c4")]
