"""A third of the rows on one key, and what must not appear in plans."""

import pytest
from pyspark.sql import functions as F

from vellumark.operators import aggregates, attachments, outliers
from vellumark.operators.label_suggestions import suggest_labels
from vellumark.operators.skew import balanced, join_unique
from vellumark.plans import inputs
from vellumark.plans.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, n=30_000):
    """id, k: every third row has key 0, the others a key of their own."""
    return spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_salted_join_equals_plain_join(spark, no_broadcast, how):
    left = skewed(spark).withColumn("k", F.when(F.col("id") % 7 != 1, F.col("k")))
    right = spark.range(0, 20_000, 2).select(F.col("id").alias("k"), (F.col("id") + 1).alias("v"))
    got, want = join_unique(left, right, "k", how), left.join(right, "k", how)
    columns = want.columns
    assert got.select(columns).exceptAll(want).isEmpty() and want.exceptAll(got.select(columns)).isEmpty()


def test_hot_key_is_spread(spark, no_broadcast):
    right = spark.range(30_000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = join_unique(skewed(spark), right, "k", salts=64)
        rows = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # Plain hashing would put more than a third into one of eight partitions.
    assert sum(r["count"] for r in rows) == 30_000 and max(r["count"] for r in rows) < 30_000 / 4


def test_small_right_side_is_broadcast(spark, tmp_path):
    path = str(tmp_path / "small")
    spark.range(100).withColumnRenamed("id", "k").write.parquet(path)
    text = plan(join_unique(skewed(spark), spark.read.parquet(path), "k"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_balanced_leaves_large_inputs(spark, monkeypatch):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    assert balanced(df, "doc_id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr("vellumark.operators.skew.TASK_BYTES", 1)
    assert balanced(df, "doc_id") is df


def test_hot_groups_keep_whole_results(spark, no_broadcast):
    df = skewed(spark, 9_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("m"), (F.col("k") % 100).cast("string")).alias("modifier"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("l"), (F.col("id") % 4).cast("string"))).alias("sensitivity_labels"),
        F.lit("final").alias("document_status"), F.lit(None).cast("string").alias("retention_policies"),
        F.when(F.col("id") == 5, "odd").otherwise("1").alias("version"),
    )
    assert suggest_labels(df, "doc_id").count() == 4_500
    found = outliers.rarity_outliers(df, ["version", "document_status", "retention_policies"])
    assert [r.doc_id for r in found.collect()] == [5]
    assert aggregates.duplicates(df, ["modifier"]).first().total_occurrences == 9_000
    refs = df.select("doc_id", F.lit(0).alias("slot"), F.col("modifier").alias("name"))
    facts = df.select(F.col("modifier").alias("name")).distinct().withColumns({"size": F.lit(1), "checksum": F.lit("c")})
    assert attachments.with_files(refs, facts).filter("size = 1").count() == 9_000


@pytest.mark.parametrize("name", ["agg_share_by_status", "agg_completeness", "dq_checks", "enr_pii", "chunk_fixed"])
def test_scans_read_only_what_they_need(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    wanted = {
        "agg_share_by_status": "ReadSchema: struct<o_orderstatus:string>",
        "agg_completeness": "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>",
        "dq_checks": "ReadSchema: struct<c_name:string,c_nationkey:int,c_mktsegment:string>",
        "enr_pii": "ReadSchema: struct<doc_id:bigint,text:string>",
        "chunk_fixed": "ReadSchema: struct<doc_id:bigint,text:string>",
    }[name]
    assert any(wanted in s for s in scans), scans


MAP_ONLY = [
    "src_json_config", "prj_element_names", "scl_split_paths", "scl_mime", "scl_ids", "scl_format_month",
    "flt_valid_rows", "src_jdbc_documents", "vec_points",
]


@pytest.mark.parametrize("name", MAP_ONLY)
def test_scalar_queries_shuffle_nothing(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    assert "Exchange" not in text and "BatchEvalPython" not in text


LAZY = [
    "join_attachments", "join_missing_attachments", "join_export_route", "join_catalog_path", "agg_share_by_sensitivity",
    "agg_duplicates", "enr_keywords", "enr_summary", "enr_entities", "enr_synonyms", "ml_rarity_outliers", "ml_knn_label",
    "sink_upsert", "win_pack_greedy", "pkg_payload_xml", "vec_cosine_topk",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_chunk_documents_are_a_written_table(spark):
    assert "Exchange" not in plan(inputs.order_documents(spark, DATA))
