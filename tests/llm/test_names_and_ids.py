"""Integer ids of any width, and columns whose names the operators use themselves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vellumark.llm import jaccard, learning, quality, scan, substrings, toxicity

CLASHES = ("score", "evidence", "_text", "_id", "_done", "removed_words", "row", "text_key", "id", "new words")


def prose(seed, n):
    draw = np.random.default_rng(seed)
    return " ".join("".join(draw.choice(list("abcdefgh"), draw.integers(4, 9))) for _ in range(n))


def documents(spark, id_type):
    passage = prose(1000, 60)
    texts = [prose(k, 80) for k in range(6)] + [prose(2, 80), prose(90, 30) + " " + passage, passage + " " + prose(91, 30), None, ""]
    rows = [(k, t, len(t or "")) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id int, text string, n_chars int").withColumn("doc_id", F.col("doc_id").cast(id_type))
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES}).repartition(3)


def labels(spark):
    return spark.createDataFrame([(k, k % 2, (k + 1) % 2) for k in range(11)], "doc_id int, quality int, toxic int")


@pytest.mark.parametrize("id_type", ["int", "bigint", "smallint"])
def test_dedup_and_join_whatever_the_id_type(spark, id_type):
    docs = documents(spark, id_type)
    made = substrings.dedup(docs)
    assert made.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    assert made.columns == [*[c for c in docs.columns if c != "removed_words"], "removed_words"]
    rows = {r["doc_id"]: r for r in made.collect()}
    assert len(rows) == 11 and rows[8]["removed_words"] >= substrings.REMOVE_WORDS and rows[7]["removed_words"] == 0
    assert rows[8]["n_chars"] == len(rows[8]["text"]) and rows[8]["_id"] == "own _id" and rows[9]["text"] is None
    kept = jaccard.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == [0, 1, 2, 3, 4, 5, 7, 8, 9, 10]


@pytest.mark.parametrize("id_type", ["int", "bigint"])
def test_classifiers_keep_columns_of_any_name(spark, id_type):
    docs = documents(spark, id_type)
    for module, keep in ((quality, quality.accepted), (toxicity, toxicity.clean)):
        model = module.train(docs, labels(spark))
        kept = keep(docs, model)
        assert kept.columns == docs.columns and kept.count() <= 11
        assert {r["score"] for r in kept.select("score").collect()} <= {"own score"}
        scored = module.score(docs, model, docs.columns)
        assert dict(scored.dtypes)["score"] == "double" and scored.count() == 11


def test_every_stage_takes_odd_rows(spark, tmp_path):
    docs = documents(spark, "int")
    more = docs.where("doc_id = 3").unionByName(docs.where("doc_id = 4").withColumn("doc_id", F.lit(None).cast("int")))
    more = more.unionByName(docs.limit(1).withColumns({"doc_id": F.lit(50), "text": F.lit("long word " * 40_000)}))
    for table in (docs.unionByName(more), docs.limit(0)):
        labels(spark).write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, table, str(tmp_path))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert made.columns == table.columns, name
                assert made.count() <= table.count()
            elif table.count():
                assert made.select("doc_id").distinct().count() == table.select("doc_id").distinct().count()


def test_pipeline_is_its_stages(spark, tmp_path):
    """Each stage by itself, on what the one before it left; results as the operators alone give them."""
    docs = documents(spark, "bigint").select("doc_id", "text", F.lit("en").alias("lang"), F.lit("src0").alias("source"), F.col("n_chars").cast("bigint").alias("n_chars"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    left = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, left, str(tmp_path)).write.parquet(f"{tmp_path}/stage{k}")
        left = spark.read.parquet(f"{tmp_path}/stage{k}")
    places = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).select(*places).collect())
    assert got == sorted(tuple(r) for r in left.select(*places).collect())


def test_a_sample_is_bounded_by_rows(spark):
    rows = [(7, f"text {k}") for k in range(300)] + [(8, "other")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    marks = spark.createDataFrame([(7, 1), (7, 0), (8, 0)], "doc_id bigint, quality int")
    assert learning.labelled_sample(docs, marks, "quality", 1, -1, 1).count() == 1
    assert sorted(map(tuple, learning.labelled_sample(docs, marks, "quality", 1, -1, 9).collect())) == [(7, 1, "text 0"), (8, 0, "other")]


def test_filters_run_without_python(spark):
    keys = spark.range(0, 3000, 3).select(F.col("id").alias("doc_id"))
    bits = scan.key_filter(keys, scan.id_hash())
    every = spark.range(3000).select(F.col("id").cast("int").alias("doc_id"))
    inside, outside = scan.filtered(every, scan.id_hash(), bits), scan.filtered(every, scan.id_hash(), bits, inside=False)
    assert "Python" not in inside._jdf.queryExecution().toString()
    assert inside.join(keys, "doc_id").count() == 1000 and inside.count() < 1010
    assert inside.count() + outside.count() == 3000
