import random

from pyspark.sql import functions as F

from vellumark.operators import outliers

SCHEMA = "doc_id int, version string, document_status string, retention_policies string, sensitivity_labels string, filename string"


def metadata(spark):
    draw = random.Random(8)
    rows = [(i, draw.choice("123"), draw.choice("abcde"), "5y", draw.choice("xyz"), f"f{i if i % 3 else 0}") for i in range(900)]
    return spark.createDataFrame([*rows, (900, "99", "lost", "never", "odd", "f0")], SCHEMA)


def test_forest_does_not_follow_the_key(spark):
    df = metadata(spark)

    def found(rows, key):
        return sorted(tuple(r) for r in outliers.forest_outliers(rows, key).select("doc_id", "score").collect())

    by_id = found(df, "doc_id")
    assert by_id and by_id == found(df, "filename") == found(df.withColumn("filename", F.lit("same")).repartition(3), "filename")


def test_trees_draw_from_all_rows(spark):
    _, combinations = outliers._combinations(metadata(spark), outliers.FEATURES)
    made = []
    for trees in (3, 30):
        made.append(outliers.grow_forest(combinations, outliers.FEATURES, trees, 1000).orderBy("tree").collect())
    assert made[0] == made[1][:3] and len(made[1]) == 30
    assert any({"99", "lost", "never", "odd"} & set(r["value"]) for r in made[1])
    assert outliers.grow_forest(combinations.limit(0), outliers.FEATURES).count() == 0


def test_draws_add_up_to_the_sample(spark):
    _, combinations = outliers._combinations(metadata(spark), outliers.FEATURES)
    drawn = outliers.drawn_rows(combinations, outliers.FEATURES, 50, 100).groupBy("tree").agg(F.sum("w").alias("w")).collect()
    assert len(drawn) == 50 and all(70 < r["w"] < 130 for r in drawn)
    assert abs(sum(r["w"] for r in drawn) / 50 - 100) < 5
    every = outliers.drawn_rows(combinations, outliers.FEATURES, 2, 5000).groupBy("tree").agg(F.sum("w").alias("w")).collect()
    assert {r["w"] for r in every} == {901}
