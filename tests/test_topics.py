import random

from pyspark.sql import functions as F

from vellumark.operators import enrichment, topics

THEMES = ["ship sea harbour sail", "bread oven flour yeast"]


def texts(spark, n=60):
    draw = random.Random(2)
    return spark.createDataFrame([(i, " ".join(draw.choices(THEMES[i % 2].split(), k=30))) for i in range(n)], "doc_id int, text string")


def test_topics_do_not_follow_the_places_of_rows(spark):
    df = texts(spark)
    found = [sorted(tuple(r) for r in enrichment.topics(x, k=2).collect()) for x in (df, df.repartition(5), df.orderBy(F.desc("text")).coalesce(1))]
    assert found[0] == found[1] == found[2]
    for theme in (0, 1):
        (label,) = {r[2] for r in found[0] if r[0] % 2 == theme}
        assert set(label.split()) <= set(THEMES[theme].split())


def test_all_texts_and_terms_take_part(spark):
    rows = texts(spark, 40).select(F.col("doc_id").alias("_row"), F.concat(F.split("text", " "), F.array(F.concat(F.lit("only"), "doc_id"))).alias("words"))
    of_rows, terms = topics.topic_model(rows, "words", 2, 3)
    assert of_rows.count() == 40 and terms.count() == 48
    counted = terms.agg(F.sum(F.aggregate("weights", F.lit(0.0), lambda a, w: a + w))).first()[0]
    assert round(counted, 6) == 40 * 31
