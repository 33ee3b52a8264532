"""Label suggestions from the nearest labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumark.operators.skew import join_unique
from vellumark.session import stored

NEIGHBOURS = 3


def suggest_labels(
    df: DataFrame, key: str, label: str = "sensitivity_labels", modifier: str = "modifier", k: int = NEIGHBOURS
) -> DataFrame:
    """key, suggestion for documents with a modifier but no label.

    Neighbours are compared by modifier only: the same one is at distance 0,
    any other at 1, equal distances go by key. So the k neighbours depend on
    the modifier alone and are found once per modifier, from its first k
    labelled documents and the first k of all. The suggestion is the most
    frequent of their labels, the smallest of equally frequent ones. Of fewer
    than k labelled documents all count; without any there are no suggestions.
    """
    labelled = df.dropna(subset=[label, modifier]).select(
        F.col(key).alias("_id"), F.col(label).alias("_label"), F.col(modifier).alias("_by")
    )
    first = Window.partitionBy("_by").orderBy("_id")
    own = labelled.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k)
    own = own.groupBy("_by").agg(F.collect_list(F.struct("_id", "_label")).alias("own"))
    overall = [(r["_id"], r["_label"], r["_by"]) for r in labelled.orderBy("_id").limit(k).collect()]
    if not overall:
        return df.limit(0).select(key, F.lit(None).cast("string").alias("suggestion"))
    candidates = df.filter(F.col(label).isNull() & F.col(modifier).isNotNull()).select(
        key, F.col(modifier).alias("_by")
    )
    others = F.array(
        *[F.struct(F.lit(i).alias("_id"), F.lit(v).alias("_label"), F.lit(by).alias("_by")) for i, v, by in overall]
    )
    strangers = F.filter(others, lambda o: o["_by"] != F.col("_by"))
    near = F.sort_array(
        F.concat(
            F.transform(
                F.coalesce("own", F.array().cast(own.schema["own"].dataType)),
                lambda o: F.struct(F.lit(0).alias("d"), o["_id"].alias("id"), o["_label"].alias("v")),
            ),
            F.transform(strangers, lambda o: F.struct(F.lit(1).alias("d"), o["_id"].alias("id"), o["_label"].alias("v"))),
        )
    )
    asked = candidates.select("_by").distinct().join(own, "_by", "left")
    votes = F.transform(F.slice(near, 1, k), lambda n: n["v"])
    tally = F.transform(
        F.array_distinct(votes),
        lambda v: F.struct((-F.size(F.filter(votes, lambda x: x == v))).alias("minus"), v.alias("v")),
    )
    suggestions = asked.select("_by", F.array_min(tally)["v"].alias("suggestion"))
    # A row per modifier; once written, its size decides how it is joined.
    suggestions = stored(suggestions, "suggestions")
    return join_unique(candidates, suggestions, "_by", "inner").select(key, "suggestion")
