"""Reports over document metadata and run data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shares(df: DataFrame, column: str, ordered: bool = True) -> DataFrame:
    """label, count, percentage per value; null is a value of its own."""
    counts = df.groupBy(F.col(column).alias("label")).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()  # reuses the shuffle of the counts
    out = counts.withColumn("percentage", F.round(F.col("count") / total * 100, 2))
    return out.orderBy(F.desc("count"), F.asc_nulls_first("label")) if ordered else out


def age_years(created: Column, as_of: Column) -> Column:
    """Whole days between the two, in years of 365 days."""
    days = F.extract(F.lit("DAY"), as_of - created)
    return F.floor(days / 365).cast("bigint")


def age_counts(df: DataFrame, created: str, as_of: str) -> DataFrame:
    """age_years, count in age order; a missing date is an age of its own."""
    stamp = F.lit(as_of).cast("timestamp_ntz")
    age = age_years(F.col(created).cast("timestamp_ntz"), stamp)
    return df.groupBy(age.alias("age_years")).agg(F.count("*").alias("count")).orderBy("age_years")


def age_bins(spark: SparkSession, counts: DataFrame, bins: int = 6) -> DataFrame:
    """Fixed bins 0..bins-1 with their counts, 0 where empty; other ages drop out."""
    years = spark.range(bins).withColumnRenamed("id", "age_years")
    label = F.concat_ws("-", F.col("age_years").cast("string"), (F.col("age_years") + 1).cast("string"))
    return (
        years.join(counts, "age_years", "left")
        .fillna(0, subset=["count"])
        .select("age_years", label.alias("age_bin"), "count")
        .orderBy("age_years")
    )


def monthly_volume(df: DataFrame, created: str) -> DataFrame:
    """month, new_docs, cumulative_total; the running total sees one row per month."""
    month = F.date_trunc("month", F.col(created))
    per_month = df.groupBy(month.alias("_month")).agg(F.count("*").alias("new_docs"))
    so_far = Window.orderBy("_month")
    return (
        per_month.withColumn("cumulative_total", F.sum("new_docs").over(so_far))
        .select(F.date_format("_month", "yyyy-MM").alias("month"), "new_docs", "cumulative_total")
        .orderBy("month")
    )


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, missing and complete percentages, all columns in one pass."""
    rows = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    missing = F.round(F.lit(100.0) * F.col("_missing") / F.nullif(F.col("_rows"), F.lit(0)), 2)
    return (
        rows.unpivot("_rows", list(columns), "column", "_missing")
        .withColumn("missing", missing)
        .select("column", "missing", F.round(F.lit(100.0) - F.col("missing"), 2).alias("complete"))
    )


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """duplicate_files and total_occurrences (null when there are none).

    Keys are grouped by their digest, so long texts are not shuffled.
    """
    marked = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")) for k in keys]
    digest = F.sha2(F.concat_ws("\u001f", *[F.sha2(m, 256) for m in marked]), 256)
    repeated = df.groupBy(digest.alias("key")).agg(F.count("*").alias("n")).filter("n > 1")
    return repeated.agg(
        F.count("*").alias("duplicate_files"), F.sum("n").alias("total_occurrences")
    )


def record_counts(tables: Mapping[str, DataFrame], chunk_rows: int) -> DataFrame:
    """table_name, record_count, chunk_count for many tables in one job."""
    counted = [
        df.agg(F.count("*").alias("record_count")).select(F.lit(name).alias("table_name"), "record_count")
        for name, df in tables.items()
    ]
    chunks = F.ceil(F.col("record_count") / F.lit(chunk_rows)).cast("bigint")
    return reduce(DataFrame.unionByName, counted).withColumn("chunk_count", chunks)


def delivery_totals(ledger: DataFrame, documents: DataFrame | None = None, batch_id: int = 0) -> DataFrame:
    """Rows attempted, delivered and failed; a content of a chunk counts once, by its best entry.

    With `documents` only the contents of that run count: neither what an
    earlier run sent under the same number nor chunks it had beyond them. A
    document without an entry has failed.
    """
    content = ["batch_id", "chunk_id", "sha"]
    per_chunk = ledger.groupBy(*content).agg(
        F.max("rows").alias("rows"), F.max(F.col("status") == 201).alias("delivered")
    )
    if documents is not None:
        own = documents.select(F.lit(batch_id).cast("bigint").alias("batch_id"), "chunk_id", "sha", "rows")
        per_chunk = own.join(per_chunk.drop("rows"), content, "left").fillna(False, ["delivered"])
    rows = F.col("rows")
    return per_chunk.agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("rows_in_chunks"),
        F.coalesce(F.sum(F.when(F.col("delivered"), rows)), F.lit(0)).alias("rows_delivered"),
        F.coalesce(F.sum(F.when(~F.col("delivered"), rows)), F.lit(0)).alias("rows_failed"),
    )


def user_summary(users: DataFrame) -> DataFrame:
    """Counts of users, administrators and active users, and the next id to give out."""
    return users.agg(
        F.count("*").alias("total_users"),
        F.count_if(F.col("role") == "admin").alias("admin_users"),
        F.count_if(F.col("is_active")).alias("active_users"),
        F.max("id").alias("max_id"),
    )
