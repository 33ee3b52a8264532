"""Lookups: export routes and paths through a service catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumark.operators.skew import hot_keys, join_unique
from vellumark.session import stored


def export_routes(requests: DataFrame, routes: DataFrame, key: str = "table_name") -> DataFrame:
    """Requests with their destination, and `error` where the table has none."""
    found = join_unique(requests, routes.select(key, "destination"), key, "left")
    unsupported = F.concat(F.lit("unsupported table "), F.coalesce(F.col(key), F.lit("")))
    return found.withColumn("error", F.when(F.col("destination").isNull(), unsupported))


def catalogue_paths(
    tenants: DataFrame, applications: DataFrame, databases: DataFrame, schemas: DataFrame, tables: DataFrame
) -> dict[str, DataFrame]:
    """Applications, schemas and tables reachable by name.

    As a client walks it: the first tenant, the application by name, its first
    database, the schema by name, the table by name; of equal names the first.
    """
    tenant = tenants.agg(F.min_by("id", "ord")).scalar()
    apps = (
        applications.filter(F.col("tenant_id") == tenant)
        .groupBy(F.col("name").alias("application"))
        .agg(F.min("id").alias("application_id"))
    )
    first_db = databases.groupBy("application_id").agg(F.min_by("id", "ord").alias("database_id"))
    opened = apps.join(first_db, "application_id")
    by_schema = (
        schemas.withColumnRenamed("name", "schema_name")
        .groupBy("database_id", "schema_name")
        .agg(F.min("id").alias("schema_id"))
        .join(opened.select("application", "database_id"), "database_id")
        .select("application", "schema_name", "schema_id")
    )
    by_table = (
        tables.withColumnRenamed("name", "table_name")
        .groupBy("schema_id", "table_name")
        .agg(F.min_by("href", "id").alias("href"))
        .join(by_schema, "schema_id")
        .select("application", "schema_name", "table_name", "href")
    )
    return {"application": apps.select("application"), "schema": by_schema, "table": by_table}


def resolve_paths(requests: DataFrame, paths: dict[str, DataFrame]) -> DataFrame:
    """application, schema_name, table_name, href, not_found for the distinct requests.

    The full path is looked up first; only misses ask how far the walk got.
    """
    full = ["application", "schema_name", "table_name"]
    found = stored(requests.select(*full).distinct().join(paths["table"], full, "left"), "paths")
    missed = found.filter(F.col("href").isNull()).drop("href")
    known_schema = paths["schema"].select("application", "schema_name", F.lit(True).alias("_schema"))
    known_app = paths["application"].withColumn("_app", F.lit(True))
    with_schema = join_unique(missed, known_schema, ["application", "schema_name"])
    walked = join_unique(with_schema, known_app, "application", hot=hot_keys(missed, ["application"]))
    level = F.when(F.col("_schema"), "table").when(F.col("_app"), "schema").otherwise("application")
    hits = found.filter(F.col("href").isNotNull()).withColumn("not_found", F.lit(None).cast("string"))
    return hits.unionByName(
        walked.select(*full, F.lit(None).cast("string").alias("href"), level.alias("not_found"))
    )
