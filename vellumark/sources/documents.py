"""The documents relation and JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

METADATA_SCHEMA = (
    "application_name string, schema_name string, default_schema string, locale string, "
    "tables array<struct<table_name string, "
    "columns array<struct<name string, type string, typeLength string>>, record_count bigint>>"
)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Full scan of a stored documents relation."""
    return spark.read.parquet(path)


def read_documents_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int | str,
    upper: int | str,
    partitions: int,
    **options: str,
) -> DataFrame:
    """The same scan over JDBC, split into ranges of a column; nothing runs in one task."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url, dbtable=table, partitionColumn=partition_column,
            lowerBound=lower, upperBound=upper, numPartitions=partitions, **options,
        )
        .load()
    )


def read_metadata_json(spark: SparkSession, path: str) -> DataFrame:
    """Metadata documents back as flat catalogue rows."""
    docs = spark.read.json(path, schema=METADATA_SCHEMA, multiLine=True)
    tables = docs.select("application_name", "schema_name", F.explode("tables").alias("t"))
    return tables.select(
        "application_name", "schema_name", "t.table_name", "t.record_count",
        F.posexplode("t.columns").alias("at", "c"),
    ).select(
        "application_name", "schema_name", "table_name", (F.col("at") + 1).alias("ordinal"),
        "c.name", "c.type", F.col("c.typeLength").alias("type_length"), "record_count",
    )


def json_fields(config: Column, schema: str) -> Column:
    """Typed struct from a JSON text column; unreadable text gives null fields."""
    return F.from_json(config, schema)
