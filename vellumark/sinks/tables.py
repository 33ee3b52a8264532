"""Keyed upsert, replace load, CSV dump, JSON reports, enrichment append."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumark.session import new_folder
from vellumark.sinks.ledger import read_or_empty
from vellumark.sources.csv_tables import write_csv

# What a user row gets when a column is not given.
USER_DEFAULTS = {"role": "user", "is_active": True}


def upsert(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    mode: str = "update",
    order_by: str | None = None,
    defaults: Mapping[str, object] | None = None,
    updated_at: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """`current` with `incoming` merged in by key.

    update: every column but the keys and `keep` comes from the incoming row;
    ignore: the current row stays; replace: the incoming row as a whole.
    Of several incoming rows for a key the last by `order_by` counts. `updated_at`
    is set on rows that were updated.
    """
    if mode not in ("update", "ignore", "replace"):
        raise ValueError(f"unknown mode {mode}")
    keys = list(keys)
    columns = current.columns
    given = dict(defaults or {})
    filled = incoming.select(
        *[
            F.coalesce(F.col(c), F.lit(given[c])).alias(c) if c in given and c in incoming.columns
            else F.col(c) if c in incoming.columns
            else F.lit(given.get(c)).cast(current.schema[c].dataType).alias(c)
            for c in columns
        ],
        *([F.col(order_by).alias("_order")] if order_by else []),
    )
    if order_by:
        # max_by aggregates before the shuffle, so a key sent very often stays cheap.
        last = F.max_by(F.struct(*columns), "_order").alias("n")
    else:
        last = F.max(F.struct(*columns)).alias("n")
    new = filled.groupBy(*keys).agg(last)
    old = current.select(*keys, F.struct(*columns).alias("o"))
    both = old.join(new, keys, "full_outer")
    known = F.col("o").isNotNull()

    def merged(c: str) -> Column:
        o, n = F.col(f"o.{c}"), F.col(f"n.{c}")
        if mode == "ignore":
            return F.when(known, o).otherwise(n)
        changed = n
        if mode == "update":
            if c in keys or c in keep:
                changed = F.when(known, o).otherwise(n)
            elif c == "updated_at" and updated_at is not None:
                changed = F.when(known, updated_at).otherwise(n)
        return F.when(F.col("n").isNull(), o).otherwise(changed)

    return both.select(*[merged(c).alias(c) for c in columns])


def replace_load(tables: Mapping[str, DataFrame], root: str) -> str:
    """Write all tables as one new version, then point to it.

    The pointer is appended last: a reader sees all tables of the old version
    or all of the new one.
    """
    spark = next(iter(tables.values())).sparkSession
    version = new_folder(spark, "version").rsplit("/", 1)[1]
    for name, df in tables.items():
        df.write.parquet(f"{root}/{version}/{name}")
    pointers = read_or_empty(spark, f"{root}/pointer", "version string, n bigint")
    count = pointers.count()
    spark.createDataFrame([(version, count)], "version string, n bigint").coalesce(1).write.mode("append").parquet(
        f"{root}/pointer"
    )
    return version


def read_loaded(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the version the pointer names."""
    pointer = spark.read.parquet(f"{root}/pointer")
    version = pointer.agg(F.max_by("version", "n").alias("v")).first()["v"]
    return spark.read.parquet(f"{root}/{version}/{table}")


def dump_csv(df: DataFrame, path: str) -> bool:
    """Header CSV of a relation; an empty one is skipped."""
    if df.isEmpty():
        return False
    write_csv(df, path)
    return True


def report_document(df: DataFrame, form: str = "lists", order_by: Sequence[Column] = ()) -> DataFrame:
    """`report`: the rows of a result as JSON, in the form the caller names, however many they are.

    object: a JSON object per row, for results of any length. The others make
    one JSON text of all rows, for results that are short by their meaning:
    lists, an object with a list per column; records, a list of objects;
    mapping, from the first column to the second. Their rows go by `order_by`,
    else by their columns.
    """
    keep_nulls = {"ignoreNullFields": "false"}
    if form == "object":
        return df.select(F.to_json(F.struct(*df.columns), keep_nulls).alias("report"))
    row = F.struct(*df.columns)
    order = F.struct(*order_by) if order_by else row
    pairs = F.sort_array(F.collect_list(F.struct(order.alias("o"), row.alias("r"))))
    one = df.agg(F.transform(pairs, lambda p: p["r"]).alias("r"))
    if form == "records":
        body = F.col("r")
    elif form == "mapping":
        body = F.map_from_entries("r")
    else:
        body = F.struct(*[F.col(f"r.{c}").alias(c) for c in df.columns])
    return one.select(F.to_json(body, keep_nulls).alias("report"))


def shares_document(shares: DataFrame) -> DataFrame:
    """Report of `aggregates.shares`, the most frequent value first."""
    named = shares.select(
        F.col("label").alias("labels"), F.col("count").alias("counts"), F.col("percentage").alias("percentages")
    )
    return report_document(named, order_by=[-F.col("counts"), F.col("labels")])


def write_reports(documents: Mapping[str, DataFrame], root: str, timestamp: str) -> DataFrame:
    """One JSON report per analysis and a summary that lists where each is."""
    spark = next(iter(documents.values())).sparkSession
    for name, document in documents.items():
        document.write.mode("overwrite").text(f"{root}/{name}")
    paths = F.struct(*[F.lit(f"{root}/{name}").alias(name) for name in documents])
    summary = spark.range(1).select(F.lit(timestamp).alias("timestamp"), paths.alias("analyses"))
    summary.write.mode("overwrite").json(f"{root}/summary_report")
    return spark.read.schema(summary.schema).json(f"{root}/summary_report")


ENRICHMENT_COLUMNS = (
    "filename", "summary", "keywords", "topic", "named_entities", "pii_entities", "intent", "synonyms",
)


def append_enrichment(
    df: DataFrame, path: str, columns: Sequence[str] = ENRICHMENT_COLUMNS, created_at: Column | None = None
) -> DataFrame:
    """Append enrichment rows, missing texts as "", with their time of writing."""
    filled = [
        F.coalesce(F.col(c), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns
    ]
    stamp = F.current_timestamp() if created_at is None else created_at
    df.select(*filled, stamp.cast("timestamp").alias("created_at")).write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)

