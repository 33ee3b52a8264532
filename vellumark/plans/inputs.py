"""Inputs of the registered queries, all derived from the given tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumark.functions.names import ten_digit_id
from vellumark.operators import attachments as att
from vellumark.operators import packing
from vellumark.operators.inference import FLAVOURS, table_states
from vellumark.operators.skew import balanced, join_unique, plan_bytes
from vellumark.session import new_folder, stored
from vellumark.sinks.xml_chunks import chunk_documents
from vellumark.sources.csv_tables import read_csv_folder, write_csv
from vellumark.sources.files import write_named_texts, write_spread_texts

CHUNK = 1000
PACKAGE_ROWS = 20
PACKAGE_BYTES = 100 * 1024
HOLDING = "DocumentHolding"
APPLICATION = "DocumentArchive"
STAMP = "2025-07-09T12:00:00"
FOLDER = "/archive/in"
FOLDER_BYTES = 16 << 20  # of the documents table for each folder that holds its files


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """The documents, over all cores where they are few."""
    return balanced(table(spark, sf, "documents"), "doc_id")


def documents_meta(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata of documents: labels give sensitivity, orders give dates."""
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels")
    dates = table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), "o_orderdate")
    size = F.col("n_chars")
    return (
        docs.join(labels, "doc_id", "left")
        .join(dates, "doc_id", "left")
        .select(
            "doc_id",
            F.concat(F.sha2("text", 256), F.lit(".txt")).alias("filename"),
            F.concat(F.lit("/"), "source").alias("folder_path"),
            F.nullif("lang", F.lit("es")).alias("document_type"),
            F.when(size < 500, "draft").when(size < 3000, "review").otherwise("final").alias("document_status"),
            F.when(F.col("toxic") == 1, "restricted").when(F.col("quality") == 1, "public")
            .when(F.col("quality") == 0, "internal").alias("sensitivity_labels"),
            F.when(size > 5000, "10y").when(size > 1000, "5y").alias("retention_policies"),
            F.concat(F.lit("v"), (size % 5).cast("string")).alias("version"),
            F.nullif("source", F.lit("src0")).alias("creator"),
            F.col("source").alias("modifier"),
            F.col("o_orderdate").alias("creation_date"),
            (F.col("o_orderdate") + F.make_dt_interval(mins=size.cast("int"))).alias("last_modified"),
        )
    )


def orders_text(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with every column a string, as an export would hold them."""
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    mixed = F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey").cast("string")).when(
        F.col("o_orderstatus") == "O", price
    ).otherwise(day)
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus",
        price.alias("o_totalprice"),
        day.alias("o_orderdate"),
        F.col("o_orderpriority").alias("order priority"),
        mixed.alias("mixed"),
    )


def export_tables(spark: SparkSession, sf: str) -> dict[str, tuple[DataFrame, str]]:
    """Tables exported to CSV, each with the column that orders it."""
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        "c_name",
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("c_acctbal"),
        F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("type"),
    )
    documents = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), "text", "lang",
        F.date_format(
            F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs="doc_id"), "yyyy-MM-dd'T'HH:mm:ss'Z'"
        ).alias("seen"),
        F.concat("source", F.lit(".txt")).alias("attachment"),
    )
    return {
        "SALES_customer": (customer, "c_custkey"),
        "SALES_orders": (orders_text(spark, sf), "o_orderkey"),
        "TEXT_documents": (documents, "doc_id"),
    }


def write_in_order(df: DataFrame, key: str, path: str) -> str:
    """CSV files whose names and lines follow the numeric key."""
    number = F.col(key).cast("bigint")
    return write_csv(df.repartitionByRange(number).sortWithinPartitions(number), path)


def orders_csv(spark: SparkSession, sf: str) -> str:
    return write_in_order(orders_text(spark, sf), "o_orderkey", new_folder(spark, "orders-csv"))


def write_broken_zips(spark: SparkSession, sf: str, folder: str) -> None:
    """A file per region that is named like a package but is none."""
    name = F.concat(F.lit("broken_"), F.col("r_regionkey").cast("string"), F.lit(".zip"))
    write_named_texts(table(spark, sf, "region").select(name.alias("name"), F.concat(F.lit("PK"), "r_name").alias("text")), folder)


def csv_folder(spark: SparkSession, sf: str) -> str:
    folder = new_folder(spark, "csv-folder")
    for name, (df, key) in export_tables(spark, sf).items():
        write_in_order(df, key, f"{folder}/{name}.csv")
    return folder


def csv_catalogues(spark: SparkSession, sf: str, *flavours: str) -> list[DataFrame]:
    """Catalogues of one exported folder, one per flavour of types, from one pass."""
    states = table_states(read_csv_folder(spark, csv_folder(spark, sf), with_order=True), flavours)
    return [FLAVOURS[f](states) for f in flavours]


def csv_catalogue(spark: SparkSession, sf: str, flavour: str) -> DataFrame:
    return csv_catalogues(spark, sf, flavour)[0]


def order_documents(spark: SparkSession, sf: str) -> DataFrame:
    """XML documents of the order chunks, keyed for delivery."""
    key = F.col("o_orderkey").cast("bigint")
    return stored(chunk_documents(orders_text(spark, sf), "SALES", "orders", [key], CHUNK), "order-documents")


def flaky_transport(payload: str, attempt: int) -> int:
    """Stand-in receiver: by the payload it accepts at once, at the second try, or never."""
    digit = int(hashlib.sha256(payload.encode()).hexdigest()[0], 16)
    return 503 if digit < 4 or (digit < 8 and attempt == 1) else 201


def accepting_transport(payload: str, attempt: int) -> int:
    return 201


def file_name(key: Column) -> Column:
    return F.concat(F.lit("doc_"), key.cast("string"), F.lit(".txt"))


def records(spark: SparkSession, sf: str) -> DataFrame:
    """Records with two attachment columns; the second points to a shared file."""
    doc = F.col("doc_id")
    shared = F.concat(F.lit(FOLDER + "/shared/"), file_name(doc - doc % 10))
    return table(spark, sf, "documents").select(
        "doc_id", "lang", "source", "n_chars",
        F.concat(F.lit(FOLDER + "/"), file_name(doc)).alias("attachment"),
        F.when(F.col("lang") != "en", shared).otherwise("").alias("second_attachment"),
    )


ATTACHMENT_COLUMNS = ["attachment", "second_attachment"]
META_COLUMNS = ["doc_id", "lang", "source", "n_chars"]


def attached_files(spark: SparkSession, sf: str, absent_lang: str | None = None) -> DataFrame:
    """name, size, checksum of the files that staging the documents gives."""
    content = F.col("text")
    docs = table(spark, sf, "documents")
    if absent_lang:
        docs = docs.filter(F.col("lang") != absent_lang)
    return docs.select(
        file_name(F.col("doc_id")).alias("name"),
        F.octet_length(content).cast("bigint").alias("size"),
        F.base64(F.unhex(F.sha2(content, 256))).alias("checksum"),
    )


def stage_documents(
    spark: SparkSession, sf: str, text: Column | None = None, name: Column | None = None
) -> list[str]:
    """Every document as a file of its own; the folders that hold them."""
    docs = texts(spark, sf)
    named = docs.select(
        (file_name(F.col("doc_id")) if name is None else name).alias("name"),
        (F.col("text") if text is None else text).alias("text"),
    )
    pieces = max(spark.sparkContext.defaultParallelism, plan_bytes(table(spark, sf, "documents")) // FOLDER_BYTES)
    return write_spread_texts(named, new_folder(spark, "documents"), pieces)


def packed_records(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, their references matched with files, their packages)."""
    rows = records(spark, sf)
    matched = att.with_files(att.references(rows, "doc_id", ATTACHMENT_COLUMNS), attached_files(spark, sf))
    matched = stored(matched, "matched")
    sizes = att.record_sizes(rows, "doc_id", matched)
    packed = packing.pack_greedy(sizes, ["doc_id"], "size", PACKAGE_BYTES, PACKAGE_ROWS)
    return rows, matched, stored(packed, "packed")


def package_documents(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(package_id, aiu_count, payload, descriptor) and the files of each package."""
    rows, matched, packed = packed_records(spark, sf)
    fragments = att.record_fragments(rows, "doc_id", META_COLUMNS, matched, FOLDER)
    docs = att.payloads(fragments, packed, "doc_id", HOLDING)
    described = with_descriptor(docs)
    return described, att.package_files(matched, packed, "doc_id")


def with_descriptor(docs: DataFrame) -> DataFrame:
    holding = F.lit(HOLDING)
    package = ten_digit_id(holding, F.col("package_id").cast("string"))
    return docs.withColumns(
        {
            "id": package,
            "descriptor": att.descriptor_xml(
                holding, package, F.lit(APPLICATION), F.lit(STAMP), F.col("aiu_count")
            ),
        }
    )


def structured_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with headings and blank lines between their lines."""
    body = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n1. "))
    return texts(spark, sf).select(
        "doc_id", F.concat(F.lit("# "), "lang", F.lit("\nPART TWO: "), body).alias("text")
    )


def users(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as users, some breaking a rule."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    name = F.lower("c_name")
    segment = F.col("c_mktsegment")
    return table(spark, sf, "customer").select(
        key.alias("id"),
        F.when(nation == 3, F.substring(name, 1, 2)).when(nation == 4, F.lit(None)).otherwise(name).alias("username"),
        F.concat(name, F.when(nation == 5, "@nowhere").otherwise("@example.org")).alias("email"),
        F.when(segment == "BUILDING", "admin").when(segment == "HOUSEHOLD", "guest").otherwise("user").alias("role"),
        (F.col("c_acctbal") > 0).alias("is_active"),
        F.when(nation != 0, key * 2).alias("created_by"),
    )


def order_notes(spark: SparkSession, sf: str) -> DataFrame:
    """A sentence per order that names a date and places."""
    orders = balanced(table(spark, sf, "orders"), "o_orderkey").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    places = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    joined = join_unique(orders, customers, "o_custkey", "inner").join(places, "c_nationkey")
    text = F.format_string(
        "Order of %s from %s in %s, placed %s by Export Desk.",
        "c_name", "n_name", "r_name", F.date_format("o_orderdate", "yyyy-MM-dd"),
    )
    return joined.select(F.col("o_orderkey").alias("doc_id"), text.alias("text"))


def gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")
    areas = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        nations.select(F.col("n_name").alias("name"))
        .union(regions.select("r_name"))
        .union(areas.select(F.concat_ws(" in ", "n_name", "r_name")))
    )
