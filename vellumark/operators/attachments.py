"""Records, the files they refer to, and the packages both go into."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumark.functions.formats import DESCRIPTOR_SPACE
from vellumark.functions.names import base_name, record_element, schema_urn, schema_urn_text
from vellumark.functions.values import media_type, stripped
from vellumark.functions.xml import element, ordered_text, wrapped
from vellumark.operators.packing import record_size
from vellumark.operators.skew import join_unique


def references(df: DataFrame, record: str, columns: Sequence[str]) -> DataFrame:
    """record, slot, name, path: one row per filled attachment cell, in column order."""
    cells = F.array(*[stripped(F.col("`" + c + "`")) for c in columns])
    return (
        df.select(record, F.posexplode(cells).alias("slot", "path"))
        .filter(F.col("path") != "")
        .select(record, "slot", base_name(F.col("path")).alias("name"), "path")
    )


def path_references(df: DataFrame, record: str, paths: Column) -> DataFrame:
    """The same for one column that holds an array of paths."""
    return df.select(record, F.posexplode(paths).alias("slot", "path")).select(
        record, "slot", base_name(F.col("path")).alias("name"), "path"
    )


def with_files(refs: DataFrame, files: DataFrame) -> DataFrame:
    """References with mimetype, size and checksum; an absent file leaves the last two null."""
    facts = files.select("name", "size", "checksum")
    return join_unique(refs, facts, "name", "left").withColumn("mimetype", media_type(F.col("name")))


def missing_files(refs: DataFrame, files: DataFrame) -> DataFrame:
    """Names referred to that no file has."""
    return refs.select("name").distinct().join(files.select("name"), "name", "left_anti")


def record_sizes(df: DataFrame, record: str, matched: DataFrame) -> DataFrame:
    """record, size: the attachment bytes of each record plus its XML overhead."""
    attached = matched.groupBy(record).agg(F.sum("size").alias("_bytes"))
    return df.select(record).join(attached, record, "left").select(
        record, record_size(F.col("_bytes")).alias("size")
    )


def package_files(matched: DataFrame, packed: DataFrame, record: str) -> DataFrame:
    """package_id, name, size: the distinct attachments of each package."""
    return (
        matched.join(packed.select(record, "package_id"), record)
        .groupBy("package_id", "name")
        .agg(F.max("size").alias("size"))
    )


def package_study(records: DataFrame, matched: DataFrame) -> DataFrame:
    """total_records, unique_attachments, attachment_bytes over all packages to come."""
    files = matched.groupBy("name").agg(F.max("size").alias("size")).agg(
        F.count("*").alias("unique_attachments"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("attachment_bytes"),
    )
    total = records.agg(F.count("*")).scalar()
    return files.select(total.alias("total_records"), "unique_attachments", "attachment_bytes")


def attachment_xml(a: Column, folder: str) -> Column:
    checksum = {"algorithm": "SHA-256", "encoding": "base64"}
    return wrapped(
        "Attachment",
        element("mimetype", a["mimetype"]),
        element("Size", a["size"]),
        element("EASFile", a["name"]),
        element("checksum", a["checksum"], checksum),
        element("FilePath", F.concat(F.lit(folder + "/"), a["name"])),
    )


def record_fragments(
    df: DataFrame, record: str, meta_columns: Sequence[str], matched: DataFrame, folder: str, child: str = "Record"
) -> DataFrame:
    """record, xml: metadata values, stripped, then the attachments in column order."""
    slots = F.sort_array(F.collect_list(F.struct("slot", "name", "mimetype", "size", "checksum")))
    attached = matched.groupBy(record).agg(slots.alias("_files"))
    inner = F.array_join(F.transform("_files", lambda a: attachment_xml(a, folder)), "")
    block = F.when(inner != "", wrapped("Attachments", inner)).otherwise(F.lit("<Attachments />"))
    meta = [
        element(record_element(c), stripped(F.col("`" + c.replace("`", "``") + "`").cast("string"))) for c in meta_columns
    ]
    return df.join(attached, record, "left").select(
        record, wrapped(child, *meta, F.coalesce(block, F.lit("<Attachments />"))).alias("xml")
    )


def payloads(fragments: DataFrame, packed: DataFrame, record: str, holding: str, root: str = "Records") -> DataFrame:
    """package_id, aiu_count, payload: the records of a package in order.

    A package has at most its bounded number of records, so a task holds few.
    """
    urn = schema_urn_text(holding)
    placed = fragments.join(packed.select(record, "position", "package_id"), record)
    return placed.groupBy("package_id").agg(
        F.count("*").alias("aiu_count"),
        F.concat(
            F.lit(f'<{root} xmlns="{urn}">'), ordered_text(F.col("position"), F.col("xml")), F.lit(f"</{root}>")
        ).alias("payload"),
    )


def counted_records(payload: Column, child: str = "Record") -> Column:
    """Number of record elements in a payload document, whatever its namespace."""
    return F.xpath_long(payload, F.lit(f'count(//*[local-name()="{child}"])'))


def descriptor_xml(
    holding: Column, package: Column, application: Column, timestamp: Column, aiu_count: Column
) -> Column:
    """Descriptor document of a package."""
    dss = wrapped(
        "dss",
        element("holding", holding),
        element("id", package),
        element("pdi_schema", schema_urn(holding)),
        element("production_date", timestamp),
        element("base_retention_date", timestamp),
        element("producer", application),
        element("entity", application),
        element("priority", F.lit("0")),
        element("application", application),
    )
    return F.concat(
        F.lit(f'<sip xmlns="{DESCRIPTOR_SPACE}">'),
        dss,
        element("production_date", timestamp),
        element("seqno", F.lit("1")),
        element("is_last", F.lit("true")),
        element("aiu_count", aiu_count),
        element("page_count", F.lit("0")),
        F.lit("</sip>"),
    )


RECORD_JSON = (
    "{meta}, Attachments struct<Attachment: array<struct<mimetype: string, Size: bigint, EASFile: string, "
    "checksum: string, FilePath: string>>>"
)


def write_records_json(
    df: DataFrame, record: str, meta_columns: Sequence[str], matched: DataFrame, path: str
) -> str:
    """Records with nested attachments, one JSON object per line.

    As one line per record the payload can be read in splits; the content name
    of an attachment is its digest, as in the attachment source.
    """
    digest = F.lower(F.hex(F.unbase64("checksum")))
    entry = F.struct(
        "slot",
        "mimetype",
        F.coalesce("size", F.lit(0)).alias("Size"),
        F.concat(F.lit("ea_"), digest).alias("EASFile"),
        "checksum",
        F.col("path").alias("FilePath"),
    )
    attached = matched.groupBy(record).agg(F.sort_array(F.collect_list(entry)).alias("_a"))
    inner = F.transform(
        "_a",
        lambda a: F.struct(*[a[c].alias(c) for c in ("mimetype", "Size", "EASFile", "checksum", "FilePath")]),
    )
    nested = F.struct(F.coalesce(inner, F.array().cast(
        "array<struct<mimetype:string,Size:bigint,EASFile:string,checksum:string,FilePath:string>>"
    )).alias("Attachment"))
    df.join(attached, record, "left").select(*meta_columns, nested.alias("Attachments")).write.json(path)
    return path
