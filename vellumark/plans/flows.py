"""The five workloads end to end, put together from the operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumark.functions.names import attachment_columns, name_parts_text, record_element, ten_digit_id
from vellumark.operators import (
    aggregates,
    enrichment,
    label_suggestions,
    outliers,
    packing,
    quality,
    schema_docs,
    text_chunks,
    vectors,
)
from vellumark.operators import attachments as att
from vellumark.operators.inference import (
    json_catalogue,
    mark_attachments,
    relational_catalogue,
    table_states,
    xsd_catalogue,
)
from vellumark.operators.row_numbers import CHUNK_ROWS, number_rows
from vellumark.session import new_folder, stored
from vellumark.sinks import ledger as ledgers
from vellumark.sinks import packages, tables
from vellumark.sinks.xml_chunks import chunk_documents
from vellumark.sources import files as sources
from vellumark.sources.csv_tables import read_csv_folder, read_csv_strings, valid_rows


def archive_table(
    spark: SparkSession,
    csv: str,
    transport: ledgers.Transport,
    work: str,
    dag_id: str,
    run_id: str,
    execution_date: str,
    schema: str | None = None,
    table: str | None = None,
    chunk_rows: int = CHUNK_ROWS,
    multi_line: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """CSV table to XML chunks, delivery and run metrics; returns (ledger, metrics).

    Schema and table are taken from a `SCHEMA_TABLE.csv` name where not given.
    Run again with the same `work` folder after a failure, it sends only what
    was not accepted.
    """
    stem = csv.rstrip("/").rsplit("/", 1)[-1].removesuffix(".csv")
    named_schema, named_table = name_parts_text(stem)
    schema, table = schema or named_schema, table or named_table
    rows = read_csv_strings(spark, csv, multi_line, with_order=True)
    documents = stored(chunk_documents(rows, schema, table, None, chunk_rows), "chunk-documents")
    ledger = ledgers.deliver(documents, f"{work}/ledger", transport)
    totals = aggregates.delivery_totals(ledger, documents)
    run = ledgers.run_metrics(totals, dag_id, run_id, execution_date)
    return ledgers.latest_status(ledger, documents), ledgers.append_metrics(run, f"{work}/metrics")


def describe_folder(
    spark: SparkSession,
    folder: str,
    out: str,
    application: str,
    holding: str,
    schema: str = "SAP",
    default_schema: str = "SAP",
    locale: str = "en-US",
    strict: bool = False,
    attachment_column: str = "",
) -> dict[str, DataFrame]:
    """Types of all CSV tables of a folder as metadata JSON and XML, JSON schemas and XSDs."""
    read = read_csv_folder(spark, folder, with_order=True)
    states = table_states(read)
    relational = stored(relational_catalogue(states, strict), "catalogue")
    as_json = stored(mark_attachments(json_catalogue(states), read, attachment_column), "catalogue")
    json_schemas = stored(schema_docs.json_schemas(as_json), "json-schemas")
    made = {
        "metadata_json": schema_docs.metadata_json(relational, application, schema, default_schema, locale),
        "metadata_xml": schema_docs.metadata_xml(relational, schema, default_schema, locale),
        "json_schemas": json_schemas,
        "xsd_from_json": schema_docs.xsd_from_json_schemas(json_schemas, holding),
        "xsd": schema_docs.xsd_from_catalogue(xsd_catalogue(states), holding),
    }
    for name, df in made.items():
        df.write.mode("overwrite").json(f"{out}/{name}")
    written = {name: spark.read.schema(df.schema).json(f"{out}/{name}") for name, df in made.items()}
    return {"catalogue": relational, **written}


def _with_unfit_records(
    described: DataFrame, fragments: DataFrame, packed: DataFrame, record: str, types: Mapping[str, str], child: str
) -> DataFrame:
    """Set `fault` of the packages that have a record which the XSD of `types` refuses."""
    named = {record_element(c): kind for c, kind in types.items()}
    folder = new_folder(fragments.sparkSession, "record-xsd")
    xsd = quality.write_record_xsd(fragments.sparkSession, {**named, "Attachments": "xs:anyType"}, folder, child)
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in named)
    unfit = quality.validate_records(fragments, "xml", xsd, schema).filter("not valid")
    counts = unfit.join(packed.select(record, "package_id"), record).groupBy("package_id").agg(F.count("*").alias("_unfit"))
    text = F.concat(F.col("_unfit").cast("string"), F.lit(" records do not fit the XSD"))
    return described.join(counts, "package_id", "left").withColumn("fault", F.coalesce("fault", text)).drop("_unfit")


def build_packages(
    spark: SparkSession,
    csv: str,
    folder: str,
    out: str,
    holding: str,
    application: str,
    timestamp: str,
    records: int = packing.RECORDS_PER_PACKAGE,
    max_kb: int = packing.PACKAGE_KB,
    child: str = "Record",
    root: str = "Records",
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV records and their attachments to zip packages; a row, with an error if there is one, per package.

    A package whose payload does not hold its number of records is an error.
    With `types`, the XSD type of every metadata column in order, so is one
    with a record that does not fit them.
    """
    record = "_position"
    rows = stored(number_rows(read_csv_strings(spark, csv, with_order=True), name=record), "records")
    columns = [c for c in rows.columns if c != record]
    meta, attached = attachment_columns(columns)
    listing = sources.list_files(spark, folder)
    if attached:
        refs = att.references(rows, record, attached)
    else:
        refs = spark.createDataFrame([], f"{record} bigint, slot int, name string, path string")
    # Only files that records refer to are digested.
    used = listing.join(refs.select("name").distinct(), "name", "left_semi")
    files = stored(sources.attachments(used), "attachments")
    matched = stored(att.with_files(refs, files), "matched")
    sizes = att.record_sizes(rows, record, matched)
    packed = stored(packing.pack_greedy(sizes, [record], "size", max_kb * 1024, records), "packed")
    kept = valid_rows(rows, ignore=(record,))
    fragments = att.record_fragments(kept, record, meta, matched, folder.rstrip("/"), child)
    docs = att.payloads(fragments, packed, record, holding, root)
    package = ten_digit_id(F.lit(holding), F.col("package_id").cast("string"))
    described = docs.withColumn(
        "descriptor",
        att.descriptor_xml(F.lit(holding), package, F.lit(application), F.lit(timestamp), F.col("aiu_count")),
    )
    miscounted = att.counted_records(F.col("payload"), child) != F.col("aiu_count")
    described = described.withColumn("fault", F.when(miscounted, "the payload's record count differs"))
    if types is not None:
        described = _with_unfit_records(described, fragments, packed, record, types, child)
    whole = packed.select("package_id").distinct().join(described, "package_id", "left")
    with_files = packages.with_package_files(whole, att.package_files(matched, packed, record), files)
    return stored(packages.write_packages(with_files, out, holding), "packages")


# Columns of the completeness report and their names in it.
REPORT_COMPLETENESS = {"document_type": "document_type", "creator": "creator", "retention_policies": "retention_policy"}


def report_metadata(documents: DataFrame, out: str, as_of: str, key: str = "filename") -> DataFrame:
    """The eleven reports over a documents relation; returns the summary that lists them."""
    documents = stored(documents, "documents")
    spark = documents.sparkSession
    unusual = outliers.forest_outliers(documents, key).select("filename", "creator", "last_modified")
    suggested = label_suggestions.suggest_labels(documents, key).groupBy(key).agg(F.max("suggestion").alias("label"))
    ages = aggregates.age_bins(spark, aggregates.age_counts(documents, "creation_date", as_of))
    complete = aggregates.completeness(documents, list(REPORT_COMPLETENESS)).groupBy().pivot(
        "column", list(REPORT_COMPLETENESS)
    ).agg(F.first("complete")).withColumnsRenamed(REPORT_COMPLETENESS)
    months = aggregates.monthly_volume(documents, "creation_date")
    repeated = aggregates.duplicates(documents, ["folder_path", "filename"])
    by_label = aggregates.shares(documents, "sensitivity_labels")
    reports = {
        "document_types": tables.shares_document(aggregates.shares(documents, "document_type")),
        "document_age": tables.report_document(
            ages.select(F.col("age_bin").alias("age_bins"), F.col("count").alias("counts"))
        ),
        "monthly_growth": tables.report_document(months, "records"),
        "metadata_completeness": tables.report_document(complete, "object"),
        "classification": tables.shares_document(by_label),
        "duplicate_analysis": tables.report_document(repeated, "object"),
        "document_status": tables.shares_document(aggregates.shares(documents, "document_status")),
        "sensitivity_labels": tables.shares_document(by_label),
        "retention_policies": tables.shares_document(aggregates.shares(documents, "retention_policies")),
        "outlier_documents": tables.report_document(unusual, "object"),
        "sensitivity_label_recommendations": tables.report_document(suggested, "object"),
    }
    return tables.write_reports(reports, out, as_of)


def prepare_documents(
    spark: SparkSession,
    folder: str,
    collection: str,
    version: str,
    previous: str | None = None,
    strategy: str = "heading",
    documents: int | None = None,
) -> DataFrame:
    """The text files of a folder, or the first `documents` of them, as embedded chunks in a new version of the collection."""
    texts = sources.document_kinds(sources.list_files(spark, folder)).filter("kind = 'text'").drop("kind")
    if documents is not None:
        texts = sources.intake(texts, "name", documents)
    chunks = text_chunks.chunks(sources.read_texts(texts), strategy, key="name")
    embedded = vectors.embed(stored(chunks, "chunks"))
    return vectors.upsert_points(vectors.points(embedded, "name", "chunk_no"), collection, version, previous)


def enrich_documents(
    spark: SparkSession,
    folder: str,
    out: str,
    gazetteer: DataFrame,
    documents: int | None = None,
    mark: bool = True,
) -> DataFrame:
    """Enrich the whole texts of the unprocessed files, append the rows, mark the files as processed.

    `documents` bounds one run; as files are marked, the next run goes on after them.
    """
    listing = sources.unprocessed(sources.list_files(spark, folder))
    if documents is not None:
        listing = sources.intake(listing, "name", documents)
    listing = stored(listing, "chosen")
    texts = sources.read_texts(listing).select(F.col("name").alias("filename"), "text")
    found = enrichment.enrich(stored(texts, "texts"), gazetteer)
    appended = tables.append_enrichment(found, out)
    if mark:
        sources.mark_processed(listing)
    return appended
