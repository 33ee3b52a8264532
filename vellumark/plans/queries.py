"""The registered queries, one per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumark.functions import names, values
from vellumark.operators import (
    aggregates,
    enrichment,
    label_suggestions,
    lookups,
    outliers,
    packing,
    quality,
    schema_docs,
    text_chunks,
    vectors,
)
from vellumark.operators import attachments as att
from vellumark.operators.row_numbers import assign_chunks
from vellumark.operators.skew import join_unique
from vellumark.plans import inputs
from vellumark.plans.inputs import table
from vellumark.session import new_folder, stored
from vellumark.sinks import ledger as ledgers
from vellumark.sinks import packages, tables
from vellumark.sources import csv_tables, documents, files
from vellumark.streaming.export import export_stream
from vellumark.streaming.intake import csv_stream, take_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2001-08-02 00:00:00"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# Sources


@query
def src_csv_strings(spark, sf):
    return csv_tables.read_csv_strings(spark, inputs.orders_csv(spark, sf)).withColumnRenamed(
        "order priority", "order_priority"
    )


@query
def src_csv_folder(spark, sf):
    """Filled cells and characters of every column of every table."""
    read = csv_tables.read_csv_folder(spark, inputs.csv_folder(spark, sf))
    out = None
    for name, df in read.items():
        cells = [
            F.struct(
                F.lit(i + 1).alias("ordinal"),
                F.lit(c).alias("name"),
                F.count(F.col(f"`{c}`")).alias("filled"),
                F.coalesce(F.sum(F.length(F.col(f"`{c}`"))), F.lit(0)).alias("chars"),
            )
            for i, c in enumerate(df.columns)
        ]
        one = df.agg(F.array(*cells).alias("c")).select(F.lit(name).alias("table_name"), F.explode("c").alias("c"))
        one = one.select("table_name", "c.*")
        out = one if out is None else out.unionByName(one)
    return out


@query
def src_name_parts(spark, sf):
    stem = F.when(F.col("c_nationkey") < 5, F.col("c_name")).otherwise(
        F.concat_ws("_", "c_mktsegment", "c_name", F.lit("2024"))
    )
    path = F.concat(F.lit("/in/"), stem, F.lit(".csv"))
    df = table(spark, sf, "customer").select("c_custkey", names.file_stem(path).alias("stem"))
    schema_name, table_name = names.name_parts(F.col("stem"))
    return df.select("c_custkey", "stem", schema_name.alias("schema_name"), table_name.alias("table_name"))


@query
def src_text_head(spark, sf):
    mark = F.when(F.col("lang") == "es", files.PROCESSED_MARK).otherwise("")
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), mark, F.lit(".txt"))
    return files.read_text_heads(spark, inputs.stage_documents(spark, sf, name=name))


@query
def src_limit_intake(spark, sf):
    docs = table(spark, sf, "documents").select(inputs.file_name(F.col("doc_id")).alias("name"), "n_chars")
    return files.intake(docs, "name")


@query
def src_attachments(spark, sf):
    found = files.attachments(files.list_files(spark, *inputs.stage_documents(spark, sf)))
    return found.select("name", "size", "checksum", "content_name", "mimetype")


@query
def src_doc_kind(spark, sf):
    magic = F.when(F.col("lang") == "de", "%PDF-1.7 ").when(F.col("lang") == "fr", "GIF89a ").otherwise("")
    folders = inputs.stage_documents(spark, sf, text=F.concat(magic, "text"))
    return files.document_kinds(files.list_files(spark, *folders)).select("name", "kind")


@query
def src_jdbc_documents(spark, sf):
    docs = documents.read_documents(spark, f"{sf}/documents.parquet")
    return docs.select("doc_id", "lang", "source", "n_chars", F.sha2("text", 256).alias("text_sha"))


@query
def src_json_metadata(spark, sf):
    path = new_folder(spark, "metadata-json")
    catalogue = inputs.csv_catalogue(spark, sf, "relational")
    schema_docs.metadata_json(catalogue, inputs.APPLICATION, "SAP", "SAP").write.text(path)
    return documents.read_metadata_json(spark, path)


@query
def src_zip_check(spark, sf):
    """Valid and broken packages of a folder, and whether the newest valid one is found though broken ones are newer."""
    docs, refs = inputs.package_documents(spark, sf)
    found = files.list_files(spark, *inputs.stage_documents(spark, sf))
    folder = new_folder(spark, "zips")
    stored(packages.write_packages(packages.with_package_files(docs, refs, found), folder, inputs.HOLDING), "written")
    inputs.write_broken_zips(spark, sf, folder)
    checked = stored(files.check_zips(files.list_files(spark, folder)), "checked")
    newest = files.newest_valid_zip(checked)
    return checked.agg(
        F.count_if("valid").alias("valid_zips"),
        F.count_if(~F.col("valid")).alias("broken_zips"),
        F.max((F.col("path") == newest) & F.col("valid")).alias("newest_is_valid"),
    )


@query
def src_json_config(spark, sf):
    fields = documents.json_fields(F.col("props"), "k int")
    return table(spark, sf, "events").select("event_id", fields["k"].alias("k"))


# Sinks


@query
def sink_xml_chunks(spark, sf):
    return inputs.order_documents(spark, sf).drop("payload")


@query
def sink_delivery_ledger(spark, sf):
    """Every try of a first run, where some chunks fail, and of a second one."""
    docs = inputs.order_documents(spark, sf)
    path = new_folder(spark, "ledger")
    ledgers.deliver(docs, path, inputs.flaky_transport)
    return ledgers.deliver(docs, path, inputs.accepting_transport)


def _first_run(spark, sf):
    return ledgers.deliver(inputs.order_documents(spark, sf), new_folder(spark, "ledger"), inputs.flaky_transport)


@query
def sink_run_metrics(spark, sf):
    totals = aggregates.delivery_totals(_first_run(spark, sf))
    run = ledgers.run_metrics(totals, "archive_orders", "run-1", "2025-07-09 10:00:00+00")
    path = new_folder(spark, "metrics")
    ledgers.append_metrics(run, path)
    table_ = ledgers.append_metrics(run, path)
    return table_.select("id", "dag_id", "run_id", "records_processed", "records_successful", "records_failed")


@query
def sink_json_report(spark, sf):
    meta = stored(inputs.documents_meta(spark, sf), "meta")
    columns = {
        "document_types": "document_type",
        "document_status": "document_status",
        "sensitivity_labels": "sensitivity_labels",
        "retention_policies": "retention_policies",
    }
    reports = {name: tables.shares_document(aggregates.shares(meta, c)) for name, c in columns.items()}
    root = new_folder(spark, "reports")
    tables.write_reports(reports, root, inputs.STAMP)
    out = None
    for name in reports:
        one = spark.read.text(f"{root}/{name}").select(F.lit(name).alias("analysis"), F.col("value").alias("report"))
        out = one if out is None else out.unionByName(one)
    return out


@query
def sink_csv_dump(spark, sf):
    path = new_folder(spark, "dump")
    meta = inputs.documents_meta(spark, sf).select(
        "doc_id", "filename", "folder_path", "document_type", "sensitivity_labels", "version"
    )
    tables.dump_csv(meta, path)
    return csv_tables.read_csv_strings(spark, path)


@query
def sink_pdi_json(spark, sf):
    """Records with nested attachments, written as JSON lines and read back flat."""
    rows = inputs.records(spark, sf)
    cell = F.concat_ws("; ", "attachment", "second_attachment")
    refs = att.path_references(rows, "doc_id", values.split_paths(cell))
    matched = att.with_files(refs, inputs.attached_files(spark, sf, absent_lang="es"))
    path = new_folder(spark, "pdi-json")
    att.write_records_json(rows, "doc_id", inputs.META_COLUMNS, matched, path)
    back = spark.read.schema(att.RECORD_JSON.format(meta="doc_id bigint, lang string")).json(path)
    return back.select("doc_id", "lang", F.posexplode("Attachments.Attachment").alias("slot", "a")).select(
        "doc_id", "lang", "slot", "a.mimetype", "a.Size", "a.EASFile", "a.checksum", "a.FilePath"
    )


@query
def sink_enrich_append(spark, sf):
    path = new_folder(spark, "enrichment")
    found = enrichment.intents(inputs.texts(spark, sf)).select(
        inputs.file_name(F.col("doc_id")).alias("filename"), "intent"
    )
    stamp = F.lit("2025-07-09 12:00:00").cast("timestamp")
    out = tables.append_enrichment(found, path, created_at=stamp)
    return out.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))


def _points(spark, sf, text):
    points = table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").alias("vector"), text.alias("text"),
        F.concat(F.lit("label_"), F.col("label").cast("string")).alias("source_file"),
    )
    return vectors.points(points, "source_file", "vec_id")


@query
def sink_vector_upsert(spark, sf):
    """The same points twice and some with new texts: ids repeat only where nothing changed."""
    collection = new_folder(spark, "collection")
    plain = _points(spark, sf, F.concat(F.lit("chunk "), F.col("vec_id").cast("string")))
    label = F.when(F.col("label") < 5, "part ").otherwise("chunk ")
    second = _points(spark, sf, F.concat(label, F.col("vec_id").cast("string")))
    vectors.upsert_points(plain, collection, "v1")
    merged = vectors.upsert_points(second, collection, "v2", "v1")
    return merged.select("id", "text", "source_file", F.size("vector").alias("dimensions"))


@query
def sink_package_zip(spark, sf):
    docs, refs = inputs.package_documents(spark, sf)
    found = files.list_files(spark, *inputs.stage_documents(spark, sf))
    with_files = packages.with_package_files(docs, refs, found)
    written = packages.write_packages(with_files, new_folder(spark, "zips"), inputs.HOLDING)
    return stored(written, "written").select("package_id", "files", "error")


@query
def sink_upsert(spark, sf):
    current = inputs.users(spark, sf).select(
        "id", "username", "role", "is_active", F.lit("2020-01-01").alias("created_at"),
        F.lit("2020-01-01").alias("updated_at"),
    )
    incoming = table(spark, sf, "orders").select(
        (F.col("o_custkey") * 2).alias("id"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("username"),
        F.when(F.col("o_orderstatus") == "P", "admin").alias("role"),
        F.lit(None).cast("boolean").alias("is_active"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("created_at"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated_at"),
        "o_orderkey",
    )
    out = None
    for mode in ("update", "ignore", "replace"):
        merged = tables.upsert(
            current, incoming, ["id"], mode, "o_orderkey", tables.USER_DEFAULTS, F.lit("2025-07-09"), ["created_at"]
        ).withColumn("mode", F.lit(mode))
        out = merged if out is None else out.unionByName(merged)
    return out


@query
def sink_replace_load(spark, sf):
    root = new_folder(spark, "load")
    names_ = ("customer", "orders")
    old = {  # other keys, which must all be gone
        "customer": table(spark, sf, "customer").withColumn("c_custkey", -F.col("c_custkey")),
        "orders": table(spark, sf, "orders").withColumn("o_orderkey", -F.col("o_orderkey")),
    }
    tables.replace_load(old, root)
    tables.replace_load({n: table(spark, sf, n) for n in names_}, root)
    customers = tables.read_loaded(spark, root, "customer").select(F.col("c_custkey").alias("key"))
    orders = tables.read_loaded(spark, root, "orders").select(F.col("o_orderkey").alias("key"))
    tagged = [customers.withColumn("table_name", F.lit("customer")), orders.withColumn("table_name", F.lit("orders"))]
    return tagged[0].unionByName(tagged[1])


# Projections, filters, scalars


@query
def prj_element_names(spark, sf):
    part = table(spark, sf, "part")
    padded = F.concat(F.lit(" "), "p_name", F.lit(" "), "p_type", F.lit(" "))
    return part.select("p_partkey", names.element_name_col(padded).alias("element"))


@query
def prj_reserved_suffix(spark, sf):
    kind = F.col("event_type")
    name = F.when(kind == "click", "Type").when(kind == "view", "complexType").when(kind == "error", "sequence")
    return table(spark, sf, "events").select(
        "event_id", names.reserved_suffix(F.coalesce(name, kind)).alias("field")
    )


@query
def prj_split_columns(spark, sf):
    rows = inputs.records(spark, sf).withColumnRenamed("second_attachment", "Second Attachment")
    meta, attached = names.attachment_columns(rows.columns)
    kinds = {**dict.fromkeys(meta, "metadata"), **dict.fromkeys(attached, "attachment")}
    main = names.attachment_column(rows.columns)
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("name"), F.lit(kinds[c]).alias("kind"), F.lit(c == main).alias("main"),
                F.count_if(F.col(f"`{c}`").cast("string") != "").alias("filled"),
            )
            for c in rows.columns
        ]
    )
    return rows.agg(cells.alias("c")).select(F.explode("c").alias("c")).select("c.*")


@query
def flt_valid_rows(spark, sf):
    """Rows of a raw CSV: those of status F lost a cell, those of status O are blank."""
    status = F.col("o_orderstatus")
    key = F.col("o_orderkey").cast("string")
    raw = F.when(status == "F", key).when(status == "O", F.lit(",,")).otherwise(
        F.concat_ws(",", key, status, "o_orderpriority")
    )
    lines = table(spark, sf, "orders").select(raw.alias("raw"))
    cells = F.split("raw", ",", -1)
    rows = lines.select("raw", *[F.get(cells, i).alias(c) for i, c in enumerate(("a", "b", "c"))])
    return csv_tables.valid_rows(rows, "raw").select("a", "b", "c")


@query
def scl_split_paths(spark, sf):
    a, b = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    status = F.col("o_orderstatus")
    cell = (
        F.when(status == "F", F.concat(a, F.lit(".pdf; "), b, F.lit("|x.txt;;")))
        .when(status == "O", F.concat(a, F.lit(".pdf | "), b, F.lit(".txt| ")))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
        .otherwise(F.concat(F.lit(" "), a))
    )
    parts = values.split_paths(cell)
    return table(spark, sf, "orders").select(
        "o_orderkey", F.size(parts).alias("paths"), F.array_join(parts, ">").alias("joined")
    )


@query
def scl_basename(spark, sf):
    path = F.concat(F.lit("/archive/"), "source", F.lit("/"), "lang", F.lit("/"), inputs.file_name(F.col("doc_id")))
    return table(spark, sf, "documents").select("doc_id", names.base_name(path).alias("name"))


@query
def scl_mime(spark, sf):
    kind = F.col("event_type")
    ending = (
        F.when(kind == "click", ".pdf").when(kind == "view", ".JPG").when(kind == "error", ".log.txt")
        .when(kind == "signup", "").otherwise(".unknown")
    )
    name = F.concat(F.lit("a.b/file"), F.col("event_id").cast("string"), ending)
    return table(spark, sf, "events").select("event_id", values.media_type(name).alias("mimetype"))


@query
def scl_strip_think(spark, sf):
    text = F.concat(
        F.lit("<think>"), "text", F.lit("</think>\n"), "text", F.lit(" <think>a\nb</think>"), "source", F.lit("\n")
    )
    return inputs.texts(spark, sf).select("doc_id", values.strip_think(text).alias("text"))


@query
def scl_format_month(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        values.month_label(F.col("o_orderdate")).alias("month"),
        values.iso_label(F.col("o_orderdate")).alias("stamp"),
    )


@query
def scl_parse_run_ts(spark, sf):
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", F.lit("not yet"))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "click", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )
    stamp = values.parse_run_timestamp(F.concat(text, F.lit("+00")))
    return table(spark, sf, "events").select("event_id", F.unix_micros(stamp).alias("micros"))


@query
def scl_type_map(spark, sf):
    catalogue = inputs.csv_catalogue(spark, sf, "relational")
    mapped = values.mapped_types(catalogue.drop("type_length"))
    return mapped.select("table_name", "ordinal", "name", "json_type", "json_format", "xsd_type", "type_length")


@query
def scl_fill_null(spark, sf):
    meta = inputs.documents_meta(spark, sf)
    kept = values.drop_missing(meta, ["document_type", "creator"])
    filled = values.fill_unknown(kept, ["sensitivity_labels", "retention_policies"])
    return filled.select("doc_id", "document_type", "creator", "sensitivity_labels", "retention_policies")


@query
def prj_run_metrics_view(spark, sf):
    metrics = table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("dag_id"),
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("execution_date"),
        F.col("user_id").alias("records_processed"),
        F.when(F.col("event_type") == "error", F.col("user_id")).otherwise(F.lit(0)).alias("records_failed"),
    )
    return ledgers.run_metrics_view(metrics)


@query
def scl_ids(spark, sf):
    doc, source = F.col("doc_id").cast("string"), F.col("source")
    return table(spark, sf, "documents").select(
        "doc_id",
        names.schema_urn(F.upper(source)).alias("urn"),
        names.ten_digit_id(source, doc).alias("package_number"),
        names.uuid_shaped(source, doc, F.col("text")).alias("point_id"),
    )


# Joins


@query
def join_age_bins(spark, sf):
    return aggregates.age_bins(spark, aggregates.age_counts(table(spark, sf, "orders"), "o_orderdate", AS_OF))


def _refs(spark, sf):
    return att.references(inputs.records(spark, sf), "doc_id", inputs.ATTACHMENT_COLUMNS)


@query
def join_attachments(spark, sf):
    return att.with_files(_refs(spark, sf), inputs.attached_files(spark, sf, absent_lang="es"))


@query
def join_missing_attachments(spark, sf):
    return att.missing_files(_refs(spark, sf), inputs.attached_files(spark, sf, absent_lang="es"))


@query
def join_export_route(spark, sf):
    docs = table(spark, sf, "documents")
    requests = docs.select("doc_id", F.col("source").alias("table_name"))
    routes = docs.filter(F.col("source") != "src0").select(F.col("source").alias("table_name")).distinct()
    target = F.concat(F.lit("https://archive.example.org/export/"), "table_name")
    return lookups.export_routes(requests, routes.withColumn("destination", target))


@query
def join_catalog_path(spark, sf):
    """Paths asked for by orders; finished orders ask for a table, schema or application that is not there."""
    customers = table(spark, sf, "customer")
    tenants = table(spark, sf, "region").select(F.col("r_regionkey").alias("id"), F.col("r_regionkey").alias("ord"))
    applications = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_regionkey").alias("tenant_id"), F.col("n_name").alias("name")
    )
    base = F.concat_ws("/", F.col("c_nationkey").cast("string"), "c_mktsegment")
    located = customers.select(
        F.col("c_nationkey").alias("application_id"), F.col("c_mktsegment").alias("ord"), base.alias("database_id"),
        F.concat(F.lit("S"), F.substring("c_name", -1, 1)).alias("schema_name"), "c_name", "c_custkey",
    ).withColumn("schema_id", F.concat_ws("/", "database_id", "schema_name"))
    databases = located.select("application_id", "ord", F.col("database_id").alias("id")).distinct()
    schemas = located.select(
        F.col("schema_id").alias("id"), "database_id", F.col("schema_name").alias("name")
    ).distinct()
    tables_ = located.select(
        F.col("c_custkey").alias("id"), "schema_id", F.col("c_name").alias("name"),
        F.concat(F.lit("/tables/"), F.col("c_custkey").cast("string")).alias("href"),
    )
    paths = lookups.catalogue_paths(tenants, applications, databases, schemas, tables_)
    priority = F.col("o_orderpriority")
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority")
    asked = join_unique(orders, located.select("c_custkey", "application_id", "schema_name", "c_name"), "c_custkey")
    requests = asked.join(
        applications.select(F.col("id").alias("application_id"), F.col("name").alias("nation")), "application_id"
    ).select(
        F.when(priority == "1-URGENT", "NOWHERE").otherwise(F.col("nation")).alias("application"),
        F.when(priority == "2-HIGH", "S").otherwise(F.col("schema_name")).alias("schema_name"),
        F.when(priority == "3-MEDIUM", "none").otherwise(F.col("c_name")).alias("table_name"),
    )
    return lookups.resolve_paths(requests, paths)


# Aggregations


@query
def agg_share_by_type(spark, sf):
    return aggregates.shares(table(spark, sf, "events"), "event_type")


@query
def agg_share_by_status(spark, sf):
    return aggregates.shares(table(spark, sf, "orders"), "o_orderstatus")


@query
def agg_share_by_sensitivity(spark, sf):
    return aggregates.shares(inputs.documents_meta(spark, sf), "sensitivity_labels")


@query
def agg_share_by_retention(spark, sf):
    return aggregates.shares(inputs.documents_meta(spark, sf), "retention_policies")


@query
def agg_classification(spark, sf):
    return aggregates.shares(table(spark, sf, "documents"), "source", ordered=False)


@query
def agg_age_histogram(spark, sf):
    return aggregates.age_counts(table(spark, sf, "orders"), "o_orderdate", AS_OF)


@query
def agg_monthly_volume(spark, sf):
    return aggregates.monthly_volume(table(spark, sf, "orders"), "o_orderdate")


@query
def agg_completeness(spark, sf):
    return aggregates.completeness(
        inputs.documents_meta(spark, sf), ["document_type", "creator", "retention_policies", "sensitivity_labels"]
    )


@query
def agg_duplicates(spark, sf):
    texts = aggregates.duplicates(table(spark, sf, "documents"), ["text"]).withColumn("keys", F.lit("text"))
    paths = aggregates.duplicates(inputs.documents_meta(spark, sf), ["folder_path", "filename"])
    urls = aggregates.duplicates(table(spark, sf, "pages"), ["url"]).withColumn("keys", F.lit("url"))
    return texts.unionByName(paths.withColumn("keys", F.lit("path"))).unionByName(urls)


@query
def agg_infer_relational(spark, sf):
    lax, strict = inputs.csv_catalogues(spark, sf, "relational", "strict")
    return lax.withColumn("mode", F.lit("lax")).unionByName(strict.withColumn("mode", F.lit("strict")))


@query
def agg_infer_json(spark, sf):
    return inputs.csv_catalogue(spark, sf, "json")


@query
def agg_infer_xsd(spark, sf):
    return inputs.csv_catalogue(spark, sf, "xsd")


@query
def agg_record_counts(spark, sf):
    read = csv_tables.read_csv_folder(spark, inputs.csv_folder(spark, sf))
    return aggregates.record_counts(read, inputs.CHUNK)


@query
def agg_delivery_totals(spark, sf):
    return aggregates.delivery_totals(_first_run(spark, sf))


@query
def agg_package_study(spark, sf):
    rows = inputs.records(spark, sf)
    matched = att.with_files(_refs(spark, sf), inputs.attached_files(spark, sf))
    return att.package_study(rows, matched)


@query
def agg_user_summary(spark, sf):
    return aggregates.user_summary(inputs.users(spark, sf))


@query
def agg_aiu_count(spark, sf):
    docs, _ = inputs.package_documents(spark, sf)
    counted = att.counted_records(F.col("payload"))
    checked = F.when(counted > 0, counted).otherwise(F.raise_error(F.lit("no records in a payload")).cast("bigint"))
    return docs.select("package_id", "aiu_count", checked.alias("counted"))


# Windows, packing, ordering, sets


@query
def win_chunk_assign(spark, sf):
    return assign_chunks(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], inputs.CHUNK)


def _packed_sizes(spark, sf):
    sizes = table(spark, sf, "documents").select("doc_id", packing.record_size(F.col("n_chars")).alias("size"))
    return packing.pack_greedy(sizes, ["doc_id"], "size", inputs.PACKAGE_BYTES, inputs.PACKAGE_ROWS)


@query
def win_pack_greedy(spark, sf):
    return _packed_sizes(spark, sf)


@query
def srt_orderings(spark, sf):
    """Newest document per folder, folders by size then name."""
    meta = inputs.documents_meta(spark, sf)
    newest = F.max_by("doc_id", F.struct("last_modified", "doc_id"))
    return (
        meta.groupBy("folder_path")
        .agg(F.count("*").alias("documents"), newest.alias("newest"))
        .orderBy(F.desc("documents"), "folder_path")
    )


@query
def set_distinct_attachments(spark, sf):
    _, matched, packed = inputs.packed_records(spark, sf)
    return att.package_files(matched, packed, "doc_id")


@query
def set_table_counts(spark, sf):
    names_ = ("customer", "documents", "lineitem", "orders")
    return aggregates.record_counts({n: table(spark, sf, n) for n in names_}, inputs.CHUNK).drop("chunk_count")


# Data quality


@query
def dq_checks(spark, sf):
    return quality.count_violations(inputs.users(spark, sf), quality.user_rules())


@query
def dq_unique(spark, sf):
    ids = quality.duplicate_keys(inputs.users(spark, sf), ["username"]).select(
        F.lit("username").alias("key"), F.col("username").alias("value"), "occurrences"
    )
    runs = quality.duplicate_keys(table(spark, sf, "events"), ["event_type", "user_id"]).select(
        F.lit("run").alias("key"), F.concat_ws("/", "event_type", F.col("user_id").cast("string")).alias("value"),
        "occurrences",
    )
    return ids.unionByName(runs)


@query
def dq_self_fk(spark, sf):
    return quality.dangling_references(inputs.users(spark, sf), "created_by")


@query
def dq_xsd_rows(spark, sf):
    """Order records against an XSD inferred from the export; records of status F carry a broken price."""
    from vellumark.functions.xml import element, wrapped

    folder = inputs.orders_csv(spark, sf)
    rows = csv_tables.read_csv_strings(spark, folder).drop("order priority", "mixed")
    price = F.when(F.col("o_orderstatus") == "F", F.concat("o_totalprice", F.lit(" EUR"))).otherwise(
        F.col("o_totalprice")
    )
    rows = rows.withColumns({"o_totalprice": price, "o_orderdate": F.replace("o_orderdate", F.lit(" "), F.lit("T"))})
    types = {
        "o_orderkey": "xs:long", "o_custkey": "xs:long", "o_orderstatus": "xs:string",
        "o_totalprice": "xs:decimal", "o_orderdate": "xs:dateTime",
    }
    xsd = quality.write_record_xsd(spark, types, new_folder(spark, "record-xsd"))
    record = wrapped("Record", *[element(c, F.col(c)) for c in types])
    checked = quality.validate_records(
        rows.select("o_orderkey", record.alias("xml")), "xml", xsd, ", ".join(f"{c} string" for c in types)
    )
    return checked.select("o_orderkey", "valid")


# Schema documents


@query
def doc_metadata_json(spark, sf):
    catalogue = inputs.csv_catalogue(spark, sf, "relational")
    return schema_docs.metadata_json(catalogue, inputs.APPLICATION, "SAP", "SAP")


@query
def doc_metadata_xml(spark, sf):
    return schema_docs.metadata_xml(inputs.csv_catalogue(spark, sf, "relational"), "SAP", "SAP")


def _json_schemas(catalogue):
    kind = F.when(F.col("name") == "attachment", "attachment").otherwise(F.col("type"))
    return schema_docs.json_schemas(catalogue.withColumn("type", kind))


@query
def doc_json_schema(spark, sf):
    return _json_schemas(inputs.csv_catalogue(spark, sf, "json"))


@query
def doc_xsd(spark, sf):
    """Both ways to an XSD: from inferred types, and from the JSON schemas."""
    by_xsd, by_json = inputs.csv_catalogues(spark, sf, "xsd", "json")
    direct = schema_docs.xsd_from_catalogue(by_xsd, inputs.HOLDING)
    converted = schema_docs.xsd_from_json_schemas(
        _json_schemas(by_json), inputs.HOLDING, always_string=values.ALWAYS_STRING
    )
    return direct.withColumn("origin", F.lit("types")).unionByName(converted.withColumn("origin", F.lit("json")))


@query
def doc_xsd_columns(spark, sf):
    direct = schema_docs.xsd_from_catalogue(inputs.csv_catalogue(spark, sf, "xsd"), inputs.HOLDING)
    return schema_docs.xsd_columns(direct)


# Packages


@query
def pkg_payload_xml(spark, sf):
    docs, _ = inputs.package_documents(spark, sf)
    return docs.select("package_id", "payload")


@query
def pkg_descriptor(spark, sf):
    docs, _ = inputs.package_documents(spark, sf)
    return docs.select("package_id", "id", "aiu_count", "descriptor")


@query
def pkg_summary(spark, sf):
    return packing.package_summary(_packed_sizes(spark, sf))


# Text chunks


@query
def chunk_fixed(spark, sf):
    return text_chunks.chunks(inputs.texts(spark, sf), "fixed")


@query
def chunk_sentence(spark, sf):
    return text_chunks.chunks(inputs.texts(spark, sf), "sentence")


@query
def chunk_heading(spark, sf):
    return text_chunks.chunks(inputs.structured_texts(spark, sf), "heading")


@query
def chunk_hybrid(spark, sf):
    """Texts with headings, and the same texts as one line under one heading."""
    texts = inputs.structured_texts(spark, sf)
    flat = inputs.texts(spark, sf).select(
        (-F.col("doc_id") - 1).alias("doc_id"), F.concat(F.lit("# "), F.translate("text", "\n", " ")).alias("text")
    )
    return text_chunks.chunks(texts.unionByName(flat), "hybrid")


@query
def chunk_paragraph(spark, sf):
    return text_chunks.chunks(inputs.structured_texts(spark, sf), "paragraph")


@query
def chunk_semantic(spark, sf):
    return text_chunks.chunks(inputs.structured_texts(spark, sf), "semantic")


# Vectors


@query
def vec_embed(spark, sf):
    chunks = text_chunks.chunks(inputs.texts(spark, sf), "fixed")
    millionths = F.transform("vector", lambda x: F.round(x.cast("double") * 1_000_000).cast("bigint").cast("string"))
    return vectors.embed(chunks).select("doc_id", "chunk_no", F.array_join(millionths, ",").alias("vector"))


@query
def vec_points(spark, sf):
    points = _points(spark, sf, F.concat(F.lit("chunk "), F.col("vec_id").cast("string")))
    return points.select("id", "text", "source_file", F.size("vector").alias("dimensions"))


@query
def vec_quantize_int8(spark, sf):
    coded = vectors.quantize_int8(table(spark, sf, "embeddings").select("vec_id", "embedding"), "embedding")
    codes = F.array_join(F.transform("code", lambda c: c.cast("string")), ",")
    return coded.select("vec_id", codes.alias("codes"), F.round("max_error", 9).alias("max_error"))


@query
def vec_cosine_topk(spark, sf):
    """The ten vectors nearest to the mean vector of each label."""
    vecs = table(spark, sf, "embeddings")
    at = vecs.select("label", F.posexplode("embedding").alias("at", "x"))
    means = at.groupBy("label", "at").agg(F.avg(F.col("x").cast("double")).alias("m"))
    centres = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("at", "m"))).alias("v"))
    centres = centres.select("label", F.transform("v", lambda p: p["m"]).alias("vector"))
    return vectors.cosine_topk(vecs, centres, 10, "vec_id", "embedding", "label", "vector")


# Enrichment and models


@query
def enr_summary(spark, sf):
    return enrichment.summaries(inputs.texts(spark, sf))


@query
def enr_keywords(spark, sf):
    return enrichment.keywords(inputs.texts(spark, sf))


@query
def enr_topic(spark, sf):
    return enrichment.topics(inputs.texts(spark, sf))


@query
def enr_entities(spark, sf):
    docs = inputs.texts(spark, sf).select((-F.col("doc_id") - 1).alias("doc_id"), "text")
    return enrichment.entities(docs.unionByName(inputs.order_notes(spark, sf)), inputs.gazetteer(spark, sf))


@query
def enr_pii(spark, sf):
    return enrichment.personal_data(inputs.texts(spark, sf))


@query
def enr_intent(spark, sf):
    return enrichment.intents(inputs.texts(spark, sf))


@query
def enr_synonyms(spark, sf):
    return enrichment.synonyms(inputs.texts(spark, sf))


@query
def ml_outliers(spark, sf):
    found = outliers.forest_outliers(stored(inputs.documents_meta(spark, sf), "meta"), "doc_id")
    return found.select("doc_id", "filename", "creator", "score")


@query
def ml_rarity_outliers(spark, sf):
    found = outliers.rarity_outliers(stored(inputs.documents_meta(spark, sf), "meta"))
    return found.select("doc_id", "filename", "creator", "score")


@query
def ml_knn_label(spark, sf):
    return label_suggestions.suggest_labels(stored(inputs.documents_meta(spark, sf), "meta"), "doc_id")


# Streaming


@query
def stream_intake(spark, sf):
    """Orders files taken by two runs over the same checkpoint."""
    folder = inputs.orders_csv(spark, sf)
    columns = csv_tables.read_csv_strings(spark, folder).columns
    checkpoint, out = new_folder(spark, "intake-checkpoint"), new_folder(spark, "intake")
    take_files(csv_stream(spark, folder, columns, 4), checkpoint, out)
    taken = take_files(csv_stream(spark, folder, columns, 4), checkpoint, out)
    return taken.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "mixed")


@query
def stream_chunk_export(spark, sf):
    """Totals of a streamed export, run again after a lost checkpoint."""
    folder = inputs.orders_csv(spark, sf)
    columns = csv_tables.read_csv_strings(spark, folder).columns
    ledger = new_folder(spark, "stream-ledger")
    for _ in range(2):
        stream = csv_stream(spark, folder, columns, 4)
        out = export_stream(
            stream, new_folder(spark, "export-checkpoint"), ledger, inputs.accepting_transport, "SALES", "orders",
            inputs.CHUNK,
        )
    entries = out.agg(F.count("*").alias("entries"), F.count_distinct("batch_id", "chunk_id").alias("chunks"))
    totals = aggregates.delivery_totals(out)
    return totals.withColumn("repeated_entries", entries.select(F.col("entries") - F.col("chunks")).scalar())
