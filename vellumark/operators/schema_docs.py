"""Schema documents rendered from catalogue rows, many tables per job.

Catalogue rows are (table_name, ordinal, name, type, type_length, record_count).
A task holds the columns of one table; only finished tables meet in the one
document an application has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumark.functions.formats import (
    ATTACHMENTS_JSON,
    DRAFT,
    SCHEMA_VERSION,
    XSD_ATTACHMENTS,
    XSD_HEAD,
    XSD_TAIL,
)
from vellumark.functions.names import element_name_col, schema_urn_text
from vellumark.functions.values import XSD_NUMBERS
from vellumark.functions.xml import element, escape_text, ordered_text, wrapped
from vellumark.session import stored


def metadata_json(
    catalogue: DataFrame, application: str, schema: str, default_schema: str, locale: str = "en-US"
) -> DataFrame:
    """document: the metadata JSON of an application, tables in name order."""
    columns = F.sort_array(
        F.collect_list(F.struct("ordinal", "name", "type", F.col("type_length").alias("typeLength")))
    )
    tables = catalogue.groupBy("table_name").agg(
        columns.alias("c"), F.max("record_count").alias("record_count")
    )
    entry = F.struct(
        "table_name",
        F.transform("c", lambda c: F.struct(c["name"], c["type"], c["typeLength"])).alias("columns"),
        "record_count",
    )
    whole = tables.agg(F.sort_array(F.collect_list(F.struct("table_name", entry.alias("t")))).alias("t"))
    settings = {
        "schema_name": schema, "default_schema": default_schema, "locale": locale, "application_name": application,
    }
    return whole.select(
        F.to_json(
            F.struct(
                *[F.lit(v).alias(k) for k, v in settings.items()],
                F.transform("t", lambda t: t["t"]).alias("tables"),
            )
        ).alias("document")
    )


def table_metadata_xml(catalogue: DataFrame) -> DataFrame:
    """table_name, xml: the tableMetadata element of each table."""
    column = wrapped(
        "column",
        element("name", F.col("name")),
        element("ordinal", F.col("ordinal")),
        element("type", F.col("type")),
        element("typeLength", F.col("type_length")),
        element("indexing", F.lit("VALUE")),
    )
    return (
        catalogue.withColumn("_x", column)
        .groupBy("table_name")
        .agg(ordered_text(F.col("ordinal"), F.col("_x")).alias("_x"), F.max("record_count").alias("_n"))
        .select(
            "table_name",
            wrapped(
                "tableMetadata",
                element("name", F.col("table_name")),
                element("recordCount", F.col("_n")),
                wrapped("columnList", F.col("_x")),
            ).alias("xml"),
        )
    )


def metadata_xml(catalogue: DataFrame, schema: str, default_schema: str, locale: str = "en-US") -> DataFrame:
    """document: the metadata XML of a schema, tables in name order."""
    tables = table_metadata_xml(catalogue).agg(
        ordered_text(F.col("table_name"), F.col("xml")).alias("x"), F.count("*").alias("n")
    )
    body = wrapped(
        "metadata",
        element("defaultSchema", F.lit(default_schema)),
        element("locale", F.lit(locale)),
        wrapped(
            "schemaMetadataList",
            wrapped(
                "schemaMetadata",
                element("name", F.lit(schema)),
                element("tableCount", F.col("n")),
                wrapped("tableMetadataList", F.col("x")),
            ),
        ),
    )
    return tables.select(
        F.concat(F.lit('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'), body).alias("document")
    )


def _quoted(text: Column) -> Column:
    """Text as a JSON string."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def json_schemas(catalogue: DataFrame, root: str = "Records", child: str = "Record") -> DataFrame:
    """table_name, document: a draft-07 schema per table from json-flavour types.

    A column of type `attachment` becomes the nested attachments object.
    """
    kind = F.col("type")
    prop = (
        F.when(kind == "attachment", F.lit(ATTACHMENTS_JSON))
        .when(kind == "number", F.lit('{"type":"number"}'))
        .when(kind.isin("date", "date-time"), F.concat(F.lit('{"type":"string","format":"'), kind, F.lit('"}')))
        .otherwise(F.lit('{"type":"string"}'))
    )
    name = _quoted(F.col("name"))
    parts = catalogue.withColumns({"_p": F.concat(name, F.lit(":"), prop), "_n": name})
    grouped = parts.groupBy("table_name").agg(
        ordered_text(F.col("ordinal"), F.col("_p"), ",").alias("p"),
        ordered_text(F.col("ordinal"), F.col("_n"), ",").alias("n"),
    )
    document = F.concat(
        F.lit(f'{{"type":"object","title":"{root}","$schema":"{DRAFT}","properties":{{"{child}":{{"type":"object",'),
        F.lit('"properties":{'), F.col("p"), F.lit('},"xsd_sequence":['), F.col("n"),
        F.lit(f']}}}},"xsd_sequence":["{child}"]}}'),
    )
    return grouped.select("table_name", document.alias("document"))


_NODE = (
    "type string, format string, properties map<string,string>, xsd_sequence array<string>, "
    "xsd_extension_attributes map<string,string>, items struct<type:string,format:string>"
)


def _xsd_type(json_type: Column, json_format: Column) -> Column:
    return (
        F.when(json_type == "number", "xs:decimal")
        .when((json_type == "string") & (json_format == "date-time"), "xs:dateTime")
        .when((json_type == "string") & (json_format == "date"), "xs:date")
        .otherwise("xs:string")
    )


def json_schema_rows(documents: DataFrame, child: str = "Record", always_string: tuple[str, ...] = ()) -> DataFrame:
    """Flatten JSON schemas to rows (table_name, parent, path, ordinal, name, kind, xsd_type, attributes).

    One pass per nesting level; kind is scalar, object, array or checksum.
    """
    top = documents.select("table_name", F.from_json("document", _NODE).alias("node"))
    record = top.select(
        "table_name",
        F.lit("").alias("path"),
        F.coalesce(F.from_json(F.col("node.properties")[child], _NODE), F.col("node")).alias("node"),
    )
    level, levels = record, []
    while True:
        order = F.coalesce(F.col("node.xsd_sequence"), F.map_keys("node.properties"))
        fields = level.select(
            "table_name",
            F.col("path").alias("parent"),
            F.posexplode(order).alias("ordinal", "name"),
            F.col("node.properties").alias("props"),
        ).select(
            "table_name",
            "parent",
            F.concat(F.col("parent"), F.lit("/"), F.col("name")).alias("path"),
            "ordinal",
            "name",
            F.from_json(F.col("props")[F.col("name")], _NODE).alias("node"),
        )
        fields = stored(fields, "schema-level")
        forced = F.col("name").isin(*always_string) if always_string else F.lit(False)
        is_object = ~forced & (F.col("node.type") == "object") & F.col("node.properties").isNotNull()
        is_array = ~forced & (F.col("node.type") == "array") & F.col("node.items").isNotNull()
        is_checksum = (F.col("name") == "checksum") & F.col("node.xsd_extension_attributes").isNotNull()
        kind = (
            F.when(is_object, "object").when(is_checksum, "checksum").when(is_array, "array").otherwise("scalar")
        )
        item = F.col("node.items")
        typed = (
            F.when(forced, "xs:string")
            .when(is_array, _xsd_type(item["type"], item["format"]))
            .otherwise(_xsd_type(F.col("node.type"), F.col("node.format")))
        )
        levels.append(
            fields.select(
                "table_name", "parent", "path", "ordinal", "name", kind.alias("kind"), typed.alias("xsd_type"),
                F.col("node.xsd_extension_attributes").alias("attributes"),
            )
        )
        level = fields.filter(is_object).select("table_name", "path", "node")
        if level.isEmpty():
            break
    rows = levels[0]
    for more in levels[1:]:
        rows = rows.unionByName(more)
    return rows


def _lines(pad: int, *lines: Column | str) -> Column:
    """Lines at a common indent, each ended by a line break."""
    parts = []
    for line in lines:
        parts += [F.lit(" " * pad), F.lit(line) if isinstance(line, str) else line, F.lit("\n")]
    return F.concat(*parts)


_CLOSE_FIELDS = ("    </xs:sequence>", "  </xs:complexType>", "</xs:element>")


def _field_xsd(depth: int, children: Column) -> Column:
    """XSD text of one row of `json_schema_rows`; children is the text of what it contains."""
    pad = 14 + 6 * depth
    name = escape_text(element_name_col(F.col("name")))
    plain = F.concat(F.lit('<xs:element name="'), name, F.lit('" type="'), F.col("xsd_type"))
    start = F.concat(F.lit('<xs:element name="'), name, F.lit('">'))
    attributes = F.array_join(
        F.transform(
            F.map_entries(F.coalesce("attributes", F.create_map().cast("map<string,string>"))),
            lambda a: F.concat(
                F.lit(" " * (pad + 8) + '<xs:attribute name="'), a["key"], F.lit('" type="'), a["value"],
                F.lit('" use="required"/>\n'),
            ),
        ),
        "",
    )
    checksum = F.concat(
        _lines(
            pad,
            F.concat(F.lit('<xs:element name="'), name, F.lit('" minOccurs="0">')),
            "  <xs:complexType>",
            "    <xs:simpleContent>",
            '      <xs:extension base="xs:string">',
        ),
        attributes,
        _lines(pad, "      </xs:extension>", "    </xs:simpleContent>", "  </xs:complexType>", "</xs:element>"),
    )
    nested = F.concat(
        _lines(pad, start, "  <xs:complexType>", "    <xs:sequence>"),
        F.coalesce(children, F.lit("")),
        _lines(pad, *_CLOSE_FIELDS),
    )
    return (
        F.when(F.col("kind") == "object", nested)
        .when(F.col("kind") == "checksum", checksum)
        .when(F.col("kind") == "array", _lines(pad, F.concat(plain, F.lit('" maxOccurs="unbounded"/>'))))
        .otherwise(_lines(pad, F.concat(plain, F.lit('"/>'))))
    )


def _xsd_document(fields: Column, holding: str, root: str, child: str) -> Column:
    head = XSD_HEAD.format(urn=schema_urn_text(holding), version=SCHEMA_VERSION, root=root, child=child)
    return F.concat(F.lit(head), F.coalesce(fields, F.lit("")), F.lit(XSD_TAIL))


def xsd_from_json_schemas(
    documents: DataFrame,
    holding: str,
    root: str = "Records",
    child: str = "Record",
    always_string: tuple[str, ...] = (),
) -> DataFrame:
    """table_name, xsd: JSON schemas of any depth as XSD documents, inner levels first."""
    rows = stored(json_schema_rows(documents, child, always_string), "schema-rows")
    depth = F.size(F.split("parent", "/")) - 1
    deepest = rows.agg(F.max(depth)).first()[0] or 0
    inner = None
    for d in range(deepest, -1, -1):
        here = rows.filter(depth == d)
        if inner is None:
            here = here.withColumn("children", F.lit(None).cast("string"))
        else:
            here = here.join(inner, ["table_name", "path"], "left")
        rendered = here.withColumn("x", _field_xsd(d, F.col("children")))
        inner = rendered.groupBy("table_name", F.col("parent").alias("path")).agg(
            ordered_text(F.col("ordinal"), F.col("x")).alias("children")
        )
    return inner.select("table_name", _xsd_document(F.col("children"), holding, root, child).alias("xsd"))


def xsd_from_catalogue(catalogue: DataFrame, holding: str, root: str = "Records", child: str = "Record") -> DataFrame:
    """table_name, xsd: from xsd-flavour types; the attachment column becomes the block."""
    line = _lines(
        14,
        F.concat(
            F.lit('<xs:element name="'), escape_text(element_name_col(F.col("name"))), F.lit('" type="'), F.col("type"),
            F.lit('"/>'),
        ),
    )
    text = F.when(F.col("type") == "attachment", F.lit(XSD_ATTACHMENTS)).otherwise(line)
    grouped = (
        catalogue.withColumn("_x", text)
        .groupBy("table_name")
        .agg(ordered_text(F.col("ordinal"), F.col("_x")).alias("_x"))
    )
    return grouped.select("table_name", _xsd_document(F.col("_x"), holding, root, child).alias("xsd"))


def _steps(*names: str) -> str:
    return "".join(f"/*[local-name()='{n}']" for n in names)


_RECORD_FIELDS = _steps("schema", "element", "complexType", "sequence", "element", "complexType", "sequence", "element")


def xsd_columns(documents: DataFrame) -> DataFrame:
    """XSD documents back to rows (table_name, ordinal, name, xsd_type, json_type, json_format).

    A nested field has the type `object`.
    """
    xsd = F.col("xsd")
    names = F.xpath(xsd, F.lit(f"{_RECORD_FIELDS}/@name"))
    typed = F.map_from_arrays(
        F.xpath(xsd, F.lit(f"{_RECORD_FIELDS}[@type]/@name")), F.xpath(xsd, F.lit(f"{_RECORD_FIELDS}[@type]/@type"))
    )
    rows = documents.select("table_name", typed.alias("typed"), F.posexplode(names).alias("at", "name"))
    kind = F.coalesce(F.col("typed")[F.col("name")], F.lit("object"))
    json_type = F.when(kind == "object", "object").when(kind.isin(*XSD_NUMBERS), "number").otherwise("string")
    json_format = F.when(kind == "xs:dateTime", "date-time").when(kind == "xs:date", "date")
    return rows.select(
        "table_name", (F.col("at") + 1).alias("ordinal"), "name", kind.alias("xsd_type"),
        json_type.alias("json_type"), json_format.alias("json_format"),
    )
