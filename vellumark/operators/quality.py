"""Checks derived from declared constraints."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from vellumark.sources.csv_tables import list_names


def user_rules() -> dict[str, Column]:
    """Constraints of a user table. As in SQL, a rule that is unknown holds."""
    return {
        "role_known": F.col("role").isin("admin", "user"),
        "username_length": F.length("username") >= 3,
        "email_format": F.col("email").like("%@%.%"),
        "username_given": F.col("username").isNotNull(),
        "email_given": F.col("email").isNotNull(),
    }


def count_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """rule, violations: all rules in one pass."""
    one = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    return one.unpivot([], list(rules), "rule", "violations")


def violating_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows breaking any rule, with the names of the broken rules."""
    broken = F.array_compact(F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()]))
    return df.withColumn("broken", broken).filter(F.size("broken") > 0)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their count; null keys never clash."""
    given = df.dropna(subset=list(keys))
    return given.groupBy(*keys).agg(F.count("*").alias("occurrences")).filter("occurrences > 1")


def dangling_references(df: DataFrame, reference: str, key: str = "id") -> DataFrame:
    """Values of `reference` that no row has as `key`, with the rows that use them.

    References are counted first, so one value used everywhere is one row here.
    """
    used = df.filter(F.col(reference).isNotNull()).groupBy(reference).agg(F.count("*").alias("rows"))
    known = df.select(F.col(key).alias(reference))
    return used.join(known, reference, "left_anti")


# Text of an element without markup other than the entities that `escape_text` writes.
_TEXT = r"(?:[\t\n\x20-\x25\x27-\x3b\x3d\x3f-\x7e\xa0-\x{d7ff}\x{e000}-\x{fffd}\x{10000}-\x{10ffff}]++|&(?:amp|lt|gt);)*+"
_DAY = "[12][0-9]{3}-(?:(?:0[1-9]|1[0-2])-(?:0[1-9]|1[0-9]|2[0-8])|(?:0[13-9]|1[0-2])-(?:29|30)|(?:0[13578]|1[02])-31)"
_CLOCK = r"(?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](?:\.[0-9]+)?"
_ZONE = "(?:Z|[+-](?:0[0-9]|1[0-3]):[0-5][0-9])?"
# By XSD type, texts that are of the type, and a pattern of all that could be. The XML validator decides between them.
XSD_TEXTS = {
    "xs:string": (_TEXT, _TEXT),
    "xs:long": ("[+-]?0*[0-9]{1,18}", r"[\s+0-9-]++"),
    "xs:decimal": (r"[+-]?[0-9]+(?:\.[0-9]+)?", r"[\s+0-9.-]++"),
    "xs:date": (_DAY + _ZONE, r"[\s+0-9:Z-]++"),
    "xs:dateTime": (f"{_DAY}T{_CLOCK}{_ZONE}", r"[\s+0-9:.TZ-]++"),
}
_NAME = "[A-Za-z_][A-Za-z0-9_.-]*"
_FIELD = f'<xs:element name="({_NAME})" type="(xs:[A-Za-z]+)"/>'
_FLAT = (
    f'<xs:schema xmlns:xs="http://www[.]w3[.]org/2001/XMLSchema"><xs:element name="({_NAME})"><xs:complexType>'
    f"<xs:sequence>((?:{_FIELD})+)</xs:sequence></xs:complexType></xs:element></xs:schema>\n?"
)


def _flat_record(spark: SparkSession, xsd_path: str) -> tuple[str, list[tuple[str, str]]] | None:
    """Record and (name, type) of its fields, of an XSD as `write_record_xsd` writes it, with types of XSD_TEXTS."""
    try:
        text = spark.read.text(xsd_path, wholetext=True).first()
    except AnalysisException:  # not a path of Spark's: only the validator finds it
        return None
    found = text and re.fullmatch(_FLAT, text["value"])
    fields = re.findall(_FIELD, found[2]) if found else []
    return (found[1], fields) if fields and all(kind in XSD_TEXTS for _, kind in fields) else None


def _layout(record: str, fields: Sequence[tuple[str, str, bool]]) -> str:
    """Pattern of a record whose fields, of which some may be empty elements, follow each other without anything between."""
    inner = ""
    for name, text, empty in fields:
        tag = re.escape(name)
        inner += f"(?:<{tag}>{text}</{tag}>" + (f"|<{tag} ?/>)" if empty else ")")
    return rf"\A<{re.escape(record)}>{inner}</{re.escape(record)}>\z"


def validate_records(df: DataFrame, xml: str, xsd_path: str, schema: str) -> DataFrame:
    """Add `valid`: does the record pass the XSD?  `xsd_path` must lie in a shared folder.

    The XML validator is set up anew for every record, which costs many times
    what the record does. Where the XSD is a flat sequence, plain records whose
    texts are of their types, or hold a sign that no text of the type has, are
    told by patterns; the validator sees the others, and all of another XSD.
    """
    options = {
        "rowValidationXSDPath": xsd_path,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_corrupt",
    }
    parsed = F.from_xml(F.col(xml), f"{schema}, _corrupt string", options)
    valid = parsed["_corrupt"].isNull()
    strings = all(f.dataType == StringType() for f in StructType.fromDDL(schema))  # else a value may fail to be read
    flat = _flat_record(df.sparkSession, xsd_path) if strings else None
    if flat:
        record, fields = flat
        plain = _layout(record, [(name, _TEXT, True) for name, _ in fields])
        sure, possible = (_layout(record, [(n, XSD_TEXTS[k][i], k == "xs:string") for n, k in fields]) for i in (0, 1))
        text = F.col(xml)
        valid = F.when(text.rlike(sure), True).when(text.rlike(plain) & ~text.rlike(possible), False).otherwise(valid)
    return df.withColumn("valid", valid)


def write_record_xsd(spark: SparkSession, types: Mapping[str, str], folder: str, record: str = "Record") -> str:
    """XSD of a flat record with the given XSD types; returns the path of its file."""
    fields = "".join(f'<xs:element name="{name}" type="{kind}"/>' for name, kind in types.items())
    text = (
        '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">'
        f'<xs:element name="{record}"><xs:complexType><xs:sequence>{fields}</xs:sequence></xs:complexType>'
        "</xs:element></xs:schema>"
    )
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(folder)
    return f"{folder}/{list_names(spark, folder, '.txt')[0]}"
