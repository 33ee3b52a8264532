"""Scalar helpers over text, timestamps and type names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Media type by file extension.
MEDIA_TYPES = {
    "csv": "text/csv",
    "doc": "application/msword",
    "gif": "image/gif",
    "htm": "text/html",
    "html": "text/html",
    "jpeg": "image/jpeg",
    "jpg": "image/jpeg",
    "json": "application/json",
    "mp3": "audio/mpeg",
    "mp4": "video/mp4",
    "pdf": "application/pdf",
    "png": "image/png",
    "ppt": "application/vnd.ms-powerpoint",
    "tif": "image/tiff",
    "tiff": "image/tiff",
    "txt": "text/plain",
    "xls": "application/vnd.ms-excel",
    "xml": "text/xml",
    "zip": "application/zip",
}
DEFAULT_MEDIA_TYPE = "application/octet-stream"

# Inferred type -> (JSON type, JSON format, XSD type, length).
TYPE_NAMES = {
    "DATE": ("string", "date", "xs:date", "64"),
    "VARCHAR": ("string", None, "xs:string", "255"),
    "FLOAT": ("number", None, "xs:decimal", "64"),
    "INT": ("number", None, "xs:decimal", "64"),
    "number": ("number", None, "xs:decimal", "64"),
    "date": ("string", "date", "xs:date", "64"),
    "date-time": ("string", "date-time", "xs:dateTime", "64"),
    "string": ("string", None, "xs:string", "255"),
}
# Columns that stay strings whatever their content.
ALWAYS_STRING = ("CustomerID", "CreditCardNumber")
# XSD types that a JSON schema calls numbers.
XSD_NUMBERS = ("xs:long", "xs:decimal", "xs:int", "xs:integer", "xs:float", "xs:double")


# What counts as white space at the ends of a text.
SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def stripped(text: Column) -> Column:
    """Text without white space at its ends."""
    return F.btrim(text, F.lit(SPACE))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once, also where body uses it in a loop."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def counted(found: Column) -> Column:
    """Array of (term, n) of an array of terms: equal ones are neighbours once sorted."""

    def runs(t: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(t) - 1), lambda i: (i == 0) | (F.get(t, i) != F.get(t, i - 1))
        )
        return let(
            starts,
            lambda s: F.transform(
                s,
                lambda i, k: F.struct(
                    F.get(t, i).alias("term"),
                    (F.coalesce(F.get(s, k + 1), F.size(t)) - i).cast("bigint").alias("n"),
                ),
            ),
        )

    return let(F.sort_array(found), lambda t: F.when(F.size(t) > 0, runs(t)))


def literal_map(entries: dict[str, str | None]) -> Column:
    """Small fixed lookup as a map literal: no join, no shuffle."""
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def media_type(path: Column) -> Column:
    extension = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    return F.coalesce(literal_map(MEDIA_TYPES)[extension], F.lit(DEFAULT_MEDIA_TYPE))


def split_paths(cell: Column) -> Column:
    """Multi-valued cell to an array: split at `;`, else at `|`, else one value."""
    parts = (
        F.when(F.contains(cell, F.lit(";")), F.split(cell, ";"))
        .when(F.contains(cell, F.lit("|")), F.split(cell, r"\|"))
        .otherwise(F.array(cell))
    )
    kept = F.filter(F.transform(parts, lambda p: stripped(p)), lambda p: p != "")
    return F.coalesce(kept, F.array().cast("array<string>"))


def strip_think(text: Column) -> Column:
    """Drop `<think>...</think>` passages, also over several lines."""
    return stripped(F.regexp_replace(text, r"(?s)<think>.*?</think>", ""))


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def iso_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def parse_run_timestamp(text: Column) -> Column:
    """Timestamp with 0-6 fraction digits and an offset such as `+00`; null if unreadable."""
    return text.try_cast("timestamp")


def mapped_types(columns: DataFrame, name: str = "name", inferred: str = "type") -> DataFrame:
    """Add json_type, json_format, xsd_type and type_length to catalogue rows."""
    kind = F.when(F.col(name).isin(*ALWAYS_STRING), F.lit("string")).otherwise(F.col(inferred))
    looked_up = {
        out: literal_map({k: v[i] for k, v in TYPE_NAMES.items()})[kind]
        for i, out in enumerate(["json_type", "json_format", "xsd_type", "type_length"])
    }
    return columns.withColumns(looked_up)


def fill_unknown(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna("Unknown", subset=columns)


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)
