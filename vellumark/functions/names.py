"""Names: XML element names, table names from files, base names, ids."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumark.functions.formats import RESERVED_NAMES, SCHEMA_VERSION, URN_START
from vellumark.functions.values import stripped


def element_name(name: str) -> str:
    """Column name as an XML element name."""
    return name.strip().replace(" ", "_")


def element_name_col(col: Column) -> Column:
    return F.replace(stripped(col), F.lit(" "), F.lit("_"))


def with_element_names(df: DataFrame) -> DataFrame:
    """Rename every column to its XML element name."""
    return df.toDF(*[element_name(c) for c in df.columns])


def reserved_suffix(col: Column) -> Column:
    """Append `_field` to names an XSD reserves, whatever their case."""
    reserved = [n.lower() for n in RESERVED_NAMES]
    return F.when(F.lower(col).isin(reserved), F.concat(col, F.lit("_field"))).otherwise(col)


def record_element(name: str) -> str:
    """Column name as the element of a record: as the XSD names it, reserved names with `_field`."""
    plain = element_name(name)
    return plain + "_field" if plain.lower() in {n.lower() for n in RESERVED_NAMES} else plain


def base_name(col: Column) -> Column:
    """Last component of a `/` separated path."""
    return F.substring_index(col, "/", -1)


def file_stem(col: Column) -> Column:
    """File name without folders and without the last extension."""
    return F.regexp_replace(base_name(col), r"(?<=.)\.[^.]*$", "")


def name_parts(stem: Column) -> tuple[Column, Column]:
    """(schema, table) of a `SCHEMA_TABLE[_...]` file stem."""
    parts = F.split(stem, "_")
    return F.get(parts, 0), F.coalesce(F.get(parts, 1), F.lit("Unknown"))


def name_parts_text(stem: str) -> tuple[str, str]:
    """The same for a name the driver holds."""
    parts = stem.split("_")
    return parts[0], parts[1] if len(parts) > 1 else "Unknown"


def attachment_columns(columns: Iterable[str]) -> tuple[list[str], list[str]]:
    """(metadata columns, attachment columns): the name contains "attachment"."""
    names = list(columns)
    attached = [c for c in names if "attachment" in c.lower()]
    return [c for c in names if c not in attached], attached


def attachment_column(columns: Iterable[str], preferred: str = "") -> str | None:
    """The preferred column if present, else the first called attachment(s)."""
    by_name = {}
    for c in columns:
        by_name.setdefault(c.strip().lower(), c)
    wanted = preferred.strip().lower()
    if wanted in by_name:
        return by_name[wanted]
    plain = [c for key, c in by_name.items() if key in ("attachment", "attachments")]
    return plain[0] if plain else None


def schema_urn(holding: Column) -> Column:
    return F.concat(F.lit(URN_START), F.lower(holding), F.lit(f".{SCHEMA_VERSION}"))


def schema_urn_text(holding: str, version: str = SCHEMA_VERSION) -> str:
    return f"{URN_START}{holding.lower()}.{version}"


def uuid_shaped(*parts: Column) -> Column:
    """Deterministic id in uuid form, so that a rerun gives the same id."""
    digest = F.sha2(F.concat_ws("\u001f", *parts), 256)
    cut = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, at, n) for at, n in cut])


def ten_digit_id(*parts: Column) -> Column:
    """Deterministic ten digit package id."""
    digest = F.sha2(F.concat_ws("\u001f", *parts), 256)
    number = F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")
    return (F.lit(1_000_000_000) + F.pmod(number, F.lit(9_000_000_000))).cast("string")
