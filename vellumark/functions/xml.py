"""XML fragments as string expressions; they stay inside code generation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def escape_text(col: Column) -> Column:
    out = F.replace(col, F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit(">"), F.lit("&gt;"))


def element(name: str, value: Column, attributes: Mapping[str, str] | None = None) -> Column:
    """`<name>value</name>`; null and empty give an empty element."""
    attrs = "".join(f' {k}="{v}"' for k, v in (attributes or {}).items())
    text = F.coalesce(value.cast("string"), F.lit(""))
    filled = F.concat(F.lit(f"<{name}{attrs}>"), escape_text(text), F.lit(f"</{name}>"))
    return F.when(text == "", F.lit(f"<{name}{attrs} />")).otherwise(filled)


def wrapped(name: str, *inner: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), *inner, F.lit(f"</{name}>"))


def ordered_text(order: Column, text: Column, sep: str = "") -> Column:
    """Aggregate: the texts of a group joined in the given order."""
    pairs = F.sort_array(F.collect_list(F.struct(order.alias("k"), text.alias("v"))))
    return F.array_join(F.transform(pairs, lambda p: p["v"]), sep)
