"""Column types of untyped tables, from states that merge."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumark.functions import kinds
from vellumark.functions.names import attachment_column, reserved_suffix
from vellumark.functions.values import stripped
from vellumark.operators.row_numbers import SOURCE_ORDER
from vellumark.session import stored

CATALOGUE = ("table_name", "ordinal", "name", "type", "type_length", "record_count")


def _value_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in SOURCE_ORDER]


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


# One number per value: its relational class, and its positions in the JSON and
# XSD classes (_NONE if blank).
_JSON, _XSD, _NONE = 8, 64, 7


def _code(value: Column, text: Column, flavours: Collection[str]) -> Column:
    json = F.coalesce(kinds.json_kind(value, text), F.lit(_NONE)) if "json" in flavours else F.lit(_NONE)
    xsd = F.coalesce(kinds.xsd_kind(value, text), F.lit(_NONE)) if "xsd" in flavours else F.lit(_NONE)
    relational = {"relational", "strict"} & set(flavours)
    return (kinds.relational_class(value, text) if relational else F.lit(kinds.ABSENT)) + json * _JSON + xsd * _XSD


def type_states(
    df: DataFrame, table: str, order_by: list[str] | None = None, flavours: Collection[str] = ("relational", "json", "xsd")
) -> DataFrame:
    """What a table's values say about its columns' types: a row per column and file, for all `flavours` at once.

    Rows of states merge: counts add up, flags and classes have a strongest
    value, and the first deciding value has its place (file, block, line, or
    the values of `order_by`). So states of new files are put beside those of
    old ones, which need no second reading. One pass, one shuffle of a row per
    column and block.
    """
    keys = list(order_by or ())
    placed = not keys and set(SOURCE_ORDER) <= set(df.columns)
    names = [c for c in df.columns if c not in (keys or SOURCE_ORDER)]
    # A row per value: the long expression is then compiled once, not once per column.
    cells = F.posexplode(F.array(*[_quoted(c).cast("string") for c in names])).alias("i", "cell")
    base = df.sparkSession.createDataFrame(
        [(table, i + 1, c, 0) for i, c in enumerate(names)], "table_name string, ordinal int, name string, records bigint"
    )
    if placed:
        rows = df.select(*SOURCE_ORDER, cells)
        place, within = ["_file", "_block"], F.col("_line")
    else:
        at = F.struct(*keys) if keys else F.struct(F.lit(0))
        rows = df.select(F.lit("").alias("_file"), at.alias("_at"), cells)
        place, within = ["_file"], None
    # Stripped once, in a projection of its own: the classes ask for it some ten times.
    rows = rows.withColumn("text", stripped(F.col("cell")))
    rows = rows.withColumn("code", _code(F.col("cell"), F.col("text"), flavours)).drop("cell", "text")
    kind = F.col("code") % _JSON
    json, xsd = F.floor(F.col("code") / _JSON) % _JSON, F.floor(F.col("code") / _XSD)

    def first(*decisive: int) -> Column:
        """The first deciding value: where, and 1 if it is a text."""
        text = (kind != kinds.DATED).cast("int")
        found = within * 2 + text if placed else F.struct(F.col("_at").alias("at"), text.alias("text"))
        return F.min(F.when(kind.isin(*decisive), found))

    states = rows.groupBy(*place, "i").agg(
        F.count("*").alias("records"),
        first(kinds.DATED, kinds.TEXT).alias("lax"),
        first(kinds.DATED, kinds.TEXT, kinds.POINTED).alias("strict"),
        F.max(kind.isin(kinds.FRACTION, kinds.POINTED)).alias("lax_float"),
        F.max(kind == kinds.FRACTION).alias("strict_float"),
        F.min(json).alias("json"),
        F.min(xsd).alias("xsd"),
    )
    if placed:  # from blocks to files

        def earliest(name: str) -> Column:
            value = F.col(name)
            at = F.struct(F.col("_block").alias("block"), F.floor(value / 2).alias("line"))
            return F.min(F.when(value.isNotNull(), F.struct(at.alias("at"), (value % 2).cast("int").alias("text")))).alias(name)

        states = states.groupBy("_file", "i").agg(
            F.sum("records").alias("records"), earliest("lax"), earliest("strict"),
            *[F.max(c).alias(c) for c in ("lax_float", "strict_float")], *[F.min(c).alias(c) for c in ("json", "xsd")],
        )
    listed = F.array(*[F.lit(c) for c in names])
    states = states.select(
        F.lit(table).alias("table_name"), (F.col("i") + 1).alias("ordinal"), F.get(listed, F.col("i")).alias("name"),
        F.col("_file").alias("file"), "records", "lax", "strict", "lax_float", "strict_float", "json", "xsd",
    )
    return states.unionByName(base, allowMissingColumns=True)  # columns of tables without rows, too


def merged_states(old: DataFrame, new: DataFrame) -> DataFrame:
    """States of old and new files; a file that is in both counts as the new one says."""
    kept = old.alias("o").join(
        new.select("table_name", "file").distinct().alias("n"),
        (F.col("o.table_name") == F.col("n.table_name")) & F.col("o.file").eqNullSafe(F.col("n.file")), "left_anti",
    )
    return kept.unionByName(new)


def _merged(states: DataFrame, **values: Column) -> DataFrame:
    """CATALOGUE rows of states; `values` give each column's type from aggregates."""
    one = states.groupBy("table_name", "ordinal", "name").agg(
        F.sum("records").alias("record_count"), *[v.alias(n) for n, v in values.items()]
    )
    return one


def _finished(one: DataFrame, kind: Column) -> DataFrame:
    length = F.when(F.col("type").isin("VARCHAR", "string", "xs:string"), "255").otherwise("64")
    return one.withColumn("type", kind).withColumn("type_length", length).select(*CATALOGUE).orderBy("table_name", "ordinal")


def relational_catalogue(states: DataFrame, strict: bool = False) -> DataFrame:
    """Types DATE / VARCHAR / FLOAT / INT.

    The first value in row order that is a date or not a number decides;
    without one the column is FLOAT if any value is, else INT.
    """
    mode = "strict" if strict else "lax"
    first = F.min(F.when(F.col(mode).isNotNull(), F.struct("file", mode)))
    one = _merged(states, first=first, float=F.max(f"{mode}_float"))
    text = F.col("first")[mode]["text"]
    return _finished(one, F.when(text == 0, "DATE").when(text == 1, "VARCHAR").when(F.col("float"), "FLOAT").otherwise("INT"))


def _strongest(states: DataFrame, flavour: str, classes: tuple[str, ...]) -> DataFrame:
    named = F.array(*[F.lit(c) for c in classes])
    kind = F.coalesce(F.get(named, F.col("best").cast("int")), F.lit(classes[-1]))
    return _finished(_merged(states, best=F.min(flavour)), kind)


def json_catalogue(states: DataFrame) -> DataFrame:
    """Types date-time / date / number / string; the strongest class present wins."""
    return _strongest(states, "json", kinds.JSON_CLASSES)


def xsd_catalogue(states: DataFrame) -> DataFrame:
    """XSD types; the last column is the attachment, reserved names get a suffix."""
    rows = _strongest(states, "xsd", kinds.XSD_CLASSES)
    last = Window.partitionBy("table_name")  # a row per column
    is_last = F.col("ordinal") == F.max("ordinal").over(last)
    return rows.withColumn("_last", is_last).select(
        "table_name",
        "ordinal",
        F.when(F.col("_last"), F.col("name")).otherwise(reserved_suffix(F.col("name"))).alias("name"),
        F.when(F.col("_last"), "attachment").otherwise(F.col("type")).alias("type"),
        F.when(F.col("_last"), "64").otherwise(F.col("type_length")).alias("type_length"),
        "record_count",
    )


FLAVOURS: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "relational": relational_catalogue,
    "strict": lambda states: relational_catalogue(states, strict=True),
    "json": json_catalogue,
    "xsd": xsd_catalogue,
}


def infer_relational(
    df: DataFrame, table: str, strict: bool = False, order_by: list[str] | None = None
) -> DataFrame:
    """Catalogue rows of one table; see `relational_catalogue`."""
    return relational_catalogue(type_states(df, table, order_by, ["relational"]), strict)


def infer_json(df: DataFrame, table: str) -> DataFrame:
    """Catalogue rows of one table; see `json_catalogue`."""
    return json_catalogue(type_states(df, table, flavours=["json"]))


def infer_xsd(df: DataFrame, table: str) -> DataFrame:
    """Catalogue rows of one table; see `xsd_catalogue`."""
    return xsd_catalogue(type_states(df, table, flavours=["xsd"]))


def table_states(tables: Mapping[str, DataFrame], flavours: Collection[str] = ("relational", "json", "xsd")) -> DataFrame:
    """States of many tables, stored, from one pass over each."""
    states = [type_states(df, name, flavours=flavours) for name, df in tables.items()]
    return stored(reduce(DataFrame.unionByName, states), "type-states")


def mark_attachments(catalogue: DataFrame, tables: Mapping[str, DataFrame], preferred: str = "") -> DataFrame:
    """Give the attachment column of each table the type `attachment`."""
    chosen = {t: attachment_column(_value_columns(df), preferred) for t, df in tables.items()}
    is_attachment = F.lit(False)
    for t, c in chosen.items():
        if c is not None:
            is_attachment = is_attachment | ((F.col("table_name") == t) & (F.col("name") == c))
    return catalogue.withColumn("type", F.when(is_attachment, "attachment").otherwise(F.col("type")))
