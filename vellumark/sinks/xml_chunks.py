"""Row chunks as XML documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumark.functions.names import element_name, with_element_names
from vellumark.functions.xml import element, ordered_text, wrapped
from vellumark.operators.row_numbers import CHUNK_ROWS, SOURCE_ORDER, chunk_of, number_rows


def row_xml(columns: list[str]) -> Column:
    """One ROW element; missing values give empty elements."""
    return wrapped("ROW", *[element(element_name(c), F.col("`" + c.replace("`", "``") + "`")) for c in columns])


def rendered(df: DataFrame) -> DataFrame:
    """`row`, each row as an element, beside the columns that hold the order of the source."""
    return df.select(row_xml([c for c in df.columns if c not in SOURCE_ORDER]).alias("row"), *SOURCE_ORDER)


def documents_of(
    numbered: DataFrame, schema: str, table: str, chunk_rows: int = CHUNK_ROWS, first_chunk: int = 0
) -> DataFrame:
    """chunk_id, rows, bytes, sha, payload of rendered rows (position, row); chunks count from `first_chunk`."""
    chunks = numbered.withColumn("chunk_id", chunk_of(F.col("position"), chunk_rows) + first_chunk)
    documents = chunks.groupBy("chunk_id").agg(
        F.count("*").alias("rows"),
        F.concat(
            F.lit(f"<{schema}><{table}>"),
            ordered_text(F.col("position"), F.col("row")),
            F.lit(f"</{table}></{schema}>"),
        ).alias("payload"),
    )
    return documents.select(
        "chunk_id",
        "rows",
        F.octet_length("payload").cast("bigint").alias("bytes"),
        F.sha2("payload", 256).alias("sha"),
        "payload",
    )


def chunk_documents(
    df: DataFrame,
    schema: str,
    table: str,
    order_by: Sequence[Column] | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """chunk_id, rows, bytes, sha, payload: one document per chunk of rows.

    Rows are rendered first, so their columns may have any name. Without
    `order_by` they keep the order of their source. A task holds one chunk at a
    time, whose length is the chunk size.
    """
    if order_by:
        keys = [f"k{i}" for i in range(len(order_by))]
        row = row_xml([c for c in df.columns if c not in SOURCE_ORDER]).alias("row")
        rows = df.select(row, *[c.alias(k) for c, k in zip(order_by, keys)])
    else:
        keys, rows = None, rendered(df)
    return documents_of(number_rows(rows, keys), schema, table, chunk_rows)


def write_rows_xml(df: DataFrame, path: str, schema: str, table: str) -> str:
    """Bulk variant: every part file is a document of its own, no shuffle."""
    named = with_element_names(df)
    filled = named.select([F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in named.columns])
    filled.write.format("xml").options(rootTag=table, rowTag="ROW", declaration="").save(path)
    return path


def read_chunk_rows(documents: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of chunk documents, as strings, for checks and replays."""
    names = [element_name(c) for c in columns]
    schema = ", ".join(f"`{n}` string" for n in names)
    rows = documents.select(
        "chunk_id", F.posexplode(F.regexp_extract_all("payload", F.lit(r"(?s)<ROW>.*?</ROW>"), F.lit(0))).alias("n", "x")
    )
    parsed = F.from_xml("x", schema, {"rowTag": "ROW"})
    return rows.select("chunk_id", "n", parsed.alias("r")).select("chunk_id", "n", "r.*")
