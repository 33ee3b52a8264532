"""CSV tables: header row, every column a string."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vellumark.operators.row_numbers import SOURCE_ORDER
from vellumark.sources import csv_records

_DIALECT = {"header": "true", "escape": '"', "enforceSchema": "true"}


def _reader(spark: SparkSession, columns: Sequence[str] | None, multi_line: bool) -> DataFrameReader:
    options = {**_DIALECT, "multiLine": str(multi_line).lower()}
    reader = spark.read.options(**options)
    return reader if columns is None else reader.schema(StructType([StructField(c, StringType()) for c in columns]))


def read_csv_strings(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool = True,
    with_order: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of CSV files or a folder as strings; short rows end in nulls, extra cells are dropped.

    Files are split, whatever their size, and line breaks inside quotes are
    kept: one pass finds whether any record spans lines. If none does, Spark's
    reader splits at line breaks; else records are cut by `csv_records` and
    stored. Only files with lone carriage returns, which may be line ends of
    their own kind, are read one a task. `multi_line=False` promises that there are none and saves the pass.
    `columns` are the names of the header, which is read where they are not
    given. `with_order` adds the columns that hold the order of the source.
    """
    columns = columns or _reader(spark, None, multi_line).csv(path).columns
    whole_files = False
    if multi_line:
        read = csv_records.lines(spark, path)
        opened, whole_files = csv_records.breaks(read)
        if opened and not whole_files:
            records = csv_records.whole_records(read)
            parsed = records.select(csv_records.cells(F.col("record"), len(columns)).alias("c"), *SOURCE_ORDER)
            values = [F.col(f"c.c{i}").alias(c) for i, c in enumerate(columns)]
            return parsed.select(*values, *(SOURCE_ORDER if with_order else ()))
    df = _reader(spark, columns, whole_files).csv(path)
    if not with_order:
        return df
    values = [(F.col("_metadata.file_path")), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
    return df.select("*", *[v.alias(n) for n, v in zip(SOURCE_ORDER, values)])


def write_csv(df: DataFrame, path: str) -> str:
    """Header CSV that `read_csv_strings` reads back unchanged (null and empty become null)."""
    df.write.options(
        header="true", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
        emptyValue="", nullValue="",
    ).csv(path)
    return path


def list_names(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Names directly in a folder with the given ending, in name order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(n for n in (f.getPath().getName() for f in files) if n.endswith(suffix))


def read_csv_folder(
    spark: SparkSession, folder: str, multi_line: bool = True, with_order: bool = False
) -> dict[str, DataFrame]:
    """Every `*.csv` of a folder as a lazy table, keyed by file stem."""
    return {
        name[: -len(".csv")]: read_csv_strings(spark, f"{folder}/{name}", multi_line, with_order)
        for name in list_names(spark, folder, ".csv")
    }


def valid_rows(
    df: DataFrame, raw: str | None = None, width: int | None = None, ignore: tuple[str, ...] = ()
) -> DataFrame:
    """Drop rows that are entirely empty and, given the raw line, rows shorter than the header.

    Without the raw line a short row looks like one that ends in empty cells, and stays.
    """
    skipped = {raw, *SOURCE_ORDER, *ignore}
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in df.columns if c not in skipped]
    kept = df.filter(F.length(F.concat(*cells)) > 0)
    if raw is None:
        return kept
    return kept.filter(F.size(F.split(F.col(raw), ",", -1)) >= (width or len(cells)))
