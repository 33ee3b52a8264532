"""Streaming intake of new files, each taken exactly once."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from vellumark.sources.csv_tables import read_csv_strings

FILES_PER_TRIGGER = 10
FILE = "path string, modificationTime timestamp, length bigint, content binary"  # as the source gives it; contents are not read


@dataclass(frozen=True)
class CsvStream:
    """New CSV files as a stream of their paths, and the names of their columns."""

    files: DataFrame
    columns: tuple[str, ...]

    def rows(self, batch: DataFrame) -> DataFrame | None:
        """Rows of a micro-batch's files in source order, split like any large file; None if it has no file.

        The driver sees paths, no more than the files of a trigger.
        """
        paths = [re.sub(r"([\\{}\[\]*?])", r"\\\1", r["path"]) for r in batch.select("path").collect()]
        if not paths:
            return None
        return read_csv_strings(batch.sparkSession, sorted(paths), with_order=True, columns=self.columns)


def csv_stream(
    spark: SparkSession,
    folder: str,
    columns: Sequence[str],
    files: int = FILES_PER_TRIGGER,
    archive: str | None = None,
) -> CsvStream:
    """New CSV files of a folder, `files` a trigger, oldest first.

    The checkpoint of the query remembers the files, in place of lock files;
    with `archive` finished files are moved there by a later trigger. Only
    names are streamed; a trigger's files are read as `read_csv_strings` does,
    so line breaks inside quotes do not make a file one task.
    """
    reader = spark.readStream.format("binaryFile").schema(FILE).option("maxFilesPerTrigger", files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return CsvStream(reader.load(folder).select("path"), tuple(columns))


def run_available(stream: CsvStream, checkpoint: str, each: Callable[[DataFrame | None, int], None]) -> None:
    """Process the rows of all files present in micro-batches, then stop."""
    query = (
        stream.files.writeStream.foreachBatch(lambda batch, batch_id: each(stream.rows(batch), batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def take_files(stream: CsvStream, checkpoint: str, out: str) -> DataFrame:
    """Append the rows of new files to a table; running again adds only what is new.

    A batch repeated after a failure overwrites its own folder. While no file
    was found, the table is empty.
    """

    def each(rows: DataFrame | None, batch_id: int) -> None:
        if rows is not None:
            rows.drop("_block", "_line").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    run_available(stream, checkpoint, each)
    spark = stream.files.sparkSession
    try:
        return spark.read.parquet(out)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        names = ", ".join(f"`{c.replace('`', '``')}` string" for c in (*stream.columns, "_file"))
        return spark.createDataFrame([], f"{names}, batch_id int")
