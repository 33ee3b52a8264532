"""Streaming twin of the archival flow: new files to chunks, XML and the ledger.

Chunks go on over micro-batches. The state between two of them is the number of
the open chunk and its rows, fewer than a chunk, kept in a version per batch: a
batch repeated after a failure starts from the version before it and gives the
same chunks. Rows are numbered and rendered by many tasks; a stateful operator
keyed by table would bring all rows of a table through one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumark.operators.row_numbers import CHUNK_ROWS, number_rows
from vellumark.session import qualified
from vellumark.sinks.ledger import LEDGER, Transport, deliver, read_or_empty
from vellumark.sinks.xml_chunks import documents_of, rendered
from vellumark.streaming.intake import CsvStream, run_available

STATE = "at bigint, row string"  # the open chunk's rows


def _versions(spark: SparkSession, state: str) -> list[tuple[int, int, int]]:
    """Complete versions, ascending: a number (two a batch, the second once its open chunk is closed), the open chunk's
    number and how many rows it has, as the folders' names say."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(state)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    found = [f.getPath().getName() for f in system.listStatus(folder)]
    done = [n for n in found if system.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{state}/{n}/_SUCCESS"))]
    return sorted(tuple(map(int, n.split("-"))) for n in done)


def _name(version: tuple[int, int, int]) -> str:
    return "-".join(map(str, version))


def _drop_before(spark: SparkSession, state: str, number: int) -> None:
    for v in _versions(spark, state):
        if v[0] < number:
            old = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/{_name(v)}")
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def _read_state(spark: SparkSession, state: str, before: int) -> tuple[int, int, DataFrame]:
    """Number of the open chunk, how many rows it has, and these, of the newest version below `before`."""
    versions = [v for v in _versions(spark, state) if v[0] < before]
    if not versions:
        return 0, 0, spark.createDataFrame([], STATE)
    _, chunk, held = versions[-1]
    return chunk, held, spark.read.schema(STATE).parquet(f"{state}/{_name(versions[-1])}")


def _write_state(rows: DataFrame, state: str, version: tuple[int, int, int]) -> None:
    kept = rows.select("at", "row").coalesce(1)  # fewer rows than a chunk
    kept.write.mode("overwrite").parquet(f"{state}/{_name(version)}")


def export_stream(
    stream: CsvStream,
    checkpoint: str,
    ledger_path: str,
    transport: Transport,
    schema: str,
    table: str,
    chunk_rows: int = CHUNK_ROWS,
    close: bool = True,
) -> DataFrame:
    """Deliver the chunks of new files; returns the ledger.

    Chunks are those of `archive_table` over the files in the order of their
    arrival (those of one trigger by name), however many a trigger takes and
    wherever a run was broken off; the ledger sends none twice. Rows that do
    not fill a chunk wait for the next run, or with `close` are sent as a last,
    shorter chunk after which a new one begins.
    """
    spark = stream.files.sparkSession
    state = f"{qualified(spark, checkpoint)}-open-chunk"

    def each(rows: DataFrame | None, batch_id: int) -> None:
        chunk, held, waiting = _read_state(spark, state, 2 * batch_id)
        if rows is None:
            return
        numbered = number_rows(rendered(rows), None)
        total = held + numbered.count()
        full = total // chunk_rows * chunk_rows
        found = numbered.select((F.col("position") + held).alias("at"), "row").unionByName(waiting.select("at", "row"))
        whole = found.where(F.col("at") < full).withColumnRenamed("at", "position")
        documents = documents_of(whole, schema, table, chunk_rows, chunk)
        if full:
            deliver(documents, ledger_path, transport)
        rest = found.where(F.col("at") >= full).withColumn("at", F.col("at") - full)
        _write_state(rest, state, (2 * batch_id, chunk + full // chunk_rows, total - full))
        _drop_before(spark, state, 2 * (batch_id - 1))

    run_available(stream, checkpoint, each)
    if close and (versions := _versions(spark, state)):
        chunk, held, waiting = _read_state(spark, state, versions[-1][0] + 1)
        if held:
            deliver(documents_of(waiting.withColumnRenamed("at", "position"), schema, table, chunk_rows, chunk), ledger_path, transport)
            _write_state(waiting.limit(0), state, (versions[-1][0] | 1, chunk + 1, 0))
    return read_or_empty(spark, ledger_path, LEDGER)
