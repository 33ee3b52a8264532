"""Delivery of chunk documents with a ledger, and run metrics."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from vellumark.session import bounded_batches

DELIVERED = 201
NO_ANSWER = 0  # status of a transport that raised
ATTEMPTS = 3  # one delivery and two retries
LEDGER = "batch_id bigint, chunk_id bigint, rows bigint, bytes bigint, sha string, status int, attempt int"
METRICS = (
    "id bigint, dag_id string, run_id string, execution_date timestamp, records_processed bigint, "
    "records_successful bigint, records_failed bigint, notes string, reserved1 string, reserved2 string, "
    "reserved3 string, reserved4 string, reserved5 string, recorded_at timestamp"
)

Transport = Callable[[str, int], int]  # (payload, attempt) -> status


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table, or an empty one while nothing was written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def undelivered(documents: DataFrame, ledger: DataFrame) -> DataFrame:
    """Documents whose content has no accepted delivery yet."""
    accepted = ledger.filter(F.col("status") == DELIVERED).select("batch_id", "chunk_id", "sha")
    return documents.join(accepted, ["batch_id", "chunk_id", "sha"], "left_anti")


def attempt_delivery(documents: DataFrame, transport: Transport, attempts: int = ATTEMPTS) -> DataFrame:
    """Ledger rows of sending each document until it is accepted or attempts run out.

    A document may be sent again after a lost task; `sha` lets the receiver see that.
    """

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            outcomes = []
            for payload in pdf["payload"]:
                for attempt in range(1, attempts + 1):
                    try:
                        status = transport(payload, attempt)
                    except Exception:  # the caller's transport; the chunk stays undelivered
                        status = NO_ANSWER
                    if status == DELIVERED:
                        break
                outcomes.append((status, attempt))
            yield pdf.drop(columns="payload").assign(
                status=[s for s, _ in outcomes], attempt=[a for _, a in outcomes]
            )

    bounded_batches(documents.sparkSession)  # payloads are long, a batch of 10,000 of them would fill a task
    sent = documents.select("batch_id", "chunk_id", "rows", "bytes", "sha", "payload")
    return sent.mapInPandas(send, LEDGER)


def deliver(
    documents: DataFrame, ledger_path: str, transport: Transport, batch_id: int = 0, attempts: int = ATTEMPTS
) -> DataFrame:
    """Send what the ledger lacks, append the outcome, return the whole ledger."""
    spark = documents.sparkSession
    ledger = read_or_empty(spark, ledger_path, LEDGER)
    todo = undelivered(documents.withColumn("batch_id", F.lit(batch_id).cast("bigint")), ledger)
    attempt_delivery(todo, transport, attempts).write.mode("append").parquet(ledger_path)
    return spark.read.schema(LEDGER).parquet(ledger_path)


def latest_status(ledger: DataFrame, documents: DataFrame | None = None, batch_id: int = 0) -> DataFrame:
    """One row per chunk: its accepted entry if there is one, else the last try; with `documents`, of their contents only."""
    if documents is not None:
        own = documents.select(F.lit(batch_id).cast("bigint").alias("batch_id"), "chunk_id", "sha")
        ledger = ledger.join(own, ["batch_id", "chunk_id", "sha"], "left_semi")
    best = F.max(F.struct((F.col("status") == DELIVERED).alias("ok"), "status", "attempt", "rows", "bytes", "sha"))
    return ledger.groupBy("batch_id", "chunk_id").agg(best.alias("b")).select(
        "batch_id", "chunk_id", "b.rows", "b.bytes", "b.sha", "b.status", "b.attempt"
    )


def run_metrics(
    totals: DataFrame, dag_id: str, run_id: str, execution_date: str, notes: str | None = None
) -> DataFrame:
    """A run row from the delivery totals."""
    return totals.select(
        F.lit(dag_id).alias("dag_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(execution_date).cast("timestamp").alias("execution_date"),
        F.coalesce("rows_in_chunks", F.lit(0)).alias("records_processed"),
        F.coalesce("rows_delivered", F.lit(0)).alias("records_successful"),
        F.coalesce("rows_failed", F.lit(0)).alias("records_failed"),
        F.lit(notes).cast("string").alias("notes"),
    )


def append_metrics(runs: DataFrame, path: str) -> DataFrame:
    """Append runs whose (dag_id, run_id) is not there yet; returns the table.

    Ids go on from the highest one; missing counts are 0, other columns null,
    and the rows are stamped with the time of writing.
    """
    spark = runs.sparkSession
    table = read_or_empty(spark, path, METRICS)
    highest = table.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    fresh = runs.dropDuplicates(["dag_id", "run_id"]).join(
        table.select("dag_id", "run_id"), ["dag_id", "run_id"], "left_anti"
    )
    numbered = fresh.withColumns(
        {
            # One row per run: the window sees the few runs being recorded.
            "id": F.row_number().over(Window.orderBy("execution_date", "dag_id", "run_id")) + highest,
            "recorded_at": F.current_timestamp(),
        }
    )
    columns = []
    for field in METRICS.split(", "):
        name, kind = field.split()
        value = F.col(name) if name in numbered.columns else F.lit(None)
        counted = F.coalesce(value, F.lit(0)) if name.startswith("records_") else value
        columns.append(counted.cast(kind).alias(name))
    numbered.select(*columns).write.mode("append").parquet(path)
    return spark.read.schema(METRICS).parquet(path)


def run_metrics_view(metrics: DataFrame) -> DataFrame:
    """The columns shown to operators."""
    return metrics.select(
        "id",
        F.col("dag_id").alias("ProcessName"),
        F.col("run_id").alias("InstanceId"),
        "execution_date",
        "records_processed",
        "records_failed",
    )
