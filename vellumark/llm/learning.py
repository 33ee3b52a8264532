"""Labelled samples, fits in one task, and calibration."""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from vellumark.session import new_folder
from vellumark.sources.filesystem import open_file_system


def fold(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, modulus: int, held_out: int, limit: int) -> DataFrame:
    """doc_id, label, text of at most `limit` labelled documents outside the fold `held_out`, chosen by a hash.

    A document labelled more than once has its largest label, one with several
    rows its smallest text. The chosen ids are at most `limit` rows, so every
    task may have them.
    """
    rows = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(column).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (fold("doc_id", modulus) != held_out)
    )
    chosen = rows.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text"))


def fit_in_one_task(rows: DataFrame, fit: Callable[[pa.Table], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Arrays that `fit` makes of rows (by their first column) whose number the caller has bounded. No rows: fit gets an empty table."""
    none = to_arrow_schema(rows.schema).empty_table()

    def run(batches):
        held = [b for b in batches if b.num_rows]
        table = pa.Table.from_batches(held) if held else none
        out = io.BytesIO()
        np.savez(out, **fit(table))
        yield pa.RecordBatch.from_pydict({"model": [out.getvalue()]}, pa.schema([("model", pa.binary())]))

    ordered = rows.repartition(1).sortWithinPartitions(rows.columns[0])
    model = ordered.mapInArrow(run, "model binary").first()
    if model is None:  # no partition at all
        return fit(none)
    return dict(np.load(io.BytesIO(model["model"])))


def fit_to_file(rows: DataFrame, fit: Callable[[pa.Table], dict[str, np.ndarray]]) -> str:
    """As `fit_in_one_task`, but the arrays stay in the shared folder; returns the file's path, which tasks open themselves.

    For models that are too large to pass through the driver. A repeated task
    writes a file of its own.
    """
    none = to_arrow_schema(rows.schema).empty_table()
    folder = new_folder(rows.sparkSession, "model")

    def run(batches):
        held = [b for b in batches if b.num_rows]
        path = save_arrays(fit(pa.Table.from_batches(held) if held else none), folder)
        yield pa.RecordBatch.from_pydict({"path": [path]}, pa.schema([("path", pa.string())]))

    ordered = rows.repartition(1).sortWithinPartitions(rows.columns[0])
    made = ordered.mapInArrow(run, "path string").first()
    return save_arrays(fit(none), folder) if made is None else made["path"]


def save_arrays(arrays: dict[str, np.ndarray], folder: str) -> str:
    system, root = open_file_system(folder)
    system.create_dir(root, recursive=True)
    name = f"{uuid.uuid4().hex}.npz"
    with system.open_output_stream(f"{root}/{name}") as out:
        body = io.BytesIO()
        np.savez(body, **arrays)
        out.write(body.getbuffer())
    return f"{folder}/{name}"


def load_arrays(path: str) -> dict[str, np.ndarray]:
    system, inner = open_file_system(path)
    with system.open_input_stream(inner) as data:
        return dict(np.load(io.BytesIO(data.read())))


def platt(margins: np.ndarray, labels: np.ndarray, rounds: int = 50) -> np.ndarray:
    """a, b of the calibrated score 1 / (1 + exp(-(a m + b))), with smoothed targets."""
    n1 = float(labels.sum())
    n0 = len(labels) - n1
    prior = np.array([0.0, np.log((n1 + 1) / (n0 + 1))])
    if not n1 or not n0 or np.ptp(margins) == 0:
        return prior
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    ab = prior
    for _ in range(rounds):
        p = logistic(x @ ab)
        slope = x.T @ (p - target) + 1e-6 * ab
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        ab = ab - step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return ab


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))
