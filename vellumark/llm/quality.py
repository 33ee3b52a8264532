"""Quality classifier: a linear support vector machine on n-gram indicators scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vellumark.llm.learning import fit_in_one_task, fold, labelled_sample, logistic, platt
from vellumark.llm.scan import flat_rows, map_rows, mix, slices, span_hashes, string_array, text_bytes, windows, word_spans

FIT_ROWS = 12_000  # at most so many labelled documents are fitted
BUCKETS = 1 << 16  # half for runs of three bytes, half for runs of word shapes
ACCEPT = 0.7
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
_BLOCK_TEXTS = 64

_CLASS = np.full(256, 4, np.uint64)  # of a byte: 0 capital, 1 small letter, 2 digit, 3 beyond ASCII, 4 other, 5 ., 6 ,
_CLASS[ord("A") : ord("Z") + 1] = 0
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[128:] = 3
_CLASS[[ord("."), ord(",")]] = 5, 6


def grams(array: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every n-gram occurrence.

    Runs of three bytes, and runs of one to three word shapes. A shape is made
    of the classes of the word's first, second and last byte, its length up to
    15 bytes, and whether it equals the word before.
    """
    body, bounds = text_bytes(array)
    half = np.uint64(BUCKETS // 2)
    owners = np.repeat(np.arange(len(array)), np.diff(bounds))
    made, first = windows(body.astype(np.uint64) + np.uint64(1), owners, 3)
    of, where = [owners[first]], [made % half]
    begins, ends = word_spans(body, bounds)
    if len(begins):
        word_owner = np.searchsorted(bounds, begins, "right") - 1
        hashes = span_hashes(body, begins, ends)
        same = np.zeros(len(begins), np.uint64)
        same[1:] = (hashes[1:] == hashes[:-1]) & (word_owner[1:] == word_owner[:-1])
        size = np.minimum(ends - begins, 15).astype(np.uint64)
        second = _CLASS[body[np.minimum(begins + 1, ends - 1)]]
        shape = (((_CLASS[body[begins]] * np.uint64(8) + second) * np.uint64(8) + _CLASS[body[ends - 1]]) * np.uint64(16) + size) * np.uint64(2) + same
        shape = mix(shape + np.uint64(1))
        for n in (1, 2, 3):
            made, first = windows(shape, word_owner, n)
            of.append(word_owner[first])
            where.append(made % half + half)
    return np.concatenate(of), np.concatenate(where).astype(np.int64)


def indicators(array: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every n-gram that a text has, ascending and without repetition."""
    of, where = [], []
    for at in range(0, len(array), _BLOCK_TEXTS):
        part = array.slice(at, _BLOCK_TEXTS)
        seen = np.zeros(len(part) * BUCKETS, bool)
        for a, b in slices(part):
            owner, bucket = grams(part.slice(a, b - a))
            seen[(owner + a) * BUCKETS + bucket] = True
        cells = np.flatnonzero(seen)
        of.append(cells // BUCKETS + at)
        where.append(cells % BUCKETS)
    if not of:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(of), np.concatenate(where)


def _margins(of: np.ndarray, where: np.ndarray, n: int, ratios: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weights times the scaled indicators, each text's brought to length one."""
    scaled = ratios[where]
    norm = np.sqrt(np.bincount(of, scaled * scaled, n))
    return np.bincount(of, scaled * weights[where], n) / np.maximum(norm, 1e-9)


class TextSets:
    """Buckets of many texts at two bytes each, and where each text's begin; nothing wider is held for all texts."""

    def __init__(self, array: pa.StringArray):
        parts, counts = [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
        for at in range(0, len(array), _BLOCK_TEXTS):
            of, where = indicators(array.slice(at, _BLOCK_TEXTS))
            parts.append(where.astype(np.uint16))
            counts.append(np.bincount(of, minlength=min(_BLOCK_TEXTS, len(array) - at)))
        self.where = np.concatenate(parts)
        self.bounds = np.concatenate([[0], np.cumsum(np.concatenate(counts))])

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def __getitem__(self, i: int) -> np.ndarray:
        return self.where[self.bounds[i] : self.bounds[i + 1]]

    def counts(self, chosen: np.ndarray) -> np.ndarray:
        """How many of the chosen texts have each bucket."""
        total = np.zeros(BUCKETS, np.int64)
        for i in np.flatnonzero(chosen).tolist():
            total[self[i]] += 1  # a text has a bucket once
        return total

    def norms(self, ratios: np.ndarray) -> np.ndarray:
        square = ratios * ratios
        return np.maximum(np.sqrt([square[self[i]].sum() for i in range(len(self))]), 1e-9)


def dual_coordinate_descent(
    sets: TextSets, rows: np.ndarray, ratios: np.ndarray, signs: np.ndarray, cost: float = COST, epochs: int = EPOCHS
) -> np.ndarray:
    """Weights of the L2-regularised hinge loss; one dual variable in [0, cost] a row, rare class weighted up.

    A row's values are the ratios of its buckets, brought to length one when the row is visited.
    """
    n = len(rows)
    norms = sets.norms(ratios)[rows]
    share = np.where(signs > 0, (signs > 0).mean(), (signs < 0).mean())
    most = cost * np.minimum(10.0, 0.5 / np.maximum(share, 1e-6))
    alpha, weights = np.zeros(n), np.zeros(BUCKETS + 1)
    random = np.random.default_rng(1)
    for _ in range(epochs):
        moved = 0.0
        for i in random.permutation(n).tolist():
            at = sets[rows[i]]
            x = ratios[at] / norms[i]
            slope = signs[i] * (float(weights[at] @ x) + weights[-1]) - 1
            new = min(max(alpha[i] - slope / (float(x @ x) + 1), 0.0), most[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * signs[i]
                weights[at] += step * x
                weights[-1] += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return weights


def fit(texts: pa.Table) -> dict[str, np.ndarray]:
    """ratios, weights (the last is the bias) and the calibration; the last fifth of the rows only calibrates."""
    labels = texts.column("label").to_numpy().astype(np.int64)
    blank = {"ratios": np.zeros(BUCKETS), "weights": np.zeros(BUCKETS + 1), "ab": platt(np.zeros(len(labels)), labels)}
    if len(np.unique(labels)) < 2:
        return blank
    sets = TextSets(string_array(texts.column("text")))
    order = np.argsort([hash(d) & 0xFFFF for d in texts.column("doc_id").to_pylist()], kind="stable")
    learn = np.zeros(len(labels), bool)
    learn[order[: len(order) - len(order) // 5]] = True
    if len(np.unique(labels[learn])) < 2 or learn.all():
        learn[:] = True
    counts = [SMOOTHING + sets.counts(learn & (labels == y)) for y in (1, 0)]
    ratios = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())
    weights = dual_coordinate_descent(sets, np.flatnonzero(learn), ratios, np.where(labels[learn] > 0, 1.0, -1.0))
    scaled = ratios * weights[:-1]
    margins = np.array([scaled[sets[i]].sum() for i in range(len(sets))]) / sets.norms(ratios) + weights[-1]
    rest = ~learn if not learn.all() else learn
    return {"ratios": ratios, "weights": weights, "ab": platt(margins[rest], labels[rest].astype(float))}


def train(
    docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2, limit: int = FIT_ROWS
) -> dict[str, np.ndarray]:
    return fit_in_one_task(labelled_sample(docs, labels, "quality", modulus, held_out, limit), fit)


def _scored(docs: DataFrame, model: dict[str, np.ndarray], keep: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers, whatever the input

    def work(part):
        ratios, weights, (a, b) = (shared.value[k] for k in ("ratios", "weights", "ab"))
        of, where = indicators(part)
        margins = _margins(of, where, len(part), ratios, weights) + weights[-1]
        return [pa.array(logistic(a * margins + b))]

    return map_rows(docs, keep, StructType().add("score", "double"), work)


def score(docs: DataFrame, model: dict[str, np.ndarray], keep: list[str] | None = None) -> DataFrame:
    """Add `score` (0 to 1, higher: label 1 likelier) to the columns `keep` (doc_id) of every row.

    The score depends on the text alone; a null text is an empty one. Without
    labels of both kinds in the sample the score is their smoothed share. A
    column `score` among those kept gives way.
    """
    return flat_rows(_scored(docs, model, keep or ["doc_id"]), "score")


def accepted(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """The rows whose score is ACCEPT or more, as they are, whatever their columns are called."""
    return flat_rows(_scored(docs, model, docs.columns).where(F.col("score") >= ACCEPT).select("row"))


def classify(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document. A null doc_id is not held out."""
    scored = score(docs, train(docs, labels, limit=limit))
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )
