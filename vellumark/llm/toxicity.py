"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over all their terms, by a block-max inverted index."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vellumark.llm.learning import fit_to_file, fold, labelled_sample, load_arrays, logistic
from vellumark.llm.scan import flat_rows, map_rows, slices, span_hashes, string_array, text_bytes, word_spans

FIT_ROWS = 16_000  # at most so many labelled documents become examples
MIN_DOCUMENTS = 6  # examples that a term needs to tell the labels apart
MIN_CHI2 = 40.0
NEIGHBOURS = 15
BLOCK = 64  # examples of one index block
SEEDS = 3  # blocks of the largest bounds, which are looked at first
FREQUENT = 8  # a term of more than 1/FREQUENT of the examples is frequent
SLACK = 1e-5  # more than single precision can be wrong by
EVIDENCE = 5
TOGETHER = 32  # texts that are answered together
KNOWN_ANSWERS = 50_000  # answers that a task remembers
ACCEPT = 0.7
PRIOR_WEIGHT = 0.5
DRAWN = 30  # examples' worth of evidence for adding up the votes as they are

_GAPS = np.ones(256, bool)  # a term is a run of letters, digits and bytes beyond ASCII, A-Z folded
for _a, _b in (("0", "9"), ("A", "Z"), ("a", "z")):
    _GAPS[ord(_a) : ord(_b) + 1] = False
_GAPS[128:] = False


def term_counts(array: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, term and count of every distinct term of every text, by text and term."""
    body, bounds = text_bytes(array)
    begins, ends = word_spans(body, bounds, _GAPS)
    terms = span_hashes(body, begins, ends, lower=True)
    of = np.searchsorted(bounds, begins, "right") - 1
    order = np.lexsort((terms, of))
    of, terms = of[order], terms[order]
    fresh = np.ones(len(of), bool)
    fresh[1:] = (of[1:] != of[:-1]) | (terms[1:] != terms[:-1])
    at = np.flatnonzero(fresh)
    return of[at], terms[at], np.diff(np.append(at, len(of)))


def document_counts(array: pa.StringArray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms ascending, texts that have each, and those of label 1; added up slice by slice."""
    distinct, df, df1 = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)
    for at, end in slices(array):
        of, terms, _ = term_counts(array.slice(at, end - at))
        seen, ones = np.append(df, np.ones(len(of))), np.append(df1, labels[of + at])
        distinct, code = np.unique(np.append(distinct, terms), return_inverse=True)
        df, df1 = np.bincount(code, seen, len(distinct)), np.bincount(code, ones, len(distinct))
    return distinct, df, df1


def known_terms(array: pa.StringArray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place in `known` (ascending, every term is in it) and count of every term of every text, by text and term."""
    parts = [(np.zeros(0, np.int32),) * 3]
    for at, end in slices(array):
        of, terms, counts = term_counts(array.slice(at, end - at))
        parts.append(tuple(x.astype(np.int32) for x in (of + at, np.searchsorted(known, terms), counts)))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


class BlockMaxIndex:
    """Weights of all terms of all examples: lists by term for rare terms, a table for frequent ones.

    The sums over rare terms are made for every example. What the frequent
    terms can add in a block of examples is bounded by the product with the
    block's largest weights, and by the product of lengths. Only blocks whose
    bound reaches the k-th best cosine are looked at further, and the cosines
    given are added up in double precision: the result is exact.
    """

    def __init__(self, term: np.ndarray, example: np.ndarray, weight: np.ndarray, terms: int, examples: int):
        self.examples = examples
        if len(example) and (np.diff(example) < 0).any():
            order = np.argsort(example, kind="stable")
            term, example, weight = term[order], example[order], weight[order]
        df = np.bincount(term, minlength=terms)
        frequent = np.flatnonzero(df * FREQUENT > examples)
        self.row = np.full(terms, -1, np.int32)
        self.row[frequent] = np.arange(len(frequent))
        row = self.row[term]
        rare = np.flatnonzero(row < 0)
        rare = rare[np.argsort(term[rare], kind="stable")]
        self.starts = np.concatenate([[0], np.cumsum(np.where(self.row < 0, df, 0))])
        self.rare_example, self.rare_weight = example[rare].astype(np.intp), weight[rare]  # as bincount takes them
        own = np.flatnonzero(row >= 0)
        self.full = np.zeros((examples, len(frequent)), weight.dtype)
        self.full[example[own], row[own]] = weight[own]
        self.table = self.full.astype(np.float32, copy=False)
        self.length = np.sqrt(np.einsum("ij,ij->i", self.table, self.table))
        firsts = np.arange(0, examples, BLOCK)
        self.most = np.maximum.reduceat(self.table, firsts, axis=0) if examples else self.table
        self.firsts = firsts
        self.longest = np.maximum.reduceat(self.length, firsts) if examples else self.length

    def _rare(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Sums over rare terms, for every example."""
        lists = [slice(a, b) for a, b in zip(self.starts[terms].tolist(), self.starts[terms + 1].tolist(), strict=True)]
        if not lists:
            return np.zeros(self.examples)
        add = np.concatenate([self.rare_weight[x] for x in lists]) * np.repeat(weights, self.starts[terms + 1] - self.starts[terms])
        return np.bincount(np.concatenate([self.rare_example[x] for x in lists]), add, self.examples)

    def nearest(
        self, asked: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int] | None = None
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text (terms, weights) the examples with the k largest cosines above 0, best first, ties by example.

        The texts are few and answered together: what they may need of the
        table is one matrix product. `without` leaves one example out of each.
        """
        n, none = self.examples, (np.zeros(0, np.int64), np.zeros(0))
        if not n or not asked:
            return [none] * len(asked)
        sums, wide = np.zeros((len(asked), n)), np.zeros((len(asked), self.table.shape[1]))
        for i, (terms, weights) in enumerate(asked):
            row = self.row[terms]
            sums[i] = self._rare(terms[row < 0], weights[row < 0])
            wide[i, row[row >= 0]] = weights[row >= 0]
        narrow = wide.astype(np.float32)
        if without is not None:
            sums[np.arange(len(asked)), without] = -2.0
        length = np.sqrt(np.einsum("ij,ij->i", narrow, narrow))[:, None]
        bound = np.maximum.reduceat(sums, self.firsts, axis=1) + np.minimum(narrow @ self.most.T, length * self.longest)
        need = np.zeros(len(self.firsts), bool)
        for i in range(len(asked)):  # against a first guess of the k-th best
            some = (self.firsts[np.argsort(-bound[i])[:SEEDS], None] + np.arange(BLOCK)).ravel()
            some = some[some < n]
            seen = sums[i, some] + self.table[some] @ narrow[i]
            least = np.partition(seen, -k)[-k] if len(seen) >= k else 0.0
            need |= bound[i] >= max(least - 2 * SLACK, SLACK * 1e-6)
        every = need.all()
        rows = None if every else np.flatnonzero(np.repeat(need, BLOCK)[:n])
        seen = (sums if every else sums[:, rows]) + narrow @ (self.table if every else self.table[rows]).T
        out = []
        for i, own in enumerate(seen):
            least = np.partition(own, len(own) - k)[len(own) - k] if len(own) >= k else 0.0
            some = np.flatnonzero(own >= max(least - 2 * SLACK, 0.0))
            some = some[own[some] > 0]
            some = some if every else rows[some]
            cosine = sums[i, some] + self.full[some] @ wide[i]  # in double precision
            first = np.lexsort((some, -np.round(cosine, 12)))[:k]
            out.append((some[first], cosine[first]))
        return out


def vote(labels: np.ndarray, cosine: np.ndarray, prior: float) -> float:
    """Share of label 1 among the neighbours, each weighted by nearness, drawn towards `prior`; as log odds."""
    weight = 1 / (1.05 - np.minimum(cosine, 1.0))
    share = (weight @ labels + PRIOR_WEIGHT * prior) / (weight.sum() + PRIOR_WEIGHT)
    return float(np.log(share / (1 - share)))


def calibrate(votes: np.ndarray, labels: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights of the votes and a constant for the logistic score, with smoothed targets.

    Votes are log odds that each hold the share of label 1 once, so without
    anything learnt they add up, less that share once. The fit starts there and
    is drawn there as by DRAWN examples' worth of evidence, which decides on
    small samples only.
    """
    n1 = float(labels.sum())
    n0 = len(labels) - n1
    base = np.log((n1 + 1) / (n0 + 1))
    start = np.append(np.ones(votes.shape[1]), -(votes.shape[1] - 1) * base)
    if not n1 or not n0:
        return np.append(np.zeros(votes.shape[1]), base)
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([votes, np.ones(len(votes))])
    pull = DRAWN * np.mean(x * x, axis=0) * 0.25
    out = start
    for _ in range(rounds):
        p = logistic(x @ out)
        slope = x.T @ (p - target) + pull * (out - start)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull + 1e-6)
        step = np.linalg.solve(curve, slope)
        out = out - step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return out


def fit(texts: pa.Table) -> dict[str, np.ndarray]:
    """All terms with their idf, the examples' weighted terms, and the calibration, learnt with each example left out."""
    array = string_array(texts.column("text"))
    labels = texts.column("label").to_numpy().astype(np.int64)
    # examples with like terms stand together if they have like labels and ids follow; the order is by id, for repeatability
    order = np.lexsort((texts.column("doc_id").to_numpy(), labels)) if len(labels) else np.zeros(0, np.int64)
    array, labels = array.take(pa.array(order)), labels[order]
    distinct, df, df1 = document_counts(array, labels)
    n, n1 = len(labels), int(labels.sum())
    with np.errstate(divide="ignore", invalid="ignore"):
        cross = df1 * (n - n1 - (df - df1)) - (df - df1) * (n1 - df1)
        chi2 = np.nan_to_num(n * cross**2 / (df * (n - df) * n1 * (n - n1)))
    idf = np.log((1 + n) / (1 + df)) + 1
    of, term, counts = known_terms(array, distinct)
    weight = (1 + np.log(counts)) * idf[term]
    weight = (weight / np.sqrt(np.bincount(of, weight * weight, n))[of]).astype(np.float32)
    bounds = np.searchsorted(of, np.arange(n + 1))
    prior = (n1 + 0.5) / (n + 1)
    blank = np.diff(bounds) == 0
    model = {
        "terms": distinct, "idf": idf, "unknown": np.array([np.log(1 + n) + 1]), "term": term, "bounds": bounds, "weight": weight,
        "tells": np.flatnonzero((df >= MIN_DOCUMENTS) & (chi2 >= MIN_CHI2) & (cross > 0)), "labels": labels,
        "ids": texts.column("doc_id").to_numpy()[order], "prior": np.array([prior]),
        "blank": np.array([(labels[blank].sum() + prior) / (blank.sum() + 1)]),
    }
    scorer = Scorer(model)
    asked = np.flatnonzero(~blank)
    votes = []
    for at in range(0, len(asked), TOGETHER):
        some = asked[at : at + TOGETHER].tolist()
        texts_ = [(term[bounds[i] : bounds[i + 1]], weight[bounds[i] : bounds[i + 1]].astype(float)) for i in some]
        votes += [v for v, _, _ in scorer.votes(texts_, some)]
    model["ab"] = calibrate(np.array(votes).reshape(-1, 2), labels[asked])
    return model


def train(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, limit: int = FIT_ROWS) -> str:
    """Path of the model in the shared folder: all terms of at most `limit` examples do not pass through the driver."""
    return fit_to_file(labelled_sample(docs, labels, "toxic", modulus, held_out, limit), fit)


class Scorer:
    """Two votes: of the nearest examples by all terms, and of those nearest by the terms that tell the labels apart."""

    def __init__(self, model: dict[str, np.ndarray]):
        self.model, self.labels, self.prior = model, model["labels"], float(model["prior"][0])
        terms, n = len(model["terms"]), len(self.labels)
        example = np.repeat(np.arange(n, dtype=np.int32), np.diff(model["bounds"]))
        self.index = BlockMaxIndex(model["term"], example, model["weight"], terms, n)
        self.tell = np.full(terms, -1, np.int32)
        self.tell[model["tells"]] = np.arange(len(model["tells"]))
        own = np.flatnonzero(self.tell[model["term"]] >= 0)
        example, weight = example[own], model["weight"][own].astype(float)
        length = np.sqrt(np.bincount(example, weight * weight, n))
        self.telling = BlockMaxIndex(self.tell[model["term"][own]], example, weight / length[example], len(model["tells"]), n)
        mute = length == 0
        share = (self.labels[mute].sum() + self.prior) / (mute.sum() + 1)
        self.mute = float(np.log(share / (1 - share)))
        self.known: dict[bytes, tuple[float, np.ndarray, np.ndarray]] = {}

    def votes(
        self, asked: list[tuple[np.ndarray, np.ndarray]], without: list[int] | None = None
    ) -> list[tuple[list[float], np.ndarray, np.ndarray]]:
        """Log odds of both votes, nearest examples and cosines of texts (terms, weights); `without` leaves one out of each."""
        near = self.index.nearest(asked, NEIGHBOURS, without)
        telling, which = [], []
        for i, (terms, weights) in enumerate(asked):
            own = self.tell[terms] >= 0
            if own.any():
                telling.append((self.tell[terms[own]], weights[own] / np.sqrt(weights[own] @ weights[own])))
                which.append(i)
        told = [self.mute] * len(asked)
        left = None if without is None else [without[i] for i in which]
        for i, (by, likeness) in zip(which, self.telling.nearest(telling, NEIGHBOURS, left), strict=True):
            told[i] = vote(self.labels[by], likeness, self.prior)
        return [([vote(self.labels[e], c, self.prior), t], e, c) for (e, c), t in zip(near, told, strict=True)]

    def answers(self, asked: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Score, nearest examples and cosines of texts with such terms; texts with the same are answered once."""
        keys = [hashlib.blake2b(t.tobytes() + w.tobytes(), digest_size=16).digest() for t, w in asked]
        if len(self.known) > KNOWN_ANSWERS:
            self.known.clear()
        new = {key: i for i, key in enumerate(keys) if key not in self.known}
        order = sorted(new.values())
        for at in range(0, len(order), TOGETHER):
            some = order[at : at + TOGETHER]
            for i, (votes, near, cosine) in zip(some, self.votes([asked[i] for i in some]), strict=True):
                odds = float(np.append(votes, 1.0) @ self.model["ab"])
                self.known[keys[i]] = float(logistic(odds)), near[:EVIDENCE], cosine[:EVIDENCE]
        return [self.known[key] for key in keys]

    def texts(self, array: pa.StringArray) -> tuple[np.ndarray, list[list[dict]]]:
        known = self.model["terms"]
        of, terms, counts = term_counts(array)
        at = np.minimum(np.searchsorted(known, terms), max(0, len(known) - 1))
        hit = known[at] == terms if len(known) else np.zeros(len(terms), bool)
        # a term that no example has makes a text longer, so less like any example
        weights = 1 + np.log(counts)
        weights[hit] *= self.model["idf"][at[hit]]
        weights[~hit] *= self.model["unknown"][0]
        weights /= np.sqrt(np.bincount(of, weights * weights, len(array)))[of]
        of, terms, weights = of[hit], at[hit], weights[hit]
        bounds = np.searchsorted(of, np.arange(len(array) + 1))
        scores, evidence = np.full(len(array), self.model["blank"][0]), [[] for _ in range(len(array))]
        asked = np.flatnonzero(np.diff(bounds)).tolist()
        found = self.answers([(terms[bounds[i] : bounds[i + 1]], weights[bounds[i] : bounds[i + 1]]) for i in asked])
        for i, (value, near, cosine) in zip(asked, found, strict=True):
            scores[i] = value
            evidence[i] = [
                {"doc_id": int(self.model["ids"][e]), "label": int(self.labels[e]), "cosine": float(c)}
                for e, c in zip(near, cosine, strict=True)
            ]
        return scores, evidence


EVIDENCE_TYPE = "array<struct<doc_id: bigint, label: int, cosine: double>>"


def _scored(docs: DataFrame, model: str, keep: list[str]) -> DataFrame:
    held: dict[int, Scorer] = {}
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))

    def work(part):
        if not held:
            held[0] = Scorer(load_arrays(model))  # one for the task
        scores, evidence = held[0].texts(part)
        return [pa.array(scores), pa.array(evidence, kind)]

    added = StructType.fromDDL(f"score double, evidence {EVIDENCE_TYPE}")
    return map_rows(docs, keep, added, work)


def score(docs: DataFrame, model: str, keep: list[str] | None = None) -> DataFrame:
    """Add `score` (0 to 1, higher: label 1 likelier) and `evidence`, the nearest examples, to the columns `keep` (doc_id).

    The score depends on the text alone. A text without any term that an
    example has (an empty or null one too) has no neighbours and gets the share
    of label 1 among examples without terms, drawn towards that among all.
    Columns `score` and `evidence` among those kept give way.
    """
    return flat_rows(_scored(docs, model, keep or ["doc_id"]), "score", "evidence")


def clean(docs: DataFrame, model: str) -> DataFrame:
    """The rows whose score is below ACCEPT, as they are, whatever their columns are called."""
    return flat_rows(_scored(docs, model, docs.columns).where(F.col("score") < ACCEPT).select("row"))


def classify(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence of every document. A null doc_id is not held out."""
    scored = score(docs, train(docs, labels, limit=limit))
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
        "evidence",
    )
