"""Quality rules: an isolation forest on rule statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumark.llm.scan import _SPACE, in_slices, per_text, span_hashes, string_array, text_bytes, windows, word_spans
from vellumark.session import stored

TREES = 100
TREE_ROWS = 256
DEPTH = 8
BAD_SHARE = 0.05
MIN_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
GOOD_KEPT = 0.99  # at least this share of the good labelled documents stays above the threshold

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_chars", "n_lines", "n_capital_words", "n_marked_ends", "n_same_words"]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[ord("A") : ord("Z") + 1] = True
_SMALL = np.zeros(256, bool)
_SMALL[ord("a") : ord("z") + 1] = True
_LETTER = np.zeros(256, bool)
for _a, _b in (("A", "Z"), ("a", "z"), ("0", "9")):
    _LETTER[ord(_a) : ord(_b) + 1] = True
_LETTER[128:] = True
_PLAIN_END = _LETTER.copy()
_PLAIN_END[list(b".,;:'\")")] = True


def _repeated(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position: is its key found twice or more in its text; was it found earlier."""
    order = np.lexsort((np.arange(len(keys)), keys, owners))
    k, o = keys[order], owners[order]
    same = np.zeros(len(k), bool)
    same[1:] = (k[1:] == k[:-1]) & (o[1:] == o[:-1])
    twice = same.copy()
    twice[:-1] |= same[1:]
    out, later = np.zeros(len(k), bool), np.zeros(len(k), bool)
    out[order], later[order] = twice, same
    return out, later


def statistics(array: pa.StringArray) -> dict[str, np.ndarray]:
    """Rule statistics of every whole text."""
    body, bounds = text_bytes(array)
    n = len(array)
    begins, ends = word_spans(body, bounds)
    owners = np.searchsorted(bounds, begins, "right") - 1
    hashes = span_hashes(body, begins, ends)
    point = (body & 0xC0) != 0x80
    out = {
        "n_words": np.bincount(owners, minlength=n),
        "word_chars": per_text(point & ~_SPACE[body], bounds),
        "n_symbols": per_text(_SYMBOL[body], bounds),
    }
    made, first = windows(hashes, owners, 3)
    twice, _ = _repeated(made, owners[first])
    covered = np.zeros(len(hashes), bool)
    for k in range(3):
        covered[first[twice] + k] = True
    breaks = np.flatnonzero(body == 10)
    line_begins = np.union1d(bounds[:-1], breaks + 1)
    line_begins = line_begins[line_begins < len(body)]
    line_owner = np.searchsorted(bounds, line_begins, "right") - 1
    line_ends = np.minimum(np.append(line_begins[1:], len(body)), bounds[line_owner + 1])
    closed = (line_ends > line_begins) & (body[np.maximum(line_ends - 1, 0)] == 10)
    line_ends = line_ends - closed
    worded = np.searchsorted(begins, line_ends, "left") > np.searchsorted(begins, line_begins, "left")
    line_begins, line_ends, line_owner = line_begins[worded], line_ends[worded], line_owner[worded]
    _, later = _repeated(span_hashes(body, line_begins, line_ends), line_owner)
    out["n_dup_lines"] = np.bincount(line_owner[later], minlength=n)
    out["n_repeat_words"] = np.bincount(owners[covered], minlength=n)
    out["n_chars"] = per_text(point, bounds)
    out["n_lines"] = np.bincount(line_owner, minlength=n)
    capitals, small = (np.concatenate([[0], np.cumsum(t[body], dtype=np.int64)]) for t in (_CAPITAL, _SMALL))
    loud = (capitals[ends] - capitals[begins] > 1) & (small[ends] == small[begins])
    out["n_capital_words"] = np.bincount(owners[loud], minlength=n)
    marked = ~_PLAIN_END[body[ends - 1]] if len(ends) else np.zeros(0, bool)
    out["n_marked_ends"] = np.bincount(owners[marked], minlength=n)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owners[1:] == owners[:-1])
    out["n_same_words"] = np.bincount(owners[same], minlength=n)
    return {k: v.astype(np.int64) for k, v in out.items()}


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every document; a null text is an empty one."""
    names = [*BASE, *EXTRA]

    def run(batches):
        for batch in batches:
            at = 0
            for part in in_slices(string_array(batch.column("text")), lambda x: x):
                made = statistics(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(part)).cast(pa.int64()), *(pa.array(made[c]) for c in names)],
                    names=["doc_id", *names],
                )
                at += len(part)

    return docs.select("doc_id", "text").mapInArrow(run, ", ".join(["doc_id bigint", *(f"{c} bigint" for c in names)]))


def features(s: dict[str, np.ndarray] | pd.DataFrame) -> np.ndarray:
    """Rates that do not depend on the length of the text."""
    words, chars = np.maximum(np.asarray(s["n_words"], float), 1), np.maximum(np.asarray(s["n_chars"], float), 1)
    lines = np.maximum(np.asarray(s["n_lines"], float), 1)
    rates = [
        np.asarray(s["n_symbols"]) / chars, np.asarray(s["n_dup_lines"]) / lines, np.asarray(s["n_repeat_words"]) / words,
        np.asarray(s["n_capital_words"]) / words, np.asarray(s["n_marked_ends"]) / words, np.asarray(s["n_same_words"]) / words,
    ]
    return np.stack(rates, axis=1)


def _draws(ids: np.ndarray, tree: int) -> np.ndarray:
    """A number between 0 and 1 for each id, by SplitMix64 of id and tree."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) + np.uint64(tree + 1) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 0x9E3779B97F4A7C15)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(29)
    return ((x >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)


def drawn(ids: np.ndarray, good: np.ndarray, counts: tuple[int, int], tree: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of the TREE_ROWS rows of least key, the draw of a tree without replacement; merges over parts.

    `counts` are all good and all bad labelled rows. Rows labelled bad are drawn
    less often, BAD_SHARE of a tree's rows on the whole: as the few among many
    they are what a forest sets apart.
    """
    weight = np.where(good, (1 - BAD_SHARE) / counts[0], BAD_SHARE / counts[1])
    key = -np.log(_draws(ids, tree)) / weight
    best = np.lexsort((ids, key))[:TREE_ROWS] if len(key) <= 2 * TREE_ROWS else np.argpartition(key, TREE_ROWS)[:TREE_ROWS]
    return best, key[best]


def grow(rows: np.ndarray, seed: int) -> dict[str, np.ndarray]:
    """A tree of random splits on its drawn rows; nodes in heap order."""
    random = np.random.default_rng(seed)
    size = (1 << (DEPTH + 1)) - 1
    feature = np.full(size, -1, np.int64)
    split = np.zeros(size)
    length = np.zeros(size)
    held = {0: np.arange(len(rows))}
    for node in range(size):
        if (own := held.pop(node, None)) is None:
            continue
        depth = (node + 1).bit_length() - 1
        low, high = rows[own].min(axis=0), rows[own].max(axis=0)
        able = np.flatnonzero(high > low)
        if depth == DEPTH or len(own) < 2 or not len(able):
            length[node] = depth + _mean_path(len(own))
            continue
        f = int(random.choice(able))
        at = random.uniform(low[f], high[f])
        feature[node], split[node] = f, at
        left = rows[own, f] <= at
        held[2 * node + 1], held[2 * node + 2] = own[left], own[~left]
    return {"feature": feature, "split": split, "length": length}


def _mean_path(n: int) -> float:
    """Mean depth of a search that ends among n rows without telling them apart."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def anomaly(model: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """2 ** (- mean path length / expected one): near 1 for rows that few splits set apart."""
    total = np.zeros(len(rows))
    at_row = np.arange(len(rows))
    for feature, split, length in zip(model["feature"], model["split"], model["length"], strict=True):
        node = np.zeros(len(rows), np.int64)
        for _ in range(DEPTH):
            f = feature[node]
            inner = f >= 0
            right = rows[at_row, np.maximum(f, 0)] > split[node]
            node = np.where(inner, 2 * node + 1 + right, node)
        total += length[node]
    return 2.0 ** (-total / len(model["feature"]) / max(_mean_path(int(model["rows"][0])), 1e-9))


def labelled_statistics(made: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, label and statistics of every labelled document with enough words.

    A document labelled more than once has its largest label, one with several rows its smallest statistics.
    """
    rows = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    names = [*BASE, *EXTRA]
    once = made.groupBy("doc_id").agg(F.min(F.struct(*names)).alias("s")).select("doc_id", "s.*")
    return once.where(F.col("n_words") >= MIN_WORDS).join(rows, "doc_id").select("doc_id", "label", *names)


def forest(rows: DataFrame, counts: tuple[int, int]) -> dict[str, np.ndarray]:
    """TREES trees, each on TREE_ROWS rows drawn of all `rows`: tasks keep the least keys of their part, a tree grows in a task."""
    names = [*BASE, *EXTRA]
    kept = ["doc_id", *names]
    schema = ", ".join(["tree int", "key double", *(f"{c} bigint" for c in kept)])

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: list[pd.DataFrame | None] = [None] * TREES
        for pdf in batches:
            ids, good = pdf["doc_id"].to_numpy(), pdf["label"].to_numpy() == 1
            for t in range(TREES):
                at, key = drawn(ids, good, counts, t)
                some = pdf.iloc[at][kept].assign(key=key)
                both = some if best[t] is None else pd.concat([best[t], some])
                best[t] = both.sort_values(["key", "doc_id"])[:TREE_ROWS]
        for t, some in enumerate(best):
            if some is not None:
                yield some.assign(tree=t)[["tree", "key", *kept]]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        own = pdf.sort_values(["key", "doc_id"])[:TREE_ROWS]
        return pd.DataFrame({"tree": [tree], **{k: [v.tobytes()] for k, v in grow(features(own), tree).items()}})

    grown = rows.mapInPandas(draw, schema).groupBy("tree").applyInPandas(one, "tree int, feature binary, split binary, length binary")
    trees = sorted(grown.collect(), key=lambda r: r["tree"])  # TREES trees of fixed depth
    read = {c: np.stack([np.frombuffer(r[c], kind) for r in trees]) for c, kind in (("feature", np.int64), ("split", float), ("length", float))}
    return read | {"rows": np.array([min(TREE_ROWS, sum(counts))])}


STEPS = 4096  # parts of the anomaly's range, whose counts pass through the driver


def threshold(scored: DataFrame) -> float:
    """The threshold on `anomaly` that tells all `label`s apart best (the sum of both classes' right shares).

    But never one that loses more than 1 - GOOD_KEPT of the good documents. Counts below a value are those of the parts
    before its own, summed by the driver, and those within its part.
    """
    each = scored.groupBy("anomaly").agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad"))
    each = stored(each.withColumn("part", F.floor(F.col("anomaly") * STEPS)), "anomalies")
    parts = each.groupBy("part").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).orderBy("part").collect()
    good, bad = (sum(p[c] for p in parts) for c in ("good", "bad"))
    before, g, b = [], 0, 0
    for p in parts:
        before.append((p["part"], g, b))
        g, b = g + p["good"], b + p["bad"]
    known = F.broadcast(scored.sparkSession.createDataFrame(before, "part bigint, g bigint, b bigint"))
    upto = Window.partitionBy("part").orderBy("anomaly").rowsBetween(Window.unboundedPreceding, 0)
    kept_good = (F.col("g") + F.sum("good").over(upto)) / F.lit(good)
    kept_bad = (F.col("b") + F.sum("bad").over(upto)) / F.lit(bad)
    steps = each.join(known, "part").select("anomaly", kept_good.alias("kept_good"), kept_bad.alias("kept_bad"))
    value = F.when(F.col("kept_good") >= GOOD_KEPT, F.col("kept_good") - F.col("kept_bad")).otherwise(F.lit(-2.0))
    best = -steps.agg(F.max(F.struct(value.alias("v"), (-F.col("anomaly")).alias("a"))).alias("m")).first()["m"]["a"]
    above = each.where(F.col("anomaly") > best).agg(F.min("anomaly")).first()[0]
    return (best + (best + 1 if above is None else above)) / 2


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, base statistics, base_failed, kept and `anomaly` of every document.

    Empty and null texts have no words and fail the base rules. An empty table
    gives no rows; without usable labels only the base rules reject. Trees are
    drawn of all labelled documents, and all of them set the threshold.
    """
    made = stored(document_statistics(docs), "statistics")
    rows = stored(labelled_statistics(made, labels), "labelled-statistics")
    counts = tuple(rows.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first())
    if min(counts):
        model = forest(rows, counts)
    else:
        none = np.zeros((0, 1))
        model = {"feature": none.astype(np.int64), "split": none, "length": none, "rows": np.array([2])}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(*columns):
        frame = pd.DataFrame({c: x for c, x in zip([*BASE, *EXTRA], columns, strict=True)})
        return pd.Series(np.round(anomaly(shared.value, features(frame)), 9))

    score = of(*[*BASE, *EXTRA])
    limit = threshold(rows.select("label", score.alias("anomaly"))) if min(counts) else 2.0
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    scored = made.withColumn("base_failed", failed).withColumn("anomaly", score)
    return scored.select(
        "doc_id", *BASE, "base_failed", (~F.col("base_failed") & (F.col("anomaly") <= limit)).alias("kept"), "anomaly"
    )
