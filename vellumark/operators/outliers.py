"""Unusual documents: by an isolation forest and by rarity of their values.

Both score the distinct combinations of values, not the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumark.functions.values import fill_unknown
from vellumark.operators.skew import hot_keys, join_unique
from vellumark.session import stored

FEATURES = ("version", "document_status", "retention_policies", "sensitivity_labels")
CONTAMINATION = 0.05
TREES = 100
SAMPLE = 256
SEED = 42
_EULER = 0.5772156649015329


def _combinations(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with missing features filled, and the distinct combinations with their counts."""
    filled = fill_unknown(df.withColumns({c: F.col(c).cast("string") for c in features}), list(features))
    return filled, filled.groupBy(*features).agg(F.count("*").alias("n"))


def _flag(scored: DataFrame, share: float) -> DataFrame:
    """Combinations above the (1 - share) percentile of the documents' scores.

    Scores have 6 digits; the percentile sees counts per distinct score.
    """
    per_score = scored.groupBy("score").agg(F.sum("n").alias("n"))
    cut = per_score.agg(F.percentile("score", F.lit(1 - share), F.col("n"))).scalar()
    return scored.filter(F.col("score") > cut).drop("n")


def rarity_outliers(
    df: DataFrame, features: Sequence[str] = FEATURES, share: float = CONTAMINATION
) -> DataFrame:
    """Documents with the rarest values, by the sum of -ln(share of each value)."""
    filled, combinations = _combinations(df, features)
    combinations = stored(combinations, "combinations")
    total = combinations.agg(F.sum("n")).scalar()
    scored = combinations
    for c in features:
        seen = combinations.groupBy(c).agg((-F.log(F.sum("n") / total)).alias(f"_s_{c}"))
        scored = join_unique(scored, seen, c, "inner", hot=hot_keys(combinations, [c]))
    score = F.round(sum((F.col(f"_s_{c}") for c in features), F.lit(0.0)), 6)
    scored = stored(scored.withColumn("score", score).select(*features, "n", "score"), "rarity-scores")
    return join_unique(filled, _flag(scored, share), list(features), "inner")


def _mean_path(n: int) -> float:
    """Mean depth of an unsuccessful search in a tree of n rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (np.log(n - 1.0) + _EULER) - 2.0 * (n - 1.0) / n


def _digest(*parts: object) -> str:
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


def _grow(rows: np.ndarray, weights: np.ndarray, name: tuple, path: str, limit: int, nodes: list) -> int:
    """Add the node of these rows, return its number.

    A split asks whether one feature has one value: a random cut of a one-hot
    column. Of all cuts that part the node's rows the one of the smallest
    digest is taken. Node: (feature, value, node if not, node if so, depth at a leaf).
    """
    at, count = len(nodes), int(weights.sum())
    nodes.append((-1, "", -1, -1, len(path) + _mean_path(count)))
    if len(path) >= limit or count <= 1:
        return at
    choices = []
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        if len(values) > 1:
            choices += [(_digest(*name, path, f, v), f, v) for v in values.tolist()]
    if not choices:
        return at
    _, feature, value = min(choices)
    match = rows[:, feature] == value
    no = _grow(rows[~match], weights[~match], name, path + "0", limit, nodes)
    yes = _grow(rows[match], weights[match], name, path + "1", limit, nodes)
    nodes[at] = (feature, value, no, yes, 0.0)
    return at


def _depths(rows: np.ndarray, tree: dict) -> np.ndarray:
    """Depth each row reaches in a tree."""
    out = np.zeros(len(rows))
    todo = [(0, np.arange(len(rows)))]
    while todo:
        node, at = todo.pop()
        feature = tree["feature"][node]
        if feature < 0:
            out[at] = tree["depth"][node]
            continue
        match = rows[at, feature] == tree["value"][node]
        todo += [(tree["no"][node], at[~match]), (tree["yes"][node], at[match])]
    return out


_TREE = "tree int, feature array<int>, value array<string>, no array<int>, yes array<int>, depth array<double>"


def drawn_rows(
    combinations: DataFrame, features: Sequence[str], trees: int = TREES, sample: int = SAMPLE, seed: int = SEED
) -> DataFrame:
    """tree, the features, w: how many rows of each combination a tree draws, about `sample` of all rows together.

    A combination's share of the sample is rounded up or down by a digest of
    tree and combination, so a rare one is in few trees. Each combination is
    looked at by itself, whatever its number of rows.
    """
    names = list(features)
    total = combinations.agg(F.sum("n")).scalar()
    share = F.col("n") * F.least(F.lit(sample), total) / total
    text = F.concat_ws("|", F.lit(str(seed)), F.col("tree").cast("string"), *names)
    chance = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(1 << 32)
    every = combinations.withColumn("share", share).withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    w = F.floor("share") + (chance < F.col("share") - F.floor("share")).cast("bigint")
    return every.select("tree", *names, w.alias("w")).where("w > 0")


def grow_forest(
    combinations: DataFrame, features: Sequence[str], trees: int = TREES, sample: int = SAMPLE, seed: int = SEED
) -> DataFrame:
    """Trees over the rows that each draws; a tree is the work of one task and has `sample` rows or so."""
    names = list(features)
    rows = combinations.agg(F.sum("n")).first()[0] or 0
    limit = int(np.ceil(np.log2(max(min(sample, rows), 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        nodes: list = []
        _grow(pdf[names].to_numpy(dtype=str), pdf["w"].to_numpy(), (seed, tree), "", limit, nodes)
        feature, value, no, yes, depth = (list(c) for c in zip(*nodes))
        return pd.DataFrame(
            {"tree": [tree], "feature": [feature], "value": [value], "no": [no], "yes": [yes], "depth": [depth]}
        )

    return drawn_rows(combinations, names, trees, sample, seed).groupBy("tree").applyInPandas(grow, _TREE)


def forest_outliers(
    df: DataFrame,
    key: str,
    features: Sequence[str] = FEATURES,
    share: float = CONTAMINATION,
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = SEED,
) -> DataFrame:
    """Documents an isolation forest over one-hot features sets apart, with `score`.

    The forest depends on the features alone; `key` only names the documents.
    Draws and splits go by digests, so it is the same on any partitioning and
    SQL can restate it.
    """
    filled, combinations = _combinations(df, features)
    combinations = stored(combinations, "combinations")
    names = list(features)
    # The forest has trees * (2 * sample) nodes at most, whatever the data.
    forest = [r.asDict() for r in grow_forest(combinations, names, trees, sample, seed).orderBy("tree").collect()]
    rows_used = min(sample, combinations.agg(F.sum("n")).first()[0] or 0)
    usual = _mean_path(rows_used) or 1.0

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = pdf[names].to_numpy(dtype=str)
            depth = sum((_depths(rows, t) for t in forest), np.zeros(len(rows))) / max(len(forest), 1)
            yield pdf.assign(score=np.round(np.power(2.0, -depth / usual), 6))

    schema = ", ".join(f"`{c}` string" for c in names) + ", n bigint, score double"
    scored = stored(combinations.mapInPandas(score, schema), "forest-scores")
    return join_unique(filled, _flag(scored, share), names, "inner")
