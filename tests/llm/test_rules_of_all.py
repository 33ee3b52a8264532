import numpy as np
import pytest

from vellumark.llm import rules


def test_draws_of_parts_are_those_of_the_whole():
    ids = np.arange(5000)
    good = ids % 10 != 0
    counts = (int(good.sum()), int((~good).sum()))
    at, key = rules.drawn(ids, good, counts, 7)
    whole = set(ids[at[np.lexsort((ids[at], key))][: rules.TREE_ROWS]])
    parts = [rules.drawn(ids[k::3], good[k::3], counts, 7) for k in range(3)]
    both = sorted((x, int(ids[k::3][i])) for k, (own, keys) in enumerate(parts) for i, x in zip(own, keys, strict=True))
    assert whole == {i for _, i in both[: rules.TREE_ROWS]}
    assert 2 <= sum(not good[i] for i in whole) <= 40


@pytest.mark.parametrize("steps", [4096, 7])
def test_all_labelled_rows_set_the_threshold(spark, monkeypatch, steps):
    """More rows than the 12,000 that once were fitted; counts over parts against the sorted whole."""
    monkeypatch.setattr(rules, "STEPS", steps)
    draw = np.random.default_rng(3)
    good = np.round(draw.beta(2, 5, 13_000), 3)
    bad = np.round(draw.beta(5, 2, 600), 3)
    rows = [(float(a), 1) for a in good] + [(float(a), 0) for a in bad]
    found = rules.threshold(spark.createDataFrame(rows, "anomaly double, label int"))
    values = np.unique(np.concatenate([good, bad]))
    kept_good = np.array([(good <= v).mean() for v in values])
    kept_bad = np.array([(bad <= v).mean() for v in values])
    best = int(np.argmax(np.where(kept_good >= rules.GOOD_KEPT, kept_good - kept_bad, -2)))
    assert found == (values[best] + values[best + 1]) / 2
