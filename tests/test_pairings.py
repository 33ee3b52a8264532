import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from vellumark.operators import enrichment, pairings
from vellumark.operators.term_blocks import Cells


def expected(texts, top):
    uses = Counter()
    for t in (x.split() for x in texts):
        uses.update(((t[i - 1], t[i + 1]), t[i]) for i in range(1, len(t) - 1))
    places = {}
    for (place, term), n in uses.items():
        places.setdefault(place, {})[term] = n
    scores = {}
    for own in places.values():
        for a in own:
            for b in own:
                if a != b:
                    scores.setdefault(a, Counter())[b] += min(own[a], own[b])
    return {
        (a, r, b, n) for a, c in scores.items() for r, (b, n) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:top], 1)
    }


@pytest.mark.parametrize("few", [False, True])
def test_all_terms_of_a_place_are_alternates(spark, monkeypatch, few):
    """A place where no term has an eighth of the uses offers alternates, too; on a grid of many cells as on one."""
    if few:
        for name, value in (("CELL", 40), ("PAIRS", 50), ("SMALL", 0)):
            monkeypatch.setattr(pairings, name, value)
    draw = random.Random(4)
    texts = [f"of {a}{b}x him" for a in "abcdefgh" for b in "abcdefgh"]
    texts += [" ".join(draw.choices("ab bc cd de ef fg gh hi ij".split(), k=12)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    got = [tuple(r) for r in enrichment.alternates(df, share=None, top=7).collect()]
    assert len(got) == len(set(got)) and set(got) == expected(texts, 7)
    wanted = spark.createDataFrame([("ab",), ("aax",), ("none",)], "term string")
    some = enrichment.alternates(df, share=None, top=7, asked=wanted).collect()
    assert {tuple(r) for r in some} == {r for r in expected(texts, 7) if r[0] in ("ab", "aax")}
    assert {r.alternate for r in some if r.term == "aax"} == {f"a{b}x" for b in "bcdefgh"}


def slices_of(uses, most, number):
    """The uses (place, id, n) cut into slices of alternates, strongest first."""
    total = np.bincount(uses[1], uses[2]).astype(np.int64)
    by = np.argsort(-total, kind="stable")
    for ids in np.array_split(by, number):
        here = np.isin(uses[1], ids)
        yield [x[here] for x in uses], int(total[ids].max()) if most else 1 << 40


def all_pairs(uses, top):
    scores = {}
    for p in np.unique(uses[0]):
        here = uses[0] == p
        own = list(zip(uses[1][here].tolist(), uses[2][here].tolist()))
        for a, n in own:
            for b, m in own:
                if a != b:
                    scores.setdefault(a, Counter())[b] += min(n, m)
    return {(a, r, b, n) for a, c in scores.items() for r, (b, n) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:top], 1)}


@pytest.mark.parametrize("seed", range(6))
def test_bounds_leave_the_best_alternates_as_they_are(monkeypatch, seed):
    draw = np.random.default_rng(seed)
    monkeypatch.setattr(pairings, "PAIRS", (7, 1 << 21)[seed % 2])
    monkeypatch.setattr(pairings, "TRIED", (1, 256)[seed // 2 % 2])
    drawn = draw.zipf(1.3, 4000) % 60, draw.zipf(1.2, 4000) % 90
    (place, id_), n = np.unique(np.stack(drawn), axis=1, return_counts=True)
    sizes = np.bincount(place)
    kept = sizes[place] > 1
    uses = [x[kept].astype(np.int64) for x in (place, id_, n)]
    own = [*uses, sizes[uses[0]].astype(np.int64)]
    for number in (1, 3, 8):
        made = pairings.best_of_slice(own, slices_of(uses, seed % 3, number), 5, 7)
        got = list(zip(*(x.tolist() for x in made)))
        assert len(got) == len(set(got)) and set(got) == all_pairs(uses, 5)


def test_a_place_of_very_many_terms_is_looked_up(monkeypatch):
    """Forty terms share thirty places; a place of 20,000 terms, in which they are once each, is not gone through for them."""
    gone_through = []
    sums = pairings._sums

    def counted(uses, *rest):
        gone_through.append(int(uses.size.sum()))
        return sums(uses, *rest)

    monkeypatch.setattr(pairings, "_sums", counted)
    place = np.concatenate([np.repeat(np.arange(30), 40), np.full(20_000, 30)])
    id_ = np.concatenate([np.tile(np.arange(40), 30), np.arange(20_000)])
    uses = [place, id_, np.ones(len(place), np.int64)]
    asked = id_ < 40
    own = [x[asked] for x in (*uses, np.bincount(place)[place])]
    of, rank, other, score = pairings.best_of_slice(own, slices_of(uses, True, 4), 5, 15)
    assert len(of) == 200 and set(score.tolist()) == {31} and set(other.tolist()) == set(range(6))
    assert rank.tolist() == [1, 2, 3, 4, 5] * 40
    assert sum(gone_through) < 40 * 20_000 / 4


def test_uses_of_blocks_of_any_width():
    """Words across texts are no neighbours; places are numbers of their terms' ids."""
    own = pa.table({"at": [2, 0, 1], "id": [70, 10, 30], "mark": [5, 4, 3]})
    codes = np.array([0, 1, 2, 1, 2, -1, 1, 2, -1, -1, 0, 1, 2, -1], np.int32)
    cells = Cells(None, None, None, None, codes)
    want = {(10 * 100 + 70, 30, 2, 3), (30 * 100 + 30, 70, 1, 5), (70 * 100 + 70, 30, 1, 3)}
    for bits in (63, 1):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(pairings, "_BITS", bits)
            assert {tuple(r.values()) for r in pairings.block_uses(own, cells, 100).to_pylist()} == want
