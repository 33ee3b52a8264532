"""Conversation repair against exhaustive edits, and against the chart over all spans and splits."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from vellumark.llm import repair

SHAPE = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, kind string, span string, place string"
KINDS = [a + b for a in "sua " for b in ".tbd"]


def exhaustive(kinds, most=2):
    """Cheapest edits of a few rows, by trying all of them with up to `most` insertions in each gap."""
    gaps = ["".join(g) for n in range(most + 1) for g in itertools.product("ua", repeat=n)]
    found = None
    for choice in itertools.product(*[["D"] if k[1] in "bd" else ["D", "Ru", "Ra", "K"] for k in kinds]):
        base = sum(4 if c == "D" else 3 * (c != "K") + 3 * (k[1] == "t") for c, k in zip(choice, kinds))
        roles = ["" if c == "D" else k[0] if c == "K" else c[1] for c, k in zip(choice, kinds)]
        for between in itertools.product(gaps, repeat=len(kinds) + 1):
            if SHAPE.fullmatch("".join(x + y for x, y in itertools.zip_longest(between, roles, fillvalue=""))):
                audit = "".join("I" * len(g) + c[:1] for g, c in itertools.zip_longest(between, choice, fillvalue=""))
                made = (base + 3 * sum(map(len, between)), audit)
                found = made if found is None or made < found else found
    return found


def whole_chart(kinds):
    """Cells of all spans from all their splits, by span length."""
    n = len(kinds)
    chart = {(i, i + 1): repair.row_cell(k) for i, k in enumerate(kinds)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cells = [repair.combine(chart[i, m], chart[m, i + length]) for m in range(i + 1, i + length)]
            chart[i, i + length] = tuple(min((c[k] for c in cells if c[k] is not None), default=None) for k in range(len(cells[0])))
    return chart[0, n]


def test_cells_equal_exhaustive_edits():
    for n in (1, 2):
        for kinds in itertools.product(KINDS, repeat=n):
            assert repair.cheapest(repair.span_cell("".join(kinds))) == exhaustive(kinds), kinds
    draw = np.random.default_rng(4)
    for _ in range(25):
        kinds = [KINDS[k] for k in draw.integers(0, len(KINDS), 3)]
        assert repair.cheapest(repair.span_cell("".join(kinds))) == exhaustive(kinds), kinds


def test_one_split_a_span_equals_all_splits():
    draw = np.random.default_rng(5)
    for n in (3, 4, 7, 12, 21):
        for _ in range(6):
            kinds = [KINDS[k] for k in draw.integers(0, len(KINDS), n)]
            assert repair.span_cell("".join(kinds)) == whole_chart(kinds)


def follow(kinds):
    """The same by one pass over the rows, place by place; for long conversations."""
    def close(state):
        for p, q in ((0, 2), (1, 2), (3, 2), (2, 3)):
            if p in state:
                made = (state[p][0] + 3, state[p][1] + "I")
                state[q] = min(state.get(q, made), made)
        return state

    state = close(close({0: (0, "")}))
    for initial, fault in kinds:
        new = {p: (c + 4, a + "D") for p, (c, a) in state.items()}
        for letter, way, cost in ((initial, "K", 0), ("u", "R", 3), ("a", "R", 3)):
            if fault in ".t":
                for p, q in {"s": [(0, 1)], "u": [(0, 2), (1, 2), (3, 2)], "a": [(2, 3)]}.get(letter, []):
                    if p in state:
                        made = (state[p][0] + cost + 3 * (fault == "t"), state[p][1] + way)
                        new[q] = min(new.get(q, made), made)
        state = close(close(new))
    return min(state[q] for q in (0, 3) if q in state)


def expected(rows):
    """Summary of each conversation's rows by plain Python."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(r[1], r[2] if r[2] is not None else " ", r[3] if r[3] is not None else " ") for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        seen, kinds = set(), []
        for _, role, text in own:
            bare = text.rstrip(repair.SPACE)
            fault = "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "."
            seen.add((role, text))
            kinds.append((role[:1] if role[:1] in ("s", "u", "a") else " ") + fault)
        cost, audit = follow(kinds)
        kept, at, total = [], 0, len(audit) - audit.count("D")
        left = iter(own)
        for letter in audit:
            row = next(left) if letter != "I" else None
            if letter != "D":
                role = row[1] if letter == "K" else repair.role_at(at, total)
                kept.append(f"{role}:{row[2] if row else ''}")
                at += 1
        assert SHAPE.fullmatch("".join(k[0] for k in kept))
        turns = [t for t, _, _ in own if t is not None]
        initials = [r[:1] for _, r, _ in own]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(sum(k[1] == f for k in kinds) for f in "bdt"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest(),
        )
    return out


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw:
            text = "" if draw == 1 else re.sub(r"[.!?]", "", text) if draw == 2 else text
            out += [(conv, turn, "user" if draw == 4 else role, text)] * (1 + (draw == 3))
    return out


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(9)
    out = []
    for conv in range(40):
        for turn in range(draw.integers(1, 9)):
            role = ["user", "assistant", "system", "tool", "", "unter"][min(5, draw.geometric(0.45) - 1)]
            out.append((conv, turn, role, f"Text {draw.integers(0, 9)}." if draw.random() < 0.7 else "open end"))
    out += [(1, 3, "user", "Again."), (1, 3, "user", "Again."), (1, None, "user", "Early."), (2, 900, None, None)]
    out += [(None, 0, "user", "No id."), (None, 1, "assistant", "é\n \x0b"), (None, None, None, None), (50, None, "user", "  \t\n")]
    out += [(77, int(t), ["user", "assistant", "user"][t % 3], f"Line {t % 900}.") for t in draw.permutation(1500)]  # a third of all and more
    out += [(78, None, "user", "One row, again and again.")] * 300
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA).repartition(4)


def test_repair_equals_plain_python(spark, rows):
    summary, made = repair.repair(frame(spark, rows))
    want = expected(rows)
    got = {r["conv_id"]: tuple(r)[1:] for r in summary.collect()}
    assert got == want
    lines = {}
    for r in made.orderBy("place").collect():
        lines.setdefault(r["conv_id"], []).append((r["place"], f"{r['role']}:{r['text']}"))
    for conv, own in lines.items():
        assert [p for p, _ in own] == list(range(len(own)))
        assert hashlib.sha256("\n".join(x for _, x in own).encode()).hexdigest() == want[conv][-1]
    assert {c for c, w in want.items() if w[-2].strip("D")} == set(lines)


def test_query_over_damaged_rows(spark, rows):
    left = expected(damage(rows))
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.repair_damaged(frame(spark, rows)).collect()}
    assert got == {conv: left.get(conv, none) for conv in {r[0] for r in rows}}


def test_empty_table(spark):
    assert repair.repair_damaged(frame(spark, [])).count() == 0
