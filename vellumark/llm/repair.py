"""Conversation structure repair by weighted CYK interval parsing.

The grammar of repaired conversations, `(s?(ua)+)?` over role initials, has four
places: nothing read, after s, after u, after a. In Chomsky normal form its
nonterminals are pairs of places, N_pq -> N_pr N_rq; a row gives N_pq by Keep,
Rerole or Delete, no row gives it by Insert. A cell of the chart has, for a span
of rows, the least (cost, audit) of every nonterminal, closed under insertions
on both sides. Because the binary rules hold for every place r, one split of a
span gives the same cell as all its splits; so spans of 1, 2, 4, ... rows are
combined bottom-up and the chart has two cells a row, not one for every interval.

Audits of one cell and cost are never a prefix of one another (a longer one has
more insertions, which cost), so the least of parts gives the least of the whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumark.session import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPAN_ROWS = 64  # rows of a leaf span; longer conversations are spread over tasks by such spans
SPACE = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}

_STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}  # place to place
_LAST = (0, 3)  # places where a conversation may end
_PAIRS = [(p, q) for p in range(4) for q in range(4) if p == q or (p, q) in ((0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3), (3, 2))]
_INDEX = {pair: k for k, pair in enumerate(_PAIRS)}
_RULES = [(_INDEX[p, q], k, _INDEX[r, q]) for k, (p, r) in enumerate(_PAIRS) for q in range(4) if (r, q) in _INDEX and (p, q) in _INDEX]

Cell = tuple


def combine(left: Cell, right: Cell) -> Cell:
    """Cell of two neighbouring spans."""
    out = [None] * len(_PAIRS)
    for to, a, b in _RULES:
        if (x := left[a]) is not None and (y := right[b]) is not None:
            made = (x[0] + y[0], x[1] + y[1])
            if out[to] is None or made < out[to]:
                out[to] = made
    return tuple(out)


def _cell(ways: list[tuple[int, int, int, str]]) -> Cell:
    out = [None] * len(_PAIRS)
    for p, q, cost, audit in ways:
        k = _INDEX[p, q]
        if out[k] is None or (cost, audit) < out[k]:
            out[k] = (cost, audit)
    return tuple(out)


def _closure() -> Cell:
    """What insertions alone can do: the cell of no rows."""
    none = [(p, p, 0, "") for p in range(4)]
    one = _cell(none + [(p, q, INSERT, "I") for c in ROLES for p, q in _STEPS[c].items()])
    return combine(one, one)  # two insertions reach every place that can be reached


@lru_cache(1024)
def row_cell(kind: str) -> Cell:
    """Cell of one row; `kind` is its role's initial if s, u or a (else a space), then b or d if it must go, t if truncated, or a dot."""
    initial, fault = kind
    ways = [(p, p, DELETE, "D") for p in range(4)]
    if fault not in "bd":
        more = TRUNCATED if fault == "t" else 0
        ways += [(p, q, KEEP + more, "K") for p, q in _STEPS.get(initial, {}).items()]
        ways += [(p, q, REROLE + more, "R") for c in ROLES for p, q in _STEPS[c].items()]
    return combine(combine(_closure(), _cell(ways)), _closure())


def combine_all(cells: list[Cell]) -> Cell:
    """Cells of neighbouring spans, combined bottom-up."""
    while len(cells) > 1:
        cells = [combine(*cells[k : k + 2]) if k + 1 < len(cells) else cells[k] for k in range(0, len(cells), 2)]
    return cells[0]


@lru_cache(1 << 14)
def _short(kinds: str) -> Cell:
    return combine_all([row_cell(kinds[k : k + 2]) for k in range(0, len(kinds), 2)])


def span_cell(kinds: str) -> Cell:
    """Cell of a span of rows, two letters each; what eight rows or fewer give is kept."""
    return combine_all([_short(kinds[k : k + 16]) for k in range(0, len(kinds), 16)])


def cheapest(cell: Cell) -> tuple[int, str]:
    return min(x for q in _LAST if (x := cell[_INDEX[0, q]]) is not None)


def role_at(place: int, rows: int) -> str | None:
    """Role of a row of the repaired conversation; None is its own, the only one that need not be user or assistant."""
    if rows % 2 and not place:
        return None
    return ROLES["ua"[(place - rows % 2) % 2]]


def row_order(turn: str = "turn") -> list[Column]:
    return [F.col(turn).asc_nulls_first(), F.col("digest").asc(), F.col("salt").asc()]


def marked(conversations: DataFrame) -> DataFrame:
    """Rows with their faults: conv (the id as text, a space if null), turn, role, text, digest, salt, kind.

    A row is a duplicate if one with its role and text is earlier in the order;
    firsts are found by a pre-aggregated minimum, so a row that is repeated
    without end makes no large group.
    """
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("bigint").cast("string"), F.lit(" ")).alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("salt"),
    )
    rows = rows.withColumn("digest", F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"), F.col("salt"))
    firsts = rows.groupBy("conv", "digest").agg(F.min(place).alias("first"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    trimmed = F.rtrim("text", F.lit(SPACE))
    rows = rows.join(firsts, ["conv", "digest"], "left")
    fault = (
        F.when(trimmed == "", "b")
        .when(F.coalesce(place > F.col("first"), F.lit(False)), "d")
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "t")
        .otherwise(".")
    )
    initial = F.substring("role", 1, 1)
    kind = F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise(" "), fault)
    return rows.select("conv", "turn", "role", "text", "digest", "salt", kind.alias("kind"))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add to sorted rows the span that each lies in and its place there. Spans ascend with the order."""
    span, at, conv = (TaskContext.get().partitionId() << 40) - 1, 0, None
    for batch in batches:
        spans, ats = [], []
        for own in batch.column("conv").to_pylist():
            if own != conv or at == SPAN_ROWS:
                conv, span, at = own, span + 1, 0
            spans.append(span)
            ats.append(at)
            at += 1
        columns = [batch.column(c) for c in ("conv", "turn", "role", "text", "kind")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, pa.int64()), pa.array(ats, pa.int32())], names=["conv", "turn", "role", "text", "kind", "span", "at"])


def ordered(conversations: DataFrame) -> DataFrame:
    """Stored rows of all conversations with `span` and `at`; a range of rows, not a conversation, is a task's."""
    order = [F.col("conv").asc(), *row_order()]
    rows = marked(conversations).repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(rows.mapInArrow(_number, "conv string, turn bigint, role string, text string, kind string, span bigint, at int"), "conversation-rows")


_SPANS = pa.schema([("conv", pa.string()), ("span", pa.int64()), ("kinds", pa.string()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
_LEAF = "conv string, span bigint, kinds string, costs array<bigint>, audits array<string>"


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str], values: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Neighbouring rows of equal keys. Groups here are spans of bounded rows, or the spans of a conversation."""
    now, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in (*keys, *values)), strict=True):
            key = row[: len(keys)]
            if key != now:
                if held:
                    yield now, held
                now, held = key, []
            held.append(row[len(keys) :])
    if held:
        yield now, held


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for (conv, span), held in _runs(batches, ["conv", "span"], ["kind"]):
        kinds = "".join(k for (k,) in held)
        cell = span_cell(kinds)
        rows.append((conv, span, kinds, [x and x[0] for x in cell], [x and x[1] for x in cell]))
        if len(rows) == 4096:
            yield _batch(rows, _SPANS)
            rows = []
    yield _batch(rows, _SPANS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_PARSED = pa.schema([("conv", pa.string()), ("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64()), ("spans", pa.list_(pa.int64())), ("rows", pa.list_(pa.int32()))])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for (conv,), held in _runs(batches, ["conv"], ["span", "kinds", "costs", "audits"]):
        cells = [tuple(None if c is None else (c, a) for c, a in zip(costs, audits, strict=True)) for _, _, costs, audits in held]
        cost, audit = cheapest(combine_all(cells))
        initials = "".join(kinds[::2] for _, kinds, _, _ in held)
        illegal = sum(initials[k : k + 2] not in ("su", "ua", "au") for k in range(len(initials) - 1))
        rows.append((conv, cost, audit, illegal, [h[0] for h in held], [len(h[1]) // 2 for h in held]))
        if len(rows) == 4096:
            yield _batch(rows, _PARSED)
            rows = []
    yield _batch(rows, _PARSED)


def parsed(rows: DataFrame) -> DataFrame:
    """conv, cost, audit, illegal, spans, rows (of each span) of every conversation of `ordered` rows.

    A group of the first shuffle is a span, one of the second the cells of a
    conversation, which are no longer than what its audit needs.
    """
    spans = rows.select("conv", "span", "at", "kind").repartition("conv", "span").sortWithinPartitions("conv", "span", "at")
    leaves = spans.mapInArrow(_leaves, _LEAF).repartition("conv").sortWithinPartitions("conv", "span")
    return leaves.mapInArrow(_parse, "conv string, cost bigint, audit string, illegal bigint, spans array<bigint>, rows array<int>")


_EDITS = pa.schema([("conv", pa.string()), ("span", pa.int64()), ("at", pa.int32()), ("edit", pa.string()), ("before", pa.int32()), ("after", pa.int32()), ("place", pa.int64()), ("total", pa.int64())])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = []
    for batch in batches:
        for conv, audit, spans, sizes in zip(*(batch.column(c).to_pylist() for c in ("conv", "audit", "spans", "rows")), strict=True):
            total, where = len(audit) - audit.count("D"), ((s, k) for s, n in zip(spans, sizes, strict=True) for k in range(n))
            place = before = 0
            ends = len(audit) - len(audit.rstrip("I"))
            body = audit[: len(audit) - ends]
            left = sum(sizes)
            for letter in body:
                if letter == "I":
                    before += 1
                    continue
                left -= 1
                out.append((conv, *next(where), letter, before, 0 if left else ends, place, total))
                place += before + (letter != "D")
                before = 0
                if len(out) >= 1 << 14:
                    yield _batch(out, _EDITS)
                    out = []
    yield _batch(out, _EDITS)


def edits(parses: DataFrame) -> DataFrame:
    """A row per row: its edit, how many rows are inserted before (and after the last) it, its place in the repaired conversation of `total` rows."""
    return parses.select("conv", "audit", "spans", "rows").mapInArrow(_edits, "conv string, span bigint, at int, edit string, before int, after int, place bigint, total bigint")


def _repaired(row: tuple) -> Iterator[tuple[int, str, str]]:
    edit, before, after, place, total, role, text = row
    for k in range(before):
        yield place + k, role_at(place + k, total), ""
    place += before
    if edit != "D":
        yield place, role if edit == "K" else role_at(place, total), text
        place += 1
    for k in range(after):
        yield place + k, role_at(place + k, total), ""


_COLUMNS = ["edit", "before", "after", "place", "total", "role", "text"]
_NEW = pa.schema([("conv", pa.string()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
_HASHES = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, tuple]]:
    """An edit (role null) is followed by the row that it edits."""
    edit = None
    for batch in batches:
        for conv, *row in zip(*(batch.column(c).to_pylist() for c in ("conv", *_COLUMNS)), strict=True):
            if row[-2] is None:
                edit = row[:-2]
            else:
                yield conv, (*edit, *row[-2:])


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for conv, row in _pairs(batches):
        for made in _repaired(row):
            out.append((conv, *made))
            size += 64 + len(made[-1])
        if size > 1 << 22:
            yield _batch(out, _NEW)
            out, size = [], 0
    yield _batch(out, _NEW)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, now, state, fresh = [], None, None, True
    for conv, row in _pairs(batches):
        if conv != now:
            if now is not None:
                out.append((now, state.hexdigest()))
            now, state, fresh = conv, hashlib.sha256(), True
        for _, role, text in _repaired(row):
            state.update(("" if fresh else "\n").encode() + f"{role}:{text}".encode())
            fresh = False
        if len(out) >= 1 << 14:
            yield _batch(out, _HASHES)
            out = []
    if now is not None:
        out.append((now, state.hexdigest()))
    yield _batch(out, _HASHES)


def _with_edits(rows: DataFrame, parses: DataFrame, *keys: str) -> DataFrame:
    """Every edit before its row, brought together by `keys` in one shuffle of the rows."""
    none = F.lit(None)
    own = rows.select(
        "conv", "span", "at", F.lit(1).alias("second"), none.cast("string").alias("edit"),
        *[none.cast("int").alias(c) for c in ("before", "after")], *[none.cast("bigint").alias(c) for c in ("place", "total")], "role", "text",
    )
    made = edits(parses).select("*", F.lit(0).alias("second"), none.cast("string").alias("role"), none.cast("string").alias("text"))
    return own.unionByName(made).repartition(*keys).sortWithinPartitions("conv", "span", "at", "second")


def repaired_rows(rows: DataFrame, parses: DataFrame) -> DataFrame:
    """conv, place (from 0), role, text of every repaired conversation; inserted rows have empty texts. Spread by spans."""
    return _with_edits(rows, parses, "conv", "span").mapInArrow(_rewrite, "conv string, place bigint, role string, text string")


def repaired_digests(rows: DataFrame, parses: DataFrame) -> DataFrame:
    """SHA-256 of each repaired conversation's `role:text` lines. A digest is sequential, so a conversation streams through one task."""
    return _with_edits(rows, parses, "conv").mapInArrow(_digest, "conv string, repaired_sha256 string")


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Summary and repaired rows of every conversation (conv_id, turn, role, text).

    Summary: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256, one row for every conv_id there is (null is one too).
    Nulls of role and text are a space; null turns come first, rows of one turn
    are ordered by the SHA-256 of role and text, repeated rows are adjacent. A
    role that begins with none of s, u, a (an empty one, too) cannot be kept. A
    conversation of any length is parsed in spans; an empty table gives no rows;
    other columns are not read.
    """
    rows = ordered(conversations)
    parses = stored(parsed(rows), "conversation-parses")
    fault = F.substring("kind", 2, 1)
    counts = rows.groupBy("conv").agg(
        *[F.count(F.when(fault == letter, 1)).alias(name) for letter, name in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))],
        F.coalesce(F.max("turn") - F.min("turn") + 1, F.lit(0)).alias("reach"),
    )
    turns = rows.where("turn is not null").select("conv", "turn").distinct().groupBy("conv").agg(F.count("*").alias("turns"))
    summary = (
        counts.join(turns, "conv", "left")
        .join(parses.select("conv", "cost", "audit", "illegal"), "conv")
        .join(repaired_digests(rows, parses), "conv")
    )
    summary = summary.select(
        F.expr("try_cast(conv as bigint)").alias("conv_id"), (F.col("reach") - F.coalesce("turns", F.lit(0))).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    )
    made = repaired_rows(rows, parses)
    return summary, made.select(F.expr("try_cast(conv as bigint)").alias("conv_id"), "place", "role", "text")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage drawn by crc32 of `conv_id:turn`, modulo 20: 0 drops the row, 1 empties
    its text, 2 takes its sentence ends, 3 repeats it, 4 sets role user. Nulls are a space, in the draw as in role and text."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("bigint").cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], (F.crc32(F.encode(key, "UTF-8")) % 20).alias("draw"),
    ).where("draw <> 0")
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Summary of `repair` after `damaged`, for every conv_id; without rows left: zeros, an empty audit, an empty text's digest."""
    summary, _ = repair(damaged(conversations))
    ids = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    joined = ids.alias("i").join(summary.alias("s"), F.col("i.conv_id").eqNullSafe(F.col("s.conv_id")), "left")
    none = hashlib.sha256(b"").hexdigest()
    return joined.select(
        "i.conv_id", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"),
    )
