"""Fill-in-middle transformation by secondary-sort assembly.

A text is cut into pieces of whole units, each keyed by its document and its
place in the output. One shuffle by document with a sort by place
(`repartition` and `sortWithinPartitions`) brings the pieces of an output past a
task in order, which digests them one by one and, reading the output's marks,
gives every piece its place in the restored text. Sorting by those places, in
the same partitions without another shuffle, streams the restored text. No task
holds more than a batch of pieces, however long a document is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumark.llm.scan import in_slices, per_text, string_array, text_bytes

PIECE_BYTES = 1 << 15
BATCH_BYTES = 1 << 22  # of pieces that a task hands on at once
MARKS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
SECTIONS = {"plain": "", "psm": "PSM", "spm": "SPM"}  # in the output
RESTORED = {"P": 0, "M": 1, "S": 2}  # in the text
PLAIN_FROM, SPM_BELOW = 90, 20  # percent

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_FACTS = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
_PIECES = pa.schema([("row", pa.int64()), ("place", pa.int64()), *_FACTS, ("piece", pa.binary())])
_REORDERED = pa.schema([("row", pa.int64()), ("place", pa.int64()), *_FACTS, ("output", pa.binary()), ("piece", pa.binary())])
_DDL = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_DDL[f.type]}" for f in schema)


class _Batches:
    """Rows gathered into record batches of bounded bytes."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, row: tuple, size: int) -> bool:
        self.rows.append(row)
        self.bytes += size + 64
        return self.bytes >= BATCH_BYTES

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [()] * len(self.schema)
        self.rows, self.bytes = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)


def draw(doc_id: int | None) -> list[int]:
    """h1 to h4 of a document; a null id is drawn as an empty one."""
    digest = hashlib.sha256(b"1:" + (b"" if doc_id is None else str(doc_id).encode())).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12)]


def _cuts(at: int, end: int, units: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of at:end, cut before a unit; only a longer unit is cut within."""
    while end - at > PIECE_BYTES:
        till = at + PIECE_BYTES
        unit = units[np.searchsorted(units, till, "right") - 1]
        till = int(unit) if unit > at else till
        yield at, till
        at = till
    if end > at:
        yield at, end


def _cut_texts(array: pa.StringArray, doc_ids: list[int | None]) -> Iterator[tuple[int, tuple, list[bytes]]]:
    """For every text its index, facts, and the pieces of its output in order."""
    body, bounds = text_bytes(array)
    data = body.tobytes()
    start = (body & 0xC0) != 0x80
    letter = _LETTER[body]
    inside = np.zeros(len(body), bool)  # letters after a letter of the same text
    inside[1:] = letter[1:] & letter[:-1]
    inside[bounds[:-1][bounds[:-1] < len(body)]] = False
    unit = start & ~inside
    units, counts = np.flatnonzero(unit), per_text(unit, bounds)
    first = np.concatenate([[0], np.cumsum(counts)])
    chars = np.concatenate([[0], np.cumsum(start)])
    marked = np.zeros(len(array), bool)
    for mark in MARKS.values():
        marked |= pc.match_substring(array, mark.decode()).to_numpy(zero_copy_only=False)
    for i, doc_id in enumerate(doc_ids):
        n, (at, end) = int(counts[i]), (int(b) for b in bounds[i : i + 2])
        h = draw(doc_id)
        if at == end or marked[i] or h[2] % 100 >= PLAIN_FROM:
            yield i, (doc_id, n, "plain", None, None), [data[s:e] for s, e in _cuts(at, end, units)]
            continue
        form = "spm" if h[3] % 100 < SPM_BELOW else "psm"
        low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        a, b = (int(units[first[i] + k]) if k < n else end for k in (low, high))
        spans = {"P": (at, a), "M": (a, b), "S": (b, end)}
        pieces = []
        for section in SECTIONS[form]:
            cuts = [data[s:e] for s, e in _cuts(*spans[section], units)] or [b""]
            cuts[0] = MARKS[section] + cuts[0]
            pieces += cuts
        yield i, (doc_id, n, form, int(chars[a] - chars[at]), int(chars[b] - chars[a])), pieces


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of all outputs; the first of each carries the document's facts."""
    out, none = _Batches(_PIECES), (None,) * len(_FACTS)
    for batch in batches:
        rows, ids = batch.column("row").to_pylist(), batch.column("doc_id").to_pylist()
        at = 0
        for made in in_slices(string_array(batch.column("text")), lambda part: (part, len(part))):
            part, size = made
            for i, facts, pieces in _cut_texts(part, ids[at : at + size]):
                for place, piece in enumerate(pieces or [b""]):
                    if out.add((rows[at + i], place, *(none if place else facts), piece), len(piece)):
                        yield out.take()
            at += size
    yield out.take()


def _unmarked(form: str) -> Callable[[bytes, bool], list[tuple[int, bytes]]]:
    """A reader of an output, piece by piece: parts of the text, each with its section's place in it."""
    ahead = list(SECTIONS[form])
    section, carry = None, b""

    def read(piece: bytes, last: bool) -> list[tuple[int, bytes]]:
        nonlocal section, carry
        out, data = [], carry + piece
        while ahead and (at := data.find(MARKS[ahead[0]])) >= 0:
            if section is not None:
                out.append((RESTORED[section], data[:at]))
            data, section = data[at + 3 :], ahead.pop(0)
        keep = 0 if last or not ahead else min(2, len(data))  # a mark may begin in what stays
        carry = data[len(data) - keep :] if keep else b""
        data = data[: len(data) - keep] if keep else data
        if data:
            out.append((RESTORED.get(section, 0), data))
        return out

    return read


class _Digest:
    def __init__(self):
        self.state = hashlib.sha256()

    def add(self, piece: bytes) -> None:
        self.state.update(piece)

    def value(self) -> bytes:
        return self.state.hexdigest().encode()


class _Whole:
    def __init__(self):
        self.pieces = []

    def add(self, piece: bytes) -> None:
        self.pieces.append(piece)

    def value(self) -> bytes:
        return b"".join(self.pieces)


def _reorder(batches: Iterator[pa.RecordBatch], sink: type) -> Iterator[pa.RecordBatch]:
    """Sorted pieces of outputs to parts of texts with their places; a row of facts, place -1, ends each document."""
    out = _Batches(_REORDERED)
    none = (None,) * (len(_FACTS) + 1)
    row = facts = held = read = made = None
    seen = {}

    def parts(piece, last):
        for section, part in read(piece, last):
            seen[section] = seen.get(section, -1) + 1
            yield (row, section << 40 | seen[section], *none, part), len(part)

    def end():
        yield from parts(held, True)
        yield (row, -1, *facts, made.value(), None), 64

    names = [f for f, _ in _FACTS]
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("row", *names, "piece")]
        for key, *own, piece in zip(*columns, strict=True):
            if key != row:
                if row is not None:
                    for made_row, size in end():
                        if out.add(made_row, size):
                            yield out.take()
                row, facts, made, seen = key, own, sink(), {}
                read, held = _unmarked(own[2]), b""
            elif held:
                for made_row, size in parts(held, False):
                    if out.add(made_row, size):
                        yield out.take()
            made.add(piece)
            held = piece
    if row is not None:
        for made_row, size in end():
            out.add(made_row, size)
    yield out.take()


def _join(batches: Iterator[pa.RecordBatch], sink: type, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted parts of texts to a row per document: its facts, output and restored text, both as `sink` gives them."""
    out = _Batches(schema)
    names = [f for f, _ in _FACTS]
    row = facts = made = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("row", *names, "output", "piece")]
        for key, *own, piece in zip(*columns, strict=True):
            if key != row:
                if row is not None and out.add((*facts, made.value()), len(facts[-1])):
                    yield out.take()
                row, facts, made = key, own, sink()  # the row of facts comes first
            if piece is not None:
                made.add(piece)
    if row is not None:
        out.add((*facts, made.value()), 0)
    yield out.take()


def _assembled(docs: DataFrame, sink: type) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    pieces = rows.mapInArrow(_emit, _ddl(_PIECES)).repartition("row").sortWithinPartitions("row", "place")
    return _restored(pieces, sink)


def _restored(pieces: DataFrame, sink: type) -> DataFrame:
    schema = pa.schema([*_FACTS, ("output", pa.binary()), ("restored", pa.binary())])
    parts = pieces.mapInArrow(lambda b: _reorder(b, sink), _ddl(_REORDERED)).sortWithinPartitions("row", "place")
    made = parts.mapInArrow(lambda b: _join(b, sink, schema), _ddl(schema))
    return made.withColumns({c: F.col(c).cast("string") for c in ("output", "restored")})


def transform(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output: every text cut by its id's draw and put together for filling in.

    A null text is an empty one and stays plain, as does a text that holds a
    mark; a null id draws as an empty one. Rows are told apart by their place in
    the input (a re-read must repeat it, as files do), so repeated rows and ids
    are each transformed. An empty table gives no rows; other columns are not
    read. A task holds one output at a time; use `transform_digests` if even
    that is too much.
    """
    return _assembled(docs, _Whole).drop("restored")


def _cut_outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Batches(_PIECES)
    for batch in batches:
        for row, form, text in zip(*(batch.column(c).to_pylist() for c in ("row", "form", "output")), strict=True):
            data = (text or "").encode()
            for place, at in enumerate(range(0, max(1, len(data)), PIECE_BYTES)):
                facts = (None, None, None if place else form, None, None)
                if out.add((row, place, *facts, data[at : at + PIECE_BYTES]), PIECE_BYTES):
                    yield out.take()
    yield out.take()


def restore(outputs: DataFrame) -> DataFrame:
    """form, output, text: the text rebuilt from each `output` and its `form` alone. Nulls: the empty text; form null: plain."""
    rows = outputs.select(F.coalesce("form", F.lit("plain")).alias("form"), "output", F.monotonically_increasing_id().alias("row"))
    pieces = rows.mapInArrow(_cut_outputs, _ddl(_PIECES))  # in order already
    return _restored(pieces, _Whole).select("form", "output", F.col("restored").alias("text"))


def transform_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and the SHA-256 of each output and of the text restored from it."""
    return _assembled(docs, _Digest).withColumnsRenamed({"output": "output_sha256", "restored": "restored_sha256"})
