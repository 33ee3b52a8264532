"""Substring dedup by content-defined chunks.

A gear rolling hash over the last 32 bytes decides at every word whether a new
chunk begins there, so the cuts move with the content when something is inserted
before it. Runs of whole chunks of at least RUN_WORDS words are compared by their
digest over all documents: the document with the smallest doc_id keeps a run, in
the others it is marked, and marked runs that together reach REMOVE_WORDS words
are cut out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumark.llm.chunked_bpe import _GEAR
from vellumark.llm.scan import (
    _SPACE, _quoted, bounded_batches, filtered, id_hash, in_slices, key_filter, may_contain, run_hashes, span_hashes, string_array, text_bytes, word_spans,
)
from vellumark.session import stored

CHUNK_WORDS = 5  # mean words of a chunk
RUN_WORDS = 16  # least words of a run of chunks that is compared
REMOVE_WORDS = 24  # least words that are cut out together
MOST_WORDS = 16  # a chunk without a cut ends here, as in one word repeated over and over
WINDOW = 32  # bytes behind a rolling hash

_FOLDED = _GEAR.copy()
_FOLDED[_SPACE] = _GEAR[0x20]  # any white space is like any other


def rolling_hashes(body: np.ndarray) -> np.ndarray:
    h = _FOLDED[body]
    for step in (1, 2, 4, 8, 16):
        moved = np.zeros_like(h)
        moved[step:] = h[:-step] << np.uint32(step)
        h = h + moved
    return h


def runs(array: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, digest, begin and end (bytes of the text) of the shortest long enough run from every chunk on."""
    none = np.zeros(0, np.int64)
    body, bounds = text_bytes(array)
    begins, ends = word_spans(body, bounds)
    if not len(begins):
        return none, none.astype(np.uint64), none, none
    of = np.searchsorted(bounds, begins, "right") - 1
    words = span_hashes(body, begins, ends)
    before = rolling_hashes(body)[np.maximum(begins - 1, 0)]
    cut = (before >> np.uint32(8)) % np.uint32(CHUNK_WORDS) == 0
    cut &= begins - bounds[of] >= WINDOW
    first_word = np.ones(len(begins), bool)
    first_word[1:] = of[1:] != of[:-1]
    cuts = np.flatnonzero(cut | first_word)
    wide = np.diff(np.append(cuts, len(begins)))
    more = (wide - 1) // MOST_WORDS
    inside = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
    cuts = np.union1d(cuts, np.repeat(cuts, more) + inside * MOST_WORDS)
    last_word = np.searchsorted(of, of[cuts], "right")  # one behind the text's last word
    borders = np.union1d(cuts, np.append(np.flatnonzero(first_word), len(begins)))
    till = borders[np.minimum(np.searchsorted(borders, cuts + RUN_WORDS), len(borders) - 1)]
    fits = (cuts + RUN_WORDS <= last_word) & (till <= last_word)
    cuts, till = cuts[fits], till[fits]
    digest = run_hashes(words, cuts, till)
    text = of[cuts]
    inner = (till < len(begins)) & (of[np.minimum(till, len(begins) - 1)] == text)
    end = np.where(inner, begins[np.minimum(till, len(begins) - 1)], bounds[text + 1])
    return text, digest, begins[cuts] - bounds[text], end - bounds[text]


RUNS = "doc_id bigint, text_key bigint, digest bigint, begin int, end int, again boolean"


def document_runs(docs: DataFrame, only: np.ndarray | None = None, within: bool = False) -> DataFrame:
    """A row for each run of each document; `again`: the same run stands earlier in the text.

    With a filter `only`, the runs that may be in it, and those again if `within`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(only)

    def run(batches):
        for batch in batches:
            at = 0
            for part in in_slices(string_array(batch.column("text")), lambda a: a):
                text, digest, begin, end = runs(part)
                order = np.lexsort((begin, digest, text))
                again = np.zeros(len(text), bool)
                again[order[1:]] = (digest[order[1:]] == digest[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
                wanted = ~again if shared.value is None else may_contain(shared.value, digest) | again & within
                rows = pa.array((text + at)[wanted])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows).cast(pa.int64()), batch.column("text_key").take(rows),
                     pa.array(digest[wanted].view(np.int64)), pa.array(begin[wanted].astype(np.int32)),
                     pa.array(end[wanted].astype(np.int32)), pa.array(again[wanted])],
                    names=["doc_id", "text_key", "digest", "begin", "end", "again"],
                )
                at += len(part)

    source = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return source.mapInArrow(run, RUNS)


def marked_runs(docs: DataFrame, within: bool = False) -> DataFrame:
    """doc_id, text_key, begin, end of every run that a document with a smaller id has too.

    `within` adds those that the text itself has before.
    """
    firsts = document_runs(docs).groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    firsts = stored(firsts.where("first < last").select("digest", "first"), "repeated-runs")
    every = document_runs(docs, key_filter(firsts, F.col("digest")).array(), within)
    place = ["doc_id", "text_key", "begin", "end"]
    mine = every.join(firsts, "digest").where(F.col("doc_id") > F.col("first")).select(*place)
    return mine.unionByName(every.where("again").select(*place)) if within else mine


def cut_out(text: str, spans: list) -> tuple[str, int]:
    """The text without the marked spans that reach REMOVE_WORDS words together, and how many words went."""
    body = text.encode()
    merged: list[list[int]] = []
    for begin, end in sorted((s["begin"], s["end"]) for s in spans):
        if merged and begin <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([begin, end])
    kept, at, gone = [], 0, 0
    for begin, end in merged:
        words = len(_words(body[begin:end]))
        if words >= REMOVE_WORDS:
            kept.append(body[at:begin])
            at, gone = end, gone + words
    return b"".join([*kept, body[at:]]).decode(), gone


_BLANKS = bytes(0x20 if 0x09 <= c <= 0x0D else c for c in range(256))


def _words(body: bytes) -> list[bytes]:
    return [w for w in body.translate(_BLANKS).split(b" ") if w]


def dedup(docs: DataFrame, counted: str | None = "removed_words", within: bool = False) -> DataFrame:
    """All columns and rows, `text` without repeated passages, `n_chars` (if there is one) as it is then.

    `counted` names a further column, the words cut out, which takes the place
    of one of that name; `within` also cuts what a text has said itself before.
    Null texts stay null; rows without doc_id stay as they are; rows with the
    same doc_id are one document and not compared with each other. Other columns
    may have any names. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    spans = marked_runs(docs, within).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))  # of one text
    spans = stored(spans, "spans").withColumnsRenamed({"doc_id": "of_id", "text_key": "of_text"})
    bits = key_filter(spans, id_hash("of_id"))

    @F.pandas_udf("text string, words bigint")
    def apply(text: pd.Series, found: pd.Series) -> pd.DataFrame:
        done = [cut_out(t, s) if t is not None and s is not None else (t, 0) for t, s in zip(text, found, strict=True)]
        return pd.DataFrame({"text": [d[0] for d in done], "words": [d[1] for d in done]})

    every = docs.select(F.struct(*[F.col(_quoted(c)).alias(c) for c in docs.columns]).alias("row"), F.col("doc_id").cast("bigint").alias("id"), "text")
    near = filtered(every, id_hash("id"), bits)
    near = near.join(spans, (F.col("id") == F.col("of_id")) & (F.xxhash64("text") == F.col("of_text")), "left")
    near = near.select("row", "spans", apply("text", "spans").alias("done"))
    changed = F.when(F.col("spans").isNotNull(), F.col("done.text"))
    near = near.select("row", changed.alias("new"), F.col("done.words").alias("words"))
    clear = filtered(every, id_hash("id"), bits, inside=False)
    made = near.unionByName(clear.select("row", F.lit(None).cast("string").alias("new"), F.lit(0).cast("bigint").alias("words")))

    def value(c: str):
        own = F.col(f"row.{_quoted(c)}")
        if c == "text":
            own = F.coalesce("new", own)
        elif c == "n_chars":
            own = F.when(F.col("words") > 0, F.char_length("new").cast(docs.schema[c].dataType)).otherwise(own)
        return own.alias(c)

    kept = [value(c) for c in docs.columns if c != counted]
    return made.select(*kept, *([F.col("words").alias(counted)] if counted else []))
