"""BPE encoding with reuse of content-defined chunks, and decoding."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from vellumark.llm.scan import _SPACE, in_slices, string_array, text_bytes
from vellumark.llm.tokens import encoder, gather, tokenizer_path

CUT_BITS = 7  # a chunk has about 2**7 bytes
SHARED_CHUNKS = 200_000  # repeated chunks whose ids a worker keeps
SHARED_CHUNK_BYTES = 1024  # longer ones are not kept

_GEAR = np.random.default_rng(7).integers(0, 2**32, 256, dtype=np.uint32)


def gear_hashes(body: np.ndarray) -> np.ndarray:
    """Rolling hash of the last 32 bytes at every position: h = 2 h + gear[byte], 32 bits."""
    h = _GEAR[body]
    for step in (1, 2, 4, 8, 16):
        moved = np.zeros_like(h)
        moved[step:] = h[:-step] << np.uint32(step)
        h = h + moved
    return h


def chunk_and_joint_bounds(body: np.ndarray, bounds: np.ndarray, bits: int = CUT_BITS) -> np.ndarray:
    """Begins of the chunks' whole-word parts and of the joints between them, in order.

    The rolling hash cuts the text into chunks anywhere. What stands around a
    cut, back to the last white space of the left chunk and on to the first
    one of the right chunk, is a joint: tokens may reach over the cut there and
    nowhere else. A chunk without white space is part of one longer joint.
    Every part begins and ends at white space or at a text's bounds, so the ids
    of a text are exactly those of its parts.
    """
    n = len(body)
    h = gear_hashes(body)
    cuts = np.flatnonzero((h >> np.uint32(32 - bits)) == 0) + 1
    cuts = cuts[cuts < n]
    space = np.flatnonzero(_SPACE[body])
    edges = np.union1d(space, bounds)  # a part may begin at white space and ends before the next
    left = edges[np.searchsorted(edges, cuts, "right") - 1]
    right = edges[np.minimum(np.searchsorted(edges, cuts, "left"), len(edges) - 1)]
    return np.union1d(np.union1d(left, right), bounds)


class ChunkEncoder:
    """Encodes each distinct chunk part once; chunks seen twice are kept for later batches of the worker."""

    def __init__(self, path: str):
        self.words = encoder(path)
        self.shared: dict[str, np.ndarray] = {}
        self.strings = pa.array(self.words.strings, pa.string())
        self.decimals = pa.array([str(i) for i in range(self.words.size)], pa.string())

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        texts = string_array(texts)
        body, bounds = text_bytes(texts)
        if not len(body):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        starts = chunk_and_joint_bounds(body, bounds)
        starts = np.union1d(starts, [0, len(body)])
        parts = pa.StringArray.from_buffers(
            len(starts) - 1, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(body))
        )
        coded = parts.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        distinct, used = coded.dictionary, np.bincount(codes, minlength=len(coded.dictionary))
        ready: dict[int, np.ndarray] = {}
        if self.shared:
            ready = {i: ids for i, t in enumerate(distinct.to_pylist()) if (ids := self.shared.get(t)) is not None}
        todo = np.array([i for i in range(len(distinct)) if i not in ready], np.int64)
        new, ends = self.words.encode(distinct.take(pa.array(todo)))
        for k in np.flatnonzero((used[todo] > 1) & (np.diff(ends) > 3)).tolist():
            if len(self.shared) < SHARED_CHUNKS and len(t := distinct[int(todo[k])].as_py()) <= SHARED_CHUNK_BYTES:
                self.shared[t] = new[ends[k] : ends[k + 1]].copy()
        counts = np.zeros(len(distinct), np.int64)
        begins = np.zeros(len(distinct), np.int64)
        counts[todo], begins[todo] = np.diff(ends), ends[:-1]
        if ready:
            old = list(ready)
            counts[old] = [len(ready[i]) for i in old]
            begins[old] = len(new) + np.concatenate([[0], np.cumsum(counts[old])[:-1]])
            new = np.concatenate([new, *ready.values()])
        at = np.concatenate([[0], np.cumsum(counts[codes])])
        ids = gather(new, begins[codes], counts[codes], at)
        return ids, at[np.searchsorted(starts, bounds)]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.StringArray:
        """Texts of the ids, as the library gives them for a tokenizer without a decoder: tokens with a space between."""
        return self._joined(self.strings, ids, bounds)

    def as_decimals(self, ids: np.ndarray, bounds: np.ndarray) -> pa.StringArray:
        return self._joined(self.decimals, ids, bounds)

    @staticmethod
    def _joined(names: pa.StringArray, ids: np.ndarray, bounds: np.ndarray) -> pa.StringArray:
        lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), names.take(pa.array(ids)))
        return pc.binary_join(lists, " ")


@lru_cache(maxsize=2)
def chunk_encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def _map_texts(docs: DataFrame, schema: str, work) -> DataFrame:
    def run(batches):
        for batch in batches:
            at = 0
            ids = batch.column("doc_id")
            for out, n in in_slices(string_array(batch.column("text")), lambda a: (work(a), len(a))):
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, n).cast(pa.int64()), *out.values()], names=["doc_id", *out]
                )
                at += n

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids of every whole text. A null text is an empty one and has no ids; repeated rows stay."""
    path = path or tokenizer_path()

    def work(texts):
        ids, bounds = chunk_encoder(path).encode(texts)
        return {"ids": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))}

    return _map_texts(docs, "doc_id bigint, ids array<int>", work)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of `encoded`'s ids, special tokens kept. Null or empty ids give the empty text."""
    path = path or tokenizer_path()

    def run(batches):
        for batch in batches:
            lists = batch.column("ids")
            lists = pc.fill_null(lists, pa.scalar([], lists.type)) if lists.null_count else lists
            bounds = lists.offsets.to_numpy().astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            texts = chunk_encoder(path).decode(ids, bounds - bounds[0])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), texts], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def round_trip_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids (decimal, one space between) and of the decoded text."""
    path = path or tokenizer_path()

    def digests(texts: pa.StringArray) -> pa.Array:
        body, bounds = text_bytes(texts)
        whole = memoryview(np.ascontiguousarray(body))
        return pa.array([hashlib.sha256(whole[a:b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.string())

    def work(texts):
        coder = chunk_encoder(path)
        ids, bounds = coder.encode(texts)
        return {
            "n_tokens": pa.array(np.diff(bounds)),
            "ids_sha256": digests(coder.as_decimals(ids, bounds)),
            "decoded_sha256": digests(coder.decode(ids, bounds)),
        }

    return _map_texts(docs, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string", work)
