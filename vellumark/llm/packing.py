"""Best-fit packing of token sequences by the sum-of-squares rule."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumark.llm.scan import in_slices, string_array
from vellumark.llm.tokens import encoder, tokenizer_path
from vellumark.session import stored

CAPACITY = 2048
END_ID = 0
SHARD_PIECES = 40_000  # pieces that one task packs; memory of a packing task is bounded by it

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def place_all(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece.

    `open_[h]` counts the sequences filled up to h. A piece goes where the sum
    of the squared counts over all residual gaps becomes smallest: into a
    sequence of level h (that level loses one, level h + length gains one) or
    into a new one. Full sequences count nothing. Ties go to the fullest.
    Longer pieces come first, so that short ones are left to close the gaps.
    Once the open gaps hold all that is left, balance between the gaps is worth
    nothing any more: the rest goes into the fullest sequences with room.
    """
    n = len(lengths)
    sequence, offset = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    count = np.zeros(capacity + 1)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    gaps = 0
    left = int(lengths.sum())
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        level = 0
        before = count[1 : capacity - size + 1]
        if left <= gaps:
            level = int(np.flatnonzero(before)[-1]) + 1 if before.any() else 0
        elif size < capacity:
            change = count[1 + size :] - before + 1.0
            change[-1] = 0.5 - before[-1]
            change[before == 0] = np.inf
            best = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[best] <= count[size] + 0.5:
                level = best + 1
        if level:
            count[level] -= 1
            number = stacks[level].pop()
            gaps -= size
        else:
            number, made = made, made + 1
            gaps += capacity - size
        left -= size
        sequence[i], offset[i] = number, level
        if level + size < capacity:
            count[level + size] += 1
            stacks[level + size].append(number)
    return sequence, offset


def document_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document's ids (its text's, then `end_id`); only longer documents are cut."""

    def pieces(batches):
        for batch in batches:
            ids_of = batch.column("doc_id")
            at = 0
            for part in in_slices(string_array(batch.column("text")), lambda a: a):
                ids, bounds = encoder(path).encode(part)
                rows = []
                for k in range(len(part)):
                    own = np.append(ids[bounds[k] : bounds[k + 1]], np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        some = own[start : start + capacity]
                        rows.append((at + k, piece, start, len(some), zlib.crc32(some.tobytes())))
                of, piece, start, length, crc = (np.array(c, np.int64) for c in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [ids_of.take(pa.array(of)).cast(pa.int64()), pa.array(piece.astype(np.int32)), pa.array(start),
                     pa.array(length), pa.array(crc)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )
                at += len(part)

    return docs.select("doc_id", "text").mapInArrow(pieces, PIECES)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Add `sequence_id` and `offset` to rows with a `length` of 1 to `capacity`.

    Pieces are dealt at random (by hash) over shards of about `shard_pieces`
    rows; a shard is packed by one task. Each shard ends with a few sequences
    that are not full, which is the price of packing in parallel.
    """
    pieces = stored(pieces, "pieces")
    shards = max(1, -(-pieces.count() // shard_pieces))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece"], kind="stable", ignore_index=True)
        sequence, offset = place_all(frame["length"].to_numpy(dtype=np.int64), capacity)
        # ids of different shards never meet: the shard is the remainder
        return frame.assign(sequence_id=sequence * shards + frame["shard"], offset=offset).drop(columns="shard")

    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
    # a stated number of partitions, as adaptive execution would join the shards, which are small and slow to pack
    return dealt.repartition(shards, "shard").groupBy("shard").applyInPandas(pack, PIECES + ", sequence_id bigint, offset bigint")


def pack_documents(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """Pack all documents into sequences of at most `capacity` tokens, as few as the rule gives.

    A null or empty text is the end id alone. A null doc_id stays null. Rows
    with a repeated doc_id are documents of their own. An empty table gives no
    rows; columns besides doc_id and text are not read.
    """
    return pack_pieces(document_pieces(docs, path or tokenizer_path(), capacity, end_id), capacity, shard_pieces)
