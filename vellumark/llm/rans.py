"""Token ids in files of a static range asymmetric numeral system (rANS).

A file holds whole documents in order: one frequency table for the file, blocks
of BLOCK ids coded by LANES interleaved coders, for each block its place, its
coders' states (from which decoding starts) and a checksum, and the documents'
ids and lengths. Blocks need nothing from each other, so any set of them can be
decoded side by side; here all blocks of a file advance together as one array.
"""

from __future__ import annotations

import json
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumark.llm.scan import in_slices, string_array
from vellumark.llm.tokens import encoder, tokenizer_path
from vellumark.session import new_folder, stored
from vellumark.sources.filesystem import open_file_system

MAGIC = b"IDRANS01"
END_ID = 2
LANES = 64
BLOCK = 1 << 16
BITS = 20  # frequencies of a table sum to 2**BITS
LOW = np.uint64(1 << 31)  # a state lies in [2**31, 2**63); 32 bits leave or enter it at once
FILE_IDS = 4 << 20  # ids after which a file ends with the document

_MASK, _SHIFT, _WORD = np.uint64((1 << BITS) - 1), np.uint64(BITS), np.uint64(32)


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and their shares of 2**BITS, at least 1 each."""
    symbols, counts = np.unique(ids, return_counts=True)
    if not len(symbols):
        return symbols.astype(np.uint32), counts.astype(np.uint64)
    if len(symbols) > 1 << BITS:
        raise ValueError(f"more than {1 << BITS} distinct ids in a file")
    spare = (1 << BITS) - len(symbols)
    shares = 1 + counts * spare // counts.sum()
    shares[np.argmax(counts)] += (1 << BITS) - shares.sum()
    return symbols.astype(np.uint32), shares.astype(np.uint64)


def encode_blocks(ids: np.ndarray, symbols: np.ndarray, shares: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Payload and final states of each block."""
    blocks = -(-len(ids) // BLOCK)
    cumulative = np.concatenate([[0], np.cumsum(shares)[:-1]]).astype(np.uint64) if len(shares) else shares
    steps = BLOCK // LANES
    coded = np.zeros(blocks * BLOCK, np.int64)
    coded[: len(ids)] = np.searchsorted(symbols, ids)
    coded = coded.reshape(blocks, steps, LANES)
    real = (np.arange(blocks * BLOCK) < len(ids)).reshape(blocks, steps, LANES)
    state = np.full((blocks, LANES), LOW, np.uint64)
    words = np.zeros((blocks, BLOCK + LANES), np.uint32)
    at = np.full(blocks, words.shape[1], np.int64)  # words are written from the end, as decoding runs forward
    rows = np.arange(blocks)[:, None]
    for t in range(steps - 1, -1, -1):
        here = real[:, t]
        if not here.any():
            continue
        share, before = shares[coded[:, t]], cumulative[coded[:, t]]
        full = here & (state >= share << np.uint64(63 - BITS))
        rank = np.cumsum(full, axis=1)
        total = rank[:, -1]
        place = at[:, None] - total[:, None] + rank - 1
        words[np.broadcast_to(rows, full.shape)[full], place[full]] = state[full].astype(np.uint32)
        at -= total
        state = np.where(full, state >> _WORD, state)
        state = np.where(here, (state // share << _SHIFT) + state % share + before, state)
    return [words[b, at[b] :].astype("<u4").tobytes() for b in range(blocks)], state


def decode_blocks(
    payloads: list[bytes], state: np.ndarray, counts: np.ndarray, symbols: np.ndarray, shares: np.ndarray
) -> np.ndarray:
    """Ids of the given blocks, in order."""
    blocks = len(payloads)
    if not blocks:
        return np.zeros(0, np.uint32)
    cumulative = np.concatenate([[0], np.cumsum(shares)[:-1]]).astype(np.uint64)
    slot = np.repeat(np.arange(len(symbols)), shares.astype(np.int64))
    words = np.concatenate([np.frombuffer(p, "<u4") for p in payloads] + [np.zeros(1, np.uint32)]).astype(np.uint64)
    at = np.concatenate([[0], np.cumsum([len(p) // 4 for p in payloads])])[:-1]
    steps = BLOCK // LANES
    real = (np.arange(BLOCK)[None, :] < counts[:, None]).reshape(blocks, steps, LANES)
    out = np.zeros((blocks, steps, LANES), np.uint32)
    state = state.copy()
    for t in range(steps):
        here = real[:, t]
        if not here.any():
            break
        low = state & _MASK
        which = slot[low.astype(np.int64)]
        out[:, t] = symbols[which]
        state = np.where(here, shares[which] * (state >> _SHIFT) + low - cumulative[which], state)
        empty = here & (state < LOW)
        rank = np.cumsum(empty, axis=1)
        place = at[:, None] + rank - 1
        state = np.where(empty, (state << _WORD) | words[np.where(empty, place, 0)], state)
        at = at + rank[:, -1]
    return out.reshape(blocks, BLOCK)[real.reshape(blocks, BLOCK)]


def file_bytes(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    symbols, shares = frequencies(ids)
    payloads, states = encode_blocks(ids, symbols, shares)
    head = {
        "documents": len(doc_ids), "ids": int(len(ids)), "symbols": len(symbols), "lanes": LANES, "block": BLOCK,
        "bits": BITS, "sizes": [len(p) for p in payloads],
        "checksums": [zlib.crc32(p, zlib.crc32(s.tobytes())) for p, s in zip(payloads, states.astype("<u8"), strict=True)],
    }
    known = np.array([d is not None for d in doc_ids], np.uint8)
    body = [
        symbols.astype("<u4").tobytes(), shares.astype("<u4").tobytes(), known.tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), lengths.astype("<i8").tobytes(), states.astype("<u8").tobytes(),
    ]
    head["tables"] = zlib.crc32(b"".join(body))
    text = json.dumps(head).encode()
    return b"".join([MAGIC, len(text).to_bytes(8, "little"), text, *body, *payloads])


def read_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, lengths and ids; raises ValueError if a checksum differs."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    size = int.from_bytes(data[8:16], "little")
    head = json.loads(data[16 : 16 + size])
    if (head["lanes"], head["block"], head["bits"]) != (LANES, BLOCK, BITS):
        raise ValueError("a token file with other settings")
    at = start = 16 + size

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        part = np.frombuffer(data, kind, n, at)
        at += part.nbytes
        return part

    symbols, shares = take("<u4", head["symbols"]), take("<u4", head["symbols"]).astype(np.uint64)
    known, doc_ids, lengths = take("u1", head["documents"]), take("<i8", head["documents"]), take("<i8", head["documents"])
    blocks = len(head["sizes"])
    states = take("<u8", blocks * LANES).reshape(blocks, LANES).astype(np.uint64)
    if zlib.crc32(data[start:at]) != head["tables"]:
        raise ValueError("damaged tables")
    payloads = []
    for b, n in enumerate(head["sizes"]):
        payloads.append(data[at : at + n])
        at += n
        if zlib.crc32(payloads[-1], zlib.crc32(states[b].astype("<u8").tobytes())) != head["checksums"][b]:
            raise ValueError(f"damaged block {b}")
    counts = np.minimum(head["ids"] - BLOCK * np.arange(blocks), BLOCK)
    ids = decode_blocks(payloads, states, counts, symbols, shares)
    return [int(d) if k else None for d, k in zip(doc_ids, known, strict=True)], lengths, ids


def write_token_files(
    docs: DataFrame, folder: str | None = None, path: str | None = None, end_id: int = END_ID, file_ids: int = FILE_IDS
) -> DataFrame:
    """Write the ids of all documents (each text's, then `end_id`) in ascending doc_id order.

    Returns the manifest: path, part, number, documents, n_tokens and `start`,
    the ids before the file. A file that a lost task wrote is not named by the
    manifest. A null or empty text is the end id alone; null doc_ids come first;
    equal doc_ids are ordered by their texts. An empty table gives no file.
    """
    path = path or tokenizer_path()
    folder = folder or new_folder(docs.sparkSession, "token-files")

    def write(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        system, root = open_file_system(folder)
        number, held = 0, []  # held: doc_ids, lengths, ids of the file to come

        def flush():
            nonlocal number, held
            ids = np.concatenate([h[2] for h in held])
            data = file_bytes([d for h in held for d in h[0]], np.concatenate([h[1] for h in held]), ids)
            name = f"part-{part:06d}-{number:06d}-{uuid.uuid4().hex}.rans"
            system.create_dir(root, recursive=True)
            with system.open_output_stream(f"{root}/{name}") as out:
                out.write(data)
            row = pa.RecordBatch.from_pylist(
                [{"path": f"{folder}/{name}", "part": part, "number": number, "documents": sum(len(h[0]) for h in held),
                  "n_tokens": len(ids), "bytes": len(data)}]
            )
            number, held = number + 1, []
            return row

        for batch in batches:
            at = 0
            for some in in_slices(string_array(batch.column("text")), lambda a: a):
                ids, bounds = encoder(path).encode(some)
                lengths = np.diff(bounds) + 1
                whole = np.insert(ids, bounds[1:], np.uint32(end_id))
                held.append((batch.column("doc_id").slice(at, len(some)).to_pylist(), lengths, whole))
                at += len(some)
                if sum(len(h[2]) for h in held) >= file_ids:
                    yield flush()
        if held:
            yield flush()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = stored(
        ordered.mapInArrow(write, "path string, part bigint, number bigint, documents bigint, n_tokens bigint, bytes bigint"),
        "token-manifest",
    )
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("_all"))  # a row per range partition
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_all").over(earlier), F.lit(0)))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.join(parts, "part").select(
        *manifest.columns, (F.col("_before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start")
    )


def _files(manifest: DataFrame) -> DataFrame:
    """The files dealt over tasks; a stated number of partitions, as adaptive execution would join these few rows."""
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path", "start").repartition(tasks, "path")


def _decoded(batches):
    """doc_ids, places of the documents before, their bounds and ids, file by file."""
    for batch in batches:
        for file, before in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
            system, root = open_file_system(file)
            with system.open_input_stream(root) as source:
                doc_ids, lengths, ids = read_file(source.read())
            yield doc_ids, before, np.concatenate([[0], np.cumsum(lengths)]), ids


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids of every document in the files of a manifest; one task reads whole files."""

    def read(batches):
        for doc_ids, before, ends, ids in _decoded(batches):
            for at in range(0, len(doc_ids), 2000):
                n = min(2000, len(doc_ids) - at)
                own = ends[at : at + n + 1]
                lists = pa.ListArray.from_arrays(
                    pa.array((own - own[0]).astype(np.int32)), pa.array(ids[own[0] : own[-1]].astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids[at : at + n], pa.int64()), pa.array(before + own[:-1]), pa.array(np.diff(own)), lists],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return _files(manifest).mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids array<int>")


def read_token_digests(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as little-endian unsigned 32-bit integers, from the files."""

    def read(batches):
        for doc_ids, before, ends, ids in _decoded(batches):
            body = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(body[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(before + ends[:-1]), pa.array(np.diff(ends)), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return _files(manifest).mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
