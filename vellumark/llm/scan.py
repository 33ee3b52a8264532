"""Words, hashes and membership filters over whole Arrow batches of texts."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vellumark.session import stored

SLICE_BYTES = 1 << 20  # texts are scanned in slices of about this size

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = _TABLE.copy()
_LOWER[ord("A") : ord("Z") + 1] = _TABLE[ord("a") : ord("z") + 1]
_POWERS = np.ones(1, np.uint64)
_INVERSE = np.ones(1, np.uint64)


def bounded_batches(spark: SparkSession) -> None:
    """From now on a batch that goes to Python has a bounded number of bytes, not only of rows; texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 * SLICE_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def string_array(column: pa.ChunkedArray | pa.Array) -> pa.StringArray:
    """One array of plain strings; a null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.string():
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def text_bytes(array: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each text begins (one more entry than texts)."""
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, bounds - bounds[0]


def slices(array: pa.StringArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes; a longer text is a range of its own."""
    _, bounds = text_bytes(array)
    at = 0
    while at < len(array):
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        yield at, end
        at = end


def per_text(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many positions of each text are marked."""
    sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> None:
    global _POWERS, _INVERSE
    if len(_POWERS) < n:
        n = 1 << (n - 1).bit_length()
        inverse = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
        for name, factor in (("_POWERS", _MULTIPLIER), ("_INVERSE", inverse)):
            steps = np.full(n, factor)
            steps[0] = 1
            globals()[name] = np.cumprod(steps, dtype=np.uint64)


def word_spans(body: np.ndarray, bounds: np.ndarray, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the words `[^\\x20\\x09-\\x0D]+`, or of the runs of bytes that are not in `gaps`.

    A word never reaches over a text's bounds.
    """
    if not len(body):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~gaps[body]
    begin, end = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    inner = bounds[(bounds > 0) & (bounds < len(body))]
    begin[inner] = solid[inner]
    end[inner - 1] = solid[inner - 1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def span_hashes(body: np.ndarray, begins: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of every span, the same wherever they stand; `lower` folds A-Z."""
    out = np.zeros(len(begins), np.uint64)
    at = 0
    while at < len(begins):  # sorted spans, taken in runs of bounded length
        base = begins[at]
        till = max(at + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
        part = body[base : ends[till - 1]]
        _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((_LOWER if lower else _TABLE)[part] * _POWERS[: len(part)], out=sums[1:])
        b, e = begins[at:till] - base, ends[at:till] - base
        out[at:till] = mix((sums[e] - sums[b]) * _INVERSE[b] + (e - b).astype(np.uint64))
        at = till
    return out


def run_hashes(hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run `begins`:`ends` of word hashes, the same wherever the run stands."""
    _powers(len(hashes) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _POWERS[: len(hashes)], dtype=np.uint64)])
    return mix((sums[ends] - sums[begins]) * _INVERSE[begins] + (ends - begins).astype(np.uint64))


def windows(hashes: np.ndarray, owners: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of `size` words inside one text, and the index of its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + n]
    first = np.flatnonzero(owners[:n] == owners[size - 1 :])
    return mix(total[first]), first


def shingles(array: pa.StringArray, size: int, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, ascending, and where each text's begin.

    A text of fewer words is one shingle; one without words has none.
    """
    body, bounds = text_bytes(array)
    begins, ends = word_spans(body, bounds)
    owners = np.searchsorted(bounds, begins, "right") - 1
    hashes = span_hashes(body, begins, ends, lower)
    made, first = windows(hashes, owners, size)
    of = owners[first]
    counts = np.bincount(owners, minlength=len(array))
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        starts = np.concatenate([[0], np.cumsum(counts)])
        whole = np.array(
            [zlib.crc32(h := hashes[starts[d] : starts[d + 1]].tobytes()) | zlib.adler32(h) << 32 for d in short], np.uint64
        )
        made, of = np.concatenate([made, mix(whole)]), np.concatenate([of, short])
    order = np.lexsort((made, of))
    made, of = made[order], of[order]
    fresh = np.ones(len(made), bool)
    fresh[1:] = (made[1:] != made[:-1]) | (of[1:] != of[:-1])
    made, of = made[fresh], of[fresh]
    return made, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(array)))]).astype(np.int64)


def in_slices(array: pa.StringArray, work: Callable[[pa.StringArray], object]) -> Iterator[object]:
    for at, end in slices(array):
        yield work(array.slice(at, end - at))


def map_rows(
    docs: DataFrame, keep: list[str], added: StructType, work: Callable[[pa.StringArray], list[pa.Array]]
) -> DataFrame:
    """`row`, a struct of the columns `keep`, and the columns `added` that `work` makes of each slice of whole texts.

    As the row is one struct, its columns may have any names.
    """

    def run(batches):
        for batch in batches:
            at = 0
            for made, n in in_slices(string_array(batch.column("text")), lambda part: (work(part), len(part))):
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(at, n), *made], names=["row", *added.names])
                at += n

    source = docs.select(F.struct(*[F.col(_quoted(c)).alias(c) for c in keep]).alias("row"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, StructType([source.schema["row"], *added.fields]))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def flat_rows(mapped: DataFrame, *added: str) -> DataFrame:
    """The columns of `row`, then those `added`, which take the place of columns of the same name."""
    kept = [c for c in mapped.schema["row"].dataType.names if c not in added]
    return mapped.select(*[F.col(f"row.{_quoted(c)}").alias(c) for c in kept], *added)


# Membership filters: a fixed number of bits, so they can go to every task whatever the table's size. Beyond their
# capacity they only let more rows through. Keys are 64-bit hashes; two runs of 26 bits of each name two places.

FILTER_WORDS = 1 << 20  # longs of a filter, 8 MB


def _filter_places(key: Column) -> list[tuple[Column, Column]]:
    runs = (key, F.shiftrightunsigned(key, 26))
    return [(F.shiftrightunsigned(k, 6).bitwiseAND(F.lit(FILTER_WORDS - 1)).cast("int"), k.bitwiseAND(F.lit(63)).cast("int")) for k in runs]


class KeyFilter:
    """Words of a filter that are not zero (w, bits), a stored table of at most FILTER_WORDS rows."""

    def __init__(self, words: DataFrame):
        self.words = words

    def array(self) -> np.ndarray:
        """All FILTER_WORDS longs, for tasks in Python; they come to the driver packed, however many keys there are."""

        def packed(batches):
            for batch in batches:
                made = [batch.column(c).to_numpy(zero_copy_only=False).tobytes() for c in ("w", "bits")]
                yield pa.RecordBatch.from_arrays([pa.array([m], pa.binary()) for m in made], names=["w", "bits"])

        out = np.zeros(FILTER_WORDS, np.int64)
        for row in self.words.mapInArrow(packed, "w binary, bits binary").collect():
            out[np.frombuffer(row["w"], np.int32)] = np.frombuffer(row["bits"], np.int64)
        return out


def key_filter(keys: DataFrame, hashed: Column) -> KeyFilter:
    """Filter of all values of `hashed`, a 64-bit hash."""
    places = F.explode(F.array(*[F.struct(w.alias("w"), b.alias("b")) for w, b in _filter_places(F.col("_hash"))]))
    words = keys.select(hashed.alias("_hash")).where("_hash is not null").select(places.alias("p"))
    words = words.groupBy(F.col("p.w").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, p.b)")).alias("bits"))
    return KeyFilter(stored(words, "filter"))


def may_contain(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """True for each 64-bit hash that may be in the filter."""
    hit = np.ones(len(keys), bool)
    for run in (keys, keys >> np.uint64(26)):
        word = ((run >> np.uint64(6)) & np.uint64(FILTER_WORDS - 1)).astype(np.int64)
        hit &= (bits[word].view(np.uint64) >> (run & np.uint64(63))) & np.uint64(1) == 1
    return hit


def filtered(df: DataFrame, hashed: Column, keys: KeyFilter, inside: bool = True) -> DataFrame:
    """Rows whose hash may be in the filter, or those where it is not.

    Two look-ups in the filter's words, which have a bounded size and are
    broadcast; rows are not shuffled and no Python runs.
    """
    out, hit = df, F.lit(True)
    for word, bit in _filter_places(hashed):
        w, bits = (f"_{name}_{uuid.uuid4().hex}" for name in ("w", "bits"))
        out = out.join(F.broadcast(keys.words.select(F.col("w").alias(w), F.col("bits").alias(bits))), word == F.col(w), "left")
        hit = hit & (F.call_function("shiftrightunsigned", F.col(bits), bit).bitwiseAND(F.lit(1)) == 1)
    hit = F.coalesce(hit, F.lit(False))
    return out.where(hit if inside else ~hit).select(*[F.col(_quoted(c)) for c in df.columns])


def id_hash(column: str = "doc_id") -> Column:
    """Hash of an integer id, the same whatever its width."""
    return F.xxhash64(F.col(column).cast("bigint"))


def without_removed(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """Rows whose doc_id is not in `removed` (doc_id); texts of rows that cannot be are not shuffled."""
    bits = key_filter(removed, id_hash())
    clear = filtered(docs, id_hash(), bits, inside=False)
    some = filtered(docs, id_hash(), bits).join(removed.select("doc_id").distinct(), "doc_id", "left_anti")
    return clear.unionByName(some.select(*docs.columns))
