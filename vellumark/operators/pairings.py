"""Terms used in the same places, all of them: slices of asked terms meet slices of alternates, strongest first."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import parquet
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumark.operators.term_blocks import Cells, per_block
from vellumark.session import bounded_batches, new_folder, stored
from vellumark.sources.filesystem import open_file_system

CELL = 1 << 21  # uses (place, term) that a slice has of either side
PAIRS = 1 << 21  # pairs a task works on at a time
SIDES = 4  # least slices of asked terms a core, but for small inputs
SMALL = 1 << 16
MERGED = 1 << 17  # rows of places that are summed at a time
TRIED = 256  # a term of fewer pairs needs no bound
_BITS = 63


def block_uses(own: pa.Table, cells: Cells, total: int) -> pa.Table:
    """place, id, n, mark of the uses in a block; a place is the number of its two terms."""
    at = own.column("at").to_numpy()
    ids, marks = np.zeros(int(at.max(initial=-1)) + 1, np.int64), np.zeros(int(at.max(initial=-1)) + 1, np.int32)
    ids[at], marks[at] = own.column("id").to_numpy(), own.column("mark").to_numpy()
    words = cells.sequence.astype(np.int64)
    left, term, right = words[:-2], words[1:-1], words[2:]
    real = (left >= 0) & (term >= 0) & (right >= 0)
    left, term, right = left[real], term[real], right[real]
    wide = max(1, len(ids))
    if wide**3 < 1 << _BITS:
        use, n = np.unique((left * wide + right) * wide + term, return_counts=True)
        left, right, term = use // wide // wide, use // wide % wide, use % wide
    else:
        place, n = np.unique(left * wide + right, return_inverse=True)
        use, n = np.unique(n.astype(np.int64) * wide + term, return_counts=True)
        left, right, term = place[use // wide] // wide, place[use // wide] % wide, use % wide
    return pa.table([pa.array(ids[left] * total + ids[right]), pa.array(ids[term]), pa.array(n.astype(np.int64)), pa.array(marks[term])], names=["place", "id", "n", "mark"])


def _merged(table: pa.Table) -> pa.RecordBatch:
    """Uses of whole places, summed, those of places with several terms."""
    place, id_, n, mark = (table.column(c).to_numpy() for c in ("place", "id", "n", "mark"))
    order = np.lexsort((id_, place))
    place, id_, n, mark = place[order], id_[order], n[order], mark[order]
    head = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (id_[1:] != id_[:-1])))
    place, id_, n, mark = place[head], id_[head], np.add.reduceat(n, head), mark[head]
    begins = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    sizes = np.diff(np.append(begins, len(place)))
    size = np.repeat(sizes, sizes)
    several = size > 1  # a place with one term offers no alternate
    arrays = [pa.array(x[several]) for x in (place, id_, n, mark, size)]
    return pa.RecordBatch.from_arrays(arrays, names=["place", "id", "n", "mark", "size"])


def shared_places(uses: DataFrame) -> DataFrame:
    """place, id, n, mark and size (terms of the place) of the places with several terms; `uses` may have a use in several rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            place = batch.column("place").to_numpy()
            if rows < MERGED or place[0] == place[-1]:  # a place that goes on over many batches is joined once
                continue
            last = int(np.searchsorted(place, place[-1]))
            yield _merged(pa.Table.from_batches([*held[:-1], batch.slice(0, last)]))
            held, rows = [batch.slice(last)], batch.num_rows - last
        if held:
            yield _merged(pa.Table.from_batches(held))

    ordered = uses.select("place", "id", "n", "mark").repartition("place").sortWithinPartitions("place")
    return ordered.mapInArrow(run, "place bigint, id bigint, n bigint, mark int, size bigint")


def _read(folder: str, side: str, number: int, columns: tuple[str, ...]) -> list[np.ndarray]:
    """The columns of a slice, by place and id."""
    system, root = open_file_system(f"{folder}/{side}={number}")
    from pyarrow import fs

    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    files = sorted(f.path for f in found if f.base_name.endswith(".parquet"))
    if not files:
        return [np.zeros(0, np.int64)] * len(columns)
    whole = pa.concat_tables([parquet.read_table(f, filesystem=system, columns=list(columns), partitioning=None) for f in files])
    arrays = [whole.column(c).to_numpy() for c in columns]
    if len(files) > 1:
        order = np.lexsort((arrays[1], arrays[0]))
        arrays = [x[order] for x in arrays]
    return arrays


@dataclass
class Uses:
    """Uses of asked terms in places that alternates have, by term and the places' sizes, largest first."""

    term: np.ndarray
    place: np.ndarray  # its number in the slice
    first: np.ndarray  # where the place's alternates begin
    size: np.ndarray  # how many they are
    n: np.ndarray

    def where(self, kept: np.ndarray) -> Uses:
        return Uses(self.term[kept], self.place[kept], self.first[kept], self.size[kept], self.n[kept])


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each size."""
    return np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)


def _sums(uses: Uses, own: np.ndarray, most: np.ndarray, offered: tuple[np.ndarray, np.ndarray], id_bits: int) -> Iterator[tuple[np.ndarray, ...]]:
    """term, alternate, score of each pair, by term, score (falling) and alternate: some whole terms at a time.

    `most` bounds the scores of a term and falls from term to term, so that the
    numbers of a pair and its score fit one integer, and sorting is of integers.
    """
    alternate, m = offered
    begins = np.flatnonzero(np.diff(uses.term, prepend=-1))
    behind = np.append(begins[1:], len(uses.term))
    pairs_till = np.cumsum(uses.size)[behind - 1] if len(begins) else begins
    low = (1 << id_bits) - 1
    k = 0
    while k < len(begins):  # a term alone has at most the pairs of a slice
        bits = int(most[uses.term[begins[k]]]).bit_length()
        fitting = 1 << max(0, _BITS - id_bits - bits)
        done = pairs_till[k - 1] if k else 0
        upto = min(max(k + 1, int(np.searchsorted(pairs_till, done + PAIRS, "right"))), k + fitting, len(begins))
        b, e = begins[k], behind[upto - 1]
        size = uses.size[b:e]
        where = _spread(uses.first[b:e], size)
        local = np.cumsum(np.diff(uses.term[b:e], prepend=uses.term[b]) != 0)
        value = np.minimum(m[where], np.repeat(uses.n[b:e], size))
        pairs = ((np.repeat(local << id_bits, size) | alternate[where]) << bits) | value
        pairs.sort()
        pair = pairs >> bits
        head = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        score = np.add.reduceat(pairs & ((1 << bits) - 1), head)
        pair = pair[head]
        of = uses.term[begins[k:upto]]
        other = (pair & low) != own[of][pair >> id_bits]
        pair, score = pair[other], score[other]
        ranked = (((pair >> id_bits) << bits | ((1 << bits) - 1 - score)) << id_bits) | (pair & low)
        ranked.sort()
        head = ranked >> id_bits
        yield of[head >> bits], ranked & low, ((1 << bits) - 1) - (head & ((1 << bits) - 1))
        k = upto


def _begins(term: np.ndarray) -> np.ndarray:
    """Where the run of each entry begins."""
    return np.maximum.accumulate(np.where(np.diff(term, prepend=-1) != 0, np.arange(len(term)), 0))


def _ranks(term: np.ndarray) -> np.ndarray:
    return np.arange(len(term)) - _begins(term)


def best_of_slice(asked: list[np.ndarray], slices: Iterable[tuple[list[np.ndarray], int]], top: int, id_bits: int) -> tuple[np.ndarray, ...]:
    """id, rank, alternate and score of the `top` best alternates of each asked term, exactly.

    `slices` are the uses of some alternates (place, id, n, by place and id)
    and the most uses any of them has. The best so far bound what comes: an
    alternate that a term meets only in some largest of its places, where the
    term has no more than half of that bound of uses, cannot be among its best. These
    places are looked up for the alternates which the others leave possible, and not gone through.
    """
    place, id_, n, size = asked
    own, term = np.unique(id_, return_inverse=True)
    total = np.bincount(term, n, len(own)).astype(np.int64)
    by_total = np.argsort(-total, kind="stable")  # terms of like totals together
    own, total = own[by_total], total[by_total]
    number = np.empty(len(own), np.int64)
    number[by_total] = np.arange(len(own))
    term = number[term]
    order = np.lexsort((-size, term))
    at_order = np.empty(len(order), np.int64)
    at_order[order] = np.arange(len(order))
    bound = np.zeros(len(own), np.int64)
    best = [np.zeros(0, np.int64)] * 3

    for (known, alternate, m), most in slices:
        if not len(known) or not len(place):
            continue
        first = np.flatnonzero(np.append(True, known[1:] != known[:-1]))
        ends = np.append(first[1:], len(known))
        active = np.flatnonzero((bound <= np.minimum(total, most))[term])  # by place
        at = np.searchsorted(known[first], place[active])
        at[at == len(first)] = 0
        met = known[first][at] == place[active]
        active, at = active[met], at[met]
        to = np.argsort(at_order[active])
        at, use = at[to], active[to]
        uses = Uses(term[use], at, first[at], (ends - first)[at], n[use])
        reach = np.bincount(uses.term, uses.n, len(own)).astype(np.int64)
        uses = uses.where((bound <= reach)[uses.term])
        if not len(uses.term):
            continue
        # All alternates of a single use have the score 1, the first ones are the best.
        alone = (np.bincount(uses.term, minlength=len(own))[uses.term] == 1) & (uses.n == 1)
        uses.size = np.where(alone, np.minimum(uses.size, top + 1), uses.size)
        till = np.cumsum(uses.n)
        till = till - (till - uses.n)[_begins(uses.term)]  # of the term's uses down to this place

        many = np.bincount(uses.term, uses.size, len(own)) >= TRIED
        tried = uses.where(((bound == 0) & many)[uses.term] & (2 * till > reach[uses.term]))
        for of, _, score in _sums(tried, own, total, (alternate, m), id_bits):
            last = _ranks(of) == top - 1
            bound[of[last]] = np.maximum(bound[of[last]], score[last])

        skipped = 2 * till <= bound[uses.term]
        left_out = np.bincount(uses.term[skipped], uses.n[skipped], len(own)).astype(np.int64)
        looked_up = uses.where(skipped)
        from_, upto = (np.searchsorted(looked_up.term, np.arange(len(own)), side) for side in ("left", "right"))
        entries = (np.repeat(np.arange(len(first)), ends - first) << id_bits) | alternate
        found = [best]
        for of, other, score in _sums(uses.where(~skipped), own, total, (alternate, m), id_bits):
            rank = _ranks(of)
            last = rank == top - 1
            bound[of[last]] = np.maximum(bound[of[last]], score[last])
            kept = (score + left_out[of] >= bound[of]) & ((rank < top) | (left_out[of] > 0))
            of, other, score = of[kept], other[kept], score[kept]
            lookups = upto[of] - from_[of]
            till_here = np.cumsum(lookups)
            k = 0
            while k < len(of):
                done = till_here[k - 1] if k else 0
                e = max(k + 1, int(np.searchsorted(till_here, done + PAIRS, "right")))
                which = _spread(from_[of[k:e]], lookups[k:e])
                if len(which):
                    pair = np.repeat(np.arange(k, e), lookups[k:e])
                    wanted = (looked_up.place[which] << id_bits) | other[pair]
                    here = np.minimum(np.searchsorted(entries, wanted), len(entries) - 1)
                    there = entries[here] == wanted
                    score += np.bincount(pair[there], np.minimum(m[here[there]], looked_up.n[which[there]]), len(of)).astype(np.int64)
                k = e
            kept = score >= bound[of]
            found.append([of[kept], other[kept], score[kept]])
        of, other, score = (np.concatenate(x) for x in zip(*found))
        order_ = np.lexsort((other, -score, of))
        of, other, score = of[order_], other[order_], score[order_]
        rank = _ranks(of)
        last = rank == top - 1
        bound[of[last]] = score[last]
        best = [x[rank < top] for x in (of, other, score)]
    of, other, score = best
    return own[of], _ranks(of).astype(np.int32) + 1, other, score


def _slices_by_strength(counts: dict[int, int]) -> list[tuple[int, list[int], int]]:
    """(slices, strengths, most uses of a term) of alternates that are sliced together, strongest first."""
    groups: list[tuple[int, list[int], int]] = []
    for strength in sorted(counts, reverse=True):
        rows, most = counts[strength], (2 << strength) - 1
        if groups and rows + groups[-1][2] <= CELL:
            groups[-1] = (1, [*groups[-1][1], strength], rows + groups[-1][2])
        else:
            groups.append((-(-rows // CELL), [strength], rows))
    return [(slices, strengths, (2 << max(strengths)) - 1) for slices, strengths, _ in groups]


def all_alternates(terms: DataFrame, blocks: DataFrame, numbered: DataFrame, asked: DataFrame | None, top: int) -> DataFrame:
    """id, rank, other, score of ordered blocks of texts and their `numbered` terms; of the ids of `asked` only, if it is given.

    Every pair of terms of every place counts. Uses are written in slices of
    terms; a task has a slice of the asked terms, reads the slices of alternates one after the other and keeps
    the `top` best of each asked term, so that no pair is shuffled and no task
    has more than two slices' uses, however many terms a place has.
    """
    spark = terms.sparkSession
    bounded_batches(spark)
    total = numbered.count()
    if total >= 3_000_000_000:
        raise ValueError("too many terms: a pair of them has no number of 63 bits")
    strength = F.floor(F.log2(F.greatest("uses", F.lit(1)) + F.lit(0.5))).cast("int")
    marked = numbered.select("term", "id", (strength * 2).alias("mark"))
    if asked is None:
        marked = marked.withColumn("mark", F.col("mark") + 1)
    else:
        wanted = asked.select("id").distinct().withColumn("asked", F.lit(1))
        marked = marked.join(wanted, "id", "left").withColumn("mark", F.col("mark") + F.coalesce("asked", F.lit(0)))
    of_blocks = terms.select("block", "at", "term").join(marked, "term").select("block", "at", "id", "mark")
    in_blocks = per_block(of_blocks, blocks.select("block", "sequence"), lambda own, cells: block_uses(own, cells, total), "place bigint, id bigint, n bigint, mark int")
    uses = stored(shared_places(in_blocks), "pairing-uses")
    counts = {r["mark"]: r["n"] for r in uses.groupBy("mark").agg(F.count("*").alias("n")).collect()}
    by_strength: dict[int, int] = {}
    for mark, rows in counts.items():
        by_strength[mark >> 1] = by_strength.get(mark >> 1, 0) + rows
    wide = sum(rows for mark, rows in counts.items() if mark & 1)
    least = SIDES * spark.sparkContext.defaultParallelism if wide > SMALL else 1
    rows = max(-(-wide // CELL), least)
    offers: list[int] = []  # most uses of a term of each slice
    number = F.lit(0).cast("long")
    for slices, strengths, most in _slices_by_strength(by_strength):
        own = F.pmod(F.xxhash64("id"), F.lit(slices)) + F.lit(len(offers))
        number = F.when(F.shiftright("mark", 1).isin(strengths), own).otherwise(number)
        offers += [most] * slices
    folder = new_folder(spark, "pairings")
    asked_slice = F.pmod(F.xxhash64("id"), F.lit(rows)).alias("asked")
    for side, of, count in (
        ("asked", uses.where("mark % 2 = 1").select("place", "id", "n", "size", asked_slice), rows),
        ("offered", uses.select("place", "id", "n", number.alias("offered")), max(1, len(offers))),
    ):
        of.repartition(count, side).sortWithinPartitions(side, "place", "id").write.partitionBy(side).parquet(f"{folder}/{side}")
    id_bits = max(1, (total - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column("id").to_pylist():
                own = _read(f"{folder}/asked", "asked", row, ("place", "id", "n", "size"))
                others = ((_read(f"{folder}/offered", "offered", k, ("place", "id", "n")), most) for k, most in enumerate(offers))
                made = best_of_slice(own, others, top, id_bits) if len(own[0]) else ()
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=["id", "rank", "other", "score"])

    slices = spark.range(0, rows, 1, rows)
    return stored(slices.mapInArrow(run, "id bigint, rank int, other bigint, score bigint"), "pairing-best")
