"""Best-fit packing of tokenized documents, after a Martello-Toth reduction.

Lengths are whole numbers up to the capacity, so all that a packing depends on is how many pieces there are of each length: at most
`capacity` numbers, whatever the corpus. The driver solves that small instance and gets patterns, each some lengths that share a
sequence and how often it is used. Spark counts the lengths, numbers the pieces of each length over all tasks, and each piece finds its
sequence and place from its number; neither pieces nor sequences ever meet in one place.

A set of pieces that share a sequence dominates another if the other's pieces can be dealt out to it, each of its pieces being at least as
long as the sum of those dealt to it: whatever solution holds the other can hold this one instead. Where a length has a set that dominates
every feasible set with it, the set is fixed for good, as often as there are pieces for it, and the instance shrinks (`reduce`). Best-fit
decreasing packs the rest.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .byte_bpe import MODEL, blocks, byte_bpe
from .common import Scratch, free_name, give_back, small_batches, table

#: Tokens of a sequence.
CAPACITY = 2048
#: Id after each document.
END = 0
#: Pieces of a shard, in which pieces are numbered by themselves.
SHARD = 1_000_000

#: How many sequences, and the lengths in each of them, with how many pieces of each.
Pattern = tuple[int, tuple[tuple[int, int], ...]]


def sums(counts: dict[int, int], most: int) -> int:
    """Bit s is set if some of the pieces sum to s, up to `most`."""
    out, mask = 1, (1 << most + 1) - 1
    for w, n in counts.items():
        n, step = min(n, most // w), 1
        while n > 0:
            some = min(step, n)
            out |= (out << w * some) & mask
            n, step = n - some, step * 2
    return out


def dominating(counts: dict[int, int], w: int, reach: int, capacity: int) -> tuple[int, ...] | None:
    """Lengths of a set with w that dominates all feasible sets with w, if one of up to three is found.

    counts: how many pieces are left of each length; reach: sums() of these or more pieces.
    """
    rest = capacity - w
    others = counts | {w: counts[w] - 1}
    fit = sorted((x for x, n in others.items() if n and x <= rest), reverse=True)
    if not fit:
        return (w,)
    first = fit[0]
    # whatever goes with w is no longer than `first`, so `first` can take its place
    if (reach & ((1 << rest + 1) - 1)).bit_length() - 1 == first:
        return (w, first)
    small = [x for x in fit[::-1][:3] for _ in range(min(3, others[x]))][:3]
    if len(small) > 1 and small[0] + small[1] > rest:
        return (w, first)
    if len(small) == 3 and sum(small) <= rest:
        return None
    # at most two go with w: of all such pairs, the one with `first` must have the longest second piece too
    second = lambda a: next((b for b in fit if b <= a and a + b <= rest and others[b] > (a == b)), 0)
    with_first = second(first)
    return (w, first, with_first) if with_first and all(second(a) <= with_first for a in fit[1:]) else None


def reduce(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Patterns that some best packing has, and how many pieces of each length are left."""
    left, fixed, found = dict(counts), [], True
    while found:
        found, reach = False, sums(left, capacity)
        for w in sorted(left, reverse=True):
            while left.get(w) and (some := dominating(left, w, reach, capacity)):
                each = {x: some.count(x) for x in some}
                times = min(left[x] // k for x, k in each.items())
                # a set of three may cease to dominate when one of its lengths runs out, not before
                for x, k in each.items():
                    left[x] -= times * k
                    if not left[x]:
                        del left[x]
                fixed.append((times, tuple(each.items())))
                found = True
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing, sequences of the same contents at a time: the piece goes where least room is left, the longest first."""
    room: dict[int, list[Pattern]] = defaultdict(list)
    for w in sorted(counts, reverse=True):
        n = counts[w]
        for r in range(w, capacity + 1):
            groups, now = room.pop(r, []) if n else [], []
            for times, has in groups:
                # a sequence with least room has least room still after it took one, so it takes all that fit
                k = min(r // w, n)
                full = min(times, n // k) if k else 0
                if full:
                    room[r - k * w].append((full, (*has, (w, k))))
                n -= full * k
                if n and full < times:
                    room[r - n * w].append((1, (*has, (w, n))))
                    full, n = full + 1, 0
                if times > full:
                    now.append((times - full, has))
            if now:
                room[r] += now
        k = capacity // w
        if n // k:
            room[capacity - k * w].append((n // k, ((w, k),)))
        if n % k:
            room[capacity - n % k * w].append((1, ((w, n % k),)))
    return [p for r in sorted(room) for p in room[r]]


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """How pieces, so many of each length, are packed: fixed sets first, then best fit for the rest."""
    fixed, left = reduce(counts, capacity)
    return fixed + best_fit(left, capacity)


def lower_bound(counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """No packing has fewer sequences (Martello and Toth's L2): for each a, pieces longer than capacity - a share with none of at least a."""
    best = 0
    for a in {0, *(w for w in counts if 2 * w <= capacity)}:
        alone = sum(n for w, n in counts.items() if w > capacity - a)
        half = {w: n for w, n in counts.items() if capacity - a >= w and 2 * w > capacity}
        small = sum(w * n for w, n in counts.items() if 2 * w <= capacity and w >= a)
        more = small - sum((capacity - w) * n for w, n in half.items())
        best = max(best, alone + sum(half.values()) + max(0, -(-more // capacity)))
    return best


class Places:
    """For the r-th piece of each length: its sequence and its place there."""

    def __init__(self, plan: list[Pattern]):
        rows: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        taken: dict[int, int] = defaultdict(int)
        first = 0
        for times, has in plan:
            at = 0
            for w, k in has:
                rows[w].append((taken[w], k, first, at))
                taken[w] += times * k
                at += w * k
            first += times
        self.sequences = first
        self.rows = {w: np.array(x, np.int64).T for w, x in rows.items()}

    def __call__(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        cut = np.flatnonzero(np.diff(length[order], prepend=-1))
        for some in np.split(order, cut[1:]) if len(order) else []:
            w = int(length[some[0]])
            start, k, first, at = self.rows[w]
            i = np.searchsorted(start, number[some], "right") - 1
            r = number[some] - start[i]
            sequence[some], offset[some] = first[i] + r // k[i], at[i] + r % k[i] * w
        return sequence, offset


def tokenized(docs: DataFrame, model: str = MODEL, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids) of every row's ids, END after them, in pieces of up to `capacity`; ids as little-endian 32-bit.

    Only documents longer than that are cut, and only their first piece is shorter. Null and empty texts are END alone. Rows may repeat
    and each has its pieces, doc_id may be null, other columns are ignored, whatever their names; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        bpe = byte_bpe(model)
        for b in batches:
            for at in range(0, b.num_rows, 64):
                some = b.slice(at, 64)
                rows = []
                for i, text in zip(*(c.to_pylist() for c in some.columns)):
                    ids = np.concatenate([*(bpe.encode(x, special=True) for x in blocks(text or "")), np.array([END], np.uint32)]).astype("<u4")
                    ends = range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)
                    rows += [(i, no, max(0, e - capacity) if no else 0, e) + (ids,) for no, e in enumerate(ends)]
                doc, no, start, end, ids = zip(*rows)
                columns = [pa.array(doc, pa.int64()), pa.array(no, pa.int32()), pa.array(start, pa.int64()), pa.array([e - s for s, e in zip(start, end)], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([x[s:e].tobytes() for x, s, e in zip(ids, start, end)], pa.binary())], names=["doc_id", "piece", "start", "length", "ids"])
        give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (length long, and any others) with sequence_id and offset: as few sequences of at most `capacity` as best fit finds.

    Pieces follow each other in a sequence without gaps. A length that is null, less than 1 or more than `capacity` has no place: both
    columns are null. Ties are of no matter: pieces of one length are interchangeable. Columns named sequence_id and offset are replaced;
    an empty table gives no rows. The number of sequences is within `lower_bound` and what best fit leaves.
    """
    spark = pieces.sparkSession
    keep = Scratch(spark)
    row, part, number, before = (free_name(pieces, x) for x in ("row", "part", "number", "before"))
    # written, so that a row's number is the same whenever it is read
    pieces = keep.save(pieces.drop("sequence_id", "offset").withColumn(row, F.monotonically_increasing_id()), "pieces")
    fits = F.coalesce(F.col("length").between(1, capacity), F.lit(False))
    shards = -(-pieces.count() // SHARD) or 1
    rows = pieces.where(fits).withColumn(part, F.shiftright(row, 33) % shards)
    each = keep.save(rows.groupBy(part, "length").agg(F.count("*").alias("n")), "lengths")
    # at most `capacity` rows
    places = Places(patterns({r.length: r.n for r in each.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity))
    earlier = Window.partitionBy("length").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    each = each.select(part, "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    order = Window.partitionBy(part, "length").orderBy(row)
    rows = rows.join(each, [part, "length"]).withColumn(number, F.row_number().over(order) + F.col(before) - 1).drop(before, part, row)

    def place(batches):
        for b in batches:
            found = places(*(b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", number)))
            rest = b.drop_columns([number])
            yield pa.RecordBatch.from_arrays([*rest.columns, *(pa.array(x) for x in found)], names=[*rest.schema.names, "sequence_id", "offset"])

    shape = rows.drop(number).withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    done = rows.select(*(c for c in rows.columns if c != number), number).mapInArrow(place, shape.schema)
    none = pieces.where(~fits).drop(row).withColumns({c: F.lit(None).cast("long") for c in ("sequence_id", "offset")})
    return done.select(*none.columns).unionByName(none)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids) of pieces (sequence_id, offset, length, ids) that pack() has placed: the rows to train on."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return packed.where("sequence_id is not null").groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = tokenized(table(spark, sf_dir, "documents"))
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
