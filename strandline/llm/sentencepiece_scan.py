"""SentencePiece encoding and decoding, giant documents included, by a max-plus scan over chunks.

The vocabulary at hand is a BPE model. A string's BPE encoding is the one path through the lattice of its pieces in which every two
neighbours are stable, that is, encode to themselves when put together; with weight 0 for stable neighbours and minus infinity for
others it is the best path of a max-plus product, and the encoding of any split can be combined from its parts. Documents of at most
CHUNK characters are one part, and the library encodes them. Longer ones are cut blindly into chunks. A chunk's transfer matrix has
an entry for each boundary state at its start (a piece that lies over or ends at the cut, and how far) and at its end, finite where
stable neighbours lead from one to the other. The product of matrices is associative: SEGMENT neighbouring ones are combined to one, in
as many rounds as a document needs, and the true states come back down the same rounds to its chunks, which are then traced back
independently. Results equal the library's on the whole text. decode() turns ids into text again.
"""

from __future__ import annotations

import functools
import re
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, give_back, small_batches, small_or_shuffled, table, texts_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of a chunk; longer documents are giant.
CHUNK = 16_384
SPACE = "▁"
BREAK = re.compile("[^▁](?=▁)")
#: Characters around a chunk, longer than any piece.
MARGIN = 64
#: Neighbouring matrices that are combined to one.
SEGMENT = 64
#: Matrices whose states a task finds together.
TOGETHER = 1000


@functools.lru_cache(maxsize=2)
def library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Lattice:
    """Pieces of a BPE model with byte fallback, and which neighbours are stable."""

    def __init__(self, path: str):
        sp = library(path)
        self.piece = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.id = {p: i for i, p in enumerate(self.piece) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
        self.rank = {p: -sp.get_score(i) for p, i in self.id.items()}
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.longest = max(map(len, self.id))
        self.pairs: dict[tuple[str, str], bool] = {}

    def merge(self, text: str) -> list[str]:
        """BPE from single characters: the best-ranked merge first, leftmost of equals."""
        parts = list(text)
        while True:
            best = min(((self.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.rank), default=None)
            if best is None:
                return parts
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def stable(self, a: str, b: str) -> bool:
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) > 60_000:
                self.pairs.clear()
            got = self.pairs[a, b] = self.merge(a + b) == [a, b]
        return got

    def pieces_over(self, text: str, cut: int) -> list[tuple[str, int]]:
        """Boundary states at a cut: (piece, characters of it before the cut), for every piece that lies over it or ends there."""
        out = []
        for k in range(1, min(self.longest, cut) + 1):
            for n in range(k, min(self.longest, len(text) - cut + k) + 1):
                p = text[cut - k : cut - k + n]
                if p in self.id or n == 1:
                    out.append((p, k))
        return out

    def walk(self, text: str, start: int, first: str | None, end: int) -> dict[int, str]:
        """Paths from `start` that begin with the piece `first` (None: with any): place -> the last piece of the one path to it.

        The piece tried is the longest that is stable beside the one before; as an encoding is unique, no other can be.
        """
        last: dict[int, str] = {}
        if first is not None:
            last[start + len(first)] = first
        for i in range(start + 1, end + 1):
            if i in last or (first is not None and i < start + len(first)):
                continue
            for n in range(min(self.longest, i - start), 0, -1):
                p = text[i - n : i]
                if n > 1 and p not in self.id:
                    continue
                before = last.get(i - n)
                if (i - n == start and first is None) or (before is not None and self.stable(before, p)):
                    last[i] = p
                    break
        return last

    def trace(self, last: dict[int, str], end: int, start: int) -> list[str]:
        out = []
        while end > start:
            p = last[end]
            out.append(p)
            end -= len(p)
        return out[::-1]

    def ids(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for p in pieces:
            i = self.id.get(p)
            if i is None:
                out += [self.byte[b] for b in p.encode("utf-8", "surrogatepass")]
            else:
                out.append(i)
        return out


@functools.lru_cache(maxsize=1)
def lattice(path: str) -> Lattice:
    return Lattice(path)


def normal(text: str) -> str:
    """The model's own form of a text: a space in front, spaces as U+2581."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def breaks(text: str, a: int, b: int) -> tuple[int, int] | None:
    """First and last place within [a, b] where a run of U+2581 starts: no piece reaches over one, so all paths pass through it."""
    at = [m.start() + 1 for m in BREAK.finditer(text, max(0, a - 1), min(len(text), b + 1))]
    return (at[0], at[-1]) if at else None


def ends(lat: Lattice, last: dict[int, str], b: int) -> list[tuple[str, int]]:
    """States at the cut b that paths lead to."""
    return [(p, b - i + len(p)) for i in range(b, b + lat.longest) if (p := last.get(i)) is not None and i - len(p) < b]


def starts(lat: Lattice, text: str, a: int) -> list[tuple[str | None, int]]:
    return lat.pieces_over(text, a) if a else [(None, 0)]


def transfer(lat: Lattice, text: str, a: int, b: int) -> list[tuple[str, str]]:
    """Finite entries of the matrix of the chunk from a to b in `text` (with margins around it): pairs of states "k:piece".

    A document starts in "0:" and ends in "end".
    """
    name = lambda s: f"{s[1]}:{s[0] or ''}"
    to = lambda last: ["end"] if b == len(text) and b in last else [] if b == len(text) else [name(s) for s in ends(lat, last, b)]
    most = min(len(text), b + lat.longest - 1)
    if (at := breaks(text, a, b - 1)) is None:
        return [(name((p, k)), t) for p, k in starts(lat, text, a) for t in to(lat.walk(text, a - k, p, most))]
    f, g = at
    out = to(lat.walk(text, g, None, most))
    return [(name((p, k)), t) for p, k in starts(lat, text, a) if a - k == f or f in lat.walk(text, a - k, p, f) for t in out]


def backtrace(lat: Lattice, sp, text: str, a: int, b: int, s0: str, s1: str) -> list[int]:
    """Ids of a chunk after the piece of its first state, up to the piece of its last one."""
    k, _, p = s0.partition(":")
    start, first = a - int(k), p or None
    if s1 == "end":
        stop = b
    else:
        k, _, p = s1.partition(":")
        stop = b - int(k) + len(p)
    head = start + len(first or "")
    if (at := breaks(text, a, b - 1)) is None:
        return lat.ids(lat.trace(lat.walk(text, start, first, stop), stop, head))
    f, g = at
    out = lat.ids(lat.trace(lat.walk(text, start, first, f), f, head)) if f > head else []
    if g > f:
        out += sp.encode(text[f + 1 : g].replace(SPACE, " "))
    return out + lat.ids(lat.trace(lat.walk(text, g, None, stop), stop, g))


def _encode_small(model: str):
    def run(batches):
        sp = library(model)
        for ids, texts in texts_of(batches, 100_000):
            texts = [t.decode("utf-8", "surrogatepass") for t in texts]
            got = sp.encode(texts, num_threads=1)
            back = sp.decode(got, num_threads=1)
            n = [len(x) for x in got]
            flat = np.fromiter((i for x in got for i in x), np.int32, sum(n))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), lists, pa.array([x == t for x, t in zip(back, texts)])], names=["doc_id", "n_tokens", "ids", "round_trip"])

    return run


def _cut(frames):
    """Giant rows -> chunks, each with a margin of MARGIN characters on both sides."""
    for pdf in frames:
        for i, h, t in zip(pdf.doc_id, pdf.h, pdf.text):
            s = normal(t)
            for no, a in enumerate(range(0, len(s), CHUNK)):
                b = min(len(s), a + CHUNK)
                lo, hi = max(0, a - MARGIN), min(len(s), b + MARGIN)
                yield pd.DataFrame({"doc_id": [i], "h": [h], "no": [no], "part": [s[lo:hi]], "a": [a - lo], "b": [b - lo]})
    give_back()


def product(matrices: list[list[tuple[str, str]]]) -> list[tuple[str, str]]:
    """Finite entries of the max-plus product; all weights are zero, so it is the composition of the relations."""
    out = matrices[0]
    for m in matrices[1:]:
        step: dict[str, list[str]] = {}
        for f, t in m:
            step.setdefault(f, []).append(t)
        out = sorted({(f, u) for f, t in out for u in step.get(t, ())})
    return out


def path(matrices: list[list[tuple[str, str]]], first: str, last: str) -> list[str]:
    """The states between matrices on the one finite path from `first` to `last`: those reached from the left, traced from the right."""
    left = [{first}]
    for m in matrices:
        left.append({t for f, t in m if f in left[-1]})
    out = [last]
    for m, reach in zip(matrices[::-1], left[-2::-1]):
        out.append(next(f for f, t in m if t == out[-1] and f in reach))
    return out[::-1]


def _matrices(pdf: pd.DataFrame) -> tuple[pd.DataFrame, list[list[tuple[str, str]]]]:
    """Matrices in order, those of repeated rows of a document once."""
    some = pdf.sort_values("no").drop_duplicates("no")
    return some, [list(zip(f, t)) for f, t in zip(some["from"], some["to"])]


def _up(pdf: pd.DataFrame) -> pd.DataFrame:
    """SEGMENT neighbours as one."""
    some, ms = _matrices(pdf)
    m = product(ms)
    return pd.DataFrame({"doc_id": some.doc_id[:1], "h": some.h[:1], "no": some.no[:1] // SEGMENT, "from": [[f for f, _ in m]], "to": [[t for _, t in m]]})


def _down(pdf: pd.DataFrame) -> pd.DataFrame:
    """The states at both ends of each matrix of some segments, given those of each segment as first and last."""
    doc, h, no, first, last = (pdf[c].tolist() for c in ("doc_id", "h", "no", "first", "last"))
    if pdf.doc_id.isna().all():
        doc = [0] * len(pdf)
    order = sorted(range(len(pdf)), key=lambda i: (h[i], doc[i], no[i]))
    kept: list[int] = []
    states: list[tuple[str, str]] = []
    for _, rows in groupby(order, key=lambda i: (h[i], doc[i], no[i] // SEGMENT)):
        # repeated rows of a document once
        some = list({no[i]: i for i in rows}.values())
        s = path([list(zip(pdf["from"].iat[i], pdf["to"].iat[i])) for i in some], first[some[0]], last[some[0]])
        kept += some
        states += zip(s, s[1:])
    return pdf.iloc[kept][["doc_id", "h", "no"]].assign(s0=[x for x, _ in states], s1=[x for _, x in states])


def _states(matrices: DataFrame, most: int, keep: Scratch) -> DataFrame:
    """(doc_id, h, no, s0, s1) of every chunk: rounds up to one matrix a document, and down again. most: the largest number of a chunk."""
    shape = "doc_id long, h string, no int, from array<string>, to array<string>"
    levels = [keep.save(matrices, "matrices")]
    while most >= SEGMENT:
        levels.append(keep.save(levels[-1].groupBy("doc_id", "h", F.expr(f"no div {SEGMENT}")).applyInPandas(_up, shape), "segments"))
        most //= SEGMENT
    states = None
    for level in levels[::-1]:
        if states is None:
            ends = level.withColumn("first", F.lit("0:")).withColumn("last", F.lit("end"))
        else:
            up = states.select(F.col("doc_id").alias("d"), F.col("h").alias("g"), F.col("no").alias("up"), F.col("s0").alias("first"), F.col("s1").alias("last"))
            ends = level.join(up, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")) & (F.expr(f"no div {SEGMENT}") == F.col("up"))).drop("d", "g", "up")
        # segments are dealt out many at a time, as most are of a few matrices; rows without doc_id apart, which would make floats of ids
        part = F.pmod(F.xxhash64("doc_id", "h", F.expr(f"no div {SEGMENT}")), F.lit(-(-level.count() // TOGETHER) or 1))
        states = ends.groupBy(F.isnull("doc_id"), part).applyInPandas(_down, "doc_id long, h string, no int, s0 string, s1 string")
        states = keep.save(states, "states")
    return states


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of every row: the ids of the whole text, and whether decoding them gives the text again.

    Null and empty texts have no ids and round-trip to the empty text. A text that holds U+2581 itself decodes to spaces there. Rows
    may repeat and are each answered, and doc_id may be null. Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    keep = Scratch(docs.sparkSession)
    sp = library(model)
    if (longest := max(len(sp.id_to_piece(i)) for i in range(sp.get_piece_size()))) > MARGIN:
        raise ValueError(f"a piece of {longest} characters is longer than MARGIN")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    giant = F.coalesce(F.length("text") > CHUNK, F.lit(False))
    small = rows.where(~giant).mapInArrow(_encode_small(model), "doc_id long, n_tokens long, ids array<int>, round_trip boolean")
    big = keep.save(rows.where(giant).withColumn("h", F.sha2("text", 256)).mapInPandas(_cut, "doc_id long, h string, no int, part string, a int, b int"), "chunks")

    def matrices(frames):
        lat = lattice(model)
        for pdf in frames:
            got = [transfer(lat, t, a, b) for t, a, b in zip(pdf.part, pdf.a, pdf.b)]
            yield pd.DataFrame({"doc_id": pdf.doc_id, "h": pdf.h, "no": pdf.no, "from": [[f for f, _ in m] for m in got], "to": [[t for _, t in m] for m in got]})
        lat.pairs.clear()
        give_back()

    def back(frames):
        lat, sp = lattice(model), library(model)
        for pdf in frames:
            yield pdf[["doc_id", "h", "no"]].assign(ids=[np.array(backtrace(lat, sp, *x), np.int32) for x in zip(pdf.part, pdf.a, pdf.b, pdf.s0, pdf.s1)])
        lat.pairs.clear()
        give_back()

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        import hashlib

        copies = int((pdf.no == 0).sum())
        ids = np.concatenate(pdf.sort_values("no").drop_duplicates("no").ids.tolist()).astype(np.int32)
        ok = hashlib.sha256(library(model).decode(ids.tolist()).encode()).hexdigest() == pdf.h.iat[0]
        return pd.DataFrame({"doc_id": [pdf.doc_id.iat[0]] * copies, "n_tokens": len(ids), "ids": [ids] * copies, "round_trip": ok})

    most = big.agg(F.max("no")).first()[0] or 0
    states = _states(big.mapInPandas(matrices, "doc_id long, h string, no int, from array<string>, to array<string>"), most, keep)
    states = small_or_shuffled(states, 10 * states.count())  # rows of about 100 bytes
    joined = big.join(states, (big.doc_id.eqNullSafe(states.doc_id)) & (big.h == states.h) & (big.no == states.no)).select(big.doc_id, big.h, big.no, "part", "a", "b", "s0", "s1")
    done = joined.mapInPandas(back, "doc_id long, h string, no int, ids array<int>").groupBy("doc_id", "h").applyInPandas(whole, "doc_id long, n_tokens long, ids array<int>, round_trip boolean")
    return small.unionByName(done)


def decode(tokens: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of every row of tokens (doc_id, ids): the text that the ids stand for.

    No ids, or null, are the empty text, and null ids among others are left out. Bytes that are no UTF-8 become U+FFFD; an id that the
    model lacks is an error. Rows may repeat, doc_id may be null, other columns are ignored; an empty table gives no rows.
    """
    small_batches(tokens.sparkSession)

    def run(batches):
        sp = library(model)
        for b in batches:
            ids = [[i for i in x or () if i is not None] for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([sp.decode(x) if x else "" for x in ids], pa.string())], names=["doc_id", "text"])
        give_back()

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
