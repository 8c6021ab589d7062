"""Alignment of two tokenizers' tokens over the same text, by a transducer over dangling suffixes.

A reads a byte-level BPE vocabulary, B a SentencePiece model; both encode a blank and the text. Reading both token streams from the left,
one side leads: the bytes by which it is ahead of the other, the residual, are all that matters for what follows. The side that lags gives
the next token; it eats the residual from its front, or uses it up and leads by what is left of the token. So (side, residual) are the
states of a transducer, and each state remembers where a token leads to. An empty residual closes a group: the least run of tokens of
A and of B that cover the same bytes. Each step but a group's first is a link, two tokens whose bytes overlap.

How many documents hold a pair of ids linked is counted over the corpus: a batch of documents sends its distinct pairs with their number
of documents to the pair's place, where they are summed, and gets the sums back. A frequent pair is one row of each batch, no more.
"""

from __future__ import annotations

import functools
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import byte_bpe, sentencepiece_scan
from .common import Scratch, give_back, small_batches, table
from .lm_score import long, short

#: Distinct links of documents that a batch holds about, and transitions that the transducer remembers at most.
BATCH, REMEMBERED = 4_000_000, 200_000


class State(dict):
    """What one side is ahead by; next token of the other -> the state that follows (None: their bytes differ)."""

    __slots__ = ("of", "side", "rest")

    def __init__(self, of: Transducer, side: int, rest: bytes):
        self.of, self.side, self.rest = of, side, rest

    def __missing__(self, token: int) -> State | None:
        of, rest = self.of, self.rest
        new = of.tokens[1 - self.side][token]
        of.remembered += 1
        if rest.startswith(new) and new:
            to = of.state(self.side, rest[len(new) :])
        else:
            to = of.state(1 - self.side, new[len(rest) :]) if new.startswith(rest) and new else None
        self[token] = to
        return to


class Transducer:
    """tokens: the bytes of each id of A and of B. A link is A id << shift | B id."""

    def __init__(self, a: list[bytes], b: list[bytes]):
        self.tokens = a, b
        self.closed = State(self, 0, b"")
        self.shift = (len(b) - 1).bit_length()
        self.forget()

    def forget(self) -> None:
        self.states: dict[tuple[int, bytes], State] = {}
        # groups of one token each, as most are, by their link
        self.ones: dict[int, str | None] = {}
        self.remembered = 0

    def state(self, side: int, rest: bytes) -> State:
        if not rest:
            return self.closed
        got = self.states.get((side, rest))
        if got is None:
            got = self.states[side, rest] = State(self, side, rest)
            self.remembered += 1
        return got

    def align(self, a: list[int], b: list[int]) -> tuple[list[int], list[str]] | None:
        """Links, and groups as "a1,a2|b1"; None if the tokens' bytes differ."""
        if self.remembered > REMEMBERED:
            self.forget()
        links: list[int] = []
        groups: list[str] = []
        link, group, shift, closed, ones, shut = links.append, groups.append, self.shift, self.closed, self.ones.get, self.shut
        left, right = iter(a), iter(b)
        next_a, next_b = left.__next__, right.__next__
        try:
            for x in left:
                y = next_b()
                k = x << shift | y
                link(k)
                some = ones(k) or shut(k, x, y)
                if some:
                    group(some)
                    continue
                state = self.state(0, self.tokens[0][x])[y]
                xs, ys = [x], [y]
                while state is not closed:
                    if state.side:
                        x = next_a()
                        xs.append(x)
                        state = state[x]
                    else:
                        y = next_b()
                        ys.append(y)
                        state = state[y]
                    link(x << shift | y)
                group(f"{','.join(map(str, xs))}|{','.join(map(str, ys))}")
        except (StopIteration, AttributeError):
            return None  # one side is at its end, or there is no state
        return (links, groups) if next(right, None) is None else None

    def shut(self, k: int, x: int, y: int) -> str:
        """The group of x and y, if these close one; else empty."""
        if self.tokens[0][x] != self.tokens[1][y]:
            return ""
        self.remembered += 1
        some = self.ones[k] = f"{x}|{y}"
        return some


class Aligner:
    """Both tokenizers and the transducer between them."""

    def __init__(self, a_model: str, b_model: str):
        self.bpe, self.sp = byte_bpe.byte_bpe(a_model), sentencepiece_scan.library(b_model)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        b = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace(sentencepiece_scan.SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.transducer = Transducer(self.bpe.bytes, b)

    def aligned(self, text: str, b: list[int]) -> tuple[int, int, list[int], list[str]] | None:
        """(A's tokens, B's tokens, links, groups) of a text that B encodes as b; None if A's or B's bytes are not the text's."""
        a = self.bpe.encode(text, special=False).tolist()
        found = self.transducer.align(a, b)
        if found is None or b"".join(map(self.bpe.bytes.__getitem__, a)) != text.encode("utf-8", "surrogatepass"):
            return None
        return len(a), len(b), *found

    def _blocks(self, text: str) -> Iterator[tuple | None]:
        """B puts the blank in front of a block itself."""
        for x in byte_bpe.blocks(" " + text):
            yield self.aligned(x, self.sp.encode(x[1:], num_threads=1))

    def texts(self, texts: list[str | None]) -> Iterator[Iterator[tuple | None]]:
        """For each text, its blocks as `aligned`."""
        short_ones = iter(self.sp.encode([t for t in texts if t and len(t) < byte_bpe.BLOCK], num_threads=1))
        for t in texts:
            yield iter(()) if not t else iter([self.aligned(" " + t, next(short_ones))]) if len(t) < byte_bpe.BLOCK else self._blocks(t)


@functools.lru_cache(maxsize=1)
def aligner(a_model: str, b_model: str) -> Aligner:
    return Aligner(a_model, b_model)


def groups(docs: DataFrame, a_model: str = byte_bpe.MODEL, b_model: str = sentencepiece_scan.MODEL) -> DataFrame:
    """(doc_id, a, b) of every row: a and b are arrays of the same length, A's and B's ids of each group.

    Null and empty texts, and those that A or B do not give back byte by byte (such as one that holds U+2581), have no groups. Rows may
    repeat, doc_id may be null, other columns are ignored, whatever their names; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        of = aligner(a_model, b_model)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                doc, texts = (c.to_pylist() for c in batch.slice(at, 64).columns)
                out = []
                for found in of.texts(texts):
                    parts = list(found)
                    out.append([] if None in parts else [[[int(x) for x in side.split(",")] for side in g.split("|")] for p in parts for g in p[3]])
                kind = pa.list_(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), *(pa.array([[g[k] for g in x] for x in out], kind) for k in (0, 1))], names=["doc_id", "a", "b"])
        give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, a array<array<int>>, b array<array<int>>")


def _digest(found: Iterator[tuple | None]) -> tuple[tuple[int, int, int, int], str, dict[int, int]]:
    """((n_a, n_b, n_groups, n_links), digest of groups, how often each link occurs) of a text's blocks."""
    n_a = n_b = n_groups = 0
    sha, sep, times = hashlib.sha256(), "", Counter()
    for part in found:
        if part is None:
            return (0, 0, 0, 0), "", {}
        a, b, links, some = part
        n_a, n_b, n_groups = n_a + a, n_b + b, n_groups + len(some)
        sha.update((sep + ";".join(some)).encode())
        sep = ";"
        times.update(links)
    return (n_a, n_b, n_groups, sum(times.values())), sha.hexdigest() if sep else "", times


BATCHED = "p long, head binary, digests array<string>, pairs array<long>, docs array<int>, places binary, times binary"


def _batches(a_model: str, b_model: str):
    def run(batches):
        of = aligner(a_model, b_model)
        p = TaskContext.get().partitionId() << 32
        heads, digests, codes, times, size = [], [], [], [], 0

        def packed():
            # frequent pairs first, whose places are small numbers
            u, at, n = np.unique(np.concatenate(codes), return_inverse=True, return_counts=True)
            first = np.argsort(-n, kind="stable")
            place = np.empty(len(u), np.int64)
            place[first] = np.arange(len(u))
            row = [[p], [np.array(heads, np.int64).tobytes()], [digests], [u[first]], [n[first].astype(np.int32)], [short(place[at], np.uint16)], [short(np.concatenate(times))]]
            kinds = pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)], names=[c.split()[0] for c in BATCHED.split(", ")])

        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                doc, texts = (c.to_pylist() for c in batch.slice(k, 64).columns)
                for i, found in zip(doc, of.texts(texts)):
                    n, digest, some = _digest(found)
                    heads.append((i or 0, i is None, *n, len(some)))
                    digests.append(digest)
                    codes.append(np.fromiter(some, np.int64, len(some)))
                    times.append(np.fromiter(some.values(), np.int64, len(some)))
                    size += len(some)
                if size > BATCH or len(heads) > 100_000:
                    yield packed()
                    p += 1
                    heads, digests, codes, times, size = [], [], [], [], 0
        if heads:
            yield packed()
        give_back()

    return run


def _sums(best: np.ndarray, shift: int):
    """Per document of a batch: what its links' pairs count over the corpus. best: of each A id, its pairs' highest count."""

    def run(batch: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in batch.itertuples():
            ids, none, a, b, n_groups, n_links, k = np.frombuffer(row.head, np.int64).reshape(-1, 7).T
            pairs, known = np.asarray(row.pairs, np.int64), counts.pair.to_numpy(np.int64)
            order = np.argsort(known)
            total = counts.n.to_numpy(np.int64)[order[np.searchsorted(known, pairs, sorter=order)]] if len(pairs) else pairs
            top = total == best[pairs >> shift]
            place, times = long(row.places, np.uint16), long(row.times)
            doc = np.repeat(np.arange(len(ids)), k)
            n_best, count = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            np.add.at(n_best, doc, times * top[place])
            np.add.at(count, doc, times * total[place])
            columns = {"n_a": a, "n_b": b, "n_groups": n_groups, "n_links": n_links, "n_best": n_best, "count_sum": count, "groups_sha256": list(row.digests)}
            out.append(pd.DataFrame({"doc_id": pd.array(np.where(none == 1, None, ids), "Int64"), **columns}))
        return pd.concat(out)

    return run


def link_strength(docs: DataFrame, a_model: str = byte_bpe.MODEL, b_model: str = sentencepiece_scan.MODEL) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    n_best: links whose pair of ids is linked in as many documents as any pair of its A id; count_sum: the sum, over links, of the
    documents that hold the pair linked. groups_sha256: of the groups as "a1,a2|b1;a3|b2,b3". Texts without groups (see `groups`) have
    zeros and an empty digest. Rows may repeat and each counts as a document, doc_id may be null, other columns are ignored, whatever their
    names; an empty table gives no rows. Texts of any length are read in blocks, but one without a blank between letters or digits is one.
    """
    keep = Scratch(docs.sparkSession)
    shift = (sentencepiece_scan.library(b_model).get_piece_size() - 1).bit_length()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    batches = keep.save(rows.mapInArrow(_batches(a_model, b_model), BATCHED), "batches")
    sent = batches.select("p", F.explode(F.arrays_zip("pairs", "docs")).alias("x")).select("p", F.col("x.pairs").alias("pair"), F.col("x.docs").cast("long").alias("n"))
    counts = keep.save(sent.select("p", "pair", F.sum("n").over(Window.partitionBy("pair")).alias("n")), "counts")
    # at most a row for each id of A
    highest = counts.groupBy(F.shiftright("pair", shift).cast("int").alias("a")).agg(F.max("n").alias("n")).toPandas()
    best = np.zeros(int(highest.a.max() + 1 if len(highest) else 0), np.int64)
    best[highest.a] = highest.n
    shape = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return batches.groupBy("p").cogroup(counts.groupBy("p")).applyInPandas(_sums(best, shift), shape)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_strength(table(spark, sf_dir, "documents"))
