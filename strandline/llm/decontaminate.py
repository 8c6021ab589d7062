"""Benchmark decontamination: BM25 over an inverted index of test items, searched for every passage of every document.

A document is read in passages of two steps' words each, a step being the longest item, so that any item that lies in a document lies
in a passage. Scores are BM25 divided by the item's score against itself: 1 means that every term of the item is there. Posting lists
are in item order (items of like length stand together) with the largest impact of each block of BLOCK items. The bounds of all blocks
are summed for all passages of a document at once; block-max WAND then moves over the lists within the blocks that can reach the
threshold, and looks at no item whose terms can't, so all items above the threshold are retrieved. What is retrieved is then verified: word 3-grams of
the item's question (all but its last sentence) and answer (the last sentence; of a single sentence, the last third) in the passage.
"""

from __future__ import annotations

import re
import string
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table, texts_of

K1, B = 1.2, 0.75
#: Least share of an item's own score, least share of the 3-grams of question and answer each, or of the whole item.
THRESHOLD, OVERLAP, WHOLE = 0.5, 0.5, 0.6
GRAM = 3
#: Items of a posting block; items of one index: more items are in further indexes, of which a task holds one at a time.
BLOCK, ITEMS = 8, 4000
OUT = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


#: What is white space to Python beyond the six characters that bytes.split() knows; for ASCII, a table that lower-cases too.
WHITE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \t\n\r\v\f"]
BLANKS = re.compile("[" + "".join(map(re.escape, WHITE)) + "]")
PLAIN = bytes(32 if chr(c).isspace() else ord(chr(c).lower()) if c < 128 else c for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words of a text in UTF-8."""
    if text.isascii():
        return text.translate(PLAIN).split()
    low = text.decode("utf-8", "surrogatepass").lower()
    if any(c in low for c in WHITE):
        low = BLANKS.sub(" ", low)
    return low.encode("utf-8", "surrogatepass").split()


def tokens(text: str) -> list[str]:
    """Words without punctuation around them."""
    words = (w.decode("utf-8", "surrogatepass").strip(string.punctuation) for w in words_of(text.encode("utf-8", "surrogatepass")))
    return [w for w in words if w]


def grams(words: list) -> set:
    n = min(GRAM, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def parts(text: str) -> tuple[list[str], list[str]]:
    """Question and answer of an item."""
    sentences = [t for s in re.split(r"(?<=[.!?])\s+", text.strip()) if (t := tokens(s))]
    if len(sentences) > 1:
        return sum(sentences[:-1], []), sentences[-1]
    words = sentences[0] if sentences else []
    cut = len(words) - max(1, len(words) // 3)
    return (words[:cut], words[cut:]) if len(words) > 1 else (words, words)


class Statistics:
    """Of all items that aren't empty: their number, how many hold each term, mean and most words."""

    def __init__(self, texts: Iterable[str | None]):
        self.n, self.df, words, self.step = 0, Counter(), 0, 1
        for t in texts:
            if t and (w := tokens(t)):
                self.n, words, self.step = self.n + 1, words + len(w), max(self.step, len(w))
                self.df.update(set(w))
        self.mean = words / self.n if self.n else 1.0


class Index:
    """items: (item_id, text); empty items are left out. of: the statistics of all items, if these are some of them."""

    def __init__(self, items: list[tuple[int, str]], of: Statistics | None = None):
        of = of or Statistics(t for _, t in items)
        rows = sorted(((i, t, w) for i, t in items if t and (w := tokens(t))), key=lambda r: (len(set(r[2])), r[0]))
        self.ids = [i for i, _, _ in rows]
        self.term: dict[str, int] = {}
        tf = [Counter(self.term.setdefault(x, len(self.term)) for x in w) for _, _, w in rows]
        df = {t: of.df[x] for x, t in self.term.items()}
        self.postings: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for k, (c, (_, _, w)) in enumerate(zip(tf, rows)):
            s = {t: np.log(1 + (of.n - df[t] + 0.5) / (df[t] + 0.5)) * n * (K1 + 1) / (n + K1 * (1 - B + B * len(w) / of.mean)) for t, n in c.items()}
            own = sum(s.values())
            for t, x in s.items():
                self.postings[t].append((k, float(x / own)))
        self.at = {t: [k for k, _ in p] for t, p in self.postings.items()}
        self.bound = np.zeros((len(self.term), -(-len(rows) // BLOCK)), np.float32)
        for t, p in self.postings.items():
            for k, x in p:
                self.bound[t, k // BLOCK] = max(self.bound[t, k // BLOCK], x)
        self.step = of.step
        self.parts = []
        for _, t, w in rows:
            q, a = parts(t)
            code = lambda words: grams([self.term[x] for x in words])
            self.parts.append((code(q), code(a), code(w)))

    def search(self, terms: list[int], block: int) -> list[tuple[int, float]]:
        """Items of a block with a score of THRESHOLD or more for a passage of these distinct terms: WAND with the block's bounds."""
        least, end = THRESHOLD - 1e-9, (block + 1) * BLOCK
        # place in the list, term, list of items, the block's bound
        cursors = [[bisect_left(self.at[t], block * BLOCK), t, self.at[t], b] for t, b in zip(terms, self.bound[terms, block].tolist()) if b > 0]
        out = []
        while True:
            cursors = [c for c in cursors if c[0] < len(c[2]) and c[2][c[0]] < end]
            cursors.sort(key=lambda c: c[2][c[0]])
            bound, pivot = 0.0, None
            for j, c in enumerate(cursors):
                bound += c[3]
                if bound >= least - 1e-5:
                    pivot = j
                    break
            if pivot is None:
                return out
            item = cursors[pivot][2][cursors[pivot][0]]
            score = 0.0
            for c in cursors:
                c[0] = bisect_left(c[2], item, c[0])
                if c[0] < len(c[2]) and c[2][c[0]] == item:
                    score += self.postings[c[1]][c[0]][1]
                    c[0] += 1
            if score >= least:
                out.append((item, score))

    def passages(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Passages of a document's terms (-1: in no item), each with the blocks of items whose bounds let it reach the threshold."""
        at = np.flatnonzero(x >= 0)
        if not len(at):
            return
        n, size = -(-len(x) // self.step), len(self.term)
        # the distinct terms of each step and of the one after it make those of a passage
        part = at // self.step
        have = np.unique(np.concatenate([part * size + x[at], (part[part > 0] - 1) * size + x[at][part > 0]]))
        passage, start = np.unique(have // size, return_index=True)
        sums = np.add.reduceat(self.bound[have % size], start, axis=0)
        hit = sums >= THRESHOLD - 1e-5
        for k in np.flatnonzero(hit.any(axis=1)):
            if passage[k] < n:
                yield x[passage[k] * self.step : (passage[k] + 2) * self.step], np.flatnonzero(hit[k])

    def found(self, x: np.ndarray) -> dict[int, tuple[float, float, float]]:
        """Verified items of a document: item -> score, overlaps of question and answer; of several passages, the best."""
        out: dict[int, tuple[float, float, float]] = {}
        for p, blocks in self.passages(x):
            words = p.tolist()
            terms = sorted({t for t in words if t >= 0})
            here = None
            for k, s in (y for b in blocks.tolist() for y in self.search(terms, b)):
                here = here if here is not None else {tuple(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}
                q, a, w = (len(g & here) / len(g) for g in self.parts[k])
                if (q >= OVERLAP and (a >= OVERLAP or w >= WHOLE)) and (s, q, a) > out.get(k, (0.0, 0.0, 0.0)):
                    out[k] = (s, q, a)
        return out


PUNCTUATION = string.punctuation.encode()


class TermIds(dict):
    """word (lower case, UTF-8) -> its term, -1 if no item has it, -2 if it is punctuation only."""

    def __init__(self, term: dict[str, int]):
        self.term = {w.encode("utf-8", "surrogatepass"): k for w, k in term.items()}

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 120_000:
            self.clear()
        w = word.strip(PUNCTUATION)
        got = self[word] = self.term.get(w, -1) if w else -2
        return got


def _hits(index: Index, ids_of: TermIds, ids: list[int], words: list[list[bytes]]) -> list[tuple]:
    rows = []
    for i, ws in zip(ids, words):
        x = np.fromiter(map(ids_of.__getitem__, ws), np.int64, len(ws))
        rows += [(i, index.ids[k], *s) for k, s in index.found(x[x > -2]).items()]
    return rows


def _find(indexes: list):
    """indexes: one index, or broadcasts of several, of which a task holds one at a time: each batch of texts is read by all in turn."""
    def run(batches):
        ids_of = TermIds(indexes[0].term) if len(indexes) == 1 else None
        for ids, texts in texts_of(batches, 300_000 if ids_of is not None else 3_000_000):
            if ids_of is not None:
                rows = _hits(indexes[0], ids_of, ids, [words_of(t) for t in texts])
            else:
                rows = []
                for b in indexes:
                    index = b.value
                    rows += _hits(index, TermIds(index.term), ids, map(words_of, texts))
                    # the worker's copy goes, and comes again from the executor's file
                    del index, b._value
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()))], names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

    return run


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) for each document that holds a test item, with its best passage.

    Null and empty texts and items hold nothing. Rows of items that repeat give repeated results once; repeated documents are found each. A
    null doc_id or item_id stays null. Other columns are ignored, whatever their names; empty tables give none. The documents are read
    once, whatever the number of items.
    """
    spark = small_batches(docs.sparkSession)
    every = items.select("item_id", "text").distinct().orderBy("item_id", "text")
    rows = iter(every.toLocalIterator())
    blocks = iter(lambda: [(r.item_id, r.text) for r in islice(rows, ITEMS)], [])
    block, more = next(blocks, None), next(blocks, None)
    if block is None:
        return spark.createDataFrame([], OUT)
    if more is None:
        indexes = [Index(block)]
    else:
        # scores and passages are of all items, whichever share an index
        of = Statistics(r.text for r in every.toLocalIterator())
        indexes = [spark.sparkContext.broadcast(Index(b, of)) for b in chain([block, more], blocks)]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_find(indexes), OUT)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
