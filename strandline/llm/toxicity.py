"""Toxicity by a factorization machine over hashed terms.

Terms are the words of a text and the first 4, 5 and 6 characters of longer words, hashed into BUCKETS. Every labelled row outside the
held-out fold counts towards the choice of terms: of those with enough texts, the TERMS whose chi-squared with the label is largest, however
many rows there are, so that all of a small vocabulary are kept. The machine has a weight and a short
vector for each: log-odds = bias + sum of weights + sum over pairs of the product of their vectors, so that a pair, such as an insult
beside the mention of a group, can count for more than its parts. It is trained on at most TRAIN_ROWS labelled rows.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, small_batches, small_or_shuffled, table, texts_of

BUCKETS = 1 << 20
#: Rows (least hash first) that the machine is fitted on; terms are chosen over all labelled rows.
TRAIN_ROWS = 30_000
#: Terms kept at most, and their least number of distinct texts.
TERMS, LEAST_DF = 2048, 4
FACTORS, EPOCHS, RATE, DECAY = 6, 12, 0.15, 2e-4
FOLDS = 5


def terms_of(word: str) -> list[int]:
    w = word.strip(string.punctuation)
    out = [w] if w else []
    out += [f"^{w[:k]}" for k in (4, 5, 6) if len(w) > k]
    return [xxhash.xxh32_intdigest(t) % BUCKETS for t in out]


class TermCache(dict):
    """word -> what `known` makes of its terms; emptied at 100,000 words."""

    def __init__(self, known=None):
        self.known = known

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= 100_000:
            self.clear()
        got = self[word] = tuple(terms_of(word) if self.known is None else (self.known[t] for t in terms_of(word) if t in self.known))
        return got


def term_set(text: str, cache: TermCache) -> set[int]:
    out: set[int] = set()
    for w in set(text.lower().split()):
        if f := cache[w]:
            out.update(f)
    return out


class Machine:
    """terms: bucket of each feature; bias, w, v: the parameters."""

    def __init__(self, terms: list[int], bias: float, w: np.ndarray, v: np.ndarray):
        self.terms, self.bias, self.w, self.v = terms, bias, w, v

    def score(self, rows: list[list[int]]) -> np.ndarray:
        n = np.array([len(r) for r in rows])
        z = np.full(len(rows), self.bias)
        some = np.flatnonzero(n)
        if len(some):
            x = np.concatenate([rows[i] for i in some]).astype(int)
            at = np.concatenate([[0], np.cumsum(n[some])[:-1]])
            s = np.add.reduceat(self.v[x], at)
            z[some] += np.add.reduceat(self.w[x], at) + 0.5 * ((s**2).sum(1) - np.add.reduceat((self.v[x] ** 2).sum(1), at))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    @classmethod
    def prior(cls, n0: int, n1: int) -> Machine:
        """No terms: the share of toxic texts is every text's score."""
        return cls([], float(np.log((n1 + 0.5) / (n0 + 0.5))) if n0 or n1 else -3.0, np.zeros(0), np.zeros((0, FACTORS)))

    @classmethod
    def fit(cls, terms: list[int], rows: list[list[int]], y: np.ndarray, seed: int = 5) -> Machine:
        """AdaGrad on the logistic loss, both classes weighing the same."""
        rng = np.random.default_rng(seed)
        m = cls(terms, 0.0, np.zeros(len(terms)), rng.normal(0, 0.02, (len(terms), FACTORS)))
        gw, gv, gb = np.full(len(terms), 1e-6), np.full((len(terms), FACTORS), 1e-6), 1e-6
        weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
        for _ in range(EPOCHS):
            for b in np.array_split(rng.permutation(len(y)), max(1, len(y) // 256)):
                got = [rows[i] for i in b]
                g = (m.score(got) - y[b]) * weight[b] / len(b)
                gb += g.sum() ** 2
                m.bias -= RATE * g.sum() / np.sqrt(gb)
                n = np.array([len(r) for r in got])
                if not n.sum():
                    continue
                x = np.concatenate([r for r in got if len(r)]).astype(int)
                doc = np.repeat(np.arange(len(b)), n)
                s = np.zeros((len(b), FACTORS))
                np.add.at(s, doc, m.v[x])
                dw, dv = np.zeros_like(m.w), np.zeros_like(m.v)
                np.add.at(dw, x, g[doc])
                np.add.at(dv, x, g[doc, None] * (s[doc] - m.v[x]))
                dw += DECAY * m.w
                dv += DECAY * m.v
                gw += dw**2
                gv += dv**2
                m.w -= RATE * dw / np.sqrt(gw)
                m.v -= RATE * 0.3 * dv / np.sqrt(gv)
        return m


def _counts(batches):
    """Labelled texts -> (term, texts with label 0, with label 1), summed over a batch."""
    cache = TermCache()
    for b in batches:
        labels = iter(b.column("y").to_pylist())
        c = np.zeros((2, BUCKETS), np.int32)
        for _, texts in texts_of([b]):
            for t in texts:
                c[next(labels), list(term_set(t.decode("utf-8", "surrogatepass"), cache))] += 1
        some = np.flatnonzero(c.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(c[0, some], pa.int64()), pa.array(c[1, some], pa.int64())], names=["term", "n0", "n1"])


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """Machine from the labelled documents outside the held-out fold. Equal texts count once; rows that disagree count as toxic.

    Labels other than 0 and 1, and labels or documents without a doc_id, teach nothing. With labels of one kind only, or none, or without a
    term in enough texts, the share of toxic texts is every text's score.
    """
    y = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y")).where(~held_out())
    y = small_or_shuffled(y, y.count())
    once = docs.select("doc_id", "text").join(y, "doc_id").groupBy(F.xxhash64("text")).agg(F.min_by(F.struct("doc_id", "y"), "doc_id").alias("r")).select("r.*")
    once = Scratch(docs.sparkSession).save(once, "labelled")
    texts = lambda ids: docs.select("doc_id", "text").join(small_or_shuffled(ids, ids.count()), "doc_id")
    rows = texts(once)
    total = {r.y: r["count"] for r in once.groupBy("y").count().collect()}
    n0, n1 = total.get(0, 0), total.get(1, 0)
    if not n0 or not n1:
        return Machine.prior(n0, n1)
    count = rows.select("text", "y").mapInArrow(_counts, "term long, n0 long, n1 long").groupBy("term").agg(F.sum("n0").cast("double").alias("a"), F.sum("n1").cast("double").alias("b"))
    chi2 = F.expr(f"({n0 + n1}D) * pow(b * ({n0} - a) - a * ({n1} - b), 2) / (({n0}D) * {n1} * (a + b) * ({n0 + n1} - a - b))")
    chosen = count.where(f"a + b >= {LEAST_DF} and a + b < {n0 + n1}").withColumn("chi2", chi2).orderBy(F.desc("chi2"), "term").limit(TERMS)
    terms = [r.term for r in chosen.select("term").collect()]
    if not terms:
        return Machine.prior(n0, n1)
    known = {t: i for i, t in enumerate(terms)}

    def features(batches):
        cache = TermCache(known)
        for b in batches:
            labels = iter(b.column("y").to_pylist())
            for _, texts in texts_of([b]):
                x = [sorted(term_set(t.decode("utf-8", "surrogatepass"), cache)) for t in texts]
                yield pa.RecordBatch.from_arrays([pa.array([next(labels) for _ in x], pa.int32()), pa.array(x, pa.list_(pa.int32()))], names=["y", "x"])

    some = once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    got = texts(some).select("text", "y").mapInArrow(features, "y int, x array<int>").toPandas()
    return Machine.fit(terms, [list(x) for x in got.x], got.y.to_numpy())


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS)) == 0, F.lit(False))


def score(docs: DataFrame, model: Machine) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row. Null and empty texts have no terms and get the bias's score.

    Rows may repeat and are each scored; a null doc_id is in no fold. Texts of any length are read whole. Other columns are ignored,
    whatever their names; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    known = {t: i for i, t in enumerate(model.terms)}

    def run(batches):
        cache = TermCache(known)
        for ids, texts in texts_of(batches):
            s = model.score([sorted(term_set(t.decode("utf-8", "surrogatepass"), cache)) for t in texts])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(s)], names=["doc_id", "score"])

    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return got.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
