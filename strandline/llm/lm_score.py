"""Language-model scoring by cross-entropy difference.

Two bigram models of the same order, smoothing and vocabulary: the target model counts the documents marked as wanted, the background
model all documents. A token's loss is -log(L c(h, w) / c(h) + (1 - L) p(w)), p(w) being a unigram with one added to every count; the
token at hand is left out of the counts it belongs to, so that a document isn't judged by itself. A document's score is the mean over
its tokens of background loss minus target loss: the higher, the more it is like the target.

The vocabulary is every word of the corpus, by 56-bit hash, and no table of words or bigrams is ever in one place. A batch of documents
sends its distinct words and bigrams with their counts, packed, to the range of their hash, where they are summed over all documents, and
the sums return to the batch. A frequent word is one entry of each batch, no more. Ranges grow in number with the text, and so do batches,
which else would send each range next to nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORDS, mix, small_batches, small_or_shuffled, table, texts_of

#: Weight of the bigram in the mixture.
L = 0.6
#: Words of text that a range of hashes is for, and words of a batch at least and at most.
RANGE_WORDS, BATCH, BATCH_MOST = 2_000_000, 800_000, 8_000_000
#: Keys are told apart by so many bits within their range.
BITS = 48
#: Bytes of a word's hash.
WIDTH = 7
#: History of a document's first word; what makes keys of words differ from those of bigrams.
START, WORD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
SENT = "p long, r long, k binary, b binary, t binary, w binary"


def hashed(batches, words: int) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """Arrow batches (doc_id, text, t) -> ids, marks t, words of each document, and the words' hashes, about `words` at a time."""
    marks: list[bool] = []

    def noted():
        for b in batches:
            marks.extend(b.column("t").to_pylist())
            yield b

    for ids, texts in texts_of(noted(), words):
        t = np.array(marks[: len(ids)], bool)
        del marks[: len(ids)]
        each = [x.lower().split() for x in texts]
        n = np.array([len(w) for w in each], np.int64)
        yield ids, t, n, np.fromiter((WORDS[w] for ws in each for w in ws), np.uint64, int(n.sum())) >> np.uint64(64 - 8 * WIDTH)


def _vocabulary(batches):
    """The distinct words of each batch, and a row without a word for its counts of tokens, in all and in the target."""
    for _, t, n, h in hashed(batches, BATCH):
        u = np.unique(h).view(np.int64)
        last = lambda x: pa.array(np.append(np.zeros(len(u), np.int64), x))
        yield pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(u), pa.nulls(1, pa.int64())]), last(len(h)), last(int(n[t].sum()))], names=["w", "b", "t"])


def short(v: np.ndarray, kind=np.uint8) -> bytes:
    """Whole numbers, most of them small, as `kind`, the largest of which stands for those that follow at the end; compressed."""
    top = np.iinfo(kind).max
    size = np.uint32 if v.max(initial=0) < 1 << 32 else np.uint64
    # low bytes apart from high ones, which are mostly zero
    x = np.minimum(v, top).astype(kind).view(np.uint8).reshape(len(v), kind().nbytes).T.tobytes() + v[v >= top].astype(size).tobytes()
    return np.array([len(v), size().nbytes, len(x)], np.uint32).tobytes() + pa.compress(x, codec="zstd", asbytes=True)


def long(x: bytes, kind=np.uint8) -> np.ndarray:
    """What short() was given."""
    n, size, m = np.frombuffer(x, np.uint32, 3).tolist()
    x = pa.decompress(x[12:], m, codec="zstd", asbytes=True)
    v = np.ascontiguousarray(np.frombuffer(x, np.uint8, n * kind().nbytes).reshape(kind().nbytes, n).T).view(kind).ravel().astype(np.int64)
    v[v == np.iinfo(kind).max] = np.frombuffer(x, np.uint32 if size == 4 else np.uint64, offset=n * kind().nbytes)
    return v


def narrow(u: np.ndarray) -> bytes:
    return np.ascontiguousarray(u.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WIDTH]).tobytes()


def wide(x: bytes) -> np.ndarray:
    some = np.frombuffer(x, np.uint8).reshape(-1, WIDTH)
    out = np.zeros((len(some), 8), np.uint8)
    out[:, :WIDTH] = some
    return out.view("<u8").ravel()


def steps(k: np.ndarray) -> bytes:
    """Rising keys as the first and the steps between them, in as few bytes each as the widest needs."""
    d = np.diff(k)
    width = max(1, (int(d.max(initial=0)).bit_length() + 7) // 8)
    return np.array([k[0], width], "<u8").tobytes() + np.ascontiguousarray(d.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def keys_of(x: bytes) -> np.ndarray:
    """What steps() was given."""
    first, width = np.frombuffer(x, "<u8", 2)
    some = np.frombuffer(x, np.uint8, offset=16).reshape(-1, int(width))
    d = np.zeros((len(some) + 1, 8), np.uint8)
    d[1:, : int(width)] = some
    d = d.view("<u8").ravel()
    d[0] = first
    return np.cumsum(d, dtype=np.uint64)


class Batch:
    """The distinct words u of some documents, w the place of each token's; their bigrams and the place of each token's; all keys
    in the order of their ranges, with where each range starts."""

    def __init__(self, u: np.ndarray, w: np.ndarray, n: np.ndarray, ranges: int):
        self.w = w
        h = np.empty(len(w), np.uint64)
        h[1:] = u[w[:-1]]
        first = (np.cumsum(n) - n)[n > 0]
        h[first] = START
        pairs, some, self.pair = np.unique(mix(h * np.uint64(0xD6E8FEB86659FD93) + u[w]), return_index=True, return_inverse=True)
        # of each distinct bigram: the places of its history (-1: start) and word
        self.word = w[some]
        before = np.concatenate([[-1], w[:-1]])[: len(w)]
        before[first] = -1
        self.history = before[some]
        keys = np.concatenate([mix(u ^ WORD), pairs])
        self.order = np.argsort(keys)
        keys = keys[self.order]
        # ranges are equal parts of all hashes; a key has BITS within its range, or all it has
        self.ranges, self.cut = np.unique(((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32), return_index=True)
        self.keys = keys >> np.uint64(max(0, 64 - BITS - (ranges - 1).bit_length()))

    def counts(self, weights: np.ndarray | None = None) -> np.ndarray:
        """How often each key occurs, in their order; weights: of each token."""
        each = [np.bincount(x, weights, size) for x, size in ((self.w, len(self.order) - len(self.word)), (self.pair, len(self.word)))]
        return np.concatenate(each).astype(np.int64)[self.order]


def _scatter(ranges: int, words: int):
    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for docs, t, n, h in hashed(batches, words):
            u, w, c = np.unique(h, return_inverse=True, return_counts=True)
            # frequent words first, whose places are small numbers
            first = np.argsort(-c, kind="stable")
            place = np.empty(len(u), np.int64)
            place[first] = np.arange(len(u))
            u, w = u[first], place[w]
            of = Batch(u, w, n, ranges)
            b, g, k = of.counts(), of.counts(np.repeat(t, n).astype(float)), of.keys
            p = (part << 32) + seq
            seq += 1
            head = np.array([[i or 0, i is None, x, m] for i, x, m in zip(docs, t, n)], np.int64)
            rows = [(p, -1 - p, narrow(u), head.tobytes(), b"", short(w, np.uint16))]
            rows += [(p, int(r), steps(k[a:z]), short(b[a:z]), short(g[a:z]), b"") for r, a, z in zip(of.ranges, of.cut, [*of.cut[1:], len(k)])]
            for a in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*rows[a : a + 10_000]), (pa.int64(), pa.int64(), *[pa.binary()] * 4))], names=["p", "r", "k", "b", "t", "w"])

    return run


def _count(pdf: pd.DataFrame) -> pd.DataFrame:
    """The keys of one range, summed over all batches, each batch getting what others have of those it sent. Heads pass through."""
    if pdf.r.iat[0] < 0:
        return pdf
    each = [keys_of(k) for k in pdf.k]
    cut = np.cumsum([len(k) for k in each])[:-1]
    u, at = np.unique(np.concatenate(each), return_inverse=True)
    del each

    def others(col) -> list[bytes]:
        own = np.concatenate([long(x) for x in col])
        return [short(v) for v in np.split(np.bincount(at, weights=own, minlength=len(u)).astype(np.int64)[at] - own, cut)]

    return pd.DataFrame({"p": pdf.p, "r": pdf.r, "k": b"", "b": others(pdf.b), "t": others(pdf.t), "w": b""})


class Model:
    """Losses of one model: words of the vocabulary, documents and tokens that it counts."""

    def __init__(self, vocabulary: int, docs: int, tokens: int):
        self.vocabulary, self.docs, self.tokens = vocabulary, docs, tokens

    def losses(self, of: Batch, counts: np.ndarray, minus: int) -> np.ndarray:
        """Loss of each distinct bigram's word, given the counts of words and bigrams; minus: 1 if the token itself is among them."""
        words, pairs = counts[: len(counts) - len(of.word)], counts[len(counts) - len(of.word) :]
        before = np.where(of.history < 0, self.docs, words[of.history]) - minus if len(words) else np.zeros(0)
        uni = np.maximum(words[of.word] - minus + 1, 1) / (self.tokens - minus + self.vocabulary)
        bi = np.divide(pairs - minus, before, out=np.zeros(len(pairs)), where=before > 0)
        return -np.log(L * np.clip(bi, 0, 1) + (1 - L) * uni)


def _gather(ranges: int, background: Model, target: Model):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        head, rest = pdf[pdf.r < 0], pdf[pdf.r >= 0].sort_values("r")
        ids, none, t, n = np.frombuffer(head.b.iat[0], np.int64).reshape(-1, 4).T
        of = Batch(wide(head.k.iat[0]), long(head.w.iat[0], np.uint16), n, ranges)

        def sums(col, weights: np.ndarray | None = None) -> np.ndarray:
            out = np.zeros(len(of.order))
            if len(out):
                out[of.order] = np.concatenate([long(x) for x in col]) + of.counts(weights)
            return out

        doc = np.repeat(np.arange(len(ids)), n)
        b = np.bincount(doc, background.losses(of, sums(rest.b), 1)[of.pair], len(ids))
        c = sums(rest.t, np.repeat(t, n).astype(float))
        own, other = (target.losses(of, c, m)[of.pair] for m in (1, 0))
        g = np.bincount(doc, np.where(t[doc] == 1, own, other), len(ids))
        n1 = np.maximum(n, 1)
        return pd.DataFrame({"doc_id": pd.array(np.where(none == 1, None, ids), "Int64"), "n_tokens": n, "loss_target": g / n1, "loss_background": b / n1, "score": (b - g) / n1})

    return run


def cross_entropy_difference(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, loss_target, loss_background, score) of every row of docs; wanted: doc_id of the target documents.

    Null and empty texts have no tokens and zeros. With no target document the target model knows nothing but the vocabulary. Rows may
    repeat and count each time, doc_id may be null, other columns are ignored, whatever their names; an empty table gives no rows. Texts
    of any length are read whole.
    """
    spark = small_batches(docs.sparkSession)
    good = wanted.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    good = small_or_shuffled(good, good.count()).withColumn("t", F.lit(True))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(good, "doc_id", "left").select("doc_id", "text", F.coalesce("t", F.lit(False)).alias("t"))
    seen = rows.agg(F.count("*").alias("docs"), F.count_if("t").alias("good")).first()
    words = rows.mapInArrow(_vocabulary, "w long, b long, t long").groupBy("w").agg(F.sum("b").alias("b"), F.sum("t").alias("t"))
    size = words.agg(F.count("w").alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b"), F.coalesce(F.sum("t"), F.lit(0)).alias("t")).first()
    ranges = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size.b // RANGE_WORDS))
    sent = rows.mapInArrow(_scatter(ranges, min(BATCH_MOST, max(BATCH, 8 * ranges))), SENT)
    summed = sent.groupBy("r").applyInPandas(_count, SENT)
    models = Model(size.n, seen.docs, size.b), Model(size.n, seen.good, size.t)
    return summed.groupBy("p").applyInPandas(_gather(ranges, *models), "doc_id long, n_tokens long, loss_target double, loss_background double, score double")


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where("quality = 1"))
