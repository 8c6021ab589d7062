"""Nearest neighbours by cosine with a hierarchical k-means tree.

The tree is fitted on a bounded sample (one vector of SHARE, from LEAST to MOST); every distinct vector is filed under a leaf. A query
walks the tree best bin first: a priority queue holds the open nodes, nearest centre first, and leaves are visited until as many are seen
as calibration asks for. Calibration searches the sample with queries from within it, widening the visits until recall against brute force
reaches RECALL. Scores are exact cosines of the original vectors in double precision; a product of whole blocks only tells which vectors
can be among the nearest, and keeps all that come within ROUNDING of the last of these.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Scratch, table

#: The tree is fitted and calibrated on one of so many distinct vectors, least hash first, within these bounds: 500 to 4,000 leaves.
SHARE, LEAST, MOST = 16, 16_384, 131_072
#: More than a cosine can be off by in a matrix product.
ROUNDING = 1e-9
BRANCH, LEAF = 8, 48
#: Recall of the k nearest that calibration must reach on its queries, and their number.
RECALL, TRIALS = 0.985, 256
#: Neighbouring leaves that are filed together, so that a query is sent once for all of them; and how many vectors of such a group, and
#: queries to it, one task compares.
GROUP, BLOCK, QUERY_BLOCK = 32, 4096, 1024
#: Pairs whose exact cosines are taken at once.
PAIRS = 20_000


class Tree:
    """centers: a row for each node; first, count: its children; leaf: its number if it has none."""

    def __init__(self, centers, first, count, leaf):
        self.centers, self.first, self.count, self.leaf = centers, first, count, leaf

    @classmethod
    def fit(cls, x: np.ndarray, branch: int = BRANCH, size: int = LEAF, seed: int = 7) -> Tree:
        rng = np.random.default_rng(seed)
        centers, first, count, leaf, leaves = [x.mean(axis=0)], [0], [0], [-1], 0
        open_ = [(0, np.arange(len(x)))]
        while open_:
            node, rows = open_.pop(0)
            groups = cls._split(x[rows], branch, rng) if len(rows) > size else []
            if len(groups) < 2:
                leaf[node], leaves = leaves, leaves + 1
                continue
            first[node], count[node] = len(centers), len(groups)
            for c, members in groups:
                open_.append((len(centers), rows[members]))
                centers.append(c)
                first.append(0)
                count.append(0)
                leaf.append(-1)
        return cls(np.array(centers), np.array(first), np.array(count), np.array(leaf))

    @staticmethod
    def _split(x: np.ndarray, k: int, rng) -> list[tuple[np.ndarray, np.ndarray]]:
        c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
        for _ in range(12):
            at = np.argmax(x @ c.T, axis=1)
            c = np.array([x[at == j].mean(axis=0) for j in range(len(c)) if (at == j).any()])
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        at = np.argmax(x @ c.T, axis=1)
        return [(c[j], np.flatnonzero(at == j)) for j in range(len(c)) if (at == j).any()]

    def file(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        node = np.zeros(len(x), np.int64)
        while (inner := self.leaf[node] < 0).any():
            for n in np.unique(node[inner]):
                rows = np.flatnonzero(node == n)
                node[rows] = self.first[n] + np.argmax(x[rows] @ self.centers[self.first[n] : self.first[n] + self.count[n]].T, axis=1)
        return self.leaf[node]

    def visit(self, q: np.ndarray, most: int) -> list[int]:
        """The first leaves that the walk for q comes to."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            node = heapq.heappop(queue)[1]
            if self.leaf[node] >= 0:
                out.append(int(self.leaf[node]))
                continue
            a, n = self.first[node], self.count[node]
            for k, s in enumerate(self.centers[a : a + n] @ q):
                heapq.heappush(queue, (-float(s), int(a + k)))
        return out


def tame(x: np.ndarray) -> np.ndarray:
    """Rows of very large or small numbers times a power of two, which changes no cosine, so that squares stay finite and above zero."""
    e = np.frexp(np.abs(x).max(axis=1, initial=0.0))[1]
    return np.ldexp(x, np.where(np.abs(e) > 400, -e, 0)[:, None])


def unit(x: np.ndarray) -> np.ndarray:
    x = tame(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def calibrate(tree: Tree, x: np.ndarray, k: int) -> int:
    """Leaf visits that find RECALL of the k nearest within the sample."""
    rows = np.linspace(0, len(x) - 1, min(TRIALS, len(x))).astype(int)
    best = []
    for part in np.array_split(rows, max(1, len(rows) // 32)):
        s = x[part] @ x.T
        s[np.arange(len(part)), part] = -2
        best += list(np.argpartition(-s, min(k, len(x) - 1), axis=1)[:, :k])
    home, leaves = tree.file(x), int((tree.leaf >= 0).sum())
    order = [tree.visit(x[r], leaves) for r in rows]
    visits = 4
    while visits < leaves:
        found = [np.isin(home[b], o[:visits]).mean() for b, o in zip(best, order)]
        if np.mean(found) >= RECALL:
            break
        visits = min(leaves, visits + max(2, visits // 4))
    return min(visits, leaves)


def matrix(v: pd.Series) -> np.ndarray:
    return np.array(v.tolist(), np.float64)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed in the same order whatever stands around."""
    a, b = tame(a), tame(b)
    dot, aa, bb = ((x * y).sum(axis=1) for x, y in ((a, b), (a, a), (b, b)))
    return dot / (np.sqrt(aa) * np.sqrt(bb))


def compared(a: np.ndarray, b: np.ndarray, c: np.ndarray, leaf: np.ndarray, visits: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, cosine) of each query's k best vectors of the leaves that it visits, ties to the least c.

    a: queries, with the leaves of each in visits; b: vectors, with their leaves and least ids c.
    """
    s = np.full((len(a), len(b)), -3.0)
    ua, ub = unit(a), unit(b)
    for x in np.unique(leaf):
        who, here = np.flatnonzero([x in v for v in visits]), np.flatnonzero(leaf == x)
        if len(who):
            s[np.ix_(who, here)] = ua[who] @ ub[here].T
    last = np.partition(s, -min(k, len(b)), axis=1)[:, -min(k, len(b))]
    who, top = np.nonzero(s >= np.maximum(last - ROUNDING, -2)[:, None])
    del s
    out: list[tuple[np.ndarray, ...]] = []
    at = 0
    while at < len(who):
        # whole queries, PAIRS pairs at a time
        end = int(np.searchsorted(who, who[min(at + PAIRS, len(who) - 1)], side="left")) if at + PAIRS < len(who) else len(who)
        end = end if end > at else int(np.searchsorted(who, who[at], side="right"))
        w, t = who[at:end], top[at:end]
        at = end
        exact = cosine(a[w], b[t])
        order = np.lexsort((c[t], -exact, w))
        w, t, exact = w[order], t[order], exact[order]
        first = np.searchsorted(w, w, side="left")
        kept = np.arange(len(w)) - first < k
        out.append((w[kept], t[kept], exact[kept]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (who, top, np.zeros(0))


def nearest(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vec_id divisible by `every`, the k nearest other rows of vectors (vec_id, embedding).

    Ties go to the smaller vec_id. Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows
    without a vec_id. Vectors of unlike dimensions have no cosine: each dimension is searched by itself. Repeated rows of one vec_id and
    vector count once. Other columns are ignored, whatever their names; an empty table gives no rows. Equal vectors are searched once:
    each stands for its k + 1 smallest ids, as no more can be among k nearest.
    """
    spark = vectors.sparkSession
    keep = Scratch(spark)
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    rows = rows.where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0))
    out = None
    for (d,) in rows.select(F.size("embedding")).distinct().orderBy(F.size("embedding")).collect():
        got = _nearest(rows.where(F.size("embedding") == d), kind, keep, k, every)
        out = got if out is None else out.unionByName(got)
    return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double") if out is None else out


def _nearest(rows: DataFrame, kind: str, keep: Scratch, k: int, every: int) -> DataFrame:
    """nearest() among vectors (vec_id, embedding) of one dimension."""
    # zeros of either sign are one: vectors that differ in them alone are equal
    few = rows.withColumn("rn", F.dense_rank().over(W.partitionBy("embedding").orderBy("vec_id"))).where(F.col("rn") <= k + 1)
    classes = keep.save(few.groupBy("embedding").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")).withColumn("c", F.col("ids")[0]), "classes")
    some = min(MOST, max(LEAST, classes.count() // SHARE))
    x = unit(matrix(classes.select("embedding", "c").orderBy(F.xxhash64("c"), "c").limit(some).select("embedding").toPandas().embedding))
    tree = Tree.fit(x)
    visits = calibrate(tree, x, k + 1)

    def file(frames):
        for pdf in frames:
            yield pdf.assign(leaf=tree.file(unit(matrix(pdf.embedding))) if len(pdf) else [])

    def walk(frames):
        for pdf in frames:
            for a in range(0, len(pdf), 256):
                part = pdf[a : a + 256]
                rows = []
                for q, raw, v in zip(part.q, part.embedding, unit(matrix(part.embedding))):
                    at = np.array(tree.visit(v, visits))
                    rows += [(q, raw, int(g), at[at // GROUP == g]) for g in np.unique(at // GROUP)]
                yield pd.DataFrame(rows, columns=["q", "embedding", "grp", "leaves"])

    def compare(key, q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(v):
            return pd.DataFrame({"q": pd.Series([], dtype="int64"), "ids": pd.Series([], dtype=object), "score": pd.Series([], dtype="float64")})
        who, top, score = compared(matrix(q.embedding), matrix(v.embedding), v.c.to_numpy(), v.leaf.to_numpy(), [set(x) for x in q.leaves], k + 1)
        return pd.DataFrame({"q": q.q.to_numpy()[who], "ids": v.ids.to_numpy()[top], "score": score})

    index = keep.save(classes.mapInPandas(file, f"embedding {kind}, ids array<long>, c long, leaf long").withColumn("grp", F.expr(f"cast(leaf div {GROUP} as long)")), "index")
    queries = keep.save(rows.where(F.col("vec_id") % every == 0).select("vec_id", "embedding").distinct().join(classes.select("embedding", F.col("c").alias("q")), "embedding").select("vec_id", "q", "embedding"), "queries")
    visited = queries.groupBy("q").agg(F.first("embedding").alias("embedding")).mapInPandas(walk, f"q long, embedding {kind}, grp long, leaves array<long>")
    split = keep.save(visited, "visited")
    # a row for each group of leaves, 125 at most
    parts = index.groupBy("grp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nv")).join(split.groupBy("grp").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("nq")), "grp")
    # both sides have keys of the same types: groups of unlike types would not meet
    pick = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
    steps = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = split.join(F.broadcast(parts), "grp").select("grp", steps("nv").alias("vb"), pick("q", "nq").alias("qb"), "q", "embedding", "leaves")
    right = index.join(F.broadcast(parts), "grp").select("grp", pick("c", "nv").alias("vb"), steps("nq").alias("qb"), "c", "ids", "embedding", "leaf")
    keys = ["grp", "vb", "qb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "q long, ids array<long>, score double")
    best = lambda df, by, n: df.withColumn("rn", F.row_number().over(W.partitionBy(by).orderBy(F.desc("score"), "vec_id"))).where(F.col("rn") <= n)
    each = best(found.select("q", "score", F.explode("ids").alias("vec_id")), "q", k + 1).select("q", "score", "vec_id")
    near = queries.select(F.col("vec_id").alias("query_id"), "q").join(each, "q").where("vec_id <> query_id")
    return best(near, "query_id", k).select("query_id", F.col("rn").cast("int").alias("rank"), "vec_id", "score")


def op2_ann_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
