"""Near-duplicate documents by exact Jaccard similarity of word n-gram sets: a size-aware heavy-light set join.

Light sets are joined by enumerating subsets of a fixed size: two sets of n <= m elements have Jaccard >= 0.8 exactly if they share
ceil(4 (n + m) / 9) elements, so each enumerates its subsets of that size under the key (n, m, subset). Equal keys are the proof; no
set is compared. Heavy sets scan inverted lists: a set of n elements enters the lists of its floor(n / 5) + 1 rarest elements, which any
partner must share one of, and sets that meet in a list are compared in full. The size between the two is the one of least total cost,
counted from the sizes and list lengths at hand.

Most sets of a crawl can't have a partner, and are never shuffled as rows: what is sent is four bytes an element, packed by batch
and range of hashes, and what returns is how many elements of each set occur in any other set; those with fewer than 80 % are done.

Long lists are not paired out. Each list names a hub by the least hash; members are compared with the hub, then only members of
different components again, with other hubs, and the rest block against block inside tasks that return a spanning forest.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import WORDS, Scratch, components, mix, small_or_shuffled, table, texts_of

N = 5
#: Links: DEN * intersection >= NUM * union.
NUM, DEN = 80, 100
#: Light sets are at most this large, whatever the costs say: beyond it one set would enumerate thousands of subsets.
LIGHT_MOST = 20
#: Elements that a range of hashes is for, words of a batch at least and at most.
RANGE_ELEMENTS, BATCH, BATCH_MOST = 4_000_000, 300_000, 8_000_000
#: Lists are compared with a new hub, round by round, until what is left is under this many comparisons a document.
LEFT_A_DOC = 1000
ROUNDS = 6
#: Documents and elements of a block in the last, exhaustive comparison.
BLOCK_DOCS, BLOCK_ELEMENTS = 256, 200_000


def least_overlap(n: int, m: int) -> int:
    """Elements that sets of n and m elements must share at least to link."""
    return -(-NUM * (n + m) // (NUM + DEN))


def shingle_sets(texts: list[bytes], n: int = N) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the n-word shingles of each text; fewer words make one shingle, none make none."""
    out = []
    p = np.uint64(0x9E3779B97F4A7C15)
    get = WORDS.__getitem__
    for t in texts:
        words = t.lower().split()
        k = len(words)
        if not k:
            out.append(np.empty(0, np.uint64))
            continue
        w = np.array([get(x) for x in words], np.uint64)
        if k < n:
            out.append(np.array([xxhash.xxh3_64_intdigest(w.tobytes(), seed=k)], np.uint64))
            continue
        h = w[: k - n + 1].copy()
        for j in range(1, n):
            h *= p
            h += w[j : k - n + 1 + j]
        h = mix(h)
        h.sort()
        keep = np.empty(len(h), bool)
        keep[0] = True
        np.not_equal(h[1:], h[:-1], out=keep[1:])
        out.append(h[keep])
    return out


def _scatter(ranges: int, words: int):
    """Arrow batches -> for each batch a head (ids, sizes, fingerprints), and for each range of hashes four bytes an element."""

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for ids, texts in texts_of(batches, words):
            sets = shingle_sets(texts)
            p = (part << 32) + seq
            seq += 1
            n = np.array([len(s) for s in sets], np.int64)
            marks = np.array([np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) for s in sets], np.int64)
            every = np.concatenate(sets)
            doc = np.repeat(np.arange(len(ids)), n)
            r = ((every >> np.uint64(32)) % np.uint64(ranges)).astype(np.uint32)
            order = np.argsort(r, kind="stable")
            low, doc = every.astype(np.uint32)[order], doc[order]
            some, at = np.unique(r[order], return_index=True)
            rows = [(p, -1 - p, np.concatenate([np.array(ids, np.int64), n]).tobytes(), marks.tobytes(), b"")]
            for k, a, b in zip(some, at, [*at[1:], len(low)]):
                # elements of each document, or of those that have any
                which, c = np.unique(doc[a:b], return_counts=True)
                few = 2 * len(which) < len(ids)
                rows.append((p, int(k), (c if few else np.bincount(doc[a:b], minlength=len(ids))).astype(np.uint32).tobytes(), low[a:b].tobytes(), which.astype(np.uint32).tobytes() if few else b""))
                if len(rows) >= 10_000:
                    yield _rows(rows)
                    rows = []
            yield _rows(rows)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [()] * 5, (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["p", "r", "a", "b", "which"])


def _shared(pdf: pd.DataFrame) -> pd.DataFrame:
    """One range of hashes: per batch, how many elements of each document occur in any other document too. Heads pass through."""
    if pdf.r.iat[0] < 0:
        return pdf.assign(head=True)[["p", "head", "a", "b"]]
    each = [np.frombuffer(x, np.uint32) for x in pdf.b]
    every = np.sort(np.concatenate(each))
    twice = every[1:][every[1:] == every[:-1]]
    twice = twice[np.concatenate([[True], twice[1:] != twice[:-1]])] if len(twice) else twice
    out = []
    for c, h in zip(pdf.a, each):
        c = np.frombuffer(c, np.uint32)
        hit = np.zeros(len(h) + 1, np.int64)
        if len(twice):
            i = np.searchsorted(twice, h)
            i[i == len(twice)] = 0
            np.cumsum(twice[i] == h, out=hit[1:])
        end = np.cumsum(c, dtype=np.int64)
        out.append((hit[end] - hit[end - c]).astype(np.uint32).tobytes())
    return pd.DataFrame({"p": pdf.p, "head": False, "a": out, "b": pdf.which})


def _gather(pdf: pd.DataFrame) -> pd.DataFrame:
    """One batch: documents with their sizes, fingerprints and shared elements."""
    head = pdf[pdf["head"]]
    ids, n = np.frombuffer(head.a.iat[0], np.int64).reshape(2, -1)
    marks = np.frombuffer(head.b.iat[0], np.int64).reshape(-1, 2)
    shared = np.zeros(len(ids), np.int64)
    for a, which in zip(pdf.a[~pdf["head"]], pdf.b[~pdf["head"]]):
        shared[np.frombuffer(which, np.uint32) if which else slice(None)] += np.frombuffer(a, np.uint32)
    return pd.DataFrame({"doc_id": ids, "n": n, "f1": marks[:, 0], "f2": marks[:, 1], "shared": shared})


def sizes_and_shared(docs: DataFrame) -> DataFrame:
    """(doc_id, n, f1, f2, shared) of documents: the set's size, its 128-bit fingerprint, its elements that other documents have.

    Elements are told apart by 32 bits within one of the ranges: a collision can raise `shared`, never lower it. Ranges grow in number
    with the text (six bytes a word), and so do batches, which else would send each range next to nothing.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // 6 // RANGE_ELEMENTS + 1)
    sent = docs.select("doc_id", "text").mapInArrow(_scatter(ranges, min(BATCH_MOST, max(BATCH, 8 * ranges))), "p long, r long, a binary, b binary, which binary")
    return sent.groupBy("r").applyInPandas(_shared, "p long, head boolean, a binary, b binary").groupBy("p").applyInPandas(_gather, "doc_id long, n long, f1 long, f2 long, shared long")


def _sets(batches):
    for ids, texts in texts_of(batches, 100_000):
        sets = shingle_sets(texts)
        values = pa.array(np.concatenate(sets).view(np.int64))
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int32()), pa.ListArray.from_arrays(offsets, values)], names=["d", "n", "h"])


def subset_keys(n: int) -> int:
    """Keys that a light set of n elements enumerates."""
    return sum(comb(n, least_overlap(n, m)) for m in range(n, n * DEN // NUM + 1)) + sum(comb(n, least_overlap(m, n)) for m in range(-(-n * NUM // DEN), n))


def boundary(sizes: dict[int, int], list_length: float) -> int:
    """The size up to which enumerating subsets costs less in total than scanning lists of that length.

    Sets over the boundary scan, and so do light sets large enough to link with them.
    """
    def cost(x: int) -> float:
        light = sum(c * subset_keys(n) for n, c in sizes.items() if n <= x)
        return light + sum(c * (n // 5 + 1) * max(1.0, list_length) for n, c in sizes.items() if n * DEN >= NUM * (x + 1))

    return min(range(LIGHT_MOST + 1), key=lambda x: (cost(x), -x))


def _subsets(most: int):
    def run(frames):
        for pdf in frames:
            key, small, d = [], [], []
            for i, n, h in zip(pdf.d, pdf.n, pdf.h):
                h = np.asarray(h, np.int64)
                for a, b in [(n, m) for m in range(n, min(most, n * DEN // NUM) + 1)] + [(m, n) for m in range(-(-n * NUM // DEN), n)]:
                    for s in combinations(range(n), least_overlap(a, b)):
                        key.append(xxhash.xxh3_128_digest(np.array([a, b, *h[list(s)]], np.int64).tobytes()))
                        small.append(n == a)
                        d.append(i)
                        if len(key) >= 50_000:
                            yield pd.DataFrame({"key": key, "small": small, "d": d})
                            key, small, d = [], [], []
            yield pd.DataFrame({"key": key, "small": small, "d": d})

    return run


def light_edges(sets: DataFrame, most: int) -> DataFrame:
    """Edges among sets of at most `most` elements. Who holds a key of (n, m) links with every holder of size n."""
    keys = sets.where(F.col("n") <= most).select("d", "n", "h").mapInPandas(_subsets(most), "key binary, small boolean, d long")
    hub = keys.where("small").groupBy("key").agg(F.min("d").alias("hub"))
    return keys.join(hub, "key").where("d <> hub").select(F.col("hub").alias("a"), F.col("d").alias("b")).distinct()


def scan_keys(sets: DataFrame, least: int) -> DataFrame:
    """(e, d, n): each set of at least `least` elements under the rarest of its elements, as many as a partner must share one of."""
    every = sets.where(F.col("n") >= least).select("d", "n", F.explode("h").alias("e"))
    df = every.groupBy("e").agg(F.count("*").alias("df")).where("df > 1")
    w = W.partitionBy("d")
    need = F.ceil(F.col("n") * NUM / DEN)
    ranked = every.join(df, "e").select("e", "d", "n", F.row_number().over(w.orderBy("df", "e")).alias("k"), F.count("*").over(w).alias("common"))
    return ranked.where((F.col("common") >= need) & (F.col("n") - F.col("common") + F.col("k") <= F.col("n") - need + 1)).select("e", "d", "n")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sets link."""
    both = F.size(F.array_intersect("ha", "hb"))
    joined = pairs.join(sets.select(F.col("d").alias("a"), F.col("n").alias("na"), F.col("h").alias("ha")), "a").join(sets.select(F.col("d").alias("b"), F.col("n").alias("nb"), F.col("h").alias("hb")), "b")
    return joined.withColumn("i", both).where(f"{DEN} * i >= {NUM} * (na + nb - i)").select("a", "b")


def _forest(pdf: pd.DataFrame) -> pd.DataFrame:
    """Block of the left against block of the right: a spanning forest of the links between different components."""
    left, right = pdf[pdf.side == 0], pdf[pdf.side == 1]
    out: list[tuple[int, int]] = []
    if len(left) and len(right):
        lsets = [np.asarray(h, np.int64) for h in left.h]
        uni, where = np.unique(np.concatenate(lsets), return_inverse=True)
        grid = np.zeros((len(uni), len(lsets)), np.uint8)
        grid[where, np.repeat(np.arange(len(lsets)), [len(s) for s in lsets])] = 1
        ln, ld, lc = left.n.to_numpy(np.int64), left.d.to_numpy(), left.component.to_numpy()
        up = {int(c): int(c) for c in pdf.component}

        def top(c: int) -> int:
            while up[c] != c:
                up[c] = up[up[c]]
                c = up[c]
            return c

        for d, n, h, c in zip(right.d, right.n, right.h, right.component):
            h = np.asarray(h, np.int64)
            i = np.searchsorted(uni, h)
            i[i == len(uni)] = 0
            got = grid[i[uni[i] == h]].sum(axis=0, dtype=np.int64)
            for k in np.flatnonzero(DEN * got >= NUM * (ln + n - got)):
                x, y = top(int(lc[k])), top(int(c))
                if x != y:
                    up[max(x, y)] = min(x, y)
                    out.append((int(ld[k]), int(d)))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def rest_edges(lists: DataFrame, sets: DataFrame, labels: DataFrame, keep: Scratch) -> DataFrame:
    """Every link left between different components within a list: outsiders of each family of lists against all its members.

    lists: (e, d, n, component) of the lists with several components. Families are lists joined by common members; the outsiders are the
    members outside the family's largest component. Two members of that component need no comparison.
    """
    first = lists.groupBy("e").agg(F.min("d").alias("hub"))
    family = components(lists.join(first, "e").select(F.col("hub").alias("a"), F.col("d").alias("b")), keep).select(F.col("id").alias("d"), F.col("component").alias("family"))
    member = keep.save(family.join(lists.select("d", "n", "component").distinct(), "d"), "family")
    largest = member.groupBy("family", "component").agg(F.count("*").alias("c")).groupBy("family").agg(F.max(F.struct("c", "component")).component.alias("main"))
    tagged = member.join(largest, "family")
    blocks = lambda df, k: df.groupBy("family").agg(F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_ELEMENTS)).cast("int").alias(k))
    out = tagged.where("component <> main")
    shape = blocks(out, "nl").join(blocks(tagged, "nr"), "family")
    pick = lambda n, seed: F.pmod(F.xxhash64("d", F.lit(seed)), F.col(n)).cast("int")
    left = out.join(shape, "family").select("family", "d", "component", pick("nl", 1).alias("l"), F.explode(F.sequence(F.lit(0), F.col("nr") - 1)).alias("r"), F.lit(0).alias("side"))
    right = tagged.join(shape, "family").select("family", "d", "component", F.explode(F.sequence(F.lit(0), F.col("nl") - 1)).alias("l"), pick("nr", 2).alias("r"), F.lit(1).alias("side"))
    return left.unionByName(right).join(sets.select("d", "n", "h"), "d").groupBy("family", "l", "r").applyInPandas(_forest, "a long, b long")


def heavy_edges(sets: DataFrame, least: int, keep: Scratch) -> DataFrame:
    """Links among sets of at least `least` elements, enough of them to connect what is connected."""
    lists = keep.save(scan_keys(sets, least), "lists")
    docs = lists.agg(F.count_distinct("d")).first()[0]
    edges, labels = None, None
    for r in range(ROUNDS):
        now = lists.withColumn("component", F.col("d")) if labels is None else lists.join(labels.select(F.col("id").alias("d"), "component"), "d", "left").withColumn("component", F.coalesce("component", "d"))
        hub = now.groupBy("e").agg(F.min_by(F.struct("d", "n", "component"), F.xxhash64("d", F.lit(r))).alias("hub"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("e", "hub")
        # counted, so that long lists need not be sent to one task to meet theirs
        hub = keep.save(hub, "hubs")
        hub = small_or_shuffled(hub, 3 * hub.count())
        if r:
            now = keep.save(now.join(hub.select("e"), "e", "left_semi"), "open")
            per = now.groupBy("e", "component").agg(F.count("*").alias("c")).groupBy("e").agg(F.sum("c").alias("m"), F.max_by("component", "c").alias("main"))
            left = now.join(per, "e").where("component <> main").groupBy("d").agg(F.max("m").alias("m")).agg(F.sum("m")).first()[0]
            if not left:
                return edges
            if left <= LEFT_A_DOC * docs or r == ROUNDS - 1:
                return edges.unionByName(rest_edges(now, sets, labels, keep))
        pairs = now.join(hub, "e").where(f"component <> hub.component and {DEN} * least(n, hub.n) >= {NUM} * greatest(n, hub.n)").select(F.least("d", "hub.d").alias("a"), F.greatest("d", "hub.d").alias("b")).distinct()
        new = verified(pairs, sets)
        edges = keep.save(new if edges is None else edges.unionByName(new), "edges")
        labels = keep.save(components(edges, keep), "labels")
    return edges


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs (doc_id long, text string).

    component_id is the smallest doc_id reachable over links of Jaccard >= 0.8 on distinct 5-word shingles, the document itself included.
    Null and empty texts and texts of blanks have no shingles and link with nothing; texts under five words have one. Rows that share a
    doc_id get the largest of its sizes and the least of its components. A null doc_id takes no part and gets a null component. Other columns are ignored; an empty table gives none.
    """
    spark = docs.sparkSession
    keep = Scratch(spark)
    marks = keep.save(sizes_and_shared(docs.where("doc_id is not null")), "marks")
    need = F.ceil(F.col("n") * NUM / DEN)
    classes = keep.save(marks.where((F.col("n") > 0) & (F.col("shared") >= need)).groupBy("f1", "f2").agg(F.min("doc_id").alias("rep")), "classes")
    reps = classes.select(F.col("rep").alias("doc_id"))
    sets = keep.save(docs.select("doc_id", "text").join(small_or_shuffled(reps, reps.count()), "doc_id", "left_semi").mapInArrow(_sets, "d long, n int, h array<long>"), "sets")
    sizes = {n: c for n, c in sets.where(F.col("n") <= 2 * LIGHT_MOST).groupBy("n").count().collect()}
    length = sets.select(F.explode("h").alias("e")).groupBy("e").count().where("count > 1").agg(F.avg("count")).first()[0]
    most = boundary(sizes, length or 1.0)
    edges = heavy_edges(sets, -(-NUM * (most + 1) // DEN), keep)
    edges = edges.unionByName(light_edges(sets, most)) if edges is not None else light_edges(sets, most)
    labels = components(edges, keep).withColumnRenamed("id", "rep")
    linked = classes.join(labels, "rep", "left").select("f1", "f2", F.coalesce("component", "rep").alias("component"))
    each = marks.join(linked, ["f1", "f2"], "left").groupBy("doc_id").agg(F.max("n").alias("n_shingles"), F.min("component").alias("component"), F.count("*").alias("times"))
    known = each.select("doc_id", "n_shingles", F.explode(F.array_repeat(F.least("component", "doc_id"), F.col("times").cast("int"))).alias("component_id"))
    blank = docs.where("doc_id is null").select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return known.unionByName(blank)


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS c FROM g GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.c + y.c - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, node) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.node)
SELECT d.doc_id, coalesce(n.c, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(node) AS component_id FROM r GROUP BY 1) m ON m.id = d.doc_id
"""


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
