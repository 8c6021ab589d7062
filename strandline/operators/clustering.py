"""Greedy clusterings whose sequential order is kept, as rounds of joins and aggregates."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rounds import Rounds, followed


def families(hits: DataFrame, by: Sequence[str] = ("part",), order: Sequence[Column] | None = None, subjects: bool = True) -> DataFrame:
    """(*by, gene, family): greedy gene families, as if hits (query, subject, bitscore) were read one by one, the best first.

    A query without a family takes the subject's; if that has none either, it founds one, named after itself. subjects: whether a subject
    without a family then joins its query's. The order is by bitscore, the larger first (order: other columns, the lesser first; null
    comes last), then query, then subject.

    A gene gets its family at the first hit that it is in, whatever comes later. So the first hits, an aggregate by gene, hold all: each is
    a link to the gene whose family is taken, which had its own earlier, and families are the ends of these chains. No group meets in one
    task, and a gene of any number of hits is one row after the partial aggregates. A hit with a null gene counts for nothing.
    """
    by = list(by)
    keys = [x for c in order or [-F.col("bitscore")] for x in (c.isNull(), c)]
    rank = F.struct(*(k.alias(f"k{i}") for i, k in enumerate(keys)), F.col("query").alias("q"), F.col("subject").alias("s"))
    h = hits.where("query is not null and subject is not null").select(*by, "query", "subject", rank.alias("rank"))
    seen = h.select(*by, F.col("query").alias("gene"), "rank")
    if subjects:
        seen = seen.unionByName(h.select(*by, F.col("subject").alias("gene"), "rank"))
    rounds = Rounds(hits.sparkSession)
    first = rounds.save(seen.groupBy(*by, "gene").agg(F.min("rank").alias("rank")))
    other = F.when(F.col("gene") == F.col("rank.q"), F.col("rank.s")).otherwise(F.col("rank.q"))
    mine = first.select(F.struct(*by, "gene").alias("node"), F.struct(*by, other.alias("gene")).alias("to"), "rank")
    theirs = first.select(F.struct(*by, "gene").alias("at"), F.col("rank").alias("before"))
    # the other has its family by then, or gets it at this very hit from its query, or (as no query's subject) has none
    found = mine.join(theirs, F.col("to") == F.col("at"), "left")
    own = F.struct(*(F.col(f"node.{b}").alias(b) for b in by), F.col("rank.q").alias("gene"))
    to = F.when(F.col("before") < F.col("rank"), F.col("to")).otherwise(own)
    ends = followed(found.select("node", to.alias("to")), rounds)
    return ends.select(*(F.col(f"node.{b}").alias(b) for b in by), F.col("node.gene").alias("gene"), F.col("to.gene").alias("family"))


def minimizers(seq: str, k: int, window: int) -> np.ndarray:
    """Distinct least hashes of each `window` neighbouring k-mers; a shorter sequence is one k-mer."""
    codes = np.frombuffer(seq.encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = max(1, len(codes) - k + 1)
    h = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
    for i in range(min(k, len(codes))):
        h = (h ^ codes[i : i + n]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    if n > window:
        h = np.lib.stride_tricks.sliding_window_view(h, window).min(axis=1)
    return np.unique(h).view(np.int64)


def _marks(k: int, window: int):
    def run(batches):
        for b in batches:
            marks = [minimizers(s, k, window) for s in b.column("seq").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("rank"), pa.array(marks, pa.list_(pa.int64()))], names=["rank", "marks"])

    return run


def _differ(a: str, b: str, identity: float) -> Column:
    """Whether two sequences are too far apart: more edits than the identity leaves the longer one."""
    most = f"cast(floor((1 - {identity}D) * greatest(length({a}), length({b})) + 1e-9D) as int)"
    return F.expr(f"levenshtein({a}, {b}, {most}) < 0")


def centroids(seqs: DataFrame, identity: float, k: int = 6, window: int = 5, first: int = 64) -> DataFrame:
    """seqs (grp, id, seq) with centroid (an id): greedy clusters within each grp, the longest sequences first, ties by id.

    As if sequences were read one by one: one that is near no centroid so far becomes one, any other belongs to the first centroid that it
    is near to. Near are two that share a minimizer (`window` neighbouring k-mers) and whose edit distance is at most (1 - identity) times the
    longer length. Equal sequences of a group are clustered as one, under the least id. Null sequences are empty, null groups one group.

    Of each minimizer, the first sequences still open are compared, `first` of them, twice as many each round. One that is among them for all
    of its minimizers and near no open one before it is a centroid; those near it are settled. The first open sequence always is one, so rounds
    end. Comparisons are those of the sequential reading between sequences of one minimizer; no pair of others is formed.
    """
    rounds = Rounds(seqs.sparkSession)
    given = seqs.withColumn("seq", F.coalesce("seq", F.lit("")))
    one = given.groupBy("grp", "seq").agg(F.min("id").alias("id"))
    # a rank that orders as the reading does and is one value; distinct, as (grp, id, seq) is
    one = rounds.save(one.select(F.struct((-F.length("seq")).alias("l"), "id", F.xxhash64("grp", "seq").alias("h"), "grp").alias("rank"), "seq"))
    shape = one.select("rank", F.array(F.lit(0).cast("long")).alias("marks")).schema
    marks = one.mapInArrow(_marks(k, window), shape).select("rank", F.explode("marks").alias("m"))
    marks = rounds.save(marks.select("rank", F.xxhash64("rank.grp", "m").alias("mark")))
    text = lambda side: one.select(F.col("rank").alias(side), F.col("seq").alias(f"{side}_seq"))

    def near(pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b) of ranks those that are near."""
        return pairs.distinct().join(text("a"), "a").join(text("b"), "b").where(~_differ("a_seq", "b_seq", identity)).select("a", "b")

    open_, found, some = marks, None, first
    left = marks.count()
    while left:
        place = F.row_number().over(Window.partitionBy("mark").orderBy("rank"))
        ahead = rounds.save(open_.withColumn("place", place).where(F.col("place") <= some).drop("place"))
        total = open_.groupBy("rank").agg(F.count("*").alias("n"))
        whole = rounds.save(ahead.groupBy("rank").agg(F.count("*").alias("seen")).join(total, "rank").where("seen = n").select("rank"))
        earlier = ahead.select("mark", F.col("rank").alias("a")).join(ahead.join(whole, "rank").select("mark", F.col("rank").alias("b")), "mark").where("a < b").select("a", "b")
        blocked = near(earlier).select(F.col("b").alias("rank")).distinct()
        new = rounds.save(whole.join(blocked, "rank", "left_anti"))
        found = new if found is None else rounds.save(found.unionByName(new))
        reach = open_.join(new, "rank").select("mark", F.col("rank").alias("a")).join(open_.select("mark", F.col("rank").alias("b")), "mark").where("a < b").select("a", "b")
        settled = near(reach).select(F.col("b").alias("rank")).unionByName(new).distinct()
        was = open_
        open_, seen = rounds.counted(open_.join(settled, "rank", "left_anti"), rows=F.count("*"))
        if was is not marks:
            rounds.drop(was)
        left, some = seen["rows"], some * 2
    if found is None:
        return given.withColumn("centroid", F.col("id"))
    reps = marks.join(found, "rank")
    rest = marks.join(found, "rank", "left_anti")
    pairs = reps.select("mark", F.col("rank").alias("a")).join(rest.select("mark", F.col("rank").alias("b")), "mark").where("a < b").select("a", "b")
    member = near(pairs).groupBy("b").agg(F.min("a").alias("a")).select(F.col("b").alias("rank"), F.col("a.id").alias("centroid"))
    member = member.unionByName(found.select("rank", F.col("rank.id").alias("centroid")))
    of = one.join(member, "rank").select(F.col("rank.grp").alias("of_grp"), F.col("seq").alias("of_seq"), "centroid")
    return given.join(of, F.col("grp").eqNullSafe(F.col("of_grp")) & (F.col("seq") == F.col("of_seq"))).drop("of_grp", "of_seq")


def iterated(seqs: DataFrame, identities: Sequence[float], least: int, **how) -> DataFrame:
    """(id, seq, level, cluster) of seqs (id, seq): clusters at the first identity; those of at least `least` sequences are clustered
    again, each by itself, at the next identity, and so on. A row for each level that a sequence reaches; a cluster is the ids of its
    centroids from the first level on, joined by "/".

    It ends when identities are used up, no cluster is large enough, or none came apart at a level: then nothing would at the same identity.
    """
    rounds = Rounds(seqs.sparkSession)
    now, out = seqs.select(F.lit("").alias("grp"), F.col("id").cast("string").alias("id"), "seq"), []
    was = None
    for level, identity in enumerate(identities):
        got = centroids(now, identity, **how).withColumn("cluster", F.concat_ws("/", F.when(F.col("grp") != "", F.col("grp")), "centroid"))
        got = rounds.save(got.select("id", "seq", F.lit(level).alias("level"), "grp", "cluster"))
        out.append(got)
        sizes = rounds.save(got.groupBy("grp", "cluster").agg(F.count("*").alias("n")))
        large = sizes.where(F.col("n") >= least)
        apart = sizes.groupBy("grp").count().where("count > 1")
        if large.isEmpty() or (identity == was and apart.isEmpty()):
            break
        was = identity
        now = got.join(large.select("cluster"), "cluster").select(F.col("cluster").alias("grp"), "id", "seq")
    rows = out[0]
    for more in out[1:]:
        rows = rows.unionByName(more)
    return rows.drop("grp")
