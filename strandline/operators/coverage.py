"""Operators on coverage histograms (contig, sample, depth, bases, len), contig tables and contig chunks (contig, chunk, bin)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def scaffold_coverage(cov: DataFrame, least_depth: int = 0, by: Sequence[str] = ("contig",)) -> DataFrame:
    """Mean coverage: summed depth x bases over the length, of depths from least_depth."""
    return cov.where(F.col("depth") >= least_depth).groupBy(*by).agg(F.round(F.try_divide(F.sum(F.col("depth") * F.col("bases")).cast("double"), F.max("len")), 6).alias("coverage"), F.max("len").alias("len"))


def merge_coverage(contigs: DataFrame, cov: DataFrame, samples: Sequence) -> DataFrame:
    """Contig x sample mean coverage; every contig stays, with 0 where it wasn't seen."""
    wide = scaffold_coverage(cov, by=("contig", "sample")).groupBy("contig").pivot("sample", list(samples)).agg(F.first("coverage"))
    wide = wide.select("contig", *(F.col(f"`{s}`").alias(f"s{s}") for s in samples))
    return contigs.select("contig").join(wide, "contig", "left").na.fill(0.0)


def inconsistent_lengths(cov: DataFrame) -> DataFrame:
    """Contigs reported with more than one length."""
    return cov.groupBy("contig").agg(F.count_distinct("len").alias("lengths")).where("lengths > 1")


def bin_coverage(cov: DataFrame, bins: DataFrame) -> DataFrame:
    """Length-weighted coverage of bins: each contig's length counts once. bins: contig, bin."""
    per = cov.groupBy("contig").agg(F.sum(F.col("depth") * F.col("bases")).alias("x"), F.max("len").alias("len"))
    return per.join(bins, "contig").groupBy("bin").agg(F.round(F.try_divide(F.sum("x").cast("double"), F.sum("len")), 6).alias("coverage"), F.count("*").alias("contigs"))


def bin_mean_coverage(cov: DataFrame, bins: DataFrame, least: float = 0.0) -> DataFrame:
    """Unweighted mean of the coverages of a bin's scaffolds from `least`."""
    return scaffold_coverage(cov).where(F.col("coverage") >= least).join(bins, "contig").groupBy("bin").agg(F.round(F.avg("coverage"), 6).alias("coverage"), F.count("*").alias("scaffolds"))


def multi_binned(bins: DataFrame) -> DataFrame:
    """Contigs in more than one bin."""
    return bins.groupBy("contig").agg(F.count_distinct("bin").alias("bins")).where("bins > 1")


def bin_summary(contigs: DataFrame) -> DataFrame:
    """Contigs, length and mean GC by bin, and the bin's share of all contigs."""
    per = contigs.groupBy("bin").agg(F.count("*").alias("contigs"), F.sum("len").alias("bases"), F.round(F.avg("gc"), 6).alias("gc"))
    return per.crossJoin(F.broadcast(per.agg(F.sum("contigs").alias("_n")))).withColumn("share", F.round(F.col("contigs") / F.col("_n"), 6)).drop("_n")


def majority_bins(chunks: DataFrame) -> DataFrame:
    """A contig's bin is that of more than half of its chunks, an unbinned chunk counting as one; else none, and ambiguous."""
    per = chunks.groupBy("contig", "bin").agg(F.count("*").alias("n"))
    top = per.groupBy("contig").agg(F.sum("n").alias("chunks"), F.max_by(F.struct("bin", "n"), F.struct("n", F.coalesce(F.col("bin"), F.lit(-1)))).alias("top"), F.count("*").alias("bins"))
    won = F.col("top.n") * 2 > F.col("chunks")
    return top.select("contig", "chunks", F.when(won, F.col("top.bin")).alias("bin"), (~won & (F.col("bins") > 1)).alias("ambiguous"))


def cross_bin_edges(chunks: DataFrame) -> DataFrame:
    """Pairs of bins that share contigs, and how many."""
    d = chunks.where("bin is not null").select("contig", "bin").distinct()
    bins = d.groupBy("contig").agg(F.array_sort(F.collect_set("bin")).alias("b")).where(F.size("b") > 1)
    pairs = bins.select(F.explode("b").alias("a"), "b").select("a", F.explode("b").alias("b")).where("a < b")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("contigs"))


def split_contigs(chunks: DataFrame) -> DataFrame:
    """Contigs over several bins, with the chunk numbers that are missing below the highest."""
    per = chunks.groupBy("contig").agg(F.count_distinct("bin").alias("bins"), F.array_sort(F.collect_set("chunk")).alias("seen"), F.max("chunk").alias("last")).where("bins > 1")
    missing = F.array_except(F.sequence(F.lit(1), F.col("last")), F.col("seen"))
    return per.select("contig", "bins", F.array_join(missing.cast("array<string>"), ",").alias("missing"))


def consecutive(chunks: DataFrame) -> DataFrame:
    """Whether a contig's chunks are 1..n without gap."""
    return chunks.groupBy("contig").agg((F.max("chunk") == F.count_distinct("chunk")).alias("complete"), F.count_distinct("chunk").alias("n"))


def runs(chunks: DataFrame) -> DataFrame:
    """Consecutive chunks of a contig as one piece: contig, first, last, n."""
    w = W.partitionBy("contig").orderBy("chunk")
    g = chunks.select("contig", "chunk").distinct().withColumn("island", F.col("chunk") - F.row_number().over(w))
    return g.groupBy("contig", "island").agg(F.min("chunk").alias("first"), F.max("chunk").alias("last"), F.count("*").alias("n")).drop("island")


def glue(pieces: DataFrame) -> DataFrame:
    """Consecutive pieces (contig, chunk, seq) as one sequence named contig.first-last."""
    w = W.partitionBy("contig").orderBy("chunk")
    g = pieces.withColumn("island", F.col("chunk") - F.row_number().over(w)).groupBy("contig", "island").agg(F.min("chunk").alias("a"), F.max("chunk").alias("b"), F.array_sort(F.collect_list(F.struct("chunk", "seq"))).alias("p"))
    name = F.when(F.col("a") == F.col("b"), F.concat_ws(".", "contig", F.col("a").cast("string"))).otherwise(F.concat(F.col("contig"), F.lit("."), F.col("a").cast("string"), F.lit("-"), F.col("b").cast("string")))
    return g.select(name.alias("id"), F.array_join(F.transform("p", lambda x: x["seq"]), "").alias("seq"))


def n50(lengths: DataFrame, group: str, column: str = "len", share: float = 0.5) -> DataFrame:
    """Per group: the length at which the longest sequences hold `share` of all bases (n), and how many those are (l).

    Sequences of one length are one row of the running sum, so the window holds distinct lengths only.
    """
    each = lengths.groupBy(group, column).agg(F.count("*").alias("c"))
    w = W.partitionBy(group).orderBy(F.desc(column))
    total = F.sum(F.col("c") * F.col(column)).over(W.partitionBy(group))
    cum = each.withColumn("goal", total * share).withColumn("bases", F.sum(F.col("c") * F.col(column)).over(w)).withColumn("seqs", F.sum("c").over(w))
    over = cum.where(F.col("bases") >= F.col("goal")).groupBy(group).agg(F.max_by(F.struct(column, "bases", "seqs", "c", "goal"), column).alias("x"))
    # of the sequences of that length, only as many as are needed
    spare = F.floor((F.col("x.bases") - F.col("x.goal")) / F.col(f"x.{column}"))
    return over.select(group, F.col(f"x.{column}").alias("n"), (F.col("x.seqs") - F.least(spare, F.col("x.c") - 1)).cast("long").alias("l"))


def depth_profile(intervals: DataFrame, key: str = "scaffold") -> DataFrame:
    """Pieces of constant depth from intervals [start, stop], both inclusive: key, start, stop, depth. Events, not positions."""
    events = intervals.select(key, F.least("start", "stop").alias("pos"), F.lit(1).alias("d")).unionByName(intervals.select(key, (F.greatest("start", "stop") + 1).alias("pos"), F.lit(-1).alias("d")))
    steps = events.groupBy(key, "pos").agg(F.sum("d").alias("d"))
    w = W.partitionBy(key).orderBy("pos")
    return steps.select(key, F.col("pos").alias("start"), (F.lead("pos").over(w) - 1).alias("stop"), F.sum("d").over(w).alias("depth")).where("depth > 0")


def covered_islands(intervals: DataFrame, key: str = "scaffold", least: int = 1) -> DataFrame:
    """Maximal covered stretches of at least `least` positions: key, start, stop, n intervals."""
    w = W.partitionBy(key).orderBy("lo", "hi")
    iv = intervals.select(key, F.least("start", "stop").alias("lo"), F.greatest("start", "stop").alias("hi"))
    before = F.max("hi").over(w.rowsBetween(W.unboundedPreceding, -1))
    marked = iv.withColumn("new", F.coalesce((F.col("lo") > before + 1).cast("int"), F.lit(1))).withColumn("island", F.sum("new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    out = marked.groupBy(key, "island").agg(F.min("lo").alias("start"), F.max("hi").alias("stop"), F.count("*").alias("n"))
    return out.where(F.col("stop") - F.col("start") + 1 >= least).drop("island")


def overlap_join(left: DataFrame, right: DataFrame, key: str, width: int = 64) -> DataFrame:
    """Pairs of intervals of one key that overlap, ends included. Columns of right get the prefix r_.

    Both sides are dealt to buckets of `width` positions, so a long scaffold is many groups; a pair counts in the first bucket both have.
    """
    bucket = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / width), F.floor(F.col(b) / width)))
    l = left.withColumn("_b", bucket("start", "stop"))
    r = right.select(*(F.col(c).alias(c if c == key else f"r_{c}") for c in right.columns)).withColumn("_b", bucket("r_start", "r_stop"))
    hit = l.join(r, [key, "_b"]).where("start <= r_stop and r_start <= stop")
    return hit.where(F.col("_b") == F.floor(F.greatest("start", "r_start") / width)).drop("_b")


def clip(intervals: DataFrame, lo: int, hi: int) -> DataFrame:
    """Intervals cut to a window; those outside go."""
    return intervals.where((F.col("stop") >= lo) & (F.col("start") <= hi)).withColumn("start", F.greatest("start", F.lit(lo))).withColumn("stop", F.least("stop", F.lit(hi)))


def offsets(lengths: DataFrame, group: str, order: str, column: str) -> DataFrame:
    """Where each sequence starts (from 0) when a group's are put end to end."""
    w = W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return lengths.withColumn("offset", F.coalesce(F.sum(column).over(w), F.lit(0)))


def binned_means(depths: DataFrame, key: str, width: int) -> DataFrame:
    """Mean of the covered positions in windows of `width`: key, bin, mean. depths: key, pos, depth."""
    return depths.groupBy(key, F.floor(F.col("pos") / width).alias("bin")).agg(F.round(F.avg("depth"), 6).alias("mean"), F.count("*").alias("n"))
