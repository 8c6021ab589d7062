"""Operators on sample x OTU counts in long form (sample, otu, count); zeros are absent rows. Wide forms exist at sinks only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def nonzero(m: DataFrame) -> DataFrame:
    return m.where(F.col("count") > 0)


def sample_sizes(m: DataFrame) -> DataFrame:
    return m.groupBy("sample").agg(F.sum("count").alias("size"))


def picked(m: DataFrame, keys: DataFrame, on: str, remove: bool = False) -> DataFrame:
    """Rows of the named samples or OTUs, or all others."""
    return m.join(keys.select(on).distinct(), on, "left_anti" if remove else "left_semi")


def large_samples(m: DataFrame, least: int) -> DataFrame:
    return m.join(sample_sizes(m).where(F.col("size") >= least).select("sample"), "sample", "left_semi")


def abundance_floor(m: DataFrame, cutoff: float) -> DataFrame:
    """Counts under size / cutoff of their sample become zero (absent)."""
    size = F.sum("count").over(W.partitionBy("sample"))
    return m.withColumn("_s", size).where(F.col("count") >= F.col("_s") / cutoff).drop("_s")


def removed_by_floor(m: DataFrame, cutoff: float) -> DataFrame:
    """What abundance_floor takes from each sample: reads, OTUs, the largest count."""
    size = F.sum("count").over(W.partitionBy("sample"))
    return m.withColumn("_s", size).where(F.col("count") < F.col("_s") / cutoff).groupBy("sample").agg(F.sum("count").alias("reads"), F.count("*").alias("otus"), F.max("count").alias("largest"))


def merged(m: DataFrame, groups: DataFrame) -> DataFrame:
    """OTUs added up under the leader of their group (groups: otu, leader); others stay."""
    return m.join(groups.select("otu", "leader"), "otu", "left").groupBy("sample", F.coalesce("leader", "otu").alias("otu")).agg(F.sum("count").alias("count"))


def jaccard_pairs(m: DataFrame) -> DataFrame:
    """Presence Jaccard of every two samples that share an OTU: a, b, shared, jaccard. Pairs without one are no rows.

    A pair costs the OTUs it shares; samples are few, whatever the number of reads.
    """
    p = nonzero(m).select("sample", "otu").distinct()
    n = p.groupBy("sample").agg(F.count("*").alias("n"))
    both = p.withColumnRenamed("sample", "a").join(p.withColumnRenamed("sample", "b"), "otu").where("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))
    j = both.join(n.select(F.col("sample").alias("a"), F.col("n").alias("na")), "a").join(n.select(F.col("sample").alias("b"), F.col("n").alias("nb")), "b")
    return j.select("a", "b", "shared", F.round(F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared")), 6).alias("jaccard"))


def jaccard_by_group(m: DataFrame, groups: DataFrame) -> DataFrame:
    """Mean Jaccard of a group's sample pairs (groups: sample, grp; a sample may be in several). Disjoint pairs don't count."""
    g = groups.select("sample", "grp").distinct()
    pairs = jaccard_pairs(m).join(g.withColumnRenamed("sample", "a"), "a").join(g.withColumnRenamed("sample", "b"), ["b", "grp"])
    return pairs.groupBy("grp").agg(F.round(F.avg("jaccard"), 6).alias("mean"), F.count("*").alias("pairs"))


def single_sample_otus(m: DataFrame) -> DataFrame:
    """OTUs of exactly one sample: otu, sample, count."""
    return nonzero(m).groupBy("otu").agg(F.count_distinct("sample").alias("n"), F.min("sample").alias("sample"), F.sum("count").alias("count")).where("n = 1").drop("n")


def accessions(m: DataFrame, prefix: str, known: DataFrame | None = None, width: int = 0) -> DataFrame:
    """otu -> accession: known ones (otu, accession) stay, the others are numbered by falling total, ties by name."""
    from ..plans.hits import ranked_globally

    total = m.groupBy("otu").agg(F.sum("count").alias("total"))
    new = total if known is None else total.join(known.select("otu"), "otu", "left_anti")
    n = F.col("place").cast("string")
    named = ranked_globally(new, [F.desc("total"), "otu"]).select("otu", F.concat(F.lit(prefix), F.lpad(n, width, "0") if width else n).alias("accession"))
    return named if known is None else named.unionByName(total.join(known.select("otu", "accession"), "otu").select("otu", "accession"))


def prevalence(m: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Per sample the OTUs with at least `least` reads; per OTU the samples."""
    hit = m.where(F.col("count") >= least)
    return hit.groupBy("sample").agg(F.count("*").alias("otus")), hit.groupBy("otu").agg(F.count("*").alias("samples"))


def median_normalised(m: DataFrame, most: float = 50.0, scale_up_deep: bool = False) -> DataFrame:
    """Counts scaled to the median sample size, at least 1; left raw where the factor is over `most`. scale_up_deep: the inverse factor."""
    size = sample_sizes(m)
    j = m.join(size, "sample").crossJoin(F.broadcast(size.agg(F.median("size").alias("med"))))
    f = F.col("size") / F.col("med") if scale_up_deep else F.col("med") / F.col("size")
    return j.select("sample", "otu", F.when(f > most, F.col("count")).otherwise(F.greatest(F.lit(1), F.floor(F.col("count") * f))).cast("long").alias("count"))


def relative(m: DataFrame) -> DataFrame:
    return m.withColumn("share", F.col("count") / F.sum("count").over(W.partitionBy("sample")))


def abundant_otus(m: DataFrame, least: float) -> DataFrame:
    """OTUs with a relative abundance of `least` in any sample, with the largest."""
    return relative(m).groupBy("otu").agg(F.round(F.max("share"), 6).alias("most")).where(F.col("most") >= least)


def spread(m: DataFrame) -> DataFrame:
    """Median and quartiles of each sample's counts."""
    return m.groupBy("sample").agg(*(F.round(F.percentile("count", F.lit(p)), 6).alias(n) for p, n in ((0.25, "q1"), (0.5, "med"), (0.75, "q3"))))


def stage_track(stages: DataFrame, order: str) -> DataFrame:
    """Reads by stage in order, the loss to the next in percent of the first: stage, reads, otus, lost, pct."""
    w = W.orderBy(order)  # stages are few: one row each
    n = stages.groupBy(order).agg(F.sum("count").alias("reads"), F.count_distinct("otu").alias("otus"))
    lost = F.coalesce(F.col("reads") - F.lead("reads").over(w), F.lit(0))
    return n.select(order, "reads", "otus", lost.alias("lost"), F.round(100.0 * F.abs(lost) / F.first("reads").over(w), 6).alias("pct"))


def longest_prefix(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """Each a with the longest b it starts with. Prefixes of a are exploded and joined on equality, so no pair is tried in vain."""
    p = left.select(a).distinct().select(a, F.explode(F.transform(F.sequence(F.lit(1), F.length(a)), lambda n: F.left(F.col(a), n))).alias(b))
    hit = p.join(right.select(b).distinct(), b)
    return hit.groupBy(a).agg(F.max_by(b, F.length(b)).alias(b))


def wide(m: DataFrame, otus: list[str]) -> DataFrame:
    """The sink form: one row a sample, one column an OTU."""
    return m.groupBy("sample").pivot("otu", otus).agg(F.sum("count")).na.fill(0)


def long(df: DataFrame, ids: list[str], otus: list[str]) -> DataFrame:
    """A wide table as (ids..., otu, count) without zeros."""
    return nonzero(df.unpivot(ids, otus, "otu", "count"))
