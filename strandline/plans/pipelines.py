"""Compositions of operators: the steps of a metagenome's way from reads to bins, around the external programs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import coverage, hits, sequences
from ..sources import files, formats


def prep(names: DataFrame) -> DataFrame:
    """Raw files in the order they are put together: sample, dir, files (array), reading order run, lane, number."""
    parts = formats.raw_names(names).where("sample is not null")
    key = F.struct(F.coalesce("run", F.lit("")).alias("run"), "lane", "fnum", "name")
    return parts.groupBy("sample", "dir").agg(F.transform(F.array_sort(F.collect_list(key)), lambda x: x["name"]).alias("files"))


def read_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Records of each file, FASTA or FASTQ by its first byte: file, reads."""
    out = None
    for kind in ("fasta", "fastq"):
        some = [p for p in paths if files.sniff(p) == kind]
        if some:
            n = files.read(spark, some, kind).groupBy("file").agg(F.count("*").alias("reads"))
            out = n if out is None else out.unionByName(n)
    return out if out is not None else spark.createDataFrame([], "file string, reads long")


def quality_control(pairs: DataFrame, least: int) -> DataFrame:
    """Read pairs (pair, fwd, rev with seq and qual) without duplicates, the best of equals, both mates long enough."""
    score = F.aggregate(F.array("fwd.qual", "rev.qual"), F.lit(0.0), lambda a, q: a + F.aggregate(F.transform(F.filter(F.split(q, ""), lambda c: c != ""), F.ascii), F.lit(0), lambda b, x: b + x) / F.greatest(F.length(q), F.lit(1)))
    scored = pairs.withColumn("score", score).withColumn("a", F.col("fwd.seq")).withColumn("b", F.col("rev.seq"))
    best = sequences.dereplicate_pairs(scored, ["a", "b"], "score", "pair")
    return best.where((F.length("a") >= least) & (F.length("b") >= least)).drop("score", "a", "b")


def trimmed(reads: DataFrame, quality: float, ambiguous: int) -> DataFrame:
    """Reads (pair, mate 0 or 1, seq, qual) of at least a mean quality, and with at most so many N."""
    n = F.length("seq") - F.length(F.replace("seq", F.lit("N"), F.lit("")))
    return reads.where((F.coalesce(t.mean_phred(F.col("qual")), F.lit(0.0)) >= quality) & (n <= ambiguous))


def repaired(reads: DataFrame) -> DataFrame:
    """Reads as pairs again: pair, fwd, rev, each with seq and qual. A mate that was dropped is an N of quality 0."""
    side = lambda m, c: reads.where(F.col("mate") == m).select("pair", F.struct("seq", "qual").alias(c))
    filler = F.struct(F.lit("N").alias("seq"), F.lit("!").alias("qual"))
    return side(0, "fwd").join(side(1, "rev"), "pair", "full").select("pair", F.coalesce("fwd", filler).alias("fwd"), F.coalesce("rev", filler).alias("rev"))


def quality_steps(reads: DataFrame, least: int, quality: float, ambiguous: int) -> tuple[DataFrame, DataFrame]:
    """Of reads (pair, mate, seq, qual): pairs that are distinct, good and long enough, and how many reads each step leaves (step, reads)."""
    pairs = quality_control(repaired(reads), 1)
    mates = pairs.select("pair", F.lit(0).alias("mate"), "fwd.seq", "fwd.qual").unionByName(pairs.select("pair", F.lit(1).alias("mate"), "rev.seq", "rev.qual")).where("seq <> 'N'")
    good = trimmed(mates, quality, ambiguous)
    long = good.where(F.length("seq") >= least)
    count = lambda name, df: df.agg(F.count("*").alias("reads")).select(F.lit(name).alias("step"), "reads")
    steps = count("raw", reads).unionByName(count("distinct", mates)).unionByName(count("good", good)).unionByName(count("long", long))
    return repaired(long), steps


def assembly_report(contigs: DataFrame, blast: DataFrame, k: int = 5) -> DataFrame:
    """The first k hits of each contig with the stretch of it that they align: query, subject, rank, start, stop, seq. contigs: id, seq;
    blast: query, subject, qstart, qend and ord."""
    w = W.partitionBy("query").orderBy("ord")
    top = blast.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(F.col("query").alias("id"), "subject", "rank", F.col("qstart").alias("start"), F.col("qend").alias("stop"))
    cut = sequences.subsequences(contigs, top.select("id", "start", "stop").distinct())
    return top.join(cut, ["id", "start", "stop"]).select(F.col("id").alias("query"), "subject", "rank", "start", "stop", "seq")


def taxonomic_summary(blast: DataFrame, evalue: float, names: DataFrame) -> DataFrame:
    """Contigs' first hits under an e-value, counted by subject with its name (names: subject, name)."""
    first = hits.first_of(blast.where(F.col("evalue") <= evalue), "query", ["ord"])
    n = first.groupBy("subject").agg(F.count("*").alias("contigs"))
    return n.join(names, "subject", "left").select("subject", F.coalesce("name", "subject").alias("name"), "contigs")


def mapping(contigs: DataFrame, histogram: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Contigs (id, seq) chopped for mapping, and each piece's mean coverage from its histogram."""
    return sequences.chop(contigs, size), coverage.scaffold_coverage(histogram)


def binning(contigs: DataFrame, chunks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From chunk bins to contig bins: (bin, id, seq) of binned contigs, ambiguous contigs, edges between bins. contigs: id, seq."""
    votes = coverage.majority_bins(chunks)
    binned = contigs.join(votes.where("bin is not null").select(F.col("contig").alias("id"), "bin"), "id").select("bin", "id", "seq")
    return binned, votes.where("ambiguous").select("contig", "chunks"), coverage.cross_bin_edges(chunks)


def cluster_genes(clusters: DataFrame, genes: DataFrame) -> DataFrame:
    """Genes within each cluster: overlaps on a scaffold, with the first product of each gene."""
    once = hits.first_of(genes, "gene", ["scaffold", "start"])
    return coverage.overlap_join(clusters, once, "scaffold")


def quality_changes(marks: DataFrame) -> DataFrame:
    """(path, prefix, test, infix, mark) before and after: tests whose mark changed, or that were not reported twice."""
    m = marks.groupBy("path", "prefix", "test").agg(F.count("*").alias("n"), F.max(F.when(F.col("infix") == "before", F.col("mark"))).alias("before"), F.max(F.when(F.col("infix") == "after", F.col("mark"))).alias("after"))
    return m.where((F.col("n") != 2) | (F.col("before") != F.col("after")))
