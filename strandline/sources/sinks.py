"""Writers. Each formats one row a record in JVM expressions and leaves the files to Spark's text writer."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import wrap_lines
from . import files


def fasta_text(width: int | None = None) -> Column:
    seq = wrap_lines(F.col("seq"), width) if width else F.col("seq")
    return F.concat(F.lit(">"), F.concat_ws(" ", "id", F.nullif("descr", F.lit(""))), F.lit("\n"), seq)


def write_fasta(df: DataFrame, path: str, width: int | None = None, by: str | None = None, mode: str = "error") -> None:
    """id, seq and perhaps descr; by: one folder for each value of a column."""
    d = df if "descr" in df.columns else df.withColumn("descr", F.lit(None).cast("string"))
    out = d.select(fasta_text(width).alias("value"), *([by] if by else []))
    w = out.write.mode(mode)
    (w.partitionBy(by) if by else w).text(path)


def write_fastq(df: DataFrame, path: str, mode: str = "error") -> None:
    df.select(F.concat(F.lit("@"), "header", F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value")).write.mode(mode).text(path)


def write_bam(df: DataFrame, path: str, contigs: list[tuple[str, int]], mode: str = "append") -> None:
    """Alignments (read, flag, contig, pos, mapq, cigar, seq, qual) in block-compressed files, each with the contigs (name, length)."""
    df.sparkSession.dataSource.register(files.RecordSource)
    rows = df.select("read", "flag", "contig", "pos", "mapq", "cigar", "seq", "qual")
    rows.write.format("records").options(kind="bam", contigs=json.dumps(contigs)).mode(mode).save(path)


def fastq_to_fasta(reads: DataFrame) -> DataFrame:
    return reads.select(F.col("header").alias("id"), "seq")


def write_fixed(df: DataFrame, path: str, digits: int = 6, mode: str = "error") -> None:
    """TSV with doubles of so many digits."""
    cols = [F.format_string(f"%.{digits}f", c).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    df.select(*cols).write.mode(mode).csv(path, sep="\t", header=True)


def write_shared(m: DataFrame, path: str, otus: list[str], label: str = "0.03", mode: str = "error") -> None:
    """(sample, otu, count) as a wide shared table."""
    wide = m.groupBy("sample").pivot("otu", otus).agg(F.sum("count")).na.fill(0)
    wide.select(F.lit(label).alias("label"), F.col("sample").alias("Group"), F.lit(len(otus)).alias("numOtus"), *(F.col(f"`{o}`") for o in otus)).write.mode(mode).csv(path, sep="\t", header=True)


def feature_table(features: DataFrame, contigs: DataFrame, least: int = 200, short: int = 300) -> DataFrame:
    """NCBI feature table, one row a feature: scaffold, start, value. Ends at a contig's edge are partial if the feature is short.

    features: scaffold, locus, start, stop, strand (+ or -), type, product; contigs: scaffold, len.
    """
    n = F.abs(F.col("start") - F.col("stop")) + 1
    f = features.where(n >= least).join(contigs, "scaffold")
    head = F.when((F.col("start") == 1) & (n <= short), "<").otherwise("")
    tail = F.when((F.col("stop") == F.col("len")) & (n <= short), ">").otherwise("")
    a, b = F.concat(head, F.col("start").cast("string")), F.concat(tail, F.col("stop").cast("string"))
    back = F.col("strand") == "-"
    first = F.concat_ws("\t", F.when(back, b).otherwise(a), F.when(back, a).otherwise(b), "type")
    return f.select("scaffold", "start", F.concat(first, F.lit("\n\t\t\tlocus_tag\t"), F.col("locus").cast("string"), F.lit("\n\t\t\tproduct\t"), F.coalesce("product", F.lit("hypothetical protein"))).alias("value"))


def write_graph(nodes: DataFrame, edges: DataFrame, path: str, mode: str = "error") -> None:
    """Nodes and relations of a property graph, a folder for each label."""
    nodes.write.mode(mode).partitionBy("label").csv(f"{path}/nodes", sep="\t")
    edges.write.mode(mode).partitionBy("relation").csv(f"{path}/rel", sep="\t")


def write_esom(vectors: DataFrame, path: str, mode: str = "error") -> None:
    """(num, window, contig, class, freqs array) as .lrn, .names and .cls bodies that share num."""
    vectors.select("num", F.array_join(F.transform("freqs", lambda x: F.format_string("%.6f", x)), "\t").alias("v")).select(F.concat_ws("\t", F.col("num").cast("string"), "v").alias("value")).write.mode(mode).text(f"{path}/lrn")
    vectors.select("num", "window", "contig").write.mode(mode).csv(f"{path}/names", sep="\t")
    vectors.select("num", "class").write.mode(mode).csv(f"{path}/cls", sep="\t")


def write_by_key(df: DataFrame, path: str, key: str, mode: str = "error") -> None:
    """One folder for each value of key; rows are first brought together by key, so that each has few files."""
    df.repartition(key).write.mode(mode).partitionBy(key).parquet(path)
