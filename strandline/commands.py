"""Sub-commands over files: each reads its inputs, applies one operator, and gives a table, or records if it has id and seq."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as t
from .operators import coverage, hits, sequences
from .sources import files, formats, sinks

COMMANDS: dict[str, Callable] = {}


def command(f: Callable) -> Callable:
    """Register f(spark, paths, size) under its name, underscores as dashes; its docstring is the help."""
    COMMANDS[f.__name__.replace("_", "-")] = f
    return f


def records(spark: SparkSession, paths: list[str]) -> DataFrame:
    return formats.sequences(spark, paths)


@command
def count(spark: SparkSession, paths: list[str], size: int) -> DataFrame:
    """Records of each FASTA or FASTQ file."""
    return records(spark, paths).groupBy("file").agg(F.count("*").alias("records"))


@command
def lengths(spark: SparkSession, paths: list[str], size: int) -> DataFrame:
    """Length and GC of every sequence of at least SIZE."""
    return sequences.length_gc(records(spark, paths), size)


@command
def n50(spark: SparkSession, paths: list[str], size: int) -> DataFrame:
    """N50 and L50 of each file."""
    return coverage.n50(records(spark, paths).select("file", F.length("seq").cast("long").alias("len")), "file")


@command
def revcomp(spark: SparkSession, paths: list[str], size: int) -> DataFrame:
    """Reverse complements."""
    return records(spark, paths).select("id", t.reverse_complement(F.col("seq")).alias("seq"))


@command
def chop(spark: SparkSession, paths: list[str], size: int) -> DataFrame:
    """Pieces of SIZE, the last taking the rest."""
    return sequences.chop(records(spark, paths), max(1, size)).select(F.concat_ws(".", "id", F.col("piece").cast("string")).alias("id"), "seq")


@command
def dereplicate(spark: SparkSession, paths: list[str], size: int) -> DataFrame:
    """Distinct sequences under their first record's id, with their number."""
    first = F.min_by("id", F.struct("file", "ord"))
    return records(spark, paths).groupBy("seq").agg(first.alias("id"), F.count("*").alias("size")).select(F.concat("id", F.lit(";size="), F.col("size").cast("string")).alias("id"), "seq")


@command
def to_fasta(spark: SparkSession, paths: list[str], size: int) -> DataFrame:
    """FASTQ as FASTA."""
    return sinks.fastq_to_fasta(files.read(spark, paths, "fastq"))


@command
def concat(spark: SparkSession, paths: list[str], size: int) -> DataFrame:
    """The lines of all files, in the order of the files given."""
    place = F.array_position(F.array(*(F.lit(p) for p in paths)), F.col("file"))
    return files.read(spark, paths).withColumn("place", place).orderBy("place", "file", "ord").select("value")


@command
def scaffold_coverage(spark: SparkSession, paths: list[str], size: int) -> DataFrame:
    """Mean coverage of each contig of coverage histograms, of depths from SIZE."""
    return coverage.scaffold_coverage(formats.genome_coverage(spark, paths), size)


@command
def top_hits(spark: SparkSession, paths: list[str], size: int) -> DataFrame:
    """The first SIZE hits of each query of tabular hits."""
    return hits.top_k(formats.blast_ordered(spark, paths), "query", ["file", "ord"], max(1, size)).drop("file", "ord")


def run(spark: SparkSession, name: str, paths: list[str], size: int, out: str | None = None) -> DataFrame:
    """The result of a sub-command, written to the folder `out` if there is one: FASTA, plain lines or a table with six digits."""
    df = COMMANDS[name](spark, paths, size)
    if out and df.columns == ["id", "seq"]:
        sinks.write_fasta(df, out)
    elif out and df.columns == ["value"]:
        df.write.text(out)
    elif out:
        sinks.write_fixed(df, out)
    return df
