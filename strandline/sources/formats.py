"""Readers of domain formats. All give long, typed DataFrames; text without order goes through Spark's own readers."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import quality_string
from ..operators.annotation import attribute_map
from . import files

BLAST = "query string, subject string, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, evalue double, bitscore double"
GFF = "seqid string, source string, type string, start int, stop int, score string, strand string, phase string, attributes string"
#: Places (bytes; virtual offsets in block-compressed files) of a file that are numbered together.
BLOCK = 1 << 20
COVERAGE = "Contig string, Depth int, bases_with_depth long, contigLen long, fraction_bases_with_depth double"


def fasta(spark: SparkSession, path) -> DataFrame:
    return files.read(spark, path, "fasta")


def fastq(spark: SparkSession, path, mode: str = "FAILFAST") -> DataFrame:
    return files.read(spark, path, "fastq", mode=mode)


def sequences(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """FASTA or FASTQ by the first byte; all paths must agree. Files that hold nothing, as a task without rows writes, are of either."""
    kinds = {files.sniff(p) for p in paths} - {None}
    if len(kinds) > 1:
        raise ValueError("the inputs are of different formats")
    return files.read(spark, list(paths), kinds.pop() if kinds else "fasta")


def interleaved_pairs(records: DataFrame) -> DataFrame:
    """Records of interleaved files as pairs: file, pair, fwd and rev (structs).

    They are numbered within blocks of BLOCK places, and shifted by how many stand in the blocks before: a file is no one task's.
    """
    n = records.withColumn("_b", F.expr(f"ord div {BLOCK}L"))
    before = F.sum("_n").over(W.partitionBy("file").orderBy("_b").rowsBetween(W.unboundedPreceding, -1))
    sizes = n.groupBy("file", "_b").agg(F.count("*").alias("_n")).select("file", "_b", F.coalesce(before, F.lit(0)).alias("_before"))
    n = n.withColumn("_k", F.row_number().over(W.partitionBy("file", "_b").orderBy("ord")) - 1).join(sizes, ["file", "_b"])
    n = n.withColumn("_k", F.col("_k") + F.col("_before")).drop("_b", "_before")
    cols = F.struct(*(c for c in records.columns if c not in ("file", "ord")))
    return n.groupBy("file", F.expr("_k div 2").alias("pair")).agg(F.max(F.when(F.col("_k") % 2 == 0, cols)).alias("fwd"), F.max(F.when(F.col("_k") % 2 == 1, cols)).alias("rev"))


def fasta_with_quality(spark: SparkSession, fasta_path, qual_path) -> DataFrame:
    """FASTA joined with its QUAL file by id: id, seq, qual (phred + 33). QUAL values keep their blanks, so it is read by lines."""
    lines = files.read(spark, qual_path, "lines")
    w = W.partitionBy("file").orderBy("ord")
    tagged = lines.withColumn("id", F.last(F.when(F.col("value").startswith(">"), F.regexp_extract("value", r"^>(\S*)", 1)), ignorenulls=True).over(w)).where(~F.col("value").startswith(">"))
    qual = tagged.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "value"))), lambda x: x["value"]), " ").alias("values"))
    return fasta(spark, fasta_path).join(qual, "id").select("id", "seq", quality_string(F.col("values")).alias("qual"))


def blast(spark: SparkSession, path, extra: str = "") -> DataFrame:
    """Tabular hits, with or without comment lines; extra: further columns, such as "qcovs double"."""
    return spark.read.csv(path, sep="\t", comment="#", schema=BLAST + (f", {extra}" if extra else ""))


def blast_ordered(spark: SparkSession, path) -> DataFrame:
    """Tabular hits with their place in the file, for operators that follow its order."""
    names = [c.split() for c in BLAST.split(", ")]
    c = F.split("value", "\t")
    return files.read(spark, path).where(~F.col("value").startswith("#") & (F.col("value") != "")).select("file", "ord", *(c[i].try_cast(t).alias(n) for i, (n, t) in enumerate(names)))


def _xml(spark: SparkSession, tag: str):
    """Malformed files, such as several documents one after the other, are errors: otherwise the rows after the first root would be lost unsaid."""
    return spark.read.format("xml").option("rowTag", tag).option("mode", "FAILFAST")


def blast_xml(spark: SparkSession, path, least_score: float = 0.0) -> DataFrame:
    """query, hit, pident, evalue, score of every HSP from a score on."""
    d = _xml(spark, "Iteration").schema(
        "`Iteration_query-def` string, Iteration_hits struct<Hit: array<struct<Hit_def: string, Hit_hsps: struct<Hsp: array<struct<`Hsp_bit-score`: double, Hsp_evalue: double, Hsp_identity: int, `Hsp_align-len`: int>>>>>>").load(path)
    h = d.select(F.col("`Iteration_query-def`").alias("query"), F.explode("Iteration_hits.Hit").alias("h")).select("query", F.col("h.Hit_def").alias("hit"), F.explode("h.Hit_hsps.Hsp").alias("p"))
    return h.select("query", "hit", (100.0 * F.col("p.Hsp_identity") / F.col("p.`Hsp_align-len`")).alias("pident"), F.col("p.Hsp_evalue").alias("evalue"), F.col("p.`Hsp_bit-score`").alias("score")).where(F.col("score") >= least_score)


def gff(spark: SparkSession, path) -> DataFrame:
    """Features with their attributes as a map."""
    return spark.read.csv(path, sep="\t", comment="#", schema=GFF).withColumn("attributes", attribute_map(F.col("attributes")))


FEATURE = "struct<type: string, start: int, stop: int, strand: int, quals: map<string, array<string>>>"


def _feature_table(lines: list[str], at: int) -> list[dict]:
    """Features of a GenBank or EMBL table whose keys start at column 5 and values at column `at`."""
    import re

    out: list[dict] = []
    key = None
    for line in lines:
        body = line[at:].rstrip()
        name = line[5:at].strip()
        if name:
            places = [int(x) for x in re.findall(r"\d+", body)] or [0]
            out.append({"type": name, "start": min(places), "stop": max(places), "strand": -1 if "complement" in body else 1, "quals": {}})
            key = None
        elif body.startswith("/") and out:
            key, _, v = body[1:].partition("=")
            out[-1]["quals"].setdefault(key, []).append(v.strip('"'))
        elif key and out:
            glue = "" if key == "translation" else " "
            out[-1]["quals"][key][-1] += glue + body.strip('"')
    return out


def _entries(spark: SparkSession, path, parse, schema: str) -> DataFrame:
    raw = spark.read.option("lineSep", "//\n").text(path).where(F.trim("value") != "")
    names = [x.strip().split()[0] for x in schema.split(", features")[0].split(",")] + ["features"]

    def run(frames):
        for pdf in frames:
            yield pd.DataFrame([parse(v) for v in pdf.value], columns=names)

    return raw.mapInPandas(run, schema)


def _genbank(text: str) -> tuple:
    lines = text.split("\n")
    first = next((x for x in lines if x.startswith("LOCUS")), "LOCUS  0").split()
    part, definition, table, seq = "", [], [], []
    for x in lines:
        if x[:1].strip():
            part = x.split()[0]
        if part == "DEFINITION":
            definition.append(x[12:].strip())
        elif part == "FEATURES" and not x.startswith("FEATURES"):
            table.append(x)
        elif part == "ORIGIN" and not x.startswith("ORIGIN"):
            seq.append("".join(c for c in x if c.isalpha()))
    return first[1], int(first[2]) if len(first) > 2 and first[2].isdigit() else None, " ".join(definition), "".join(seq).upper(), _feature_table(table, 21)


def _embl(text: str) -> tuple:
    lines = text.split("\n")
    of = lambda k: [x[5:] for x in lines if x.startswith(k)]
    name = (of("ID") or [""])[0].split(";")[0].strip()
    seq = "".join(c for x in lines if x.startswith("  ") for c in x if c.isalpha()).upper()
    return name, len(seq) or None, " ".join(x.strip() for x in of("DE")), seq, _feature_table(["     " + x[5:] for x in lines if x.startswith("FT")], 21)


ENTRY = f"locus string, length int, definition string, seq string, features array<{FEATURE}>"


def genbank(spark: SparkSession, path) -> DataFrame:
    """One row an entry: locus, length, definition, seq, features."""
    return _entries(spark, path, _genbank, ENTRY)


def embl(spark: SparkSession, path) -> DataFrame:
    return _entries(spark, path, _embl, ENTRY)


def features_of(entries: DataFrame, kind: str | None = None) -> DataFrame:
    """One row a feature, with first values of common qualifiers."""
    e = entries.select("locus", F.explode("features").alias("f")).select("locus", "f.*")
    e = e if kind is None else e.where(F.col("type") == kind)
    return e.select("*", *(F.col("quals")[q][0].alias(q) for q in ("locus_tag", "gene", "product", "translation")))


def split_entries(spark: SparkSession, path) -> DataFrame:
    """Flat-file entries as they are: locus, text."""
    raw = spark.read.option("lineSep", "//\n").text(path).where(F.trim("value") != "")
    return raw.select(F.regexp_extract("value", r"(?m)^(?:LOCUS|ID)\s+([^\s;]+)", 1).alias("locus"), F.concat("value", F.lit("//\n")).alias("text"))


def genome_coverage(spark: SparkSession, path) -> DataFrame:
    """Coverage histogram with a mandatory header: contig, depth, bases, len, frac."""
    d = spark.read.csv(path, sep="\t", header=True, schema=COVERAGE, enforceSchema=False)
    return d.toDF("contig", "depth", "bases", "len", "frac")


def scaffold_cov(spark: SparkSession, path) -> DataFrame:
    return spark.read.csv(path, sep="\t", comment="#", schema="scaffold string, coverage double, len long")


def header_of(spark: SparkSession, path) -> list[str]:
    return spark.read.text(path).first()[0].rstrip("\r").split("\t")


def _wide(spark: SparkSession, path, names: list[str], skip: int = 1) -> DataFrame:
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.read.csv(path, sep="\t", header=skip == 1, schema=schema)


def shared(spark: SparkSession, path) -> DataFrame:
    """Wide sample x OTU table as (sample, otu, count); several labels or a repeated sample are errors."""
    names = header_of(spark, path)
    if names[:3] != ["label", "Group", "numOtus"]:
        raise ValueError("not a shared table")
    d = _wide(spark, path, names)
    bad = d.agg(F.count_distinct("label").alias("l"), F.count("*").alias("n"), F.count_distinct("Group").alias("g")).first()
    if bad.l > 1 or bad.n != bad.g:
        raise ValueError("more than one label, or a repeated sample")
    m = d.unpivot(["Group"], names[3:], "otu", "count")
    return m.select(F.col("Group").alias("sample"), "otu", F.col("count").cast("long").alias("count")).where("count > 0")


def count_table(spark: SparkSession, path) -> DataFrame:
    """OTU x sample counts, plain or compressed ("idx,count" pairs), as (sample, otu, count)."""
    lines = [r[0] for r in spark.read.text(path).take(3)]
    if lines and lines[0].startswith("#Compressed"):
        head = next(x for x in lines if not x.startswith("#")).split("\t")
        names = head[2:]
        body = spark.read.text(path).where(~F.col("value").startswith("#") & ~F.col("value").startswith(head[0]))
        c = F.split("value", "\t")
        pairs = body.select(c[0].alias("otu"), F.explode(F.slice(c, F.lit(3), F.size(c))).alias("p")).select("otu", F.split("p", ",").alias("p")).where(F.size("p") == 2)
        sample = F.element_at(F.array(*map(F.lit, names)), F.col("p")[0].cast("int"))
        return pairs.select(sample.alias("sample"), "otu", F.col("p")[1].cast("long").alias("count")).where("count > 0")
    names = lines[0].split("\t")
    m = _wide(spark, path, names).unpivot([names[0]], names[2:], "sample", "count")
    return m.select("sample", F.col(f"`{names[0]}`").alias("otu"), F.col("count").cast("long").alias("count")).where("count > 0")


def groups(spark: SparkSession, path) -> DataFrame:
    """Sequences per group: sample, count."""
    return spark.read.csv(path, sep="\t", schema="seq string, sample string").groupBy("sample").agg(F.count("*").alias("count"))


def cons_taxonomy(spark: SparkSession, path) -> DataFrame:
    """otu, size, ranks (array; scores in brackets removed)."""
    d = spark.read.csv(path, sep="\t", header=True, schema="otu string, size long, taxonomy string")
    ranks = F.filter(F.split(F.regexp_replace("taxonomy", r"\(\d+\)", ""), ";"), lambda x: x != "")
    return d.select("otu", "size", ranks.alias("ranks"))


def group_definitions(spark: SparkSession, path) -> DataFrame:
    """leader<TAB>m1,m2 as (otu, leader), the leader being a member."""
    d = spark.read.csv(path, sep="\t", schema="leader string, members string")
    return d.select(F.explode(F.array_union(F.array("leader"), F.split("members", ","))).alias("otu"), "leader")


def sequence_table(spark: SparkSession, path, prefix: str = "dada2") -> DataFrame:
    """Samples x sequences (the header holds the sequences) as (sample, otu, seq, count); dashes in samples become underscores."""
    seqs = [s.strip('"') for s in header_of(spark, path) if s.strip('"')]
    names = [f"{prefix}_{i + 1}" for i in range(len(seqs))]
    d = spark.read.csv(path, sep="\t", schema=", ".join(f"`{n}` string" for n in ["sample", *names])).where(F.try_to_number(F.col(names[0]), F.lit("999999999")).isNotNull() if names else F.lit(False))
    m = d.unpivot(["sample"], names, "otu", "count")
    known = spark.createDataFrame(list(zip(names, seqs)), "otu string, seq string")
    return m.select(F.replace("sample", F.lit("-"), F.lit("_")).alias("sample"), "otu", F.col("count").cast("long").alias("count")).where("count > 0").join(F.broadcast(known), "otu").select("sample", "otu", "seq", "count")


def name_map(spark: SparkSession, path) -> DataFrame:
    return spark.read.csv(path, sep="\t", comment="#", schema="old string, new string")


def checkm(spark: SparkSession, path) -> DataFrame:
    """bin and its dictionary as key, value (text), number (null where it isn't one)."""
    d = spark.read.csv(path, sep="\t", quote="", schema="bin string, dict string")
    m = F.from_json(F.replace("dict", F.lit("'"), F.lit('"')), "map<string,string>")
    return d.select("bin", F.explode(m).alias("key", "value")).select("bin", "key", "value", F.col("value").try_cast("double").alias("number"))


def typed_cells(spark: SparkSession, path, sep: str = "\t") -> DataFrame:
    """A table with a row id as (row, column, value, whole, number): the type is each cell's own."""
    d = spark.read.csv(path, sep=sep, header=True)
    m = d.unpivot([d.columns[0]], d.columns[1:], "column", "value").withColumnRenamed(d.columns[0], "row")
    return m.select("row", "column", "value", F.col("value").try_cast("long").alias("whole"), F.col("value").try_cast("double").alias("number"))


def fastqc(spark: SparkSession, path) -> DataFrame:
    """Marks in the summary.txt of FastQC archives: archive, mark, test, file."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content")

    def run(frames):
        import io
        import zipfile

        for pdf in frames:
            rows = []
            for p, c in zip(pdf.path, pdf.content):
                with zipfile.ZipFile(io.BytesIO(c)) as z:
                    for n in z.namelist():
                        if n.endswith("summary.txt"):
                            rows += [(p.rsplit("/", 1)[-1], *x.split("\t")[:3]) for x in z.read(n).decode().splitlines() if x.count("\t") >= 2]
            yield pd.DataFrame(rows, columns=["archive", "mark", "test", "file"])

    return raw.mapInPandas(run, "archive string, mark string, test string, file string")


def esom(spark: SparkSession, path, schema: str) -> DataFrame:
    """A .lrn, .names or .cls body; header lines start with %."""
    return spark.read.csv(path, sep="\t", comment="%", schema=schema)


def taxonomy_dump(spark: SparkSession, path, columns: str) -> DataFrame:
    """A nodes.dmp or names.dmp: columns parted by tab, bar, tab."""
    names = [c.split() for c in columns.split(", ")]
    c = F.split(F.regexp_replace("value", r"\t\|$", ""), r"\t\|\t")
    return spark.read.text(path).select(*(F.get(c, F.lit(i)).try_cast(t).alias(n) for i, (n, t) in enumerate(names)))


def uclust(spark: SparkSession, path) -> DataFrame:
    """Seeds and hits: cluster, member, seed (the target of a hit, itself for a seed)."""
    c = F.split("value", "\t")
    d = spark.read.text(path).where(F.col("value").rlike("^[SH]\t")).select(c[0].alias("type"), c[1].cast("int").alias("cluster"), F.element_at(c, -2).alias("member"), F.element_at(c, -1).alias("target"))
    return d.select("cluster", "member", F.when(F.col("type") == "S", F.col("member")).otherwise(F.col("target")).alias("seed"))


def sectioned(spark: SparkSession, path, head: str, **options) -> DataFrame:
    """Lines with the head line (a regex) they stand under: file, ord, head, value. Ranges are read as they come: nothing is sorted by file."""
    return files.read(spark, path, "sections", head=head, **options)


def last_graph(spark: SparkSession, path) -> DataFrame:
    """Reads of assembly nodes from a LastGraph file: node, read."""
    s = sectioned(spark, path, r"^(NR|NODE|ARC|SEQ)\t").where(F.col("head").startswith("NR"))
    return s.select(F.abs(F.split("head", "\t")[1].cast("int")).alias("node"), F.split("value", "\t")[0].cast("long").alias("read")).distinct()


def assembled_contigs(spark: SparkSession, path) -> DataFrame:
    """Members of a .contig file: contig, members, length, read, reversed."""
    s = sectioned(spark, path, "^##").where(F.col("value").startswith("#"))
    h = F.split(F.substring(F.col("head"), F.lit(3), F.length("head")), r"\s+")
    return s.select(h[0].alias("contig"), h[1].cast("int").alias("members"), h[2].cast("int").alias("length"), F.regexp_extract("value", r"^#([^(\s]+)", 1).alias("read"), F.col("value").contains("[RC]").alias("reversed"))


def cluster_overview(spark: SparkSession, path) -> DataFrame:
    """Rows under ">folder" heads: folder, fields."""
    s = sectioned(spark, path, "^>").where(F.trim("value") != "")
    return s.select(F.substring("head", 2, 1000).alias("folder"), F.split("value", "\t").alias("fields"))


def tiny_seq(spark: SparkSession, path, kind: str = "protein") -> DataFrame:
    """TinySeq XML records of one type: gi, accver, taxid, orgname, defline, length, seq."""
    schema = "TSeq_seqtype struct<_value: string>, TSeq_gi long, TSeq_accver string, TSeq_taxid int, TSeq_orgname string, TSeq_defline string, TSeq_length int, TSeq_sequence string"
    d = _xml(spark, "TSeq").schema(schema).load(path).where(F.col("TSeq_seqtype._value") == kind)
    return d.select(F.col("TSeq_gi").alias("gi"), F.col("TSeq_accver").alias("accver"), F.col("TSeq_taxid").alias("taxid"), F.col("TSeq_orgname").alias("orgname"), F.col("TSeq_defline").alias("defline"), F.col("TSeq_length").alias("length"), F.col("TSeq_sequence").alias("seq"))


def document_summaries(spark: SparkSession, path) -> DataFrame:
    """Id and title of DocSum records."""
    d = _xml(spark, "DocSum").schema("Id long, Item array<struct<_Name: string, _VALUE: string>>").load(path)
    return d.select(F.col("Id").alias("id"), F.filter("Item", lambda x: x["_Name"] == "Title")[0]["_VALUE"].alias("title"))


def cited_entries(spark: SparkSession, path) -> DataFrame:
    """gi, title, journal and sequence of flat-file entries, but for unpublished ones and direct submissions."""
    raw = spark.read.option("lineSep", "//\n").text(path).where(F.trim("value") != "")
    one = lambda k: F.trim(F.regexp_replace(F.regexp_extract("value", rf"(?m)^\s*{k}\s+(.*(?:\n {{12}}.*)*)", 1), r"\s+", " "))
    seq = F.upper(F.regexp_replace(F.regexp_extract("value", r"(?s)\nORIGIN[^\n]*\n(.*)", 1), "[^A-Za-z]", ""))
    d = raw.select(F.regexp_extract("value", r"(?m)^VERSION.*GI:(\d+)", 1).alias("gi"), one("TITLE").alias("title"), one("JOURNAL").alias("journal"), seq.alias("seq"))
    return d.where(~F.col("journal").startswith("Unpublished") & (F.col("title") != "Direct Submission"))


def alignments(spark: SparkSession, path) -> DataFrame:
    """Mapped reads of SAM text, or of BAM: read, flag, contig, pos, mapq, cigar, seq, qual."""
    if str(path).endswith(".bam"):
        return files.read(spark, path, "bam").drop("file", "ord").where(F.col("flag").bitwiseAND(4) == 0)
    c = F.split("value", "\t")
    names = ("read string", "flag int", "contig string", "pos int", "mapq int", "cigar string")
    d = spark.read.text(path).where(~F.col("value").startswith("@"))
    d = d.select(*(c[i].try_cast(n.split()[1]).alias(n.split()[0]) for i, n in enumerate(names)), F.get(c, F.lit(9)).alias("seq"), F.get(c, F.lit(10)).alias("qual"))
    return d.where(F.col("flag").bitwiseAND(4) == 0)


def step_log(spark: SparkSession, path) -> DataFrame:
    """Steps of an assembler log with their time and duration: ord, ts, step, seconds (0 for the last)."""
    d = files.read(spark, path).select("file", "ord", F.regexp_extract("value", r"^--- \[(.*?)\] (.*?) ---", 1).alias("t"), F.regexp_extract("value", r"^--- \[(.*?)\] (.*?) ---", 2).alias("step")).where("t <> ''")
    ts = F.to_timestamp(F.regexp_replace(F.substring("t", 5, 30), " +", " "), "MMM d HH:mm:ss yyyy")
    d = d.select("file", "ord", ts.alias("ts"), "step")
    return d.withColumn("seconds", F.coalesce(F.unix_timestamp(F.lead("ts").over(W.partitionBy("file").orderBy("ord"))) - F.unix_timestamp("ts"), F.lit(0)))


RAW_NAME = r"^(?:(.+?)_)??([^_]+)_([ACGTN+-]+|NoIndex)_(?:S(\d+)_)?L(\d+)_R([12])_(\d+)\.(.+)$"


def raw_names(names: DataFrame, column: str = "name") -> DataFrame:
    """Parts of Illumina file names: run, sample, index, snum, lane, dir, fnum, suffix; other names have none."""
    part = lambda i, t="string": F.nullif(F.regexp_extract(column, RAW_NAME, i), F.lit("")).cast(t)
    kinds = (("run", "string"), ("sample", "string"), ("index", "string"), ("snum", "int"), ("lane", "int"), ("dir", "int"), ("fnum", "int"), ("suffix", "string"))
    return names.select(column, *(part(i, t).alias(n) for i, (n, t) in enumerate(kinds, 1)))


def header_coordinates(reads: DataFrame) -> DataFrame:
    """tile, x, y of Illumina headers (fields 5 to 7 between colons)."""
    c = F.split(F.split("header", " ")[0], ":")
    return reads.where(F.size(c) >= 7).select(c[4].cast("int").alias("tile"), c[5].cast("int").alias("x"), c[6].cast("int").alias("y"))


def annotation_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Tab-separated annotation files of a folder by their suffix (cog, ec, ko, pfam, map, phylodist, gene_product, gff)."""
    where, path = files.place(folder)
    from pyarrow import fs

    out = {}
    for x in where.get_file_info(fs.FileSelector(path)):
        kind = x.base_name.rsplit(".", 1)[-1]
        if kind == "gff":
            out[kind] = gff(spark, f"{folder}/{x.base_name}")
        elif kind in ("cog", "ec", "ko", "pfam", "map", "phylodist", "gene_product"):
            out[kind] = spark.read.csv(f"{folder}/{x.base_name}", sep="\t")
    return out
