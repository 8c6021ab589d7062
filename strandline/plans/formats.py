"""Queries that write the tables in a format, and read them back by its reader: what comes back is held against the tables.

Files go to the shared folder (`files.shared_folder`) and stay until the driver's JVM ends, as the frames returned read them lazily. A
record of several lines is one row of text when written, so its lines stay together whatever file it lands in.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import query
from ..sources import files, formats, sinks


def _folder(v) -> str:
    at = f"{files.shared_folder(v.spark)}/strandline-{uuid.uuid4().hex}"
    jvm = v.spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(v.spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return at


def _written(v, df: DataFrame, value: Column) -> str:
    at = _folder(v)
    df.select(value.alias("value")).write.text(at)
    return at


def _xml(v, df: DataFrame, tag: str) -> str:
    """Files of one root each."""
    at = _folder(v)
    df.write.format("xml").option("rootTag", f"{tag}Set").option("rowTag", tag).save(at)
    return at


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _tabbed(*cols: str | Column) -> Column:
    return F.concat_ws("\t", *map(_s, cols))


@query("s1_fasta", "SELECT id, coalesce(grp, '') AS descr, CAST(length(coalesce(seq, '')) AS INTEGER) AS n, md5(coalesce(seq, '')) AS digest FROM seqs", "seqs")
def _(v):
    """FASTA of lines of 60 letters, written and read."""
    at = _folder(v)
    sinks.write_fasta(v.seqs.select("id", F.col("grp").alias("descr"), F.coalesce("seq", F.lit("")).alias("seq")), at, width=60)
    return formats.fasta(v.spark, at).select("id", "descr", F.length("seq").alias("n"), F.md5("seq").alias("digest"))


@query("s1_fasta_repair", "SELECT 'c' || c_custkey || ' +' || c_mktsegment AS header, c_name AS seq FROM customer")
def _(v):
    """A ">" within a header is read as "+"."""
    at = _written(v, v.table("customer"), F.concat(F.lit(">c"), _s("c_custkey"), F.lit(" >"), "c_mktsegment", F.lit("\n"), "c_name"))
    return files.read(v.spark, at, "fasta", repair="true").select("header", "seq")


@query("s2_fastq", "SELECT id || ' ' || coalesce(grp, '-') AS header, md5(coalesce(seq, '')) AS digest, md5(repeat('I', length(coalesce(seq, '')))) AS quality FROM seqs", "seqs")
def _(v):
    at = _folder(v)
    seq = F.coalesce("seq", F.lit(""))
    sinks.write_fastq(v.seqs.select(F.concat_ws(" ", "id", F.coalesce("grp", F.lit("-"))).alias("header"), seq.alias("seq"), F.repeat(F.lit("I"), F.length(seq)).alias("qual")), at)
    return formats.fastq(v.spark, at).select("header", F.md5("seq").alias("digest"), F.md5("qual").alias("quality"))


@query("s2_fastq_check", "SELECT 'c' || c_custkey AS id, CASE WHEN c_custkey % 10 = 0 THEN 'sequence and qualities differ in length' WHEN c_custkey % 10 = 1 THEN 'no +' END AS error FROM customer")
def _(v):
    """Malformed records are kept with what is wrong with them."""
    k = F.col("c_custkey") % 10
    at = _written(v, v.table("customer"), F.concat(F.lit("@c"), _s("c_custkey"), F.lit("\n"), "c_name", F.lit("\n"), F.when(k == 1, "-").otherwise("+"), F.lit("\n"), F.repeat(F.lit("I"), F.length("c_name") - F.when(k == 0, 1).otherwise(0))))
    return formats.fastq(v.spark, at, "PERMISSIVE").select("id", "error")


@query("k3_fastq_to_fasta", "SELECT 'c' || c_custkey || ' x' AS id, c_name AS seq FROM customer")
def _(v):
    at, out = _folder(v), _folder(v)
    sinks.write_fastq(v.table("customer").select(F.concat(F.lit("c"), _s("c_custkey"), F.lit(" x")).alias("header"), F.col("c_name").alias("seq"), F.repeat(F.lit("I"), F.length("c_name")).alias("qual")), at)
    sinks.write_fasta(sinks.fastq_to_fasta(formats.fastq(v.spark, at)), out)
    return formats.fasta(v.spark, out).select(F.col("header").alias("id"), "seq")


@query("s3_sniffed_s4_packed", "SELECT 'c' || c_custkey AS id, c_name AS seq FROM customer")
def _(v):
    """Packed by gzip; the format is told by the first byte of a file."""
    at = _folder(v)
    v.table("customer").select(F.concat(F.lit(">c"), _s("c_custkey"), F.lit("\n"), "c_name").alias("value")).write.option("compression", "gzip").text(at)
    parts = [r[0] for r in v.spark.read.format("binaryFile").load(at).select("path").orderBy("path").collect()]
    return formats.sequences(v.spark, parts).select("id", "seq")


@query("s5_interleaved_pairs", "SELECT 'c' || c_custkey || '/1' AS fwd, 'c' || c_custkey || '/2' AS rev, c_name AS fwd_seq, c_mktsegment AS rev_seq FROM customer")
def _(v):
    mate = lambda n, c: F.concat(F.lit("@c"), _s("c_custkey"), F.lit(f"/{n}\n"), c, F.lit("\n+\n"), F.repeat(F.lit("I"), F.length(c)))
    at = _written(v, v.table("customer"), F.concat(mate(1, "c_name"), F.lit("\n"), mate(2, "c_mktsegment")))
    p = formats.interleaved_pairs(formats.fastq(v.spark, at))
    return p.select(F.col("fwd.id").alias("fwd"), F.col("rev.id").alias("rev"), F.col("fwd.seq").alias("fwd_seq"), F.col("rev.seq").alias("rev_seq"))


@query("s6_fasta_with_quality", "SELECT 's' || s_suppkey AS id, 'ACG' AS seq, chr(CAST(33 + s_suppkey % 40 AS INTEGER)) || chr(CAST(33 + s_suppkey % 30 AS INTEGER)) || chr(CAST(33 + s_suppkey % 20 AS INTEGER)) AS qual FROM supplier")
def _(v):
    d, k = v.table("supplier"), F.col("s_suppkey")
    head = F.concat(F.lit(">s"), _s(k), F.lit("\n"))
    a = _written(v, d, F.concat(head, F.lit("ACG")))
    b = _written(v, d, F.concat(head, F.concat_ws(" ", _s(k % 40), _s(k % 30)), F.lit("\n"), _s(k % 20)))
    return formats.fasta_with_quality(v.spark, a, b)


@query("s7_tabular_hits", """
    SELECT CAST(query AS VARCHAR) AS query, CAST(subject AS VARCHAR) AS subject, CAST(pident AS DOUBLE) AS pident, length, CAST(mismatch AS INTEGER) AS mismatch, CAST(gapopen AS INTEGER) AS gapopen,
      CAST(sstart AS INTEGER) AS sstart, CAST(send AS INTEGER) AS send, CAST(evalue AS DOUBLE) AS evalue, CAST(bitscore AS DOUBLE) AS bitscore FROM hits""", "hits")
def _(v):
    at = _written(v, v.hits, F.concat(F.lit("# a comment\n"), _tabbed("query", "subject", "pident", "length", "mismatch", "gapopen", F.lit(1), "length", "sstart", "send", "evalue", "bitscore")))
    return formats.blast(v.spark, at).drop("qstart", "qend")


@query("s8_hits_xml", "SELECT s_name AS query, 'n' || s_nationkey AS hit, CAST(s_suppkey % 90 + 10 AS DOUBLE) AS pident, 0.25::DOUBLE AS evalue, CAST(s_suppkey % 5 AS DOUBLE) AS score FROM supplier WHERE s_suppkey % 5 >= 2")
def _(v):
    k = F.col("s_suppkey")
    part = F.struct((k % 5).alias("Hsp_bit-score"), F.lit(0.25).alias("Hsp_evalue"), (k % 90 + 10).alias("Hsp_identity"), F.lit(100).alias("Hsp_align-len"))
    hit = F.struct(F.concat(F.lit("n"), _s("s_nationkey")).alias("Hit_def"), F.struct(F.array(part).alias("Hsp")).alias("Hit_hsps"))
    return formats.blast_xml(v.spark, _xml(v, v.table("supplier").select(F.col("s_name").alias("Iteration_query-def"), F.struct(F.array(hit).alias("Hit")).alias("Iteration_hits")), "Iteration"), 2)


@query("s9_gff", "SELECT CAST(scaffold AS VARCHAR) AS seqid, start, stop, strand, 'f' || locus AS id, type AS product FROM features", "features")
def _(v):
    dot = F.lit(".")
    at = _written(v, v.features, F.concat(_tabbed("scaffold", F.lit("x"), F.lit("CDS"), "start", "stop", dot, "strand", F.lit("0")), F.lit("\t"), F.lit("ID=f"), _s("locus"), F.lit(";product="), "type"))
    a = F.col("attributes")
    return formats.gff(v.spark, at).select("seqid", "start", "stop", "strand", a["ID"].alias("id"), a["product"].alias("product"))


def _entry() -> Column:
    k = _s("c_custkey")
    return F.concat(
        F.lit("LOCUS       E"), k, F.lit("   8 bp\nDEFINITION  "), "c_name", F.lit("\n            of two lines.\nVERSION     E"), k, F.lit(".1  GI:"), k, F.lit("\nREFERENCE   1\n  TITLE     On "), "c_name",
        F.lit("\n  JOURNAL   "), F.when(F.col("c_custkey") % 5 == 0, "Unpublished").otherwise(F.col("c_mktsegment")), F.lit("\nFEATURES             Location/Qualifiers\n     CDS             "),
        F.when(F.col("c_custkey") % 2 == 0, "complement(2..7)").otherwise("2..7"), F.lit('\n                     /locus_tag="t'), k, F.lit('"\n                     /product="a\n                     '), "c_mktsegment",
        F.lit('"\nORIGIN\n        1 acgta cgt\n//'))


@query("s10_flat_files", "SELECT 'E' || c_custkey AS locus, 8 AS length, c_name || ' of two lines.' AS definition, 'ACGTACGT' AS seq FROM customer")
def _(v):
    return formats.genbank(v.spark, _written(v, v.table("customer"), _entry())).drop("features")


@query("s10_flat_file_features", "SELECT 'E' || c_custkey AS locus, 'CDS' AS type, 2 AS start, 7 AS stop, CASE WHEN c_custkey % 2 = 0 THEN -1 ELSE 1 END AS strand, 't' || c_custkey AS locus_tag, 'a ' || c_mktsegment AS product FROM customer")
def _(v):
    e = formats.genbank(v.spark, _written(v, v.table("customer"), _entry()))
    return formats.features_of(e, "CDS").select("locus", "type", "start", "stop", "strand", "locus_tag", "product")


@query("s11_split_entries", "SELECT 'E' || c_custkey AS locus, c_name AS name FROM customer")
def _(v):
    d = formats.split_entries(v.spark, _written(v, v.table("customer"), _entry()))
    return d.select("locus", F.regexp_extract("text", r"(?m)^DEFINITION +(.*)$", 1).alias("name"))


@query("s12_embl", "SELECT 'Y' || c_custkey AS locus, c_name AS definition, 'ACGTACGT' AS seq, c_mktsegment AS gene, 3 AS start FROM customer")
def _(v):
    at = _written(v, v.table("customer"), F.concat(F.lit("ID   Y"), _s("c_custkey"), F.lit("; x\nDE   "), "c_name", F.lit('\nFT   CDS             3..8\nFT                   /gene="'), "c_mktsegment", F.lit('"\nSQ   x\n     acgtac gt 8\n//')))
    e = formats.embl(v.spark, at)
    f = F.col("features")[0]
    return e.select("locus", "definition", "seq", f["quals"]["gene"][0].alias("gene"), f["start"].alias("start"))


@query("s33_cited_entries", "SELECT CAST(c_custkey AS VARCHAR) AS gi, 'On ' || c_name AS title, c_mktsegment AS journal, 'ACGTACGT' AS seq FROM customer WHERE c_custkey % 5 <> 0")
def _(v):
    return formats.cited_entries(v.spark, _written(v, v.table("customer"), _entry()))


@query("s13_genome_coverage", "SELECT CAST(contig AS VARCHAR) AS contig, depth, bases, len, bases * 1.0::DOUBLE / len AS frac FROM cov", "cov")
def _(v):
    at = _folder(v)
    v.cov.select(F.col("contig").alias("Contig"), F.col("depth").alias("Depth"), F.col("bases").alias("bases_with_depth"), F.col("len").alias("contigLen"), (F.col("bases") / F.col("len")).alias("fraction_bases_with_depth")).write.csv(at, sep="\t", header=True)
    return formats.genome_coverage(v.spark, at)


@query("s14_scaffold_cov", "SELECT CAST(contig AS VARCHAR) AS scaffold, gc AS coverage, len FROM contigs", "contigs")
def _(v):
    return formats.scaffold_cov(v.spark, _written(v, v.contigs, F.concat(F.lit("# coveragePerScaffold\n"), _tabbed("contig", "gc", "len"))))


@query("s15_shared", "SELECT sample, otu, count FROM matrix", "matrix")
def _(v):
    """The wide form has a column for each OTU, so their list is the driver's."""
    at = _folder(v)
    sinks.write_shared(v.matrix, at, [r[0] for r in v.matrix.select("otu").distinct().orderBy("otu").collect()])
    return formats.shared(v.spark, at)


@query("s16_count_table", "SELECT sample, otu, count FROM matrix", "matrix")
def _(v):
    """OTU by sample, with a total in the second column."""
    at, m = _folder(v), v.matrix
    names = [r[0] for r in m.select("sample").distinct().orderBy("sample").collect()]
    wide = m.groupBy(F.col("otu").alias("Representative_Sequence")).pivot("sample", names).agg(F.sum("count")).na.fill(0)
    total = sum((F.col(f"`{n}`") for n in names), F.lit(0))
    wide.select("Representative_Sequence", total.alias("total"), *(F.col(f"`{n}`") for n in names)).write.csv(at, sep="\t", header=True)
    return formats.count_table(v.spark, at)


@query("s17_compressed_count_table", "SELECT sample, otu, count FROM matrix", "matrix")
def _(v):
    """Each row names the columns of its samples by number; the head lines stand before every row, so that each file has them."""
    at, m = _folder(v), v.matrix
    names = [r[0] for r in m.select("sample").distinct().orderBy("sample").collect()]
    pair = F.concat_ws(",", _s(F.array_position(F.array(*map(F.lit, names)), F.col("sample"))), _s("count"))
    head = "#Compressed Format: groupIndex,abundance\n" + "\t".join(["Representative_Sequence", "total", *names]) + "\n"
    body = m.groupBy("otu").agg(F.sum("count").alias("total"), F.array_join(F.collect_list(pair), "\t").alias("pairs"))
    body.select(F.concat(F.lit(head), _tabbed("otu", "total", "pairs")).alias("value")).write.text(at)
    return formats.count_table(v.spark, at)


@query("s18_groups", "SELECT o_orderstatus AS sample, count(*) AS count FROM orders GROUP BY 1")
def _(v):
    return formats.groups(v.spark, _written(v, v.table("orders"), _tabbed("o_orderkey", "o_orderstatus")))


@query("s19_cons_taxonomy", "SELECT 'p' || p_partkey AS otu, CAST(p_size AS BIGINT) AS size, p_brand AS first, p_type AS second, 2 AS ranks FROM part")
def _(v):
    at = _folder(v)
    v.table("part").select(F.concat(F.lit("p"), _s("p_partkey")).alias("OTU"), F.col("p_size").alias("Size"), F.concat("p_brand", F.lit("(100);"), "p_type", F.lit("(90);")).alias("Taxonomy")).write.csv(at, sep="\t", header=True)
    r = F.col("ranks")
    return formats.cons_taxonomy(v.spark, at).select("otu", "size", r[0].alias("first"), r[1].alias("second"), F.size(r).alias("ranks"))


@query("s20_group_definitions", """
    SELECT DISTINCT 'l' || l_partkey AS otu, 'o' || l_orderkey AS leader FROM lineitem UNION ALL SELECT DISTINCT 'o' || l_orderkey, 'o' || l_orderkey FROM lineitem""")
def _(v):
    g = v.table("lineitem").groupBy("l_orderkey").agg(F.array_join(F.collect_set(F.concat(F.lit("l"), _s("l_partkey"))), ",").alias("members"))
    return formats.group_definitions(v.spark, _written(v, g, F.concat(F.lit("o"), _s("l_orderkey"), F.lit("\t"), "members")))


@query("s22_name_map", "SELECT c_name AS old, 'c' || c_custkey AS new FROM customer")
def _(v):
    return formats.name_map(v.spark, _written(v, v.table("customer"), _tabbed("c_name", F.concat(F.lit("c"), _s("c_custkey")))))


@query("s23_checkm", """
    SELECT 'p' || p_partkey AS bin, 'Size' AS key, CAST(p_size AS VARCHAR) AS value, CAST(p_size AS DOUBLE) AS number FROM part
    UNION ALL SELECT 'p' || p_partkey, 'Brand', p_brand, NULL FROM part""")
def _(v):
    return formats.checkm(v.spark, _written(v, v.table("part"), F.concat(F.lit("p"), _s("p_partkey"), F.lit("\t{'Size': "), _s("p_size"), F.lit(", 'Brand': '"), "p_brand", F.lit("'}"))))


@query("s24_typed_cells", """
    SELECT CAST(p_partkey AS VARCHAR) AS "row", 'size' AS "column", CAST(p_size AS VARCHAR) AS value, CAST(p_size AS BIGINT) AS whole, CAST(p_size AS DOUBLE) AS number FROM part
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'brand', p_brand, NULL, NULL FROM part""")
def _(v):
    at = _folder(v)
    v.table("part").select("p_partkey", F.col("p_size").alias("size"), F.col("p_brand").alias("brand")).write.csv(at, sep="\t", header=True)
    return formats.typed_cells(v.spark, at)


@query("k9_esom", "SELECT CAST(p_partkey AS INTEGER) AS num, round(p_size / 64.0::DOUBLE, 6) AS a, round(p_size / 128.0::DOUBLE, 6) AS b, 'w' || p_partkey AS win, p_brand AS contig, CAST(p_size AS INTEGER) AS class FROM part")
def _(v):
    """The three files share their numbers."""
    at, k, n = _folder(v), F.col("p_partkey"), F.col("p_size")
    sinks.write_esom(v.table("part").select(k.alias("num"), F.concat(F.lit("w"), _s(k)).alias("window"), F.col("p_brand").alias("contig"), n.alias("class"), F.array(n / 64.0, n / 128.0).alias("freqs")), at)
    lrn = formats.esom(v.spark, f"{at}/lrn", "num int, a double, b double")
    names = formats.esom(v.spark, f"{at}/names", "num int, win string, contig string")
    return lrn.join(names, "num").join(formats.esom(v.spark, f"{at}/cls", "num int, class int"), "num")


@query("s27_taxonomy_dump", "SELECT CAST(taxid AS INTEGER) AS taxid, CAST(parent AS INTEGER) AS parent, rank FROM nodes", "nodes")
def _(v):
    at = _written(v, v.nodes, F.concat(F.concat_ws("\t|\t", _s("taxid"), _s("parent"), "rank"), F.lit("\t|")))
    return formats.taxonomy_dump(v.spark, at, "taxid int, parent int, rank string")


@query("s28_uclust", "SELECT CAST(p_partkey // 10 AS INTEGER) AS cluster, 'p' || p_partkey AS member, 'p' || (p_partkey // 10 * 10) AS seed FROM part")
def _(v):
    k = F.col("p_partkey")
    first = F.expr("p_partkey div 10")
    at = _written(v, v.table("part"), F.concat(F.when(k % 10 == 0, "S").otherwise("H"), F.lit("\t"), _s(first), F.lit("\t9\t*\t*\t*\t*\t*\tp"), _s(k), F.lit("\t"), F.when(k % 10 == 0, "*").otherwise(F.concat(F.lit("p"), _s(first * 10)))))
    return formats.uclust(v.spark, at)


def _sections(v, head: Column, line: Column) -> str:
    """A text for each order: its head, and a line for each of its rows."""
    g = v.table("lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.array_join(F.collect_list(line), "\n").alias("body"))
    return _written(v, g, F.concat(head, F.lit("\n"), "body"))


@query("s29_last_graph", "SELECT DISTINCT CAST(l_orderkey AS INTEGER) AS node, CAST(l_partkey AS BIGINT) AS read FROM lineitem")
def _(v):
    return formats.last_graph(v.spark, _sections(v, F.concat(F.lit("NR\t-"), _s("l_orderkey"), F.lit("\t"), _s("n")), _tabbed("l_partkey", F.lit(0), F.lit(0))))


@query("s30_assembled_contigs", """
    SELECT 'o' || l_orderkey AS contig, CAST(count(*) OVER (PARTITION BY l_orderkey) AS INTEGER) AS members, 50 AS length, 'r' || l_partkey AS read, l_returnflag = 'R' AS reversed FROM lineitem""")
def _(v):
    return formats.assembled_contigs(v.spark, _sections(v, F.concat(F.lit("##o"), _s("l_orderkey"), F.lit(" "), _s("n"), F.lit(" 50")), F.concat(F.lit("#r"), _s("l_partkey"), F.when(F.col("l_returnflag") == "R", "(0) [RC] x").otherwise("(5) [] x"))))


@query("s39_cluster_overview", "SELECT 'o' || l_orderkey AS folder, CAST(l_partkey AS VARCHAR) AS part, l_returnflag AS flag FROM lineitem")
def _(v):
    f = F.col("fields")
    d = formats.cluster_overview(v.spark, _sections(v, F.concat(F.lit(">o"), _s("l_orderkey")), _tabbed("l_partkey", "l_returnflag")))
    return d.select("folder", f[0].alias("part"), f[1].alias("flag"))


@query("s31_tiny_seq", "SELECT CAST(s_suppkey AS BIGINT) AS gi, CAST(s_nationkey AS INTEGER) AS taxid, s_name AS seq FROM supplier WHERE s_suppkey % 2 = 0")
def _(v):
    kind = F.when(F.col("s_suppkey") % 2 == 0, "protein").otherwise("nucleotide")
    d = v.table("supplier").select(F.struct(kind.alias("_value")).alias("TSeq_seqtype"), F.col("s_suppkey").alias("TSeq_gi"), F.col("s_nationkey").alias("TSeq_taxid"), F.col("s_name").alias("TSeq_sequence"))
    return formats.tiny_seq(v.spark, _xml(v, d, "TSeq")).select("gi", "taxid", "seq")


@query("s32_document_summaries", "SELECT CAST(p_partkey AS BIGINT) AS id, p_name AS title FROM part")
def _(v):
    item = lambda n, c: F.struct(F.lit(n).alias("_Name"), F.col(c).alias("_VALUE"))
    d = v.table("part").select(F.col("p_partkey").alias("Id"), F.array(item("Brand", "p_brand"), item("Title", "p_name")).alias("Item"))
    return formats.document_summaries(v.spark, _xml(v, d, "DocSum"))


@query("s36_alignments", "SELECT 'q' || query AS read, CAST(mismatch AS INTEGER) AS flag, CAST(subject AS VARCHAR) AS contig, CAST(sstart AS INTEGER) AS pos, 60 AS mapq, length || 'M' AS cigar FROM hits WHERE mismatch & 4 = 0", "hits")
def _(v):
    at = _written(v, v.hits, F.concat(F.lit("@HD\nq"), _tabbed("query", "mismatch", "subject", "sstart", F.lit(60)), F.lit("\t"), _s("length"), F.lit("M\t*\t0\t0\tACGT\tIIII")))
    return formats.alignments(v.spark, at).drop("seq", "qual")


@query("s36_bam_in_ranges", """
    SELECT 'q' || query AS read, CAST(mismatch AS INTEGER) AS flag, 'c' || (subject % 50) AS contig, CAST(sstart AS INTEGER) AS pos, CAST(length % 60 AS INTEGER) AS mapq,
      length || 'M' AS cigar, substr(repeat('ACGTN', 20), 1, length) AS seq, repeat('I', length) AS qual FROM hits""", "hits")
def _(v):
    """Hits as a BAM, read again in ranges of its blocks."""
    n = F.col("length")
    r = v.hits.select(F.concat(F.lit("q"), _s("query")).alias("read"), F.col("mismatch").cast("int").alias("flag"), F.concat(F.lit("c"), _s(F.col("subject") % 50)).alias("contig"), F.col("sstart").cast("int").alias("pos"),
                      (n % 60).cast("int").alias("mapq"), F.concat(_s(n), F.lit("M")).alias("cigar"), F.left(F.repeat(F.lit("ACGTN"), 20), n).alias("seq"), F.repeat(F.lit("I"), n).alias("qual"))
    at = _folder(v)
    sinks.write_bam(r, at, [(f"c{k}", 1000) for k in range(50)])
    return files.read(v.spark, at, "bam", maxPartitionBytes=str(1 << 20)).drop("file", "ord")


@query("s37_step_log", """
    SELECT CAST(event_id AS VARCHAR) AS step, coalesce(CAST(epoch(date_trunc('second', lead(ts) OVER w)) - epoch(date_trunc('second', ts)) AS BIGINT), 0) AS seconds
    FROM events WINDOW w AS (PARTITION BY user_id % 40 ORDER BY ts, event_id)""")
def _(v):
    """A log for each of 40 groups of users, one file each."""
    at = _folder(v)
    e = v.table("events").withColumn("log", F.col("user_id") % 40).repartition("log").sortWithinPartitions("log", "ts", "event_id")
    line = F.concat(F.lit("--- ["), F.date_format("ts", "EEE MMM d HH:mm:ss yyyy"), F.lit("] "), _s("event_id"), F.lit(" ---"))
    e.select(line.alias("value"), "log").write.partitionBy("log").text(at)
    return formats.step_log(v.spark, at).select("step", "seconds")


@query("s40_raw_names", """
    SELECT 'run' || s_nationkey AS run, 's' || s_suppkey AS sample, 'ACGT' AS "index", CAST(s_suppkey % 9 + 1 AS INTEGER) AS snum, CAST(s_suppkey % 8 + 1 AS INTEGER) AS lane, CAST(s_suppkey % 2 + 1 AS INTEGER) AS dir, 1 AS fnum, 'fastq.gz' AS suffix FROM supplier""")
def _(v):
    k = F.col("s_suppkey")
    name = F.concat(F.lit("run"), _s("s_nationkey"), F.lit("_s"), _s(k), F.lit("_ACGT_S"), _s(k % 9 + 1), F.lit("_L00"), _s(k % 8 + 1), F.lit("_R"), _s(k % 2 + 1), F.lit("_001.fastq.gz"))
    return formats.raw_names(v.table("supplier").select(name.alias("name"))).drop("name")


@query("s41_header_coordinates", "SELECT CAST(s_suppkey AS INTEGER) AS tile, CAST(s_nationkey AS INTEGER) AS x, CAST(s_suppkey % 7 AS INTEGER) AS y FROM supplier")
def _(v):
    k = F.col("s_suppkey")
    head = F.concat(F.concat_ws(":", F.lit("M:1:F:1"), _s(k), _s("s_nationkey"), _s(k % 7)), F.lit(" 1:N"))
    return formats.header_coordinates(v.table("supplier").select(head.alias("header")))


@query("k4_by_key", "SELECT p_brand AS brand, CAST(p_partkey AS BIGINT) AS part FROM part")
def _(v):
    at = _folder(v)
    sinks.write_by_key(v.table("part").select(F.col("p_brand").alias("brand"), F.col("p_partkey").cast("long").alias("part")), at, "brand")
    return v.spark.read.parquet(at)


@query("k6_fixed_digits", "SELECT CAST(c_custkey AS VARCHAR) AS customer, printf('%.6f', CAST(c_acctbal AS DOUBLE)) AS balance FROM customer")
def _(v):
    at = _folder(v)
    sinks.write_fixed(v.table("customer").select(F.col("c_custkey").alias("customer"), F.col("c_acctbal").cast("double").alias("balance")), at)
    return v.spark.read.csv(at, sep="\t", header=True)


@query("k7_feature_table", """
    WITH f AS (SELECT scaffold, start, strand = 'F' AS back, locus, type, (CASE WHEN start = 1 AND abs(start - stop) < 20 THEN '<' ELSE '' END) || start AS a,
      (CASE WHEN stop = 2000 AND abs(start - stop) < 20 THEN '>' ELSE '' END) || stop AS b FROM features WHERE abs(start - stop) + 1 >= 5)
    SELECT CAST(scaffold AS VARCHAR) AS scaffold, start, (CASE WHEN back THEN b || chr(9) || a ELSE a || chr(9) || b END) || chr(9) || type || chr(10) || chr(9) || chr(9) || chr(9) || 'locus_tag' || chr(9) || locus
      || chr(10) || chr(9) || chr(9) || chr(9) || 'product' || chr(9) || (CASE WHEN locus % 3 = 0 THEN 'hypothetical protein' ELSE type END) AS value FROM f""", "features")
def _(v):
    """Every scaffold ends at 2000; features of F are on the reverse strand."""
    f = v.features.withColumn("strand", F.when(F.col("strand") == "F", "-").otherwise("+")).withColumn("product", F.when(F.col("locus") % 3 != 0, F.col("type")))
    contigs = v.features.select("scaffold", F.lit(2000).alias("len")).distinct()
    return sinks.feature_table(f, contigs, least=5, short=20).withColumn("scaffold", _s("scaffold"))


@query("k8_graph_files", """
    SELECT 'region' AS label, 'r' || r_regionkey AS a, r_name AS b FROM region UNION ALL SELECT 'nation', 'n' || n_nationkey, n_name FROM nation
    UNION ALL SELECT 'in', 'n' || n_nationkey, 'r' || n_regionkey FROM nation""")
def _(v):
    """Nodes and relations as read back, one after the other."""
    at, r, n = _folder(v), v.table("region"), v.table("nation")
    key = lambda p, c: F.concat(F.lit(p), _s(c))
    nodes = r.select(key("r", "r_regionkey").alias("id"), F.col("r_name").alias("name"), F.lit("region").alias("label")).union(n.select(key("n", "n_nationkey"), "n_name", F.lit("nation")))
    sinks.write_graph(nodes, n.select(key("n", "n_nationkey").alias("src"), key("r", "n_regionkey").alias("dst"), F.lit("in").alias("relation")), at)
    back = lambda p, label: v.spark.read.csv(f"{at}/{p}", sep="\t", schema=f"a string, b string, {label} string").withColumnRenamed(label, "label").select("label", "a", "b")
    return back("nodes", "label").union(back("rel", "relation"))
