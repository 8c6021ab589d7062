"""Queries on sequences, reads and qualities."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..functions import text as t
from ..operators import sequences as ops
from .hits import ranked_globally

GC = "(length(seq) - length(replace(replace(seq, 'G', ''), 'C', '')))"


@query("a3_length_gc", f"SELECT id, length(seq) AS len, round(100.0 * {GC} / length(seq), 4) AS gc FROM bases WHERE length(seq) >= 1", "bases")
def _(v):
    return ops.length_gc(v.bases)


@query("a4_composition", "SELECT grp, CAST(sum(length(seq)) AS BIGINT) AS bases, " + ", ".join(f"round(100.0 * sum(length(seq) - length(replace(seq, '{b}', ''))) / sum(length(seq)), 6) AS pct_{b.lower()}" for b in "ATGCN") + " FROM bases GROUP BY 1", "bases")
def _(v):
    return ops.composition(v.bases, "grp")


@query("a5_length_histogram", "SELECT CAST(CASE WHEN length(seq) <= 5000 THEN ceil(length(seq) / 100.0) * 100 ELSE 5000 + ceil((length(seq) - 5000) / 1000.0) * 1000 END AS BIGINT) AS hi, count(*) AS n FROM seqs GROUP BY 1", "seqs")
def _(v):
    return ops.length_histogram(v.seqs, 100)


@query("a2_records_per_sample", "SELECT file, count(*) AS n FROM seqs GROUP BY 1", "seqs")
def _(v):
    return v.seqs.groupBy("file").agg(F.count("*").alias("n"))


@query("a25_dereplicate", "SELECT count(*) AS size, arg_min(id, ord) AS representative, md5(seq) AS seq_md5 FROM seqs GROUP BY seq", "seqs")
def _(v):
    return ops.dereplicate(v.seqs).select("size", "representative", F.md5("seq").alias("seq_md5"))


@query("a25_dereplicate_by_quality", "SELECT count(*) AS size, arg_min(id, (-(length(file) * 100 + ord % 7)) * 1000000 + ord) AS representative FROM seqs GROUP BY seq", "seqs")
def _(v):
    return ops.dereplicate(v.seqs, F.length("file") * 100 + F.col("ord") % 7).select("size", "representative")


@query("a25_cluster_members", "SELECT r.representative, s.id, s.ord FROM seqs s JOIN (SELECT seq, arg_min(id, ord) AS representative FROM seqs GROUP BY 1) r ON r.seq = s.seq", "seqs")
def _(v):
    return ops.cluster_members(v.seqs)


@query("a26_derep_pairs", """
    WITH p AS (SELECT pair, max(seq) FILTER (mate = 0) AS fwd, max(seq) FILTER (mate = 1) AS rev FROM reads GROUP BY 1)
    SELECT pair, n FROM (SELECT pair, length(coalesce(rev, '')) AS n, row_number() OVER (PARTITION BY left(fwd, 3), left(rev, 2) ORDER BY length(coalesce(rev, '')) DESC, pair) AS k FROM p) WHERE k = 1""", "reads")
def _(v):
    p = v.reads.groupBy("pair").agg(F.max(F.when(F.col("mate") == 0, F.col("seq"))).alias("fwd"), F.max(F.when(F.col("mate") == 1, F.col("seq"))).alias("rev"))
    p = p.select("pair", F.left("fwd", F.lit(3)).alias("a"), F.left("rev", F.lit(2)).alias("b"), F.length(F.coalesce("rev", F.lit(""))).cast("long").alias("n"))
    return ops.dereplicate_pairs(p, ["a", "b"], "n", "pair").select("pair", "n")


@query("a27_group_fractions", "SELECT r.representative, p.grp, round(p.n / CAST(r.t AS DOUBLE), 6) AS share FROM (SELECT seq, grp, count(*) AS n FROM seqs GROUP BY 1, 2) p JOIN (SELECT seq, count(*) AS t, arg_min(id, ord) AS representative FROM seqs GROUP BY 1) r USING (seq)", "seqs")
def _(v):
    return ops.group_fractions(v.seqs, "grp")


@query("a28_duplicate_ids", "SELECT query AS id, count(*) AS n FROM hits GROUP BY 1 HAVING count(*) > 1", "hits")
def _(v):
    return ops.duplicate_ids(v.hits.select(F.col("query").alias("id")), "id")


@query("a29_quality_classes", "SELECT class, n, round(100.0 * n / sum(n) OVER (), 6) AS percent FROM (SELECT CASE WHEN q > 30 THEN 'Q1' WHEN q > 20 THEN 'Q2' WHEN q > 10 THEN 'Q3' WHEN q > 0 THEN 'Q4' ELSE 'Zero' END AS class, count(*) AS n FROM quality GROUP BY 1)", "quality")
def _(v):
    return ops.quality_classes(v.quality)


@query("a30_read_lengths", "SELECT length(seq) AS len, count(*) AS n, round((SELECT avg(length(seq)) FROM reads), 6) AS mean FROM reads GROUP BY 1", "reads")
def _(v):
    n = v.reads.groupBy(F.length("seq").cast("long").alias("len")).agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.round(F.sum(F.col("len") * F.col("n")) / F.sum("n"), 6).alias("mean"))))


@query("n7_mean_quality", "SELECT id, round(avg(q), 6) AS mean, CAST(sum(q) AS BIGINT) AS total FROM quality GROUP BY 1", "quality")
def _(v):
    return v.quality.groupBy("id").agg(F.round(F.avg("q"), 6).alias("mean"), F.sum("q").alias("total"))


@query("f8_min_quality", "SELECT id, round(avg(q), 6) AS mean FROM quality GROUP BY 1 HAVING avg(q) >= 20", "quality")
def _(v):
    return v.quality.groupBy("id").agg(F.round(F.avg("q"), 6).alias("mean"), F.avg("q").alias("m")).where("m >= 20").drop("m")


@query("f8_string_quality", "SELECT ord, round(list_sum(list_transform(string_split(seq, ''), lambda c: ascii(c) - 33)) / CAST(length(seq) AS DOUBLE), 6) AS mean FROM seqs WHERE length(seq) > 0", "seqs")
def _(v):
    return v.seqs.where("length(seq) > 0").select("ord", F.round(t.mean_phred(F.col("seq")), 6).alias("mean"))


@query("f6_length_at_least", "SELECT id, length(seq) AS len FROM seqs WHERE length(seq) >= 1000", "seqs")
def _(v):
    return v.seqs.select("id", F.length("seq").cast("long").alias("len")).where("len >= 1000")


@query("f6_length_below", "SELECT id, length(seq) AS len FROM seqs WHERE length(seq) <= 300", "seqs")
def _(v):
    return v.seqs.select("id", F.length("seq").cast("long").alias("len")).where("len <= 300")


@query("f10_empty_sequences", "SELECT id FROM seqs WHERE length(regexp_replace(seq, '[^JKQXYZ]', '', 'g')) = 0", "seqs")
def _(v):
    """Of each sequence the rare letters; those without any are empty."""
    return v.seqs.where(F.length(F.regexp_replace("seq", "[^JKQXYZ]", "")) == 0).select("id")


@query("f2_header_tokens", "SELECT doc_id FROM documents WHERE list_has_any(string_split_regex(trim(upper(regexp_replace(text, '[^A-Za-z ]', ' ', 'g'))), '\\s+'), ['THE', 'WITH'])")
def _(v):
    from ..operators.hits import listed_tokens

    d = v.table("documents").select("doc_id", F.regexp_replace("text", "[^A-Za-z ]", " ").alias("header"))
    ids = v.spark.createDataFrame([("the",), ("with",)], "name string")
    return listed_tokens(d, ids, "header", "name").select("doc_id")


@query("f2_header_tokens_excluded", "SELECT doc_id FROM documents WHERE NOT list_has_any(string_split_regex(trim(upper(regexp_replace(text, '[^A-Za-z ]', ' ', 'g'))), '\\s+'), ['THE', 'WITH'])")
def _(v):
    from ..operators.hits import listed_tokens

    d = v.table("documents").select("doc_id", F.regexp_replace("text", "[^A-Za-z ]", " ").alias("header"))
    ids = v.spark.createDataFrame([("the",), ("with",)], "name string")
    return listed_tokens(d, ids, "header", "name", exclude=True).select("doc_id")


@query("f3_fuzzy_tokens", "SELECT s_suppkey FROM supplier WHERE list_has_any(string_split_regex(trim(regexp_replace(upper(s_name), '[^A-Z0-9=_/.]', ' ', 'g')), '\\s+'), ['SUPPLIER', '000000007'])")
def _(v):
    from ..operators.hits import listed_tokens

    ids = v.spark.createDataFrame([("Supplier",), ("000000007",)], "name string")
    return listed_tokens(v.table("supplier").withColumn("s_name", F.replace("s_name", F.lit("#"), F.lit(" "))), ids, "s_name", "name", fuzzy=True).select("s_suppkey")


@query("f7_length_and_gc", f"SELECT id, length(seq) AS len, round(100.0 * {GC} / length(seq), 4) AS gc FROM bases WHERE length(seq) >= 500", "bases")
def _(v):
    return ops.length_gc(v.bases, 500)


@query("p1_header_prefix", "SELECT id || '_' || grp AS header, length(seq) AS len FROM seqs", "seqs")
def _(v):
    return v.seqs.select(F.concat_ws("_", "id", "grp").alias("header"), F.length("seq").cast("long").alias("len"))


@query("p2_file_in_header", "SELECT file || '|' || id AS header FROM seqs", "seqs")
def _(v):
    return v.seqs.select(F.concat_ws("|", "file", "id").alias("header"))


@query("p3_beautify", "SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(p_name || ' (' || p_brand || ')', '\\s+', '_', 'g'), '[^A-Za-z0-9_]+', '_', 'g'), '_+', '_', 'g'), '_') AS header FROM part")
def _(v):
    return v.table("part").select("p_partkey", t.beautify(F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))).alias("header"))


@query("p4_running_alias", "SELECT id, lpad(CAST(row_number() OVER (ORDER BY ord) AS VARCHAR), 10, '0') AS alias FROM seqs", "seqs")
def _(v):
    return ranked_globally(v.seqs.select("id", "ord"), ["ord"]).select("id", F.lpad(F.col("place").cast("string"), 10, "0").alias("alias"))


@query("p5_curate_headers", "SELECT id, '>' || replace(substr('>' || id || '>' || grp, 2), '>', '+') AS header FROM seqs", "seqs")
def _(v):
    h = F.concat(F.lit(">"), F.col("id"), F.lit(">"), F.col("grp"))
    return v.seqs.select("id", F.concat(F.lit(">"), F.replace(F.substring(h, F.lit(2), F.length(h)), F.lit(">"), F.lit("+"))).alias("header"))


@query("p6_strip_comments", "SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(replace(text, chr(13), ''), chr(10))) AS line FROM documents) WHERE line <> '' AND NOT starts_with(line, 'T')")
def _(v):
    lines = v.table("documents").select("doc_id", F.explode(F.split(F.replace("text", F.lit("\r"), F.lit("")), "\n")).alias("line"))
    return lines.where((F.col("line") != "") & ~F.col("line").startswith("T"))


@query("p7_column_from_end", "SELECT p_partkey, split_part(p_name || ' ' || p_type, ' ', -1) AS last, split_part(p_name, ' ', 1) AS first FROM part")
def _(v):
    line = F.concat_ws(" ", "p_name", "p_type")
    return v.table("part").select("p_partkey", t.column_at(line, -1, " ").alias("last"), t.column_at(line, 1, " ").alias("first"))


@query("p9_u_to_t", "SELECT id, md5(replace(seq, 'U', 'T')) AS seq FROM seqs", "seqs")
def _(v):
    return v.seqs.select("id", F.md5(t.dna_letters(F.col("seq"))).alias("seq"))


@query("p10_degap", "SELECT doc_id, md5(trim(replace(text, '-', ''), '.')) AS seq FROM documents")
def _(v):
    return v.table("documents").select("doc_id", F.md5(t.degap(F.col("text"))).alias("seq"))


@query("p11_reverse_complement", "SELECT id, md5(translate(reverse(upper(seq)), 'ACGT', 'TGCA')) AS rc FROM bases", "bases")
def _(v):
    return v.bases.select("id", F.md5(t.reverse_complement(F.col("seq"))).alias("rc"))


@query("p12_gap_columns", """
    WITH c AS (SELECT ord, id, unnest(range(1, length(seq) + 1)) AS p, unnest(string_split(seq, '')) AS base FROM bases WHERE length(seq) > 0), a AS (SELECT id, p, CASE WHEN p % 3 = 0 OR base = 'N' THEN '-' ELSE base END AS c FROM c),
    k AS (SELECT DISTINCT p FROM a WHERE c <> '-') SELECT id, md5(coalesce(string_agg(c, '' ORDER BY a.p) FILTER (k.p IS NOT NULL), '')) AS seq FROM a LEFT JOIN k ON k.p = a.p GROUP BY 1""", "bases")
def _(v):
    a = v.bases.where("length(seq) > 0").select("id", F.regexp_replace(F.regexp_replace("seq", "(..).", "$1-"), "N", "-").alias("seq"))
    return ops.without_gap_columns(a).withColumn("seq", F.md5("seq"))


@query("p17_size_annotation", "SELECT replace(arg_min(file || ' ' || id, ord), ' ', '_') || ';size=' || count(*) || ';' AS header FROM seqs GROUP BY seq", "seqs")
def _(v):
    d = ops.dereplicate(v.seqs.withColumn("id", F.concat_ws(" ", "file", "id")))
    return d.select(F.concat(F.replace("representative", F.lit(" "), F.lit("_")), F.lit(";size="), F.col("size").cast("string"), F.lit(";")).alias("header"))


@query("j12_pair_reads", "SELECT pair, md5(f.seq) AS fwd, md5(r.seq) AS rev, CASE WHEN r.seq IS NULL THEN 'forward only' WHEN f.seq IS NULL THEN 'reverse only' ELSE 'pair' END AS kind FROM (SELECT * FROM reads WHERE mate = 0) f FULL JOIN (SELECT * FROM reads WHERE mate = 1) r USING (pair)", "reads")
def _(v):
    return ops.mates(v.reads).select("pair", F.md5("fwd").alias("fwd"), F.md5("rev").alias("rev"), "kind")


@query("j12b_positional_zip", "SELECT CAST(ord // 2 AS BIGINT) AS pair, md5(max(seq) FILTER (ord % 2 = 0)) AS fwd, md5(max(seq) FILTER (ord % 2 = 1)) AS rev FROM seqs GROUP BY 1", "seqs")
def _(v):
    return ops.interleaved(v.seqs.select(F.col("ord").alias("idx"), "seq")).select("pair", F.md5("fwd").alias("fwd"), F.md5("rev").alias("rev"))


@query("j16_subsequences", "SELECT id, ord % 50 + 20 AS start, ord % 13 + 1 AS stop, substr(seq, CAST(least(ord % 50 + 20, ord % 13 + 1) AS INTEGER), CAST(abs(ord % 50 + 20 - (ord % 13 + 1)) + 1 AS INTEGER)) AS seq FROM seqs", "seqs")
def _(v):
    places = v.seqs.select("id", (F.col("ord") % 50 + 20).alias("start"), (F.col("ord") % 13 + 1).alias("stop"))
    return ops.subsequences(v.seqs, places)


@query("o9_chop", """
    WITH n AS (SELECT id, seq, greatest(1, length(seq) // 500) AS n FROM seqs)
    SELECT id, CAST(i AS INTEGER) AS piece, length(s) AS len, md5(s) AS seq FROM (SELECT id, i, CASE WHEN i < n - 1 THEN substr(seq, CAST(i * 500 + 1 AS INTEGER), 500) ELSE substr(seq, CAST(i * 500 + 1 AS INTEGER)) END AS s FROM n, LATERAL (SELECT unnest(range(n)) AS i))""", "seqs")
def _(v):
    return ops.chop(v.seqs, 500).select("id", "piece", F.length("seq").cast("long").alias("len"), F.md5("seq").alias("seq"))


@query("o8_chop_overlapping", "SELECT id, CAST(i // 400 + 1 AS INTEGER) AS part, md5(substr(seq, CAST(i + 1 AS INTEGER), 500)) AS seq FROM seqs, LATERAL (SELECT unnest(CASE WHEN length(seq) > 100 THEN range(0, length(seq) - 100, 400) ELSE [0] END) AS i)", "seqs")
def _(v):
    return ops.chop_overlapping(v.seqs, 500, 100).select("id", "part", F.md5("seq").alias("seq"))


@query("o7_file_parts", "SELECT id, (row_number() OVER (ORDER BY ord) - 1) // 100 AS part FROM seqs", "seqs")
def _(v):
    return ops.numbered(v.seqs.select("id", "ord"), ["ord"], 100).select("id", "part")


@query("w15_running_ids", "SELECT id, 'c' || row_number() OVER (ORDER BY length(seq) DESC, ord) AS cluster FROM seqs", "seqs")
def _(v):
    s = v.seqs.select("id", "ord", F.length("seq").alias("n"))
    return ranked_globally(s, [F.desc("n"), "ord"]).select("id", F.concat(F.lit("c"), F.col("place").cast("string")).alias("cluster"))


@query("w12_glue_pieces", "SELECT id || '.0' || CASE WHEN n > 1 THEN '-' || (n - 1) ELSE '' END AS id, md5(seq) AS seq FROM (SELECT id, seq, greatest(1, length(seq) // 500) AS n FROM seqs)", "seqs")
def _(v):
    from ..operators.coverage import glue

    return glue(ops.chop(v.seqs, 500).select(F.col("id").alias("contig"), F.col("piece").alias("chunk"), "seq")).select("id", F.md5("seq").alias("seq"))


@query("w8_gc_skew", """
    WITH w AS (SELECT id, i AS start, substr(seq, CAST(i + 1 AS INTEGER), 100) AS w FROM bases, LATERAL (SELECT unnest(range(0, length(seq) - 99, 80)) AS i) WHERE length(seq) > 1000),
    n AS (SELECT id, start, length(w) - length(replace(w, 'C', '')) AS c, length(w) - length(replace(w, 'G', '')) AS g FROM w)
    SELECT id, CAST(start AS INTEGER) AS start, CAST(start + 80 AS INTEGER) AS stop, round((c + g) * 100.0 / 100, 6) AS gc, CASE WHEN c + g = 0 THEN 0.0 ELSE round((c - g) * 100.0 / (c + g), 6) END AS skew FROM n""", "bases")
def _(v):
    return ops.gc_skew(v.bases, 100, 20)


@query("a41_kmer_count", "SELECT kmer, count(*) AS n FROM (SELECT substr(seq, CAST(i AS INTEGER), 4) AS kmer FROM bases, LATERAL (SELECT unnest(range(1, length(seq) - 2)) AS i)) WHERE NOT contains(kmer, 'N') GROUP BY 1", "bases")
def _(v):
    return ops.kmer_counts(v.bases, 4)


@query("a41_kmer_both_strands", """
    WITH k AS (SELECT kmer, translate(reverse(kmer), 'ACGT', 'TGCA') AS rc, count(*) AS n FROM (SELECT substr(seq, CAST(i AS INTEGER), 4) AS kmer FROM bases, LATERAL (SELECT unnest(range(1, length(seq) - 2)) AS i)) WHERE NOT contains(kmer, 'N') GROUP BY 1)
    SELECT least(kmer, rc) AS kmer, CAST(sum(CASE WHEN kmer = rc THEN 2 * n ELSE n END) AS BIGINT) AS n FROM k GROUP BY 1""", "bases")
def _(v):
    return ops.kmer_counts(v.bases, 4, both_strands=True)


@query("a42_kmer_frequencies", """
    WITH k AS (SELECT id, least(kmer, translate(reverse(kmer), 'ACGT', 'TGCA')) AS kmer, count(*) AS n FROM (SELECT id, substr(seq, CAST(i AS INTEGER), 2) AS kmer FROM bases, LATERAL (SELECT unnest(range(1, length(seq))) AS i)) WHERE NOT contains(kmer, 'N') GROUP BY 1, 2)
    SELECT id, kmer, n / CAST(sum(n) OVER (PARTITION BY id) AS DOUBLE) AS share FROM k""", "bases")
def _(v):
    return ops.kmer_frequencies(v.bases, 2)


@query("n4_kmers_without_stops", "SELECT kmer, count(*) AS n FROM (SELECT substr(seq, CAST(i AS INTEGER), 4) AS kmer FROM bases, LATERAL (SELECT unnest(range(1, length(seq) - 2)) AS i)) WHERE NOT regexp_matches(kmer, '^(ATG|TAG|TAA|TGA)|(ATG|TAG|TAA|TGA)$|N') GROUP BY 1", "bases")
def _(v):
    return ops.kmer_counts(v.bases, 4).where(~F.col("kmer").rlike("^(ATG|TAG|TAA|TGA)|(ATG|TAG|TAA|TGA)$"))


def places(pattern: str, select: str) -> str:
    """SQL for where a pattern matches: the lengths of matches and of what lies between, summed."""
    return f"""
    WITH m AS (SELECT id, regexp_extract_all(seq, '{pattern}') AS r, string_split_regex(seq, '{pattern}') AS s FROM bases), e AS (SELECT id, generate_subscripts(r, 1) AS k, unnest(r) AS r, unnest(s[1:len(r)]) AS s FROM m WHERE len(r) > 0),
    p AS (SELECT id, CAST(length(r) AS INTEGER) AS len, CAST(sum(length(r) + length(s)) OVER (PARTITION BY id ORDER BY k ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop FROM e)
    {select}"""


@query("r1_find_runs", places("[ACN]{6,}", "SELECT id, stop - len AS start, stop, len FROM p"), "bases")
def _(v):
    """Runs of A, C or N of six and more."""
    return ops.character_runs(v.bases, "ACN", 6)


@query("r1_run_counts", "SELECT id, CAST(len(regexp_extract_all(seq, '[ACN]{6,}')) AS BIGINT) AS n, list_max(list_transform(regexp_extract_all(seq, '[ACN]{6,}'), lambda x: length(x))) AS longest FROM bases WHERE regexp_matches(seq, '[ACN]{6,}')", "bases")
def _(v):
    return ops.character_runs(v.bases, "ACN", 6).groupBy("id").agg(F.count("*").alias("n"), F.max("len").cast("long").alias("longest"))


@query("r2_split_at_runs", "SELECT id, md5(s) AS seq FROM (SELECT id, string_split_regex(seq, '[ACN]{8,}') AS p FROM bases), LATERAL (SELECT unnest(p) AS s, generate_subscripts(p, 1) AS k) WHERE length(s) >= 40 OR (k = len(p) AND length(s) > 0)", "bases")
def _(v):
    return ops.split_at_runs(v.bases, "ACN", 8, 40).select("id", F.md5("seq").alias("seq"))


@query("r3_pattern_positions", places("ACGT", "SELECT id, stop - len AS start, stop FROM p"), "bases")
def _(v):
    """Places of ACGT in each sequence."""
    return ops.find_all(v.bases, "ACGT")


@query("r4_spacers", places("ACGT", "SELECT id, start, stop FROM (SELECT id, lag(stop, 1, 0) OVER (PARTITION BY id ORDER BY stop) AS start, stop - len AS stop FROM p) WHERE stop - start <= 200 AND stop >= start"), "bases")
def _(v):
    return ops.spacers(ops.find_all(v.bases, "ACGT"), 200)


@query("o10_sample", "SELECT count(*) > 0 AS some FROM reads", "reads")
def _(v):
    s = ops.sampled(v.reads, "pair", 0.5)
    return s.agg((F.count("*") > 0).alias("some"))


@query("o10_sampled_pairs", "SELECT pair, mate FROM reads WHERE left(md5('1/' || pair), 8) < '80000000'", "reads")
def _(v):
    """Half of the pairs, both mates or none."""
    return ops.sampled(v.reads, "pair", 0.5).select("pair", "mate")


@query("o11_exact_sample", "SELECT id FROM seqs ORDER BY md5('1/' || id), id LIMIT 50", "seqs")
def _(v):
    return ops.exact_sample(v.seqs.select("id"), "id", 50)


@query("o12_sampled_groups", "SELECT id, file FROM seqs WHERE file IN (SELECT file FROM (SELECT DISTINCT file FROM seqs) ORDER BY md5('1/' || file), file LIMIT 5)", "seqs")
def _(v):
    """All rows of 5 of the files, chosen by hash."""
    files = ops.exact_sample(v.seqs.select("file").distinct(), "file", 5)
    return v.seqs.join(F.broadcast(files), "file", "left_semi").select("id", "file")


@query("w10_column_ranks", """
    WITH c AS (SELECT ord, CAST(unnest(range(length(seq))) AS INTEGER) AS pos, unnest(string_split(seq, '')) AS base FROM bases WHERE length(seq) > 0),
    n AS (SELECT pos, base, count(*) AS n, min(ord) AS seen FROM c GROUP BY 1, 2) SELECT pos, base, n, row_number() OVER (PARTITION BY pos ORDER BY n DESC, seen) AS rank FROM n""", "bases")
def _(v):
    return ops.column_ranks(v.bases.select("ord", "seq")).withColumn("rank", F.col("rank").cast("long"))


@query("w11_frequency_labels", "SELECT grp, chr(CAST(96 + row_number() OVER (ORDER BY count(*) DESC, grp) AS INTEGER)) AS label, count(*) AS n FROM seqs GROUP BY 1", "seqs")
def _(v):
    from pyspark.sql import Window as W

    n = v.seqs.groupBy("grp").agg(F.count("*").alias("n"))
    # the groups are as many as the alphabet at most; others get blanks
    k = F.row_number().over(W.orderBy(F.desc("n"), "grp"))
    return n.withColumn("k", k).select("grp", F.when(F.col("k") <= 26, F.char(F.col("k") + 96)).otherwise("").alias("label"), "n")


@query("m11_closest_sequence")
def _(v):
    """Global alignment score (match 1, mismatch -1, gap -1) of every part's name against the names of all nations, the best first."""
    from ..operators.alignment import closest

    names = v.table("part").select(F.col("p_partkey").cast("string").alias("id"), F.upper("p_name").alias("seq"))
    return closest(names, v.table("nation").select(F.col("n_name").alias("ref"), F.col("n_name").alias("ref_seq")))


@query("m11_closest_name")
def _(v):
    """The part whose name is closest to each part's name without its e's: most have a near one, which the index finds."""
    from ..operators.alignment import closest

    part = v.table("part").select(F.col("p_partkey").cast("string").alias("id"), "p_name")
    return closest(part.select("id", F.translate("p_name", "e", "").alias("seq")), part.select(F.col("id").alias("ref"), F.col("p_name").alias("ref_seq")))


@query("x10_header_codec", """
    WITH h AS (SELECT id, file || ' ' || id AS header FROM seqs), b AS (SELECT id, header, list_reduce(list_transform(range(0, octet_length(encode(header))), lambda i: lpad(bin(CAST('0x' || substr(hex(encode(header)), CAST(2 * i + 1 AS INTEGER), 2) AS INTEGER)), 8, '0')), lambda x, y: x || y) AS bits FROM h),
    g AS (SELECT id, header, list_transform(range(0, CAST(ceil(length(bits) / 5.0) AS BIGINT)), lambda i: rpad(substr(bits, CAST(5 * i + 1 AS INTEGER), 5), 5, '0')) AS g FROM b)
    SELECT id, list_reduce(list_transform(g, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(list_sum(list_transform(range(1, 6), lambda j: CAST(substr(x, CAST(j AS INTEGER), 1) AS INTEGER) * (CASE j WHEN 1 THEN 16 WHEN 2 THEN 8 WHEN 3 THEN 4 WHEN 4 THEN 2 ELSE 1 END))) + 1 AS INTEGER), 1)), lambda x, y: x || y) AS code, header FROM g""", "seqs")
def _(v):
    """Headers as base32 and back."""
    h = F.concat_ws(" ", "file", "id")
    return v.seqs.select("id", t.base32(h).alias("code"), t.from_base32(t.base32(h)).alias("header"))


@query("r5_masked_islands", "SELECT id, md5(regexp_replace(seq, 'N([ACGT]{1,5})N', 'NZN', 'g')) AS seq FROM bases", "bases")
def _(v):
    """Short islands between ambiguous bases are masked."""
    return v.bases.select("id", F.md5(F.regexp_replace("seq", "N([ACGT]{1,5})N", "NZN")).alias("seq"))


@query("u5_sql_functions", "SELECT id, md5(translate(reverse(upper(seq)), 'ACGT', 'TGCA')) AS rc, len(regexp_extract_all(seq, '[AC]{5,}')) AS runs FROM bases", "bases")
def _(v):
    from ..functions.register import register

    register(v.spark)
    return v.bases.select("id", F.expr("md5(revcomp(seq))").alias("rc"), F.expr("cast(count_runs(seq, 'AC', 5) as long)").alias("runs"))


@query("a42_kmer_vectors", """
    WITH k AS (SELECT id, substr(seq, CAST(i AS INTEGER), 1) AS c FROM bases, LATERAL (SELECT unnest(range(1, length(seq) + 1)) AS i))
    SELECT id, """ + ", ".join(f"round(count(*) FILTER (c = '{c}') / CAST(count(*) FILTER (c <> 'N') AS DOUBLE), 6) AS {c}" for c in "ACGT") + " FROM k GROUP BY 1 HAVING count(*) FILTER (c <> 'N') > 0", "bases")
def _(v):
    """The wide form of 1-mer shares: what a self-organising map is trained on."""
    k = ops.exploded_kmers(v.bases, 1).withColumnRenamed("kmer", "c")
    n = k.groupBy("id").pivot("c", list("ACGT")).agg(F.count(F.lit(1))).na.fill(0)
    total = sum(F.col(c) for c in "ACGT")
    return n.select("id", *(F.round(F.col(c) / total, 6).alias(c) for c in "ACGT"))
