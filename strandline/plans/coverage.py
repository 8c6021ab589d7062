"""Queries on coverage, contigs, chunks and intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..operators import coverage as ops

PER = "(SELECT contig, sum(depth * bases) AS x, max(len) AS len FROM cov GROUP BY 1)"


@query("a7_coverage_per_scaffold", "SELECT contig, round(sum(depth * bases) / CAST(max(len) AS DOUBLE), 6) AS coverage, max(len) AS len FROM cov WHERE depth >= 10 GROUP BY 1", "cov")
def _(v):
    return ops.scaffold_coverage(v.cov, 10)


@query("a8_merge_coverage", "SELECT c.contig, " + ", ".join(f"coalesce(round(sum(depth * bases) FILTER (sample = {s}) / CAST(max(cov.len) FILTER (sample = {s}) AS DOUBLE), 6), 0.0) AS s{s}" for s in range(5)) + " FROM contigs c LEFT JOIN cov ON cov.contig = c.contig GROUP BY 1", "cov contigs")
def _(v):
    return ops.merge_coverage(v.contigs, v.cov, range(5))


@query("a8_length_conflicts", "SELECT contig, count(DISTINCT len) AS lengths FROM (SELECT contig, len + CASE WHEN depth = 50 THEN 1 ELSE 0 END AS len FROM cov) GROUP BY 1 HAVING count(DISTINCT len) > 1", "cov")
def _(v):
    return ops.inconsistent_lengths(v.cov.withColumn("len", F.col("len") + (F.col("depth") == 50).cast("long")))


@query("a9_bin_coverage", f"SELECT bin, round(sum(x) / CAST(sum(p.len) AS DOUBLE), 6) AS coverage, count(*) AS contigs FROM {PER} p JOIN contigs USING (contig) GROUP BY 1", "cov contigs")
def _(v):
    return ops.bin_coverage(v.cov, v.contigs.select("contig", "bin"))


@query("a10_bin_mean_coverage", f"SELECT bin, round(avg(c), 6) AS coverage, count(*) AS scaffolds FROM (SELECT contig, round(x / CAST(len AS DOUBLE), 6) AS c FROM {PER}) JOIN contigs USING (contig) WHERE c >= 1 GROUP BY 1", "cov contigs")
def _(v):
    return ops.bin_mean_coverage(v.cov, v.contigs.select("contig", "bin"), 1)


@query("a10_multi_binned", "SELECT contig, count(DISTINCT bin) AS bins FROM chunks GROUP BY 1 HAVING count(DISTINCT bin) > 1", "chunks")
def _(v):
    return ops.multi_binned(v.chunks)


@query("a21_bin_summary", "SELECT bin, count(*) AS contigs, CAST(sum(len) AS BIGINT) AS bases, round(avg(gc), 6) AS gc, round(count(*) / CAST((SELECT count(*) FROM contigs) AS DOUBLE), 6) AS share FROM contigs GROUP BY 1", "contigs")
def _(v):
    return ops.bin_summary(v.contigs)


@query("j4_left_zero", "SELECT contig, coalesce(CAST(sum(length) AS BIGINT), 0) AS aligned FROM contigs LEFT JOIN hits ON subject = contig AND bitscore > 80000 GROUP BY 1", "contigs hits")
def _(v):
    n = v.hits.where("bitscore > 80000").groupBy(F.col("subject").alias("contig")).agg(F.sum("length").alias("aligned"))
    return v.contigs.select("contig").join(n, "contig", "left").na.fill(0)


@query("j5_outer_merge", "SELECT coalesce(a.bin, b.bin) AS bin, a.contigs, b.n FROM (SELECT bin, count(*) AS contigs FROM contigs WHERE len < 100 GROUP BY 1) a FULL JOIN (SELECT bin, count(*) AS n FROM contigs WHERE len > 450 GROUP BY 1) b ON a.bin = b.bin", "contigs")
def _(v):
    a = v.contigs.where("len < 100").groupBy("bin").agg(F.count("*").alias("contigs"))
    b = v.contigs.where("len > 450").groupBy("bin").agg(F.count("*").alias("n"))
    return a.join(b, "bin", "full").select("bin", "contigs", "n")


@query("j18_bin_membership", "SELECT bin, contig, name FROM contigs WHERE len >= 300", "contigs")
def _(v):
    return v.contigs.select("contig", "name", "len").join(v.contigs.where("len >= 300").select("contig", "bin"), "contig").select("bin", "contig", "name")


@query("a23_majority_bin", """
    WITH p AS (SELECT contig, bin, count(*) AS n FROM chunks GROUP BY 1, 2),
    t AS (SELECT contig, CAST(sum(n) AS BIGINT) AS chunks, count(*) AS bins, max(n) AS m FROM p GROUP BY 1)
    SELECT t.contig, chunks, CASE WHEN m * 2 > chunks THEN (SELECT max(bin) FROM p WHERE p.contig = t.contig AND p.n = t.m) END AS bin, m * 2 <= chunks AND bins > 1 AS ambiguous FROM t""", "chunks")
def _(v):
    return ops.majority_bins(v.chunks)


@query("g2_cross_bin_edges", "WITH d AS (SELECT DISTINCT contig, bin FROM chunks WHERE bin IS NOT NULL) SELECT x.bin AS a, y.bin AS b, count(*) AS contigs FROM d x JOIN d y ON x.contig = y.contig AND x.bin < y.bin GROUP BY 1, 2", "chunks")
def _(v):
    return ops.cross_bin_edges(v.chunks)


@query("a24_split_contigs", """
    SELECT contig, count(DISTINCT bin) AS bins, array_to_string(list_filter(range(1, max(chunk) + 1), lambda x: NOT list_contains(list(chunk), x)), ',') AS missing FROM chunks GROUP BY 1 HAVING count(DISTINCT bin) > 1""", "chunks")
def _(v):
    return ops.split_contigs(v.chunks)


@query("w12_unchop_runs", "SELECT contig, min(chunk) AS first, max(chunk) AS last, count(*) AS n FROM (SELECT contig, chunk, chunk - row_number() OVER (PARTITION BY contig ORDER BY chunk) AS island FROM chunks) GROUP BY contig, island", "chunks")
def _(v):
    return ops.runs(v.chunks)


@query("w13_consecutive", "SELECT contig, max(chunk) = count(DISTINCT chunk) AS complete, count(DISTINCT chunk) AS n FROM chunks GROUP BY 1", "chunks")
def _(v):
    return ops.consecutive(v.chunks)


@query("a22_class_loyalty", "SELECT contig, bin, n / CAST(t AS DOUBLE) AS loyalty FROM (SELECT contig, bin, count(*) AS n, sum(count(*)) OVER (PARTITION BY contig) AS t FROM chunks GROUP BY 1, 2) WHERE bin IS NOT NULL AND n / CAST(t AS DOUBLE) >= 0.5", "chunks")
def _(v):
    per = v.chunks.groupBy("contig", "bin").agg(F.count("*").alias("n"))
    total = v.chunks.groupBy("contig").agg(F.count("*").alias("t"))
    return per.where("bin is not null").join(total, "contig").withColumn("loyalty", F.col("n") / F.col("t")).where("loyalty >= 0.5").select("contig", "bin", "loyalty")


N50 = """
    WITH r AS (SELECT {g} AS bin, {c} AS len, sum({c}) OVER (PARTITION BY {g} ORDER BY {c} DESC, {i} ROWS UNBOUNDED PRECEDING) AS cum, row_number() OVER (PARTITION BY {g} ORDER BY {c} DESC, {i}) AS k, sum({c}) OVER (PARTITION BY {g}) AS t FROM {f})
    SELECT bin, max(len) AS n, min(k) AS l FROM r WHERE cum >= {s} * t GROUP BY 1"""


@query("a6_n50", N50.format(g="bin", c="len", i="contig", s=0.5, f="contigs"), "contigs")
def _(v):
    return ops.n50(v.contigs, "bin")


@query("a6_n95", N50.format(g="bin", c="len", i="contig", s=0.95, f="contigs"), "contigs")
def _(v):
    return ops.n50(v.contigs, "bin", share=0.95)


@query("w5_cumulative_lengths", "SELECT contig, bin, CAST(sum(len) OVER (PARTITION BY bin ORDER BY len DESC, contig ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum FROM contigs", "contigs")
def _(v):
    from pyspark.sql import Window as W

    return v.contigs.select("contig", "bin", F.sum("len").over(W.partitionBy("bin").orderBy(F.desc("len"), "contig").rowsBetween(W.unboundedPreceding, 0)).alias("cum"))


@query("w6_concatenated_offset", "SELECT contig, bin, CAST(coalesce(sum(len) OVER (PARTITION BY bin ORDER BY contig ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset_ FROM contigs", "contigs")
def _(v):
    return ops.offsets(v.contigs, "bin", "contig", "len").select("contig", "bin", F.col("offset").alias("offset_"))


@query("a38_depth_profile", """
    WITH e AS (SELECT scaffold, start AS pos, 1 AS d FROM features UNION ALL SELECT scaffold, stop + 1, -1 FROM features), s AS (SELECT scaffold, pos, sum(d) AS d FROM e GROUP BY 1, 2)
    SELECT * FROM (SELECT scaffold, pos AS start, lead(pos) OVER w - 1 AS stop, CAST(sum(d) OVER w AS BIGINT) AS depth FROM s WINDOW w AS (PARTITION BY scaffold ORDER BY pos)) WHERE depth > 0""", "features")
def _(v):
    return ops.depth_profile(v.features)


@query("a39_covered_islands", """
    WITH m AS (SELECT scaffold, start, stop, CASE WHEN start <= max(stop) OVER (PARTITION BY scaffold ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS new FROM features),
    i AS (SELECT *, sum(new) OVER (PARTITION BY scaffold ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS island FROM m)
    SELECT scaffold, min(start) AS start, max(stop) AS stop, count(*) AS n FROM i GROUP BY scaffold, island HAVING max(stop) - min(start) + 1 >= 10""", "features")
def _(v):
    return ops.covered_islands(v.features, least=10)


@query("a38_mean_depth", "SELECT scaffold, round(sum(stop - start + 1) / 2700.0, 6) AS depth FROM features GROUP BY 1", "features")
def _(v):
    d = ops.depth_profile(v.features)
    return d.groupBy("scaffold").agg(F.round(F.sum((F.col("stop") - F.col("start") + 1) * F.col("depth")) / F.lit(2700.0), 6).alias("depth"))


@query("j14_interval_overlap", "SELECT f.locus, f.scaffold, f.start, f.stop, g.gene AS r_gene, g.start AS r_start, g.stop AS r_stop FROM features f JOIN genes g ON f.scaffold = g.scaffold AND f.start <= g.stop AND g.start <= f.stop", "features genes")
def _(v):
    return ops.overlap_join(v.features.select("locus", "scaffold", "start", "stop"), v.genes, "scaffold").select("locus", "scaffold", "start", "stop", "r_gene", "r_start", "r_stop")


@query("j15_interval_clip", "SELECT locus, greatest(start, 500) AS start, least(stop, 900) AS stop FROM features WHERE stop >= 500 AND start <= 900", "features")
def _(v):
    return ops.clip(v.features, 500, 900).select("locus", "start", "stop")


@query("w7_binned_mean", "SELECT contig, depth // 10 AS bin, round(avg(bases), 6) AS mean, count(*) AS n FROM cov GROUP BY 1, 2", "cov")
def _(v):
    d = v.cov.select("contig", F.col("depth").alias("pos"), F.col("bases").alias("depth"))
    return ops.binned_means(d, "contig", 10).withColumn("bin", F.col("bin").cast("int"))


@query("a44_region_stats", "SELECT contig, round(sum(depth * bases) / CAST(sum(bases) AS DOUBLE), 6) AS mean_depth, round(count(*) / CAST(max(len) AS DOUBLE), 6) AS reads_per_base FROM cov WHERE depth > 0 GROUP BY 1", "cov")
def _(v):
    return v.cov.where("depth > 0").groupBy("contig").agg(F.round(F.sum(F.col("depth") * F.col("bases")) / F.sum("bases").cast("double"), 6).alias("mean_depth"), F.round(F.count("*") / F.max("len").cast("double"), 6).alias("reads_per_base"))


@query("a43_reads_per_contig", "SELECT subject AS contig, count(DISTINCT query) AS reads FROM hits GROUP BY 1", "hits")
def _(v):
    return v.hits.groupBy(F.col("subject").alias("contig")).agg(F.count_distinct("query").alias("reads"))


@query("a20_marker_completeness", "SELECT bin, round(100.0 * count(DISTINCT kind) / 36, 6) AS completeness, count(*) AS copies FROM contigs WHERE kind IN ('ECONOMY', 'STANDARD', 'PROMO') GROUP BY 1", "contigs")
def _(v):
    markers = v.spark.createDataFrame([("ECONOMY",), ("STANDARD",), ("PROMO",)], "kind string")
    return v.contigs.join(F.broadcast(markers), "kind", "left_semi").groupBy("bin").agg(F.round(100.0 * F.count_distinct("kind") / 36, 6).alias("completeness"), F.count("*").alias("copies"))


@query("f13_min_feature_length", "SELECT locus, abs(start - stop) + 1 AS len FROM features WHERE abs(start - stop) + 1 >= 20", "features")
def _(v):
    n = F.abs(F.col("start") - F.col("stop")) + 1
    return v.features.where(n >= 20).select("locus", n.alias("len"))


@query("r6_partial_flags", "SELECT locus, CASE WHEN start <= 10 AND stop - start <= 300 THEN '<' ELSE '' END AS head, CASE WHEN stop >= 2400 AND stop - start <= 300 THEN '>' ELSE '' END AS tail, CASE WHEN strand = 'F' THEN stop ELSE start END AS first FROM features", "features")
def _(v):
    short = F.col("stop") - F.col("start") <= 300
    return v.features.select("locus", F.when((F.col("start") <= 10) & short, "<").otherwise("").alias("head"), F.when((F.col("stop") >= 2400) & short, ">").otherwise("").alias("tail"), F.when(F.col("strand") == "F", F.col("stop")).otherwise(F.col("start")).alias("first"))


@query("w16_exon_numbers", "SELECT locus, scaffold, row_number() OVER (PARTITION BY scaffold ORDER BY start, locus) AS exon FROM features", "features")
def _(v):
    from pyspark.sql import Window as W

    return v.features.select("locus", "scaffold", F.row_number().over(W.partitionBy("scaffold").orderBy("start", "locus")).cast("long").alias("exon"))
