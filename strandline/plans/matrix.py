"""Queries on community matrices and numeric columns."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..catalog import query
from ..operators import matrix as ops

SIZED = "(SELECT *, sum(count) OVER (PARTITION BY sample) AS size FROM matrix)"


@query("m1_pick_samples", "SELECT * FROM matrix WHERE sample IN (SELECT sample FROM meta WHERE grp = 'g1')", "matrix meta")
def _(v):
    return ops.picked(v.matrix, v.meta.where("grp = 'g1'"), "sample")


@query("m1_remove_samples", "SELECT * FROM matrix WHERE sample NOT IN (SELECT sample FROM meta WHERE grp = 'g1')", "matrix meta")
def _(v):
    return ops.picked(v.matrix, v.meta.where("grp = 'g1'"), "sample", remove=True)


@query("m2_pick_otus", "SELECT * FROM matrix WHERE otu IN (SELECT otu FROM matrix GROUP BY 1 HAVING sum(count) >= 20)", "matrix")
def _(v):
    return ops.picked(v.matrix, v.matrix.groupBy("otu").agg(F.sum("count").alias("n")).where("n >= 20"), "otu")


@query("m3_rows", "SELECT sample, string_agg(otu || '=' || count, ',' ORDER BY otu) AS counts FROM matrix GROUP BY 1", "matrix")
def _(v):
    pairs = F.array_sort(F.collect_list(F.struct("otu", "count")))
    return v.matrix.groupBy("sample").agg(F.array_join(F.transform(pairs, lambda x: F.concat_ws("=", x["otu"], x["count"].cast("string"))), ",").alias("counts"))


@query("m4_abundance_floor", f"SELECT sample, otu, count FROM {SIZED} WHERE count >= size / 100.0", "matrix")
def _(v):
    return ops.abundance_floor(v.matrix, 100.0)


@query("m4_removed", f"SELECT sample, CAST(sum(count) AS BIGINT) AS reads, count(*) AS otus, max(count) AS largest FROM {SIZED} WHERE count < size / 100.0 GROUP BY 1", "matrix")
def _(v):
    return ops.removed_by_floor(v.matrix, 100.0)


@query("m5_merge_otus", "SELECT sample, CASE WHEN otu LIKE 'click%' THEN 'click_0' ELSE otu END AS otu, CAST(sum(count) AS BIGINT) AS count FROM matrix GROUP BY 1, 2", "matrix")
def _(v):
    groups = v.matrix.select("otu").distinct().where("otu like 'click%'").withColumn("leader", F.lit("click_0"))
    return ops.merged(v.matrix, groups)


PAIRS = """p AS (SELECT sample, otu FROM matrix GROUP BY 1, 2), n AS (SELECT sample, count(*) AS n FROM p GROUP BY 1),
    b AS (SELECT x.sample AS a, y.sample AS b, count(*) AS shared FROM p x JOIN p y ON x.otu = y.otu AND x.sample < y.sample GROUP BY 1, 2),
    j AS (SELECT a, b, shared, round(shared / CAST(na.n + nb.n - shared AS DOUBLE), 6) AS jaccard FROM b JOIN n na ON na.sample = a JOIN n nb ON nb.sample = b)"""


@query("m6_jaccard_pairs", f"WITH {PAIRS} SELECT * FROM j", "matrix")
def _(v):
    return ops.jaccard_pairs(v.matrix)


@query("m6_jaccard_by_group", f"WITH {PAIRS} SELECT ga.grp, round(avg(jaccard), 6) AS mean, count(*) AS pairs FROM j JOIN meta ga ON ga.sample = a JOIN meta gb ON gb.sample = b AND gb.grp = ga.grp GROUP BY 1", "matrix meta")
def _(v):
    return ops.jaccard_by_group(v.matrix, v.meta)


@query("m7_select_by_metadata", f"SELECT 'x-' || s.sample AS sample, otu, count FROM {SIZED} s JOIN meta m ON m.sample = s.sample WHERE grp = 'g1' AND site <> '0' AND size >= 100", "matrix meta")
def _(v):
    kept = ops.large_samples(ops.picked(v.matrix, v.meta.where("grp = 'g1' and site <> '0'"), "sample"), 100)
    return kept.withColumn("sample", F.concat(F.lit("x-"), "sample"))


@query("f11_metadata_query", "SELECT * FROM meta WHERE grp = 'g2' AND site <> '1'", "meta")
def _(v):
    return v.meta.where((F.col("grp") == "g2") & (F.col("site") != "1"))


@query("f12_min_sample_size", f"SELECT sample, otu, count FROM {SIZED} WHERE size >= 250", "matrix")
def _(v):
    return ops.large_samples(v.matrix, 250)


ACC = "SELECT otu, 'A' || lpad(CAST(row_number() OVER (ORDER BY sum(count) DESC, otu) AS VARCHAR), 4, '0') AS accession FROM matrix {w} GROUP BY 1"


@query("w14_accessions", ACC.format(w=""), "matrix")
def _(v):
    return ops.accessions(v.matrix, "A", width=4)


@query("m8_renumber_keeping_known", ACC.format(w="WHERE otu NOT LIKE 'view%'") + " UNION ALL SELECT DISTINCT otu, 'K' || otu FROM matrix WHERE otu LIKE 'view%'", "matrix")
def _(v):
    known = v.matrix.select("otu").distinct().where("otu like 'view%'").withColumn("accession", F.concat(F.lit("K"), "otu"))
    return ops.accessions(v.matrix, "A", known, 4)


@query("d5_single_sample_otus", "SELECT otu, min(sample) AS sample, CAST(sum(count) AS BIGINT) AS count FROM (SELECT * FROM matrix WHERE count >= 5) GROUP BY 1 HAVING count(DISTINCT sample) = 1", "matrix")
def _(v):
    return ops.single_sample_otus(v.matrix.where("count >= 5"))


@query("d6_zero_trim", "SELECT otu, CAST(sum(c) AS BIGINT) AS total FROM (SELECT otu, CASE WHEN count > 2 THEN count ELSE 0 END AS c FROM matrix) GROUP BY 1 HAVING sum(c) > 0", "matrix")
def _(v):
    m = v.matrix.withColumn("count", F.when(F.col("count") > 2, F.col("count")).otherwise(0))
    return ops.nonzero(m).groupBy("otu").agg(F.sum("count").alias("total"))


@query("a34_sample_sizes", "SELECT sample, CAST(sum(count) AS BIGINT) AS size FROM matrix GROUP BY 1", "matrix")
def _(v):
    return ops.sample_sizes(v.matrix)


@query("a34_prevalence", "SELECT otu, count(*) AS samples FROM matrix WHERE count >= 3 GROUP BY 1", "matrix")
def _(v):
    return ops.prevalence(v.matrix, 3)[1]


@query("a34_richness", "SELECT sample, count(*) AS otus FROM matrix WHERE count >= 3 GROUP BY 1", "matrix")
def _(v):
    return ops.prevalence(v.matrix, 3)[0]


NORM = "WITH s AS (SELECT sample, sum(count) AS size FROM matrix GROUP BY 1) SELECT sample, otu, CAST(greatest(1, floor(count * {f})) AS BIGINT) AS count FROM matrix JOIN s USING (sample), (SELECT median(size) AS med FROM s)"


@query("a35_median_normalise", NORM.format(f="(med / size)"), "matrix")
def _(v):
    return ops.median_normalised(v.matrix)


@query("a35_median_scale_up", NORM.format(f="(size / med)"), "matrix")
def _(v):
    return ops.median_normalised(v.matrix, scale_up_deep=True)


@query("a37_spread", "SELECT sample, round(quantile_cont(count, 0.25), 6) AS q1, round(quantile_cont(count, 0.5), 6) AS med, round(quantile_cont(count, 0.75), 6) AS q3 FROM matrix GROUP BY 1", "matrix")
def _(v):
    return ops.spread(v.matrix)


@query("m12_abundant_otus", f"SELECT otu, round(max(count / CAST(size AS DOUBLE)), 6) AS most FROM {SIZED} GROUP BY 1 HAVING round(max(count / CAST(size AS DOUBLE)), 6) >= 0.015", "matrix")
def _(v):
    return ops.abundant_otus(v.matrix, 0.015)


@query("m9_reduced_sequences", "SELECT otu, CAST(sum(count) AS BIGINT) AS total FROM matrix GROUP BY 1 HAVING sum(count) > 15", "matrix")
def _(v):
    return v.matrix.groupBy("otu").agg(F.sum("count").alias("total")).where("total > 15")


@query("m10_wide_to_long", "SELECT replace(sample, 's', 'd2_') AS sample, otu, CAST(sum(count) AS BIGINT) AS count FROM matrix WHERE otu IN ('click_1', 'view_2', 'error_3') GROUP BY 1, 2", "matrix")
def _(v):
    names = ["click_1", "view_2", "error_3"]
    w = ops.wide(v.matrix, names)
    return ops.long(w.withColumn("sample", F.replace("sample", F.lit("s"), F.lit("d2_"))), ["sample"], names)


@query("k5_shared_table", "SELECT sample, " + ", ".join(f"CAST(coalesce(sum(count) FILTER (otu = '{o}'), 0) AS BIGINT) AS {o}" for o in ("click_1", "view_2", "error_3")) + " FROM matrix WHERE otu IN ('click_1', 'view_2', 'error_3') GROUP BY 1", "matrix")
def _(v):
    names = ["click_1", "view_2", "error_3"]
    return ops.wide(v.matrix.where(F.col("otu").isin(names)), names)


@query("a45_contamination", f"SELECT otu, round(max(count / CAST(size AS DOUBLE)), 6) AS maxab, count(*) AS samples, max(CASE WHEN otu LIKE '%\\_1' ESCAPE '\\' THEN 1 ELSE 0 END) = 1 AS perfect FROM {SIZED} GROUP BY 1", "matrix")
def _(v):
    return ops.relative(v.matrix).groupBy("otu").agg(F.round(F.max("share"), 6).alias("maxab"), F.count("*").alias("samples"), F.bool_or(F.col("otu").endswith("_1")).alias("perfect"))


@query("u2_positive_entries", "SELECT otu, count(*) FILTER (count > 1) AS n FROM matrix GROUP BY 1", "matrix")
def _(v):
    return v.matrix.groupBy("otu").agg(F.count_if(F.col("count") > 1).alias("n"))


@query("j19_sample_pairs", "SELECT a.sample AS a, b.sample AS b FROM meta a JOIN meta b ON a.grp = b.grp AND a.sample < b.sample", "meta")
def _(v):
    m = v.meta
    return m.select(F.col("sample").alias("a"), "grp").join(m.select(F.col("sample").alias("b"), "grp"), "grp").where("a < b").select("a", "b")


@query("j13_longest_prefix", "SELECT otu, max(prefix) AS prefix FROM (SELECT DISTINCT otu FROM matrix), (VALUES ('click'), ('click_1'), ('view'), ('pur')) t(prefix) WHERE starts_with(otu, prefix) GROUP BY 1", "matrix")
def _(v):
    p = v.spark.createDataFrame([("click",), ("click_1",), ("view",), ("pur",)], "prefix string")
    return ops.longest_prefix(v.matrix, p, "otu", "prefix")


@query("o13_group_reference", "SELECT grp, arg_min(sample, md5(sample)) AS sample FROM meta GROUP BY 1", "meta")
def _(v):
    """One sample of each group, by least hash: repeatable, not the reference's draw."""
    return v.meta.groupBy("grp").agg(F.min_by("sample", F.md5("sample")).alias("sample"))


@query("o4_multi_key_order", "SELECT otu, n, row_number() OVER (ORDER BY n DESC, otu) AS place FROM (SELECT otu, count(*) AS n FROM matrix GROUP BY 1)", "matrix")
def _(v):
    from .hits import ranked_globally

    return ranked_globally(v.matrix.groupBy("otu").agg(F.count("*").alias("n")), [F.desc("n"), "otu"])


@query("o3_natural_order", "SELECT otu, row_number() OVER (ORDER BY CAST(regexp_replace(otu, '[^0-9]', '', 'g') AS BIGINT), otu) AS place FROM (SELECT DISTINCT otu FROM matrix)", "matrix")
def _(v):
    from ..functions.text import number_in
    from .hits import ranked_globally

    return ranked_globally(v.matrix.select("otu").distinct().withColumn("k", number_in(F.col("otu"))), ["k", "otu"]).drop("k")


@query("o5_order_by_lists", "SELECT sample, row_number() OVER (ORDER BY coalesce(list_position(['s3', 's1', 's2'], sample), 2147483647), sample) AS place FROM meta", "meta")
def _(v):
    from .hits import ranked_globally

    order = v.spark.createDataFrame([("s3", 1), ("s1", 2), ("s2", 3)], "sample string, k int")
    return ranked_globally(v.meta.join(F.broadcast(order), "sample", "left").withColumn("k", F.coalesce("k", F.lit(2147483647))), ["k", "sample"]).select("sample", "place")


@query("n1_min_max", "SELECT contig, CASE WHEN hi = lo THEN 0.5 ELSE round((gc - lo) / (hi - lo), 6) END AS scaled FROM contigs, (SELECT min(gc) AS lo, max(gc) AS hi FROM contigs)", "contigs")
def _(v):
    edge = v.contigs.agg(F.min("gc").alias("lo"), F.max("gc").alias("hi"))
    return v.contigs.crossJoin(F.broadcast(edge)).select("contig", F.when(F.col("hi") == F.col("lo"), 0.5).otherwise(F.round(F.try_divide(F.col("gc") - F.col("lo"), F.col("hi") - F.col("lo")), 6)).alias("scaled"))


@query("n2_z_score", "SELECT contig, CASE WHEN sd = 0 THEN 0.0 ELSE round((gc - m) / sd, 6) END AS z FROM contigs, (SELECT avg(gc) AS m, stddev_pop(gc) AS sd FROM contigs)", "contigs")
def _(v):
    s = v.contigs.agg(F.avg("gc").alias("m"), F.stddev_pop("gc").alias("sd"))
    return v.contigs.crossJoin(F.broadcast(s)).select("contig", F.coalesce(F.round(F.try_divide(F.col("gc") - F.col("m"), F.col("sd")), 6), F.lit(0.0)).alias("z"))


@query("n3_robust_z", "WITH m AS (SELECT median(gc) AS m FROM contigs), d AS (SELECT median(abs(gc - m)) AS mad FROM contigs, m) SELECT contig, CASE WHEN mad = 0 THEN 0.0 ELSE round((gc - m) / (1.4826 * mad), 6) END AS z FROM contigs, m, d", "contigs")
def _(v):
    m = v.contigs.crossJoin(F.broadcast(v.contigs.agg(F.median("gc").alias("m"))))
    d = m.agg(F.median(F.abs(F.col("gc") - F.col("m"))).alias("mad"))
    return m.crossJoin(F.broadcast(d)).select("contig", F.coalesce(F.round(F.try_divide(F.col("gc") - F.col("m"), 1.4826 * F.col("mad")), 6), F.lit(0.0)).alias("z"))


@query("n5_grid_size", "SELECT bin, CAST(floor(sqrt(5.5 * count(*) / 2) + 0.5) AS BIGINT) AS rows_, CAST(2 * floor(sqrt(5.5 * count(*) / 2) + 0.5) AS BIGINT) AS cols FROM contigs GROUP BY 1", "contigs")
def _(v):
    r = F.floor(F.sqrt(5.5 * F.count("*") / 2) + 0.5).cast("long")
    return v.contigs.groupBy("bin").agg(r.alias("rows_"), (2 * r).alias("cols"))


@query("n6_relabel", "SELECT contig, CASE WHEN contig % 10 = 3 THEN 'new' ELSE bin END AS bin FROM contigs", "contigs")
def _(v):
    return v.contigs.select("contig", F.when(F.col("contig") % 10 == 3, "new").otherwise(F.col("bin")).alias("bin"))


@query("n8_log_bins", "SELECT CAST(floor(log10(len) * 10) AS BIGINT) AS bucket, count(*) AS n FROM contigs GROUP BY 1", "contigs")
def _(v):
    return v.contigs.groupBy(F.floor(F.log10("len") * 10).alias("bucket")).agg(F.count("*").alias("n"))


@query("w17_frames", """
    SELECT locus, scaffold, lag(start) OVER w AS before, lead(start) OVER w AS next, ntile(4) OVER w AS quarter, sum(stop - start) OVER (PARTITION BY scaffold ORDER BY start RANGE BETWEEN 30 PRECEDING AND CURRENT ROW) AS near,
      last_value(CASE WHEN strand = 'F' THEN locus END IGNORE NULLS) OVER (PARTITION BY scaffold ORDER BY start, locus ROWS UNBOUNDED PRECEDING) AS last_forward FROM features WINDOW w AS (PARTITION BY scaffold ORDER BY start, locus)""", "features")
def _(v):
    """Extra: neighbours, quarters, ranges of values, and the last value that isn't null."""
    w = W.partitionBy("scaffold").orderBy("start", "locus")
    near = W.partitionBy("scaffold").orderBy("start").rangeBetween(-30, 0)
    forward = F.last(F.when(F.col("strand") == "F", F.col("locus")), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    return v.features.select("locus", "scaffold", F.lag("start").over(w).alias("before"), F.lead("start").over(w).alias("next"), F.ntile(4).over(w).cast("long").alias("quarter"), F.sum(F.col("stop") - F.col("start")).over(near).alias("near"), forward.alias("last_forward"))


@query("a49_rollup", "SELECT domain, family, count(*) AS n FROM lineage GROUP BY ROLLUP (domain, family)", "lineage")
def _(v):
    """Extra: grouping sets."""
    return v.lineage.rollup("domain", "family").agg(F.count("*").alias("n"))


@query("d7_multiset_except", "SELECT bin FROM contigs WHERE len > 250 EXCEPT ALL SELECT bin FROM contigs WHERE len < 200", "contigs")
def _(v):
    """Extra: EXCEPT ALL."""
    return v.contigs.where("len > 250").select("bin").exceptAll(v.contigs.where("len < 200").select("bin"))
