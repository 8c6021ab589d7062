"""Queries on annotation, taxonomy and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..operators import annotation as ops


@query("a18_phylum_distribution", "SELECT lower(phylum) AS phylum, count(*) AS n FROM lineage GROUP BY 1", "lineage")
def _(v):
    return v.lineage.groupBy(F.lower("phylum").alias("phylum")).agg(F.count("*").alias("n"))


@query("a19_rank_profile", """
    WITH l AS (SELECT * FROM lineage WHERE pid >= CASE WHEN domain = 'ASIA' THEN 3000 ELSE 5000 END), t AS (SELECT bin, count(*) AS genes FROM l GROUP BY 1),
    u AS (SELECT bin, 'domain' AS rank, domain AS taxon FROM l UNION ALL SELECT bin, 'phylum', phylum FROM l UNION ALL SELECT bin, 'family', family FROM l),
    n AS (SELECT bin, rank, taxon, count(*) AS n FROM u GROUP BY 1, 2, 3)
    SELECT * FROM (SELECT n.bin, rank, taxon, n, round(100.0 * n / genes, 6) AS percent, row_number() OVER (PARTITION BY n.bin, rank ORDER BY n DESC, taxon) AS place FROM n JOIN t ON t.bin = n.bin) WHERE place <= 5""", "lineage")
def _(v):
    return ops.rank_profile(v.lineage.where(F.col("pid") >= F.when(F.col("domain") == "ASIA", 3000).otherwise(5000)), ("domain", "phylum", "family"), 5).withColumn("place", F.col("place").cast("long"))


@query("a31_copy_matrix", "SELECT kind, " + ", ".join(f"count(*) FILTER (bin = 'Brand#{i}') AS b{i}" for i in (1, 2, 3)) + ", " + " + ".join(f"CAST(count(*) FILTER (bin = 'Brand#{i}') > 0 AS INTEGER)" for i in (1, 2, 3)) + " AS presence FROM contigs WHERE bin IN ('Brand#1', 'Brand#2', 'Brand#3') GROUP BY 1", "contigs")
def _(v):
    return ops.copy_matrix(v.contigs.where("bin in ('Brand#1', 'Brand#2', 'Brand#3')"), "kind", "bin", {"Brand#1": "b1", "Brand#2": "b2", "Brand#3": "b3"})


@query("a31_core_clusters", "SELECT kind FROM contigs GROUP BY 1 HAVING count(DISTINCT bin) = (SELECT count(DISTINCT bin) FROM contigs)", "contigs")
def _(v):
    return ops.core(v.contigs, "kind", "bin")


@query("a32_cluster_density", "SELECT c_custkey AS cluster, len(string_split(c_name, '0')) AS nodes, round(len(string_split(c_name, '0')) / CAST(len(string_split(c_name, '#')) AS DOUBLE), 6) AS density FROM customer")
def _(v):
    n, d = F.size(F.split("c_name", "0")), F.size(F.split("c_name", "#"))
    return v.table("customer").select(F.col("c_custkey").alias("cluster"), n.cast("long").alias("nodes"), F.round(n / d, 6).alias("density"))


@query("a33_taxon_tags", "WITH t AS (SELECT bin, string_agg(DISTINCT domain, ',' ORDER BY domain) AS tag FROM lineage GROUP BY bin) SELECT tag, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM t), 6) AS percent FROM t GROUP BY 1", "lineage")
def _(v):
    return ops.tags(v.lineage, "bin", "domain")


@query("a36_gene_coverage", "SELECT c.kind AS aro, c.bin, round(sum(s.coverage * (1 + c.contig % 3)), 6) AS coverage FROM contigs c JOIN (SELECT contig, round(sum(depth * bases) / CAST(max(len) AS DOUBLE), 6) AS coverage FROM cov GROUP BY 1) s ON s.contig = c.contig GROUP BY 1, 2", "contigs cov")
def _(v):
    from ..operators.coverage import scaffold_coverage

    j = v.contigs.join(scaffold_coverage(v.cov).select("contig", "coverage"), "contig")
    return j.groupBy(F.col("kind").alias("aro"), "bin").agg(F.round(F.sum(F.col("coverage") * (1 + F.col("contig") % 3)), 6).alias("coverage"))


@query("j6_star_lookup", """
    SELECT l.gene, l.bin, p.name AS product, o.best AS cog, s.last AS ko FROM lineage l LEFT JOIN contigs p ON p.contig = l.gene LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS best FROM orders GROUP BY 1) o ON o.o_custkey = l.gene
    LEFT JOIN (SELECT o_custkey, max(o_orderstatus) AS last FROM orders GROUP BY 1) s ON s.o_custkey = l.gene""", "lineage contigs")
def _(v):
    o = v.table("orders").groupBy(F.col("o_custkey").alias("gene")).agg(F.min("o_orderpriority").alias("cog"), F.max("o_orderstatus").alias("ko"))
    p = v.contigs.select(F.col("contig").alias("gene"), F.col("name").alias("product"))
    return ops.star(v.lineage.select("gene", "bin"), "gene", p, o)


@query("j7_rename_with_fallback", "SELECT l.gene, coalesce(c.bin, b.name, l.bin) AS name FROM lineage l LEFT JOIN (SELECT DISTINCT bin AS k, 'x' || bin AS name FROM lineage WHERE bin < 'b3') b ON b.k = l.bin LEFT JOIN (SELECT 'xb1' AS k, 'renamed' AS bin) c ON c.k = coalesce(b.name, l.bin)", "lineage")
def _(v):
    first = v.lineage.select(F.col("bin").alias("old")).distinct().where("old < 'b3'").withColumn("new", F.concat(F.lit("x"), "old"))
    second = v.spark.createDataFrame([("xb1", "renamed")], "old string, new string")
    return ops.renamed(v.lineage.select("gene", F.col("bin").alias("name")), "name", first, second)


@query("j11_append_features", "SELECT c.contig, c.gc, coalesce(n, 0) AS n, coalesce(best, 0.0) AS best FROM contigs c LEFT JOIN (SELECT subject, count(*) AS n, max(bitscore) AS best FROM hits WHERE bitscore > 90000 GROUP BY 1) h ON h.subject = c.contig", "contigs hits")
def _(v):
    info = v.hits.where("bitscore > 90000").groupBy(F.col("subject").alias("contig")).agg(F.count("*").alias("n"), F.max("bitscore").alias("best"))
    return v.contigs.select("contig", "gc").join(info, "contig", "left").na.fill(0)


@query("g3_taxonomy_walk", """
    WITH RECURSIVE up(taxid, node, rank, name, depth) AS (SELECT taxid, taxid, rank, name, 0 FROM nodes WHERE rank = 'species' UNION ALL
    SELECT up.taxid, n.taxid, n.rank, n.name, depth + 1 FROM up JOIN nodes o ON o.taxid = up.node JOIN nodes n ON n.taxid = o.parent WHERE up.rank NOT IN ('phylum', 'no rank'))
    SELECT taxid, name AS phylum, CAST(depth AS INTEGER) AS depth FROM up WHERE rank = 'phylum'""", "nodes")
def _(v):
    return ops.climb(v.nodes, v.nodes.where("rank = 'species'").select("taxid"), ("phylum",), most=8).select("taxid", F.col("name").alias("phylum"), "depth")


@query("g6_map_composition", "SELECT s_suppkey, r_name AS name FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey")
def _(v):
    s = v.table("supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("name"))
    n = v.table("nation").select(F.col("n_nationkey").cast("string").alias("old"), F.concat(F.lit("r"), F.col("n_regionkey")).alias("new"))
    r = v.table("region").select(F.concat(F.lit("r"), F.col("r_regionkey")).alias("old"), F.col("r_name").alias("new"))
    return ops.renamed(s, "name", n, r)


@query("g5_graph_nodes", "SELECT CAST(locus AS VARCHAR) AS id, type AS label FROM features WHERE abs(start - stop) + 1 >= 20 UNION ALL SELECT DISTINCT 's' || scaffold, 'scaffold' FROM features WHERE abs(start - stop) + 1 >= 20", "features")
def _(v):
    return ops.graph(v.features, 20)[0]


@query("g5_graph_edges", "SELECT CAST(locus AS VARCHAR) AS source, 'is_' || type || '_on' AS relation, 's' || scaffold AS target FROM features WHERE abs(start - stop) + 1 >= 20", "features")
def _(v):
    return ops.graph(v.features, 20)[1]


@query("p8_expand_attributes", "SELECT ord, k AS k, CASE WHEN type = 'click' THEN k END AS click FROM attributes", "attributes")
def _(v):
    a = v.attributes.select("ord", F.concat(F.lit("k="), "k", F.when(F.col("type") == "click", F.concat(F.lit(";click="), "k")).otherwise("")).alias("attributes"))
    wide = ops.expanded(a, "attributes", ["k", "click"])
    return wide.select("ord", F.col("k").cast("int").alias("k"), F.col("click").cast("int").alias("click"))


@query("p8_attribute_keys", "SELECT 'k' AS key, count(*) AS n FROM attributes UNION ALL SELECT 'click', count(*) FROM attributes WHERE type = 'click'", "attributes")
def _(v):
    a = v.attributes.select("ord", F.concat(F.lit("k="), "k", F.when(F.col("type") == "click", F.concat(F.lit(";click="), "k")).otherwise("")).alias("attributes"))
    return ops.attribute_keys(a, "attributes")


@query("p13_carry_forward", "SELECT ord, coalesce(last_value(CASE WHEN k < 10 THEN k END IGNORE NULLS) OVER (PARTITION BY type ORDER BY ord ROWS UNBOUNDED PRECEDING), -1) AS id FROM attributes", "attributes")
def _(v):
    return ops.carried(v.attributes.withColumn("k", F.when(F.col("k") < 10, F.col("k"))), "type", "ord", "k").select("ord", F.coalesce("k", F.lit(-1)).alias("id"))


@query("p14_binning_rows", "SELECT contig, 'Bin_' || replace(bin, 'Brand#', '') AS bin, regexp_replace('k' || contig || '_' || len, '_', '.') AS name FROM contigs", "contigs")
def _(v):
    return v.contigs.select("contig", F.concat(F.lit("Bin_"), F.replace("bin", F.lit("Brand#"), F.lit(""))).alias("bin"), F.regexp_replace(F.concat(F.lit("k"), "contig", F.lit("_"), "len"), r"(?<=\d)_(?=\d)", ".").alias("name"))


@query("p15_patched_subjects", "SELECT query, split_part(dataset || '|' || subject || '|' || name, '|', 2) AS subject, split_part(dataset || '|' || subject || '|' || name, '|', 3) AS name FROM hits JOIN contigs ON contig = subject", "hits contigs")
def _(v):
    s = F.split(F.concat_ws("|", "dataset", F.col("subject").cast("string"), "name"), r"\|")
    return v.hits.join(v.contigs.select(F.col("contig").alias("subject"), "name"), "subject").select("query", s[1].alias("subject"), s[2].alias("name"))


@query("p16_upload_rows", "SELECT contig || ' ' || name AS row, bin FROM contigs WHERE len > 400", "contigs")
def _(v):
    return v.contigs.where("len > 400").select(F.concat_ws(" ", F.col("contig").cast("string"), "name").alias("row"), "bin")


@query("f14_marks", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus IN ('F', 'P') AND (starts_with(o_orderpriority, '1') OR starts_with(o_orderpriority, '2'))")
def _(v):
    p = F.col("o_orderpriority")
    return v.table("orders").where(F.col("o_orderstatus").isin("F", "P") & (p.startswith("1") | p.startswith("2"))).select("o_orderkey", "o_orderpriority")


@query("f15_prefix_groups", "SELECT CASE WHEN starts_with(p_name, 'red') THEN 'red' WHEN starts_with(p_name, 'small') THEN 'small' ELSE 'others' END AS grp, count(*) AS n FROM part GROUP BY 1")
def _(v):
    return v.table("part").groupBy(ops.prefix_group(F.col("p_name"), ("red", "small"), "others").alias("grp")).agg(F.count("*").alias("n"))


@query("f16_banned_taxa", "SELECT s_suppkey FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def _(v):
    banned = v.table("nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("s_nationkey"))
    return v.table("supplier").join(banned, "s_nationkey", "left_anti").select("s_suppkey")


@query("f17_path_depth", "SELECT page_id FROM pages WHERE len(string_split(split_part(url, '?', 1), '/')) = 5")
def _(v):
    return v.table("pages").where(F.size(F.split(F.substring_index("url", "?", 1), "/")) == 5).select("page_id")


@query("j20_seed_by_genome", "SELECT r_name AS seed, n_name AS genome FROM region, nation WHERE n_regionkey <> r_regionkey")
def _(v):
    r = v.table("region").select(F.col("r_name").alias("seed"), "r_regionkey")
    return v.table("nation").crossJoin(r).where("n_regionkey <> r_regionkey").select("seed", F.col("n_name").alias("genome"))


@query("j21_scan_small_side", "SELECT p_partkey, r_name FROM part, region WHERE strpos(upper(p_name), left(r_name, 1)) > 0")
def _(v):
    r = v.table("region").select("r_name")
    return v.table("part").select("p_partkey", "p_name").join(r, F.upper("p_name").contains(F.left("r_name", F.lit(1)))).select("p_partkey", "r_name")
