"""Queries on alignment hits."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..catalog import query
from ..operators import hits as ops
from ..operators.clustering import families, iterated
from ..operators.rounds import Rounds
from ..operators.sketches import merged, sketches
from ..operators.temporal import first_of_each, overlapping
from .views import Views

ORDER = Views.FILE_ORDER
COLS = ("query", "subject", "pident", "length", "bitscore")
PICK = "query, subject, pident, length, bitscore"


@query("f1_hit_filter", f"SELECT {PICK} FROM hits WHERE pident >= 95 AND length >= 20 AND evalue <= 0.05 AND bitscore >= 20000", "hits")
def _(v):
    return v.hits.where(ops.threshold(95, 20, 0.05, 20000)).select(*COLS)


@query("f1_hit_filter_complement", f"SELECT {PICK} FROM hits WHERE NOT (pident >= 95 AND length >= 20 AND evalue <= 0.05 AND bitscore >= 20000)", "hits")
def _(v):
    return v.hits.where(~ops.threshold(95, 20, 0.05, 20000)).select(*COLS)


@query("f1_global_coverage", "SELECT query, subject, round((length - mismatch - gapopen) / least(send, 40.0), 6) AS gcov FROM hits WHERE (length - mismatch - gapopen) / least(send, 40.0) >= 0.5", "hits")
def _(v):
    g = ops.global_coverage("send", "qlen")
    return v.hits.withColumn("qlen", F.lit(40.0)).where(g >= 0.5).select("query", "subject", F.round(g, 6).alias("gcov"))


@query("f4_hits_of_interest", f"SELECT {PICK} FROM hits WHERE bitscore >= 50000 AND (query IN (SELECT contig FROM contigs WHERE bin = 'Brand#1') OR subject IN (SELECT contig FROM contigs WHERE bin = 'Brand#1'))", "hits contigs")
def _(v):
    return ops.either_listed(v.hits.where("bitscore >= 50000"), v.contigs.where("bin = 'Brand#1'").select("contig"), "c").select(*COLS)


@query("f5_remove_subjects", f"SELECT {PICK} FROM hits WHERE subject NOT IN (SELECT contig FROM contigs WHERE len >= 100)", "hits contigs")
def _(v):
    return ops.listed(v.hits, v.contigs.where("len >= 100").withColumnRenamed("contig", "subject"), "subject", exclude=True).select(*COLS)


@query("f9_no_self_hits", f"SELECT {PICK} FROM hits WHERE query <> subject", "hits")
def _(v):
    return ops.without_self(v.hits).select(*COLS)


@query("j1_semi_join", f"SELECT {PICK} FROM hits WHERE subject IN (SELECT contig FROM contigs WHERE bin = 'Brand#3')", "hits contigs")
def _(v):
    return ops.listed(v.hits, v.contigs.where("bin = 'Brand#3'").withColumnRenamed("contig", "subject"), "subject").select(*COLS)


@query("j2_anti_join", "SELECT contig, len, bin FROM contigs c WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.subject = c.contig AND h.bitscore > 90000)", "hits contigs")
def _(v):
    return ops.listed(v.contigs, v.hits.where("bitscore > 90000").withColumnRenamed("subject", "contig"), "contig", exclude=True).select("contig", "len", "bin")


@query("j3_three_way_chain", "SELECT o_custkey AS otu, max(s_suppkey) AS accession FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1")
def _(v):
    chain = v.table("orders").join(v.table("lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).join(v.table("supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    return chain.groupBy(F.col("o_custkey").alias("otu")).agg(F.max("s_suppkey").alias("accession"))


@query("j8_describe_subjects", "SELECT query, subject, coalesce(name, '') AS descr FROM hits LEFT JOIN contigs ON subject = contig AND len > 200", "hits contigs")
def _(v):
    d = v.contigs.where("len > 200").select(F.col("contig").alias("subject"), "name")
    return v.hits.join(d, "subject", "left").select("query", "subject", F.coalesce("name", F.lit("")).alias("descr"))


@query("j9_two_hop_names", "SELECT query, coalesce(n.n_name, 'diff' || s.s_suppkey) AS name FROM hits h JOIN supplier s ON s.s_suppkey = h.subject % 100 LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey AND n.n_regionkey <> 0", "hits")
def _(v):
    s = v.table("supplier").select("s_suppkey", "s_nationkey")
    n = v.table("nation").where("n_regionkey <> 0").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return v.hits.join(s, F.col("subject") % 100 == F.col("s_suppkey")).join(n, "s_nationkey", "left").select("query", F.coalesce("n_name", F.concat(F.lit("diff"), "s_suppkey")).alias("name"))


@query("j10_inflate_clusters", "SELECT h.dataset AS ref, CAST(sum(o.n) AS BIGINT) AS reads FROM hits h JOIN (SELECT o_orderkey AS k, o_custkey % 9 + 1 AS n FROM orders) o ON o.k = h.query GROUP BY 1", "hits")
def _(v):
    size = v.table("orders").select(F.col("o_orderkey").alias("query"), (F.col("o_custkey") % 9 + 1).alias("n"))
    return v.hits.join(size, "query").groupBy(F.col("dataset").alias("ref")).agg(F.sum("n").alias("reads"))


@query("w1_top5", f"SELECT {PICK} FROM ranked WHERE ord <= 5", "ranked")
def _(v):
    return ops.top_k(v.hits, "query", ORDER, 5).select(*COLS)


@query("w1_top5_no_self", f"SELECT {PICK} FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY ord) AS k FROM ranked WHERE query <> subject) WHERE k <= 5", "ranked")
def _(v):
    return ops.top_k(ops.without_self(v.hits), "query", ORDER, 5).select(*COLS)


@query("w2_first_hit", f"SELECT {PICK} FROM ranked WHERE ord = 1", "ranked")
def _(v):
    return ops.first_of(v.hits, "query", ORDER).select(*COLS)


@query("w3_last_hit", f"SELECT {PICK} FROM (SELECT *, max(ord) OVER (PARTITION BY query) AS m FROM ranked) WHERE ord = m", "ranked")
def _(v):
    return ops.last_of(v.hits, "query", ORDER).select(*COLS)


@query("w4_best_within_tolerance", f"SELECT {PICK} FROM (SELECT *, max(bitscore) OVER (PARTITION BY query) AS m FROM hits) WHERE bitscore >= m * (1 - 10 / 100.0)", "hits")
def _(v):
    return ops.within_tolerance(v.hits, 10).select(*COLS)


@query("a11_best_hit_identity", "SELECT dataset, round(avg(pident), 6) AS ani, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY ord) AS k FROM ranked WHERE length >= 10) WHERE k = 1 AND pident > 91 AND length * 100 / 50.0 >= 40 GROUP BY 1", "ranked")
def _(v):
    return ops.best_hit_identity(v.hits, ORDER, 10, 91, 50, 40)


@query("a12_pair_identity", """
    WITH h AS (SELECT query % 20 AS a, subject % 20 AS b, pident FROM hits),
    g AS (SELECT a AS id, count(*) AS genes FROM h GROUP BY 1),
    s AS (SELECT least(a, b) AS x, greatest(a, b) AS y, sum(pident) AS s, count(*) AS n, count(*) FILTER (a < b) AS nab, count(*) FILTER (a > b) AS nba FROM h WHERE a <> b GROUP BY 1, 2)
    SELECT x, y, round(s / n, 6) AS aai, round((gx.genes - nab + gy.genes - nba) / CAST(gx.genes + gy.genes AS DOUBLE), 6) AS fluidity FROM s JOIN g gx ON gx.id = x JOIN g gy ON gy.id = y""", "hits")
def _(v):
    h = v.hits.select((F.col("query") % 20).alias("a"), (F.col("subject") % 20).alias("b"), "pident")
    return ops.pair_identity(h, h.groupBy(F.col("a").alias("id")).agg(F.count("*").alias("genes")))


@query("a13_subject_score", """
    WITH k AS (SELECT * FROM (SELECT *, max(bitscore) OVER (PARTITION BY query) AS m FROM hits) WHERE bitscore >= m * (1 - 10 / 100.0)),
    p AS (SELECT query, subject, max(bitscore) AS b FROM k GROUP BY 1, 2), d AS (SELECT *, 1.0 / count(*) OVER (PARTITION BY query) AS share FROM p),
    s AS (SELECT subject, sum(share) AS score, count(*) AS queries, max(b) AS best FROM d GROUP BY 1)
    SELECT subject, round(score, 6) AS score, queries, best, round(100 * score / (SELECT sum(score) FROM s), 6) AS percent FROM s""", "hits")
def _(v):
    return ops.subject_scores(v.hits, 10)


@query("a14_query_log", "SELECT subject, string_agg(CAST(query AS VARCHAR), ',' ORDER BY query) AS queries FROM (SELECT DISTINCT subject, query FROM hits WHERE bitscore > 60000) GROUP BY 1", "hits")
def _(v):
    return ops.query_log(v.hits.where("bitscore > 60000"))


@query("a15_itemize", """SELECT CAST(subject AS VARCHAR) AS subject, count(*) FILTER (dataset = 'A') AS "A", count(*) FILTER (dataset = 'N') AS "N", count(*) FILTER (dataset = 'R') AS "R" FROM hits GROUP BY 1""", "hits")
def _(v):
    return ops.itemize(v.hits, "subject", "dataset", ("A", "N", "R"))


@query("a16_master_tally", """
    SELECT contig AS subject, coalesce(n, 0) AS n, coalesce(total, 0) AS total FROM contigs LEFT JOIN
    (SELECT subject, count(*) AS n, CAST(sum(length) AS BIGINT) AS total FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY ord) AS k FROM ranked WHERE bitscore >= 30000) WHERE k = 1 GROUP BY 1) ON subject = contig""", "ranked contigs")
def _(v):
    return ops.master_tally(v.contigs.withColumnRenamed("contig", "subject"), v.hits, ORDER, 30000)


@query("a17_tally_weave", """
    WITH c AS (SELECT CAST(subject AS VARCHAR) AS subject, count(*) FILTER (dataset = 'A') AS "A", count(*) FILTER (dataset = 'N') AS "N", count(*) FILTER (dataset = 'R') AS "R" FROM hits GROUP BY 1)
    SELECT *, CAST("A" > 0 AS INTEGER) + CAST("N" > 0 AS INTEGER) + CAST("R" > 0 AS INTEGER) AS presence FROM c""", "hits")
def _(v):
    return ops.weave(v.hits, "subject", "dataset", ("A", "N", "R"))


@query("a1_count_values", "SELECT dataset, count(*) AS n, CAST(sum(length) AS BIGINT) AS total FROM hits GROUP BY 1", "hits")
def _(v):
    return v.hits.groupBy("dataset").agg(F.count("*").alias("n"), F.sum("length").alias("total"))


@query("o1_top_n", "SELECT subject, count(*) AS n FROM hits GROUP BY 1 ORDER BY n DESC, subject LIMIT 20", "hits")
def _(v):
    return v.hits.groupBy("subject").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "subject").limit(20)


@query("o2_three_key_sort", "SELECT query, subject, row_number() OVER (ORDER BY bitscore DESC, evalue, length DESC, query, subject) AS place FROM hits", "hits")
def _(v):
    # the sort is a range partitioning; places come from per-partition counts, not from one task
    return ranked_globally(v.hits, [F.desc("bitscore"), "evalue", F.desc("length"), "query", "subject"]).select("query", "subject", "place")


def ranked_globally(df, order):
    """df with its place (from 1) in a total order: range partitions are numbered within, and shifted by the sizes before them.

    They are numbered once and written: the bounds of ranges come from a sample, so that a second evaluation would cut elsewhere.
    """
    parts = df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    # the partition's number in the upper bits, the row's in it in the lower 33
    at = Rounds(df.sparkSession).save(parts.withColumn("_id", F.monotonically_increasing_id()))
    at = at.withColumn("_p", F.shiftright("_id", 33)).withColumn("_k", F.col("_id").bitwiseAND((1 << 33) - 1) + 1).drop("_id")
    sizes = at.groupBy("_p").agg(F.count("*").alias("_n"))
    shift = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("_p", "_before")
    return at.join(F.broadcast(shift), "_p").withColumn("place", F.col("_k") + F.col("_before")).drop("_p", "_k", "_before")


@query("o6_group_others", "WITH n AS (SELECT CAST(subject AS VARCHAR) AS subject, count(*) AS n FROM hits GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, subject) AS k FROM n) SELECT CASE WHEN k <= 10 THEN subject ELSE 'others' END AS subject, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY 1", "hits")
def _(v):
    return ops.group_others(v.hits, "subject", 10)


@query("j17_matched_pairs", "SELECT value, min(name) AS first, max(name) AS second FROM (SELECT DISTINCT query AS name, bitscore AS value FROM hits) GROUP BY 1 HAVING count(*) = 2", "hits")
def _(v):
    return ops.matched_pairs(v.hits.select(F.col("query").alias("name"), F.col("bitscore").alias("value")), "name", "value")


FAMILIES = """
    WITH RECURSIVE h AS ({hits}),
    seen AS (SELECT part, query AS gene, k, query, subject FROM h{subjects}),
    first AS (SELECT part, gene, min(k) AS k, arg_min(query, k) AS query, arg_min(subject, k) AS subject FROM seen GROUP BY 1, 2),
    links AS (SELECT a.part, a.gene, CASE WHEN b.k < a.k THEN b.gene ELSE a.query END AS up
      FROM first a LEFT JOIN first b ON b.part = a.part AND b.gene = CASE WHEN a.gene = a.query THEN a.subject ELSE a.query END),
    walk AS (SELECT part, gene, gene AS family, up FROM links UNION ALL SELECT w.part, w.gene, l.gene, l.up FROM walk w JOIN links l ON l.part = w.part AND l.gene = w.up WHERE w.up <> w.family)
    SELECT part, gene, family FROM walk WHERE up = family"""


@query("g1_gene_families", FAMILIES.format(hits="SELECT query % 50 AS part, query, subject, row_number() OVER (ORDER BY bitscore DESC, query, subject) AS k FROM hits", subjects=" UNION ALL SELECT part, subject, k, query, subject FROM h"), "hits")
def _(v):
    """Greedy families within parts, as if hits were read one by one."""
    h = v.hits.select((F.col("query") % 50).alias("part"), "query", "subject", "bitscore")
    return families(h)


@query("g1_query_families", "SELECT gene, family FROM (" + FAMILIES.format(hits="SELECT 0 AS part, query % 9973 AS query, subject, row_number() OVER (ORDER BY bitscore DESC, evalue, length DESC, query % 9973, subject) AS k FROM hits", subjects="") + ")", "hits")
def _(v):
    """Families of queries alone over all hits, by score, then error, then length: a subject has one only by a hit of its own."""
    h = v.hits.withColumn("query", F.col("query") % 9973)
    return families(h, (), [-F.col("bitscore"), F.col("evalue"), -F.col("length")], subjects=False)


def _names(v):
    return v.table("part").select(F.col("p_partkey").cast("string").alias("id"), F.upper("p_name").alias("seq"))


@query("g4_iterative_clusters")
def _(v):
    """Part names clustered at 60 %, clusters of at least three names again at 75 %, and again at 90 %."""
    return iterated(_names(v), (0.6, 0.75, 0.9), 3, k=4, window=3)


@query("j22_asof", """
    SELECT h.locus, h.scaffold, h.start, b.gene FROM features h ASOF LEFT JOIN (SELECT scaffold, start, max(gene) AS gene FROM genes GROUP BY 1, 2) b ON h.scaffold = b.scaffold AND h.start >= b.start""", "features genes")
def _(v):
    """The last gene that starts at or before each feature on its scaffold; of genes with one start, the largest."""
    g = v.genes.groupBy("scaffold", "start").agg(F.max("gene").alias("gene"))
    return ops.as_of(v.features.select("locus", "scaffold", "start"), g, "scaffold", "start", ["gene"])


@query("j22_full_and_right", "SELECT coalesce(a.query, b.subject) AS id, coalesce(a.n, 0) AS queries, coalesce(b.n, 0) AS subjects FROM (SELECT query, count(*) AS n FROM hits GROUP BY 1) a FULL JOIN (SELECT subject, count(*) AS n FROM hits GROUP BY 1) b ON a.query = b.subject", "hits")
def _(v):
    a, b = (v.hits.groupBy(F.col(c).alias("id")).agg(F.count("*").alias(n)) for c, n in (("query", "queries"), ("subject", "subjects")))
    return a.join(b, "id", "full").na.fill(0, ["queries", "subjects"])


@query("d4_array_difference", "SELECT query, array_to_string(list_sort(list_filter(['A', 'N', 'R'], lambda x: NOT list_contains(list(DISTINCT dataset), x))), ',') AS missing FROM hits GROUP BY 1", "hits")
def _(v):
    """The datasets that a query has no hit in."""
    return v.hits.groupBy("query").agg(F.array_join(F.array_sort(F.array_except(F.array(*map(F.lit, "ANR")), F.collect_set("dataset"))), ",").alias("missing"))


@query("j22_overlapping_spans", """
    WITH a AS (SELECT o_orderkey AS ordered, o_custkey AS customer, CAST(o_orderdate AS DATE) AS start, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER) AS stop FROM orders),
    b AS (SELECT l_orderkey AS shipped, l_linenumber AS line, o_custkey AS customer, CAST(l_shipdate AS DATE) AS start, CAST(l_shipdate AS DATE) + CAST(l_linenumber * 3 AS INTEGER) AS stop FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
    SELECT a.customer, ordered, shipped, line, a.start, b.stop AS right_stop FROM a JOIN b ON a.customer = b.customer AND a.start <= b.stop AND b.start <= a.stop""")
def _(v):
    """Orders and shipments of one customer that are open at the same time."""
    o = v.table("orders")
    a = o.select(F.col("o_orderkey").alias("ordered"), F.col("o_custkey").alias("customer"), F.col("o_orderdate").cast("date").alias("start"))
    a = a.withColumn("stop", F.date_add("start", (F.col("ordered") % 60).cast("int")))
    b = v.table("lineitem").join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    b = b.select(F.col("l_orderkey").alias("shipped"), F.col("l_linenumber").alias("line"), F.col("o_custkey").alias("customer"), F.col("l_shipdate").cast("date").alias("start"))
    b = b.withColumn("stop", F.date_add("start", (F.col("line") * 3).cast("int")))
    return overlapping(a, b, "customer", 40).select("customer", "ordered", "shipped", "line", "start", "right_stop")


@query("j22_lateral", """
    SELECT c_custkey, c_name, o.o_orderkey, o.o_totalprice FROM customer c, LATERAL (SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = c.c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 2) o""")
def _(v):
    """The two dearest orders of every customer who has any, by a correlated subquery."""
    c = v.table("customer").select("c_custkey", "c_name")
    return first_of_each(c, v.table("orders"), ("c_custkey", "o_custkey"), [F.desc("o_totalprice"), F.col("o_orderkey")], 2, "o_orderkey", "o_totalprice")


@query("a50_merged_sketches", "SELECT dataset, count(DISTINCT subject) AS exact, true AS near, true AS as_whole FROM hits GROUP BY 1", "hits")
def _(v):
    """Distinct subjects by sketches that each part of the hits has stored: merged, they are within 5 % of the exact count, and what one
    sketch of all hits says."""
    rounds = Rounds(v.spark)
    h = v.hits.select("dataset", "subject", (F.col("query") % 16).alias("part"))
    stored = rounds.save(sketches(h, "subject", "dataset", "part"))
    whole = merged(sketches(h, "subject", "dataset"), "dataset").withColumnRenamed("n", "whole")
    exact = h.groupBy("dataset").agg(F.count_distinct("subject").alias("exact"))
    near = F.abs(F.col("n") - F.col("exact")) <= F.col("exact") * 0.05
    return exact.join(merged(stored, "dataset"), "dataset").join(whole, "dataset").select("dataset", "exact", near.alias("near"), (F.col("n") == F.col("whole")).alias("as_whole"))


@query("a50_approx_distinct", "SELECT dataset, true AS near FROM hits GROUP BY 1", "hits")
def _(v):
    """Extra: a sketch of distinct subjects, within a tenth of their number.

    The sketch takes the distinct rows that the exact count is of, as repeats don't change it: beside a distinct count it would be kept for
    each dataset and subject."""
    n = v.hits.select("dataset", "subject").distinct().groupBy("dataset").agg(F.approx_count_distinct("subject", 0.02).alias("sketch"), F.count("subject").alias("exact"))
    return n.select("dataset", (F.abs(F.col("sketch") - F.col("exact")) <= 0.1 * F.col("exact")).alias("near"))


@query("a40_subject_range", "SELECT subject, min(least(sstart, send)) AS lo, max(greatest(sstart, send)) AS hi, count(*) AS n FROM hits GROUP BY 1", "hits")
def _(v):
    return v.hits.groupBy("subject").agg(F.min(F.least("sstart", "send")).alias("lo"), F.max(F.greatest("sstart", "send")).alias("hi"), F.count("*").alias("n"))


@query("d1_distinct_list", "SELECT DISTINCT subject FROM hits WHERE pident >= 98", "hits")
def _(v):
    return v.hits.where("pident >= 98").select("subject").distinct()


@query("d2_union_all", "SELECT query AS id FROM hits WHERE dataset = 'A' UNION ALL SELECT subject FROM hits WHERE dataset = 'R'", "hits")
def _(v):
    return v.hits.where("dataset = 'A'").select(F.col("query").alias("id")).unionByName(v.hits.where("dataset = 'R'").select(F.col("subject").alias("id")))


@query("d3_intersect_except", "(SELECT query AS id, 'both' AS side FROM hits INTERSECT SELECT subject, 'both' FROM hits) UNION ALL (SELECT subject, 'subject only' FROM hits EXCEPT SELECT query, 'subject only' FROM hits)", "hits")
def _(v):
    q, s = v.hits.select(F.col("query").alias("id")), v.hits.select(F.col("subject").alias("id"))
    return q.intersect(s).withColumn("side", F.lit("both")).unionByName(s.subtract(q).withColumn("side", F.lit("subject only")))
