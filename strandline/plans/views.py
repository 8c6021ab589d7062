"""Views that give the driver's tables the shape of domain records, in Spark and in SQL.

Operators never see the driver's names: they take hits, coverage, contigs, chunks, sequences, reads, features and count matrices, and run
on domain files just so.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import dna, letters

#: name -> views it is built from, SQL
VIEW_SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "hits": ((), """
        SELECT l_orderkey AS query, l_partkey AS subject, round(100 * (1 - l_discount), 2) AS pident, CAST(l_quantity AS INTEGER) AS length,
          l_linenumber AS mismatch, l_suppkey % 3 AS gapopen, l_linenumber * 10 AS sstart, l_linenumber * 10 + CAST(l_quantity AS INTEGER) AS send,
          l_tax AS evalue, l_extendedprice AS bitscore, l_returnflag AS dataset FROM lineitem"""),
    "ranked": (("hits",), """
        SELECT *, row_number() OVER (PARTITION BY query ORDER BY mismatch, subject, bitscore, length, pident, evalue, gapopen, dataset) AS ord FROM hits"""),
    "cov": ((), """
        SELECT l_partkey AS contig, l_suppkey % 5 AS sample, CAST(l_quantity AS INTEGER) AS depth, CAST(l_linenumber AS BIGINT) AS bases, CAST(p_size * 10 AS BIGINT) AS len
        FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    "contigs": ((), """
        SELECT p_partkey AS contig, CAST(p_size * 10 AS BIGINT) AS len, p_brand AS bin, p_type AS kind, p_name AS name, CAST(20.0 + (p_partkey % 60) AS DOUBLE) AS gc FROM part"""),
    "chunks": ((), """
        SELECT l_orderkey AS contig, l_linenumber AS chunk, min(nullif(l_suppkey % 7, 0)) AS bin FROM lineitem GROUP BY 1, 2"""),
    "seqs": ((), """
        SELECT doc_id AS ord, 'd' || doc_id AS id, lang AS grp, source AS file, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS seq FROM documents"""),
    "bases": (("seqs",), """
        SELECT ord, id, grp, file, translate(seq, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ACGTACGTACGTACGTACGTACGTNN') AS seq FROM seqs"""),
    "matrix": ((), """
        SELECT 's' || (user_id % 40) AS sample, event_type || '_' || (CAST(json_extract_string(props, '$.k') AS INTEGER) % 25) AS otu, count(*) AS count FROM events GROUP BY 1, 2"""),
    "meta": ((), """
        SELECT 's' || (user_id % 40) AS sample, 'g' || min(user_id % 40 % 4) AS grp, CAST(min(user_id % 40 % 3) AS VARCHAR) AS site FROM events GROUP BY 1"""),
    "reads": ((), """
        SELECT conv_id || ':' || (turn // 2) AS pair, CAST(turn % 2 AS INTEGER) AS mate, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS seq, role AS run FROM conversations"""),
    "features": ((), """
        SELECT o_orderkey AS locus, o_custkey AS scaffold, CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS start,
          CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + o_orderkey % 30 AS INTEGER) AS stop, o_orderpriority AS type, o_orderstatus AS strand FROM orders"""),
    "genes": ((), """
        SELECT l_partkey AS gene, o_custkey AS scaffold, CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS INTEGER) AS start,
          CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) + l_linenumber * 2 AS INTEGER) AS stop FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "lineage": ((), """
        SELECT c_custkey AS gene, 'b' || (c_custkey % 7) AS bin, r_name AS domain, n_name AS phylum, c_mktsegment AS family, CAST(c_acctbal AS DOUBLE) AS pid
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "nodes": ((), """
        SELECT 1 AS taxid, 1 AS parent, 'no rank' AS rank, 'root' AS name UNION ALL
        SELECT 10 + r_regionkey, 1, 'phylum', r_name FROM region UNION ALL SELECT 100 + n_nationkey, 10 + n_regionkey, 'family', n_name FROM nation UNION ALL
        SELECT CAST(1000 + s_suppkey AS INTEGER), 100 + s_nationkey, 'species', s_name FROM supplier"""),
    "quality": ((), """
        SELECT l_orderkey AS id, CAST(l_linenumber AS INTEGER) AS pos, CAST(least(l_quantity, 42) - 1 AS INTEGER) AS q FROM lineitem"""),
    "attributes": ((), "SELECT event_id AS ord, event_type AS type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"),
}


class Views:
    """The same views as DataFrames, made when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def hits(self) -> DataFrame:
        n = F.col("l_linenumber")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("query"), F.col("l_partkey").alias("subject"), F.round(100 * (1 - F.col("l_discount")), 2).alias("pident"), F.col("l_quantity").cast("int").alias("length"),
            n.alias("mismatch"), (F.col("l_suppkey") % 3).alias("gapopen"), (n * 10).alias("sstart"), (n * 10 + F.col("l_quantity").cast("int")).alias("send"),
            F.col("l_tax").alias("evalue"), F.col("l_extendedprice").alias("bitscore"), F.col("l_returnflag").alias("dataset"))

    #: the order of rows that stands for a file's
    FILE_ORDER = ("mismatch", "subject", "bitscore", "length", "pident", "evalue", "gapopen", "dataset")

    @cached_property
    def cov(self) -> DataFrame:
        j = self.table("lineitem").join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        return j.select(F.col("l_partkey").alias("contig"), (F.col("l_suppkey") % 5).alias("sample"), F.col("l_quantity").cast("int").alias("depth"), F.col("l_linenumber").cast("long").alias("bases"), (F.col("p_size") * 10).cast("long").alias("len"))

    @cached_property
    def contigs(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("contig"), (F.col("p_size") * 10).cast("long").alias("len"), F.col("p_brand").alias("bin"), F.col("p_type").alias("kind"), F.col("p_name").alias("name"), (20.0 + F.col("p_partkey") % 60).alias("gc"))

    @cached_property
    def chunks(self) -> DataFrame:
        return self.table("lineitem").groupBy(F.col("l_orderkey").alias("contig"), F.col("l_linenumber").alias("chunk")).agg(F.min(F.nullif(F.col("l_suppkey") % 7, F.lit(0).cast("long"))).alias("bin"))

    @cached_property
    def seqs(self) -> DataFrame:
        return self.table("documents").select(F.col("doc_id").alias("ord"), F.concat(F.lit("d"), "doc_id").alias("id"), F.col("lang").alias("grp"), F.col("source").alias("file"), letters(F.col("text")).alias("seq"))

    @cached_property
    def bases(self) -> DataFrame:
        return self.seqs.withColumn("seq", dna(F.col("seq")))

    @cached_property
    def matrix(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int") % 25
        return self.table("events").groupBy(F.concat(F.lit("s"), (F.col("user_id") % 40).cast("string")).alias("sample"), F.concat_ws("_", "event_type", k.cast("string")).alias("otu")).agg(F.count("*").alias("count"))

    @cached_property
    def meta(self) -> DataFrame:
        u = F.col("user_id") % 40
        return self.table("events").groupBy(F.concat(F.lit("s"), u.cast("string")).alias("sample")).agg(F.concat(F.lit("g"), F.min(u % 4).cast("string")).alias("grp"), F.min(u % 3).cast("string").alias("site"))

    @cached_property
    def reads(self) -> DataFrame:
        return self.table("conversations").select(F.concat_ws(":", F.col("conv_id").cast("string"), F.expr("turn div 2").cast("string")).alias("pair"), (F.col("turn") % 2).cast("int").alias("mate"), letters(F.col("text")).alias("seq"), F.col("role").alias("run"))

    @cached_property
    def features(self) -> DataFrame:
        day = F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date"))
        return self.table("orders").select(F.col("o_orderkey").alias("locus"), F.col("o_custkey").alias("scaffold"), day.alias("start"), (day + F.col("o_orderkey") % 30).cast("int").alias("stop"), F.col("o_orderpriority").alias("type"), F.col("o_orderstatus").alias("strand"))

    @cached_property
    def genes(self) -> DataFrame:
        day = F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date"))
        j = self.table("lineitem").join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return j.select(F.col("l_partkey").alias("gene"), F.col("o_custkey").alias("scaffold"), day.alias("start"), (day + F.col("l_linenumber") * 2).cast("int").alias("stop"))

    @cached_property
    def lineage(self) -> DataFrame:
        j = self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return j.select(F.col("c_custkey").alias("gene"), F.concat(F.lit("b"), (F.col("c_custkey") % 7).cast("string")).alias("bin"), F.col("r_name").alias("domain"), F.col("n_name").alias("phylum"), F.col("c_mktsegment").alias("family"), F.col("c_acctbal").alias("pid"))

    @cached_property
    def nodes(self) -> DataFrame:
        root = self.spark.range(1).select(F.lit(1).alias("taxid"), F.lit(1).alias("parent"), F.lit("no rank").alias("rank"), F.lit("root").alias("name"))
        phyla = self.table("region").select((10 + F.col("r_regionkey")).cast("int"), F.lit(1), F.lit("phylum"), "r_name")
        families = self.table("nation").select((100 + F.col("n_nationkey")).cast("int"), (10 + F.col("n_regionkey")).cast("int"), F.lit("family"), "n_name")
        species = self.table("supplier").select((1000 + F.col("s_suppkey")).cast("int"), (100 + F.col("s_nationkey")).cast("int"), F.lit("species"), "s_name")
        return root.union(phyla).union(families).union(species)

    @cached_property
    def quality(self) -> DataFrame:
        return self.table("lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").cast("int").alias("pos"), (F.least("l_quantity", F.lit(42.0)) - 1).cast("int").alias("q"))

    @cached_property
    def attributes(self) -> DataFrame:
        return self.table("events").select(F.col("event_id").alias("ord"), F.col("event_type").alias("type"), F.get_json_object("props", "$.k").cast("int").alias("k"))
