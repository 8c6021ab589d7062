"""Operators on alignment hits (query, subject, pident, length, mismatch, gapopen, sstart, send, evalue, bitscore) and keyed rows.

"First" and "top" follow the file's order, which the caller names by columns: no operator relies on how rows happen to arrive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Tokens up to which a list goes to every row as it is.
SHORT_LIST = 1_000


def threshold(pident: float = 0, length: int = 0, evalue: float = 1e9, score: float = 0, coverage: float = 0) -> Column:
    """Condition of a hit filter; coverage in percent against a qcovs column. Null-safe, so that its complement is exact."""
    c = (F.col("pident") >= pident) & (F.col("length") >= length) & (F.col("evalue") <= evalue) & (F.col("bitscore") >= score)
    if coverage:
        c &= F.col("qcovs") >= coverage
    return F.coalesce(c, F.lit(False))


def global_coverage(qlen: str = "qlen", slen: str = "slen") -> Column:
    """Aligned share of the shorter sequence."""
    return F.try_divide((F.col("length") - F.col("mismatch") - F.col("gapopen")).cast("double"), F.least(qlen, slen))


def without_self(hits: DataFrame) -> DataFrame:
    return hits.where(F.col("query") != F.col("subject"))


def listed(df: DataFrame, ids: DataFrame, key: str, exclude: bool = False) -> DataFrame:
    """Rows whose key is (not) in ids (one column of that name). A null key is never in a list."""
    return df.join(ids.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti" if exclude else "left_semi")


def listed_tokens(df: DataFrame, ids: DataFrame, header: str, key: str, exclude: bool = False, fuzzy: bool = False) -> DataFrame:
    """Rows of which any token of the header is in ids, case ignored. fuzzy: odd characters part tokens too.

    A list of up to SHORT_LIST goes to the rows. A longer one is joined with their distinct tokens, each of which carries the header's
    digest: a token that carried its header would make the work quadratic in a header's length.
    """
    text = F.upper(header)
    text = F.regexp_replace(text, r"[^A-Z0-9=_#/.]", " ") if fuzzy else text
    tokens = F.split(F.trim(text), r"\s+")
    wanted = ids.select(F.upper(F.col(key)).alias("_t")).where("_t is not null").distinct()
    short = [r[0] for r in wanted.limit(SHORT_LIST + 1).collect()]
    if len(short) <= SHORT_LIST:
        hit = F.coalesce(F.arrays_overlap(tokens, F.array(*map(F.lit, short)).cast("array<string>")), F.lit(False))
        return df.where(~hit if exclude else hit)
    d = df.withColumn("_h", F.unhex(F.sha2(header, 256)))
    hits = d.select("_h", F.explode(F.array_distinct(tokens)).alias("_t")).join(wanted, "_t", "left_semi").select("_h").distinct()
    return d.join(hits, "_h", "left_anti" if exclude else "left_semi").drop("_h")


def either_listed(hits: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Hits with a listed query (q), subject (s) or either (c)."""
    q = ids.select(F.col(ids.columns[0]).alias("query")).distinct().withColumn("_q", F.lit(True))
    s = ids.select(F.col(ids.columns[0]).alias("subject")).distinct().withColumn("_s", F.lit(True))
    cols = hits.columns
    j = hits.join(q, "query", "left").join(s, "subject", "left")
    keep = {"q": F.col("_q"), "s": F.col("_s"), "c": F.col("_q") | F.col("_s")}[on]
    return j.where(F.coalesce(keep, F.lit(False))).select(*cols)


def top_k(df: DataFrame, key: str | Sequence[str], order: Sequence, k: int) -> DataFrame:
    """The first k rows of each key in the given order."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_rn") <= k).drop("_rn")


def first_of(df: DataFrame, key: str | Sequence[str], order: Sequence) -> DataFrame:
    return top_k(df, key, order, 1)


def last_of(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    return top_k(df, key, [F.desc(o) for o in order], 1)


def within_tolerance(hits: DataFrame, percent: float) -> DataFrame:
    """Hits of a query that score at least its best less so many percent."""
    best = F.max("bitscore").over(W.partitionBy("query"))
    return hits.withColumn("_best", best).where(F.col("bitscore") >= F.col("_best") * (1 - percent / 100)).drop("_best")


def subject_scores(hits: DataFrame, percent: float) -> DataFrame:
    """Each query deals one point to the subjects of its hits within tolerance; per subject: points, queries, best score, share."""
    pair = within_tolerance(hits, percent).groupBy("query", "subject").agg(F.max("bitscore").alias("b"))
    dealt = pair.withColumn("share", 1.0 / F.count("*").over(W.partitionBy("query")))
    per = dealt.groupBy("subject").agg(F.sum("share").alias("score"), F.count("*").alias("queries"), F.max("b").alias("best"))
    return per.crossJoin(F.broadcast(per.agg(F.sum("score").alias("total")))).select("subject", F.round("score", 6).alias("score"), "queries", "best", F.round(100 * F.col("score") / F.col("total"), 6).alias("percent"))


def query_log(hits: DataFrame) -> DataFrame:
    """Subject -> its queries, sorted and joined by commas."""
    return hits.select("subject", "query").distinct().groupBy("subject").agg(F.array_join(F.transform(F.array_sort(F.collect_list("query")), lambda x: x.cast("string")), ",").alias("queries"))


def itemize(df: DataFrame, key: str, dataset: str, values: Sequence[str]) -> DataFrame:
    """key x dataset counts, zero-filled, a null key as "Unassigned"."""
    return df.withColumn(key, F.coalesce(F.col(key).cast("string"), F.lit("Unassigned"))).groupBy(key).pivot(dataset, list(values)).agg(F.count(F.lit(1))).na.fill(0)


def master_tally(master: DataFrame, hits: DataFrame, order: Sequence[str], least: float, key: str = "subject") -> DataFrame:
    """Rows of the first qualifying hit of each query by subject; every master key stays, with 0."""
    first = first_of(hits.where(F.col("bitscore") >= least), "query", order)
    n = first.groupBy(key).agg(F.count("*").alias("n"), F.sum("length").cast("long").alias("total"))
    return master.select(key).distinct().join(n, key, "left").na.fill(0, ["n", "total"])


def weave(df: DataFrame, key: str, dataset: str, values: Sequence[str]) -> DataFrame:
    """key x dataset counts and in how many datasets the key is."""
    wide = itemize(df, key, dataset, values)
    present = sum((F.col(v) > 0).cast("int") for v in values)
    return wide.withColumn("presence", present)


def pair_identity(hits: DataFrame, genomes: DataFrame) -> DataFrame:
    """Of unordered genome pairs: mean identity of hits both ways (aai), and fluidity from hit and gene counts.

    hits: a, b, pident; genomes: id, genes.
    """
    sums = hits.where("a <> b").groupBy(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).agg(F.sum("pident").alias("s"), F.count("*").alias("n"), F.count_if(F.col("a") < F.col("b")).alias("nab"), F.count_if(F.col("a") > F.col("b")).alias("nba"))
    g = lambda k: genomes.select(F.col("id").alias(k), F.col("genes").alias(f"n_{k}"))
    j = sums.join(g("x"), "x").join(g("y"), "y")
    gf = (F.col("n_x") - F.col("nab") + F.col("n_y") - F.col("nba")) / (F.col("n_x") + F.col("n_y"))
    return j.select("x", "y", F.round(F.col("s") / F.col("n"), 6).alias("aai"), F.round(gf, 6).alias("fluidity"))


def best_hit_identity(hits: DataFrame, order: Sequence[str], least_length: int, least_pident: float, piece: int, least_coverage: float) -> DataFrame:
    """ANI: the first hit of each query of at least a length, kept by identity and coverage of the piece; mean identity by subject group."""
    first = first_of(hits.where(F.col("length") >= least_length), "query", order)
    kept = first.where((F.col("pident") > least_pident) & (F.col("length") * 100 / piece >= least_coverage))
    return kept.groupBy("dataset").agg(F.round(F.avg("pident"), 6).alias("ani"), F.count("*").alias("n"))


def group_others(df: DataFrame, key: str, keep: int) -> DataFrame:
    """Counts of the `keep` largest groups (ties by key), the rest as "others"."""
    n = df.groupBy(F.col(key).cast("string").alias(key)).agg(F.count("*").alias("n"))
    ranked = n.orderBy(F.desc("n"), key).limit(keep).withColumn("_top", F.lit(True)).select(key, "_top")
    return n.join(F.broadcast(ranked), key, "left").groupBy(F.when(F.col("_top"), F.col(key)).otherwise("others").alias(key)).agg(F.sum("n").alias("n"))


def as_of(left: DataFrame, right: DataFrame, key: str, time: str, values: Sequence[str]) -> DataFrame:
    """left with the `values` of right's last row at or before it on the same key, nulls if there is none.

    Both sides are sorted together and the last row of right is carried along: one shuffle, no pairs. right has one row a key and time.
    """
    both = left.select("*", F.lit(1).alias("_side"), F.lit(None).cast(right.select(F.struct(*values)).schema[0].dataType).alias("_v")).unionByName(
        right.select(key, time, F.lit(0).alias("_side"), F.struct(*values).alias("_v")), allowMissingColumns=True)
    last = F.last("_v", ignorenulls=True).over(W.partitionBy(key).orderBy(time, "_side").rowsBetween(W.unboundedPreceding, 0))
    return both.withColumn("_v", last).where("_side = 1").select(*left.columns, *(F.col("_v")[c].alias(c) for c in values))


def matched_pairs(df: DataFrame, name: str, value: str) -> DataFrame:
    """Values that exactly two names share, with both."""
    d = df.select(name, value).where(F.col(value).isNotNull()).distinct()
    return d.groupBy(value).agg(F.count("*").alias("n"), F.min(name).alias("first"), F.max(name).alias("second")).where("n = 2").drop("n")
