"""Operators on sequence records (ord, id, seq, ...), reads and qualities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import text as t


def length_gc(seqs: DataFrame, least: int = 1) -> DataFrame:
    return seqs.select("id", F.length("seq").cast("long").alias("len"), F.round(t.gc_percent(F.col("seq")), 4).alias("gc")).where(F.col("len") >= least)


def composition(seqs: DataFrame, group: str) -> DataFrame:
    """Percentages of A, T, G, C and N over all bases of a group."""
    n = seqs.groupBy(group).agg(F.sum(F.length("seq")).alias("bases"), *(F.sum(t.base_count(F.col("seq"), b)).alias(b) for b in "ATGCN"))
    return n.select(group, "bases", *(F.round(t.percent(F.col(b), F.col("bases")), 6).alias(f"pct_{b.lower()}") for b in "ATGCN"))


def length_histogram(seqs: DataFrame, width: int, bins: int = 50) -> DataFrame:
    """Counts of lengths in (lo, hi] bins; beyond the last, bins are ten times as wide."""
    n = F.length("seq")
    edge = width * bins
    hi = F.when(n <= edge, F.ceil(n / width) * width).otherwise(edge + F.ceil((n - edge) / (10 * width)) * 10 * width)
    return seqs.groupBy(hi.cast("long").alias("hi")).agg(F.count("*").alias("n"))


def dereplicate(seqs: DataFrame, quality: Column | None = None) -> DataFrame:
    """Equal sequences as one: the representative has the best quality (if given), the first of equals; size and members.

    Members come as (ord, id) pairs in order; a cluster's list is as long as the cluster.
    """
    best = F.struct(F.lit(0) if quality is None else -quality, F.col("ord"))
    return seqs.groupBy("seq").agg(F.count("*").alias("size"), F.min_by("id", best).alias("representative"), F.min("ord").alias("first"))


def cluster_members(seqs: DataFrame) -> DataFrame:
    """(representative, id, ord) of every record: a cluster as rows, so that a large one is no long list."""
    first = seqs.groupBy("seq").agg(F.min_by("id", "ord").alias("representative"))
    return seqs.select("seq", "id", "ord").join(first, "seq").select("representative", "id", "ord")


def dereplicate_pairs(pairs: DataFrame, key: list[str], score: str, order: str) -> DataFrame:
    """Of read pairs alike in `key`, the one with the best score, the first of equals."""
    w = W.partitionBy(*key).orderBy(F.desc(score), order)
    return pairs.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def group_fractions(seqs: DataFrame, group: str) -> DataFrame:
    """Share of each group among equal sequences: representative, group, share."""
    per = seqs.groupBy("seq", group).agg(F.count("*").alias("n"))
    total = seqs.groupBy("seq").agg(F.count("*").alias("t"), F.min_by("id", "ord").alias("representative"))
    return per.join(total, "seq").select("representative", group, F.round(F.col("n") / F.col("t"), 6).alias("share"))


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def mates(reads: DataFrame) -> DataFrame:
    """Reads (pair, mate 0 or 1, seq) as pairs and singles: pair, fwd, rev, kind."""
    side = lambda m, c: reads.where(F.col("mate") == m).select("pair", F.col("seq").alias(c))
    kind = F.when(F.col("rev").isNull(), "forward only").when(F.col("fwd").isNull(), "reverse only").otherwise("pair")
    return side(0, "fwd").join(side(1, "rev"), "pair", "full").withColumn("kind", kind)


def interleaved(records: DataFrame) -> DataFrame:
    """Records with idx from 0, two of them a pair: pair, fwd, rev."""
    return records.groupBy(F.expr("idx div 2").alias("pair")).agg(F.max(F.when(F.col("idx") % 2 == 0, F.col("seq"))).alias("fwd"), F.max(F.when(F.col("idx") % 2 == 1, F.col("seq"))).alias("rev"))


def chop(seqs: DataFrame, size: int) -> DataFrame:
    """Pieces of `size`, the last one taking the rest (size to 2 size - 1): id, piece (from 0), seq."""
    n = F.greatest(F.lit(1), F.expr(f"length(seq) div {size}")).cast("int")
    p = seqs.select("id", "seq", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("piece"))
    return p.select("id", "piece", F.when(F.col("piece") < F.col("n") - 1, F.substring("seq", F.col("piece") * size + 1, F.lit(size))).otherwise(F.substring("seq", F.col("piece") * size + 1, F.length("seq"))).alias("seq"))


def chop_overlapping(seqs: DataFrame, size: int, overlap: int) -> DataFrame:
    """Pieces of up to `size` that share `overlap` with the next: id, part (from 1), seq. No piece is only overlap."""
    step = size - overlap
    starts = F.when(F.length("seq") > overlap, F.sequence(F.lit(0), F.length("seq") - overlap - 1, F.lit(step))).otherwise(F.array(F.lit(0)))
    p = seqs.select("id", "seq", F.posexplode(starts).alias("k", "at"))
    return p.select("id", (F.col("k") + 1).alias("part"), F.substring("seq", F.col("at") + 1, F.lit(size)).alias("seq"))


def gc_skew(seqs: DataFrame, window: int, overlap: int = 0, least: int = 1000) -> DataFrame:
    """Whole windows of sequences over `least`: id, start, stop (from start, plus the step), gc, skew = 100 (C - G) / (C + G)."""
    step = window - overlap
    w = seqs.where(F.length("seq") > least).select("id", "seq", F.explode(F.sequence(F.lit(0), F.length("seq") - window, F.lit(step))).alias("start"))
    w = w.withColumn("w", F.substring("seq", F.col("start") + 1, F.lit(window)))
    c, g = t.base_count(F.col("w"), "C"), t.base_count(F.col("w"), "G")
    return w.select("id", "start", (F.col("start") + step).alias("stop"), F.round((c + g) * 100.0 / window, 6).alias("gc"), F.round(F.coalesce(F.try_divide((c - g) * 100.0, c + g), F.lit(0.0)), 6).alias("skew"))


def exploded_kmers(seqs: DataFrame, k: int, tile: int = 64) -> DataFrame:
    """(id, kmer) of every overlapping k-mer without N.

    Sequences are cut into tiles that overlap by k - 1 first: a substring is found by walking from the start of its string, which for a
    whole sequence would make the work quadratic in its length.
    """
    n = F.length("seq")
    starts = F.when(n >= k, F.sequence(F.lit(1), n - (k - 1), F.lit(tile))).otherwise(F.array().cast("array<int>"))
    tiles = seqs.select("id", "seq", F.explode(starts).alias("at")).select("id", F.substring("seq", F.col("at"), F.lit(tile + k - 1)).alias("tile"))
    return tiles.select("id", F.explode(t.kmers(F.col("tile"), k)).alias("kmer")).where(~F.col("kmer").contains("N"))


def kmer_counts(seqs: DataFrame, k: int, both_strands: bool = False) -> DataFrame:
    """k-mers without N and how often they occur; both_strands: a k-mer and its reverse complement are one, palindromes counting twice."""
    e = exploded_kmers(seqs, k)
    if not both_strands:
        return e.groupBy("kmer").agg(F.count("*").alias("n"))
    n = e.groupBy("kmer").agg(F.count("*").alias("n"))
    return n.groupBy(t.canonical(F.col("kmer")).alias("kmer")).agg(F.sum(F.when(F.col("kmer") == t.reverse_complement(F.col("kmer")), 2 * F.col("n")).otherwise(F.col("n"))).alias("n"))


def kmer_frequencies(seqs: DataFrame, k: int) -> DataFrame:
    """Per sequence the share of each canonical k-mer: id, kmer, share."""
    e = exploded_kmers(seqs, k)
    n = e.groupBy("id", t.canonical(F.col("kmer")).alias("kmer")).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy("id"))).drop("n")


def character_runs(seqs: DataFrame, chars: str, least: int, most: int | None = None) -> DataFrame:
    """Runs of one of `chars` (a regex class body), from `least` long, longer than `most` in pieces: id, start (from 0), stop (exclusive), len.

    Built-in: the text between runs and the runs, as two arrays, give the places by summed lengths.
    """
    pattern = f"[{chars}]{{{least},{'' if most is None else most}}}"
    found = seqs.select("id", F.regexp_extract_all("seq", F.lit(pattern), F.lit(0)).alias("r"), F.split("seq", pattern, -1).alias("s")).where(F.size("r") > 0)
    e = found.select("id", F.posexplode(F.arrays_zip(F.transform("r", F.length).alias("n"), F.transform(F.slice("s", F.lit(1), F.size("r")), F.length).alias("gap"))).alias("k", "x"))
    w = W.partitionBy("id").orderBy("k")
    stop = F.sum(F.col("x.n") + F.col("x.gap")).over(w)
    return e.select("id", (stop - F.col("x.n")).alias("start"), stop.alias("stop"), F.col("x.n").alias("len"))


def split_at_runs(seqs: DataFrame, chars: str, least: int, keep: int) -> DataFrame:
    """Pieces between runs, from `keep` long (the last one in any case): id, piece (from 1), seq."""
    p = seqs.select("id", F.split("seq", f"[{chars}]{{{least},}}", -1).alias("p")).select("id", F.size("p").alias("n"), F.posexplode("p").alias("k", "seq"))
    p = p.where((F.length("seq") >= keep) | ((F.col("k") == F.col("n") - 1) & (F.length("seq") > 0)))
    return p.select("id", (F.col("k") + 1).alias("piece"), "seq")


def find_all(seqs: DataFrame, pattern: str) -> DataFrame:
    """Non-overlapping places of an exact pattern: id, start (from 0), stop."""
    import re

    return character_runs_of(seqs, re.escape(pattern))


def character_runs_of(seqs: DataFrame, regex: str) -> DataFrame:
    found = seqs.select("id", F.regexp_extract_all("seq", F.lit(regex), F.lit(0)).alias("r"), F.split("seq", regex, -1).alias("s")).where(F.size("r") > 0)
    e = found.select("id", F.posexplode(F.arrays_zip(F.transform("r", F.length).alias("n"), F.transform(F.slice("s", F.lit(1), F.size("r")), F.length).alias("gap"))).alias("k", "x"))
    stop = F.sum(F.col("x.n") + F.col("x.gap")).over(W.partitionBy("id").orderBy("k"))
    return e.select("id", (stop - F.col("x.n")).alias("start"), stop.alias("stop"))


def spacers(matches: DataFrame, most: int) -> DataFrame:
    """Gaps of at most `most` between neighbouring matches (the first from 0): id, start, stop."""
    before = F.lag("stop", 1, 0).over(W.partitionBy("id").orderBy("start"))
    return matches.select("id", before.alias("start"), F.col("start").alias("stop")).where((F.col("stop") - F.col("start") <= most) & (F.col("stop") >= F.col("start")))


def subsequences(seqs: DataFrame, places: DataFrame) -> DataFrame:
    """places (id, start, stop; from 1, inclusive, either way round) cut out of seqs."""
    lo, hi = F.least("start", "stop"), F.greatest("start", "stop")
    return places.join(seqs.select("id", "seq"), "id").select("id", "start", "stop", F.substring("seq", lo, hi - lo + 1).alias("seq"))


def numbered(df: DataFrame, order: list[str], per: int) -> DataFrame:
    """File parts of `per` records in order: part (from 0)."""
    from ..plans.hits import ranked_globally

    return ranked_globally(df, order).withColumn("part", F.expr(f"cast((place - 1) div {per} as long)")).drop("place")


def quality_classes(values: DataFrame, column: str = "q") -> DataFrame:
    """Counts by class: Q1 (30, 41], Q2 (20, 30], Q3 (10, 20], Q4 (0, 10], Zero."""
    q = F.col(column)
    name = F.when(q > 30, "Q1").when(q > 20, "Q2").when(q > 10, "Q3").when(q > 0, "Q4").otherwise("Zero")
    n = values.groupBy(name.alias("class")).agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("_t")))).select("class", "n", F.round(100.0 * F.col("n") / F.col("_t"), 6).alias("percent"))


def _draw(key: str, seed: int) -> Column:
    """A row's number in the draw, in hexadecimal: the same on every engine."""
    return F.md5(F.concat_ws("/", F.lit(str(seed)), F.col(key).cast("string")))


def sampled(df: DataFrame, key: str, fraction: float, seed: int = 1) -> DataFrame:
    """A reproducible sample: rows (or pairs) whose hash falls under the fraction."""
    return df if fraction >= 1 else df.where(F.left(_draw(key, seed), F.lit(8)) < f"{int(fraction * (1 << 32)):08x}")


def exact_sample(df: DataFrame, key: str, n: int, seed: int = 1) -> DataFrame:
    """n rows by least hash, ties by key."""
    return df.orderBy(_draw(key, seed), key).limit(n)


def without_gap_columns(alignment: DataFrame, gap: str = "-") -> DataFrame:
    """An alignment (id, seq) without the columns that are gaps in every row.

    Columns are counted within tasks first; which of them stay, one list as wide as the alignment, goes to every row.
    """
    c = alignment.select(F.posexplode(F.filter(F.split("seq", ""), lambda x: x != "")).alias("pos", "c"))
    columns = c.groupBy("pos").agg(F.bool_or(F.col("c") != gap).alias("keep"))
    flags = columns.agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "keep"))), lambda x: x["keep"]).alias("keep"))
    kept = F.array_join(F.filter(F.transform(F.filter(F.split("seq", ""), lambda x: x != ""), lambda x, i: F.when(F.get("keep", i), x)), lambda x: x.isNotNull()), "")
    return alignment.crossJoin(F.broadcast(flags)).select("id", kept.alias("seq"))


def column_ranks(alignment: DataFrame) -> DataFrame:
    """Rank of each base within its alignment column, most frequent first, then the one seen first: pos, base, n, rank."""
    c = alignment.select("ord", F.posexplode(F.filter(F.split("seq", ""), lambda x: x != "")).alias("pos", "base"))
    n = c.groupBy("pos", "base").agg(F.count("*").alias("n"), F.min("ord").alias("seen"))
    return n.select("pos", "base", "n", F.row_number().over(W.partitionBy("pos").orderBy(F.desc("n"), "seen")).alias("rank"))
