"""Global alignment scores, and the closest of many references by bound and prune.

With matches 1, mismatches -1 and gaps -1, a query of m letters that aligns at a score of at least L has an alignment with
2 x mismatches + 2 x letters left out + letters put in at most m - L =: slack. A q-gram of the query is lost only to an edit: a mismatch or a
letter left out costs two of the slack and loses up to q, a letter put in costs one and loses up to q - 1. So once some reference has
shown a score of L, any other that is as good shares one of the query's (q - 1) x slack + 1 rarest q-grams: an inverted index finds these.
Its length, too, is from m - slack / 2 to m + slack.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rounds import Rounds

#: Letters of a gram of the index, and of one by which the references to try first are found, beside the former.
Q, SEED = 5, 12
#: Queries and references that a task compares all with all, for queries that grams can't help.
QUERIES, REFS = 500, 5000
#: References tried first for each query: those of most grams in common, the rare ones counting more.
SEEDS = 3


def scores(a: str, refs: list[str], match: int = 1, mismatch: int = -1, gap: int = -1) -> np.ndarray:
    """Needleman-Wunsch scores of a against each reference (linear gaps): one row of all tables at a time.

    A row's left-to-right dependency is a running maximum once each cell is shifted by the gaps up to it.
    """
    n = max(map(len, refs), default=0)
    grid = np.array([[ord(c) for c in r] + [0] * (n - len(r)) for r in refs], np.int32).reshape(len(refs), n)
    k = np.arange(n + 1) * gap
    row = np.broadcast_to(k, (len(refs), n + 1)).astype(np.int64)
    for i, c in enumerate(a, 1):
        diagonal = row[:, :-1] + np.where(grid == ord(c), match, mismatch)
        best = np.concatenate([np.full((len(refs), 1), i * gap), np.maximum(diagonal, row[:, 1:] + gap)], axis=1)
        row = np.maximum.accumulate(best - k, axis=1) + k
    return row[np.arange(len(refs)), [len(r) for r in refs]]


def _scored(frames):
    """Rows (seq, ref_seq) with their score, references of one query and about one length at a time."""
    for pdf in frames:
        out = np.empty(len(pdf), np.int64)
        pdf = pdf.reset_index(drop=True)
        for (seq, _), at in pdf.groupby(["seq", pdf.ref_seq.str.len() // 64]).indices.items():
            for k in range(0, len(at), 1000):
                out[at[k : k + 1000]] = scores(seq, pdf.ref_seq.iloc[at[k : k + 1000]].tolist())
        yield pdf[["seq", "ref_seq"]].assign(score=out)


def _all(queries: pd.DataFrame, refs: pd.DataFrame) -> pd.DataFrame:
    """The best of some references for each of some queries, but for those that are too short or too long to be."""
    refs = refs.sort_values("ref_seq", key=lambda s: s.str.len(), kind="stable")
    size, some = refs.ref_seq.str.len().to_numpy(np.int64), refs.ref_seq.tolist()
    out = []
    for seq, low, high in zip(queries.seq, queries.low, queries.high):
        a, b = np.searchsorted(size, low, "left"), np.searchsorted(size, high, "right")
        for k in range(a, b, 1000):
            got = scores(seq, some[k : min(b, k + 1000)])
            out += [(seq, some[k + i], int(got.max())) for i in np.flatnonzero(got == got.max())]
    return pd.DataFrame(out, columns=["seq", "ref_seq", "score"]).astype({"score": "int64"})


SCORED = "seq string, ref_seq string, score long"


def _grams(df: DataFrame, column: str, q: int) -> DataFrame:
    """(column, gram) of the distinct grams; a shorter text is one."""
    grams = F.expr(f"transform(sequence(1, greatest(length({column}) - {q - 1}, 1)), i -> substring({column}, i, {q}))")
    return df.select(column, F.explode(F.array_distinct(grams)).alias("gram"))


def _known(grams: DataFrame, index: DataFrame) -> DataFrame:
    """Grams (seq, gram) with n, how many references of the index have them, and ref_seq, the least that does."""
    rarity = index.groupBy("gram").agg(F.count("*").alias("n"), F.min("ref_seq").alias("ref_seq"))
    return grams.join(rarity, "gram", "left").select("seq", "gram", F.coalesce("n", F.lit(0)).alias("n"), "ref_seq")


def _best(scored: DataFrame, keys: list[str], least: Column) -> DataFrame:
    best = F.min(F.struct((-F.col("score")).alias("minus"), least.alias("ref")))
    return scored.groupBy(*keys).agg(best.alias("best")).select(*keys, F.col("best.ref").alias("ref"), (-F.col("best.minus")).alias("score"))


def closest(queries: DataFrame, refs: DataFrame) -> DataFrame:
    """id, ref, score: the best of refs (ref, ref_seq) for each query (id, seq) by global alignment, ties to the lesser ref.

    Null sequences are empty; rows of queries may repeat and are each answered, and without a reference there are no rows. Every distinct
    query is first aligned with `SEEDS` references of most grams in common, the rare ones counting more; the best of these shows how many grams
    another must share at least one of (see the module). Queries for which that is all their grams or more, as nothing much like them is
    there, are aligned with every reference of a possible length, in blocks of QUERIES by REFS. Results are those of all pairs.
    """
    rounds = Rounds(queries.sparkSession)
    given = queries.select("id", F.coalesce("seq", F.lit("")).alias("seq"))
    named = refs.select("ref", F.coalesce("ref_seq", F.lit("")).alias("ref_seq")).groupBy("ref_seq").agg(F.min("ref").alias("ref"))
    named, seen = rounds.counted(named, n=F.count("*"), least=F.min("ref_seq"))
    if not seen["n"]:
        return given.select("id", F.lit(None).cast(refs.schema["ref"].dataType).alias("ref"), F.lit(0).cast("long").alias("score")).limit(0)
    wanted = rounds.save(given.select("seq").distinct())
    index = rounds.save(_grams(named, "ref_seq", Q))
    grams = rounds.save(_known(_grams(wanted, "seq", Q), index))
    seeds = grams.unionByName(_known(_grams(wanted, "seq", SEED), _grams(named, "ref_seq", SEED)))
    votes = seeds.where("ref_seq is not null").groupBy("seq", "ref_seq").agg(F.sum(F.lit(1.0) / F.col("n")).alias("vote"))
    place = F.row_number().over(Window.partitionBy("seq").orderBy(F.desc("vote"), "ref_seq"))
    first = votes.withColumn("place", place).where(F.col("place") <= SEEDS).select("seq", "ref_seq")
    tried = rounds.save(first.mapInPandas(_scored, SCORED))
    # a query without a gram in common is known to score no worse than letter by letter against some reference
    none = F.lit(seen["least"])
    shown = tried.groupBy("seq").agg(F.max("score").alias("score"))
    shown = wanted.join(shown, "seq", "left").select("seq", F.coalesce("score", -F.greatest(F.length("seq"), F.length(none))).alias("score"))
    slack = F.length("seq") - F.col("score")
    shown = rounds.save(shown.select("seq", slack.alias("slack"), (F.length("seq") - F.expr("(length(seq) - score) div 2")).alias("low"), (F.length("seq") + slack).alias("high")))
    # of distinct grams no more are lost than of all
    need = shown.select("seq", "slack", "low", "high", ((Q - 1) * F.col("slack") + 1).alias("need"))
    order = F.row_number().over(Window.partitionBy("seq").orderBy("n", "gram"))
    count = F.count("*").over(Window.partitionBy("seq"))
    ranked = grams.select("seq", "gram", order.alias("place"), count.alias("all")).join(need, "seq")
    prefix = ranked.where("all >= need and place <= need")
    pairs = prefix.select("seq", "gram", "low", "high").join(index, "gram").where("length(ref_seq) between low and high").select("seq", "ref_seq").distinct()
    by_index = pairs.repartition("seq", F.xxhash64("ref_seq") % 8).mapInPandas(_scored, SCORED)
    # letters of a text shorter than a gram are one gram, of which an edit may leave nothing
    rest = rounds.save(need.join(ranked.where(f"all >= need and length(seq) > {Q}").select("seq").distinct(), "seq", "left_anti").select("seq", "low", "high"))
    parts, blocks = -(-rest.count() // QUERIES) or 1, -(-seen["n"] // REFS)
    left = rest.withColumn("part", F.pmod(F.xxhash64("seq"), F.lit(parts)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = named.select("ref_seq", F.pmod(F.xxhash64("ref_seq"), F.lit(blocks)).cast("int").alias("block")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    by_all = left.groupBy("part", "block").cogroup(right.groupBy("part", "block")).applyInPandas(_all, SCORED)
    scored = by_index.unionByName(by_all).unionByName(tried.select("seq", "ref_seq", "score")).join(named, "ref_seq")
    best = _best(scored, ["seq"], F.col("ref"))
    return given.join(best, "seq").select("id", "ref", "score")
