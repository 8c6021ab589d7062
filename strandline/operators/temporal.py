"""Joins of rows that hold for a span of time, and correlated lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rounds import Rounds

#: Spans of one key that share a bucket of time, about.
SPANS = 10_000


def overlapping(left: DataFrame, right: DataFrame, key: str, spans: int = SPANS) -> DataFrame:
    """Pairs of rows of left and right with one key whose spans [start, stop], both ends included, meet: left's columns, then right's.

    left and right have the key, start and stop, and no other names in common; right's key, start and stop come as right_start and so on.
    Spans with a null, or that end before they start, meet nothing.

    The time of each key is cut at quantiles of all its starts, so that a bucket holds about `spans` of them, however many a key has and
    wherever they lie; a key of few has one bucket. A span is in each bucket that it touches, and a pair is found in the first that
    both touch, and only there.
    """
    rounds = Rounds(left.sparkSession)
    ok = F.col("start") <= F.col("stop")
    a = left.where(ok & F.col(key).isNotNull())
    b = right.where(ok & F.col(key).isNotNull()).select(F.col(key).alias(f"right_{key}"), F.col("start").alias("right_start"), F.col("stop").alias("right_stop"), *(c for c in right.columns if c not in (key, "start", "stop")))
    starts = a.select(key, "start").unionByName(b.select(F.col(f"right_{key}").alias(key), F.col("right_start").alias("start")))
    counts = rounds.save(starts.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > spans))
    # approximate quantiles differ from one evaluation to the next, and both sides must be cut alike
    cuts = rounds.save(_cuts(starts, counts, key, spans))
    place = lambda at, cut: F.coalesce(F.size(F.filter(cut, lambda c: c <= at)), F.lit(0))

    def bucketed(df: DataFrame, of: str, start: str, stop: str, name: str) -> DataFrame:
        have = df.join(cuts.withColumnRenamed(key, "cut_key"), F.col(of) == F.col("cut_key"), "left")
        first = F.when(F.col("cuts").isNull(), 0).otherwise(place(F.col(start), F.col("cuts")))
        last = F.when(F.col("cuts").isNull(), 0).otherwise(place(F.col(stop), F.col("cuts")))
        return have.withColumn(f"{name}_first", first).withColumn(f"{name}_bucket", F.explode(F.sequence(F.col(f"{name}_first"), last))).drop("cut_key", "cuts")

    x, y = bucketed(a, key, "start", "stop", "a"), bucketed(b, f"right_{key}", "right_start", "right_stop", "b")
    meet = (F.col("start") <= F.col("right_stop")) & (F.col("right_start") <= F.col("stop"))
    once = F.col("a_bucket") == F.greatest("a_first", "b_first")
    return x.join(y, (F.col(key) == F.col(f"right_{key}")) & (F.col("a_bucket") == F.col("b_bucket")) & meet & once).select(*left.columns, *b.columns)


def _cuts(starts: DataFrame, counts: DataFrame, key: str, spans: int) -> DataFrame:
    """(key, cuts): of the keys of counts (key, n), the starts that cut theirs into parts of about `spans`, in order.

    Quantiles are partial aggregates, so a key's starts never meet in one task."""
    hot = starts.join(counts, key)
    # how many parts a key has is rounded up to a power of two, so that keys are few kinds
    kinds = hot.withColumn("parts", F.expr(f"cast(pow(2, ceil(log2(n / {spans}))) as int)"))
    parts = [r.parts for r in kinds.select("parts").distinct().collect()]
    out = None
    for p in sorted(parts):
        q = F.percentile_approx("start", [k / p for k in range(1, p)], 10 * p) if p > 1 else F.array().cast("array<long>")
        some = kinds.where(F.col("parts") == p).groupBy(key).agg(q.alias("cuts"))
        out = some if out is None else out.unionByName(some)
    if out is None:
        return counts.select(key, F.lit(None).alias("cuts")).limit(0).withColumn("cuts", F.array(F.lit(None).cast(starts.schema["start"].dataType)))
    return out.withColumn("cuts", F.array_distinct("cuts"))


def first_of_each(df: DataFrame, other: DataFrame, on: tuple[str, str], order: Sequence[Column], n: int, *columns: str) -> DataFrame:
    """df's rows, each with the first n of other's rows whose on[1] is its on[0], by order: a lateral join. Rows without any are left out."""
    its = other.where(F.col(on[1]) == F.col(on[0]).outer()).orderBy(*order).limit(n).select(*columns)
    return df.lateralJoin(its)
