"""Spans that meet, against every pair; correlated lookups."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from strandline.operators.temporal import first_of_each, overlapping


@pytest.mark.parametrize("spans", [5, 40, 10_000])
def test_overlapping_against_all_pairs(spark, spans):
    """A key with most rows, spans that cover many buckets, ties of starts, nulls, and spans that end before they start."""
    rng = random.Random(spans)

    def side(n):
        out = []
        for i in range(n):
            start = rng.choice((rng.randint(0, 400), 100))
            out.append((i, rng.choice(("hot", "hot", "hot", "a", "b")), start, start + rng.choice((0, 1, 5, 300))))
        return out + [(n, None, 1, 5), (n + 1, "a", None, 5), (n + 2, "hot", 9, 3), (n + 3, "hot", 5, None)]

    a, b = side(120), side(90)
    x = spark.createDataFrame(a, "x long, who string, start long, stop long").repartition(3)
    y = spark.createDataFrame(b, "y long, who string, start long, stop long")
    want = sorted((i, j) for i, k, s, e in a for j, m, t, f in b if k and k == m and None not in (s, e, t, f) and s <= e and t <= f and s <= f and t <= e)
    got = overlapping(x, y, "who", spans)
    assert sorted((r.x, r.y) for r in got.collect()) == want
    assert got.columns == ["x", "who", "start", "stop", "right_who", "right_start", "right_stop", "y"]


def test_spans_of_dates(spark):
    import datetime

    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)
    x = spark.createDataFrame([(i, 1, day(i), day(i + 2)) for i in range(50)], "x long, k long, start date, stop date")
    y = spark.createDataFrame([(i, 1, day(i * 5), day(i * 5)) for i in range(10)], "y long, k long, start date, stop date")
    assert sorted((r.x, r.y) for r in overlapping(x, y, "k", 8).collect()) == sorted((i, j) for i in range(50) for j in range(10) if i <= 5 * j <= i + 2)


def test_first_of_each(spark):
    x = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "k long, name string")
    y = spark.createDataFrame([(1, 5), (1, 7), (1, 6), (2, 1), (None, 9)], "of long, v long")
    assert rows(first_of_each(x, y, ("k", "of"), [F.desc("v")], 2, "v")) == [(1, "a", 6), (1, "a", 7), (2, "b", 1)]


def test_both_sides_are_cut_alike(spark):
    """Approximate quantiles of many rows differ from one evaluation to the next: pairs were lost where the sides were cut apart."""
    side = lambda n, seed, name: spark.range(0, n, 1, 16).select(F.col("id").alias(name), (F.col("id") % 40).alias("k"), (F.xxhash64("id", F.lit(seed)) % 100_000).alias("start")).withColumn("stop", F.col("start") + 20)
    x, y = side(40_000, 1, "x").repartition(16), side(40_000, 2, "y").repartition(16)
    plain = x.join(y.select(F.col("k").alias("k2"), F.col("start").alias("s2"), F.col("stop").alias("e2"), "y"), (F.col("k") == F.col("k2")) & (F.col("start") <= F.col("e2")) & (F.col("s2") <= F.col("stop")))
    want = plain.count()
    got = overlapping(x, y, "k", 40)
    assert got.count() == want
    assert "percentile" not in got._jdf.queryExecution().executedPlan().toString()
