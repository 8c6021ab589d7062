"""Closest references against every pair aligned by a plain table."""

import random

import pytest
from helpers import rows

from strandline.operators import alignment as a


def score(x, y):
    row = [-j for j in range(len(y) + 1)]
    for i, c in enumerate(x, 1):
        now = [-i]
        for j, d in enumerate(y, 1):
            now.append(max(row[j - 1] + (1 if c == d else -1), row[j] - 1, now[-1] - 1))
        row = now
    return row[-1]


def brute(queries, refs):
    return sorted(((i, *max(((score(s or "", r or ""), name) for name, r in sorted(refs)), key=lambda t: t[0])[::-1]) for i, s in queries), key=repr)


def got(spark, queries, refs):
    return rows(a.closest(spark.createDataFrame(queries, "id string, seq string").repartition(3), spark.createDataFrame(refs, "ref string, ref_seq string")))


def changed(rng, s, n, letters):
    s = list(s)
    for _ in range(n):
        j = rng.randrange(len(s) + 1)
        s[j : j + 1] = rng.choice(([], [rng.choice(letters)], [rng.choice(letters), rng.choice(letters)]))
    return "".join(s)


def test_scores():
    rng = random.Random(1)
    text = lambda: "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 12)))
    for _ in range(100):
        x, some = text(), [text() for _ in range(5)]
        assert a.scores(x, some).tolist() == [score(x, y) for y in some]


@pytest.mark.parametrize("letters, size, edits, seed", [("ACGT", (30, 50), (0, 1, 2, 3), 1), ("ACGT", (1, 12), (0, 1, 5), 2), ("abcdefghijkl", (10, 30), (0, 2, 8), 3), ("ab", (8, 30), (0, 1), 4)])
def test_closest_against_all_pairs(spark, letters, size, edits, seed, monkeypatch):
    """Near copies that the index finds, poor ones that it can't, ties, nulls, repeated rows, and references in several blocks."""
    monkeypatch.setattr(a, "QUERIES", 7)
    monkeypatch.setattr(a, "REFS", 9)
    rng = random.Random(seed)
    refs = [(f"r{i:02d}", "".join(rng.choice(letters) for _ in range(rng.randint(*size)))) for i in range(40)]
    refs += [("a", refs[3][1]), ("z", refs[4][1]), ("n", None), ("e", "")]
    queries = [(f"q{i}", changed(rng, rng.choice(refs[:40])[1], rng.choice(edits), letters)) for i in range(40)]
    queries += [queries[0], ("q0", "other"), (None, refs[5][1]), ("null", None), ("far", "%" * 20), ("short", "A")]
    assert got(spark, queries, refs) == brute(queries, refs)


def test_the_index_leaves_few_to_align(spark, monkeypatch):
    """Queries a few edits from a reference are aligned with none of the others that are not like it."""
    def nothing(queries, refs):
        import pandas as pd

        return pd.DataFrame({"seq": [], "ref_seq": [], "score": []}).astype({"seq": str, "ref_seq": str, "score": "int64"})

    monkeypatch.setattr(a, "_all", nothing)
    rng = random.Random(8)
    refs = [(f"r{i}", "".join(rng.choice("ACGT") for _ in range(120))) for i in range(60)]
    queries = [(f"q{i}", changed(rng, refs[i][1], 3, "ACGT")) for i in range(60)]
    assert got(spark, queries, refs) == brute(queries, refs)


def test_without_references_or_queries(spark):
    assert got(spark, [("a", "ACGT")], []) == [] and got(spark, [], [("a", "ACGT")]) == []


def test_query_against_all_pairs(spark):
    from strandline.catalog import QUERIES

    sf = "/root/testdata/sf0.001"
    part = [tuple(r) for r in spark.read.parquet(f"{sf}/part.parquet").selectExpr("cast(p_partkey as string)", "p_name").collect()]
    best = {}
    names = [n for _, n in part]
    for i, n in part:
        s = a.scores(n.replace("e", ""), names)
        best[i] = (min(k for (k, _), x in zip(part, s) if x == s.max()), int(s.max()))
    assert {r.id: (r.ref, r.score) for r in QUERIES["m11_closest_name"](spark, sf).collect()} == best
