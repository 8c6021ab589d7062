"""Greedy clusterings against plain sequential ones."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from strandline.operators import clustering as c
from strandline.operators.rounds import Rounds, followed


def walked(hits, subjects):
    """Families by reading (part, query, subject, score) one by one."""
    want = set()
    for part in {h[0] for h in hits}:
        family = {}
        for _, q, s, _ in sorted((h for h in hits if h[0] == part), key=lambda h: (h[3] is None, -(h[3] or 0), h[1], h[2])):
            family.setdefault(q, family.get(s, q))
            if subjects:
                family.setdefault(s, family[q])
        want |= {(part, g, f) for g, f in family.items()}
    return want


@pytest.mark.parametrize("subjects", [True, False])
@pytest.mark.parametrize("genes, n, ties", [(40, 150, 30), (400, 300, 5), (3, 40, 2)])
def test_families_against_a_plain_walk(spark, subjects, genes, n, ties):
    rng = random.Random(genes)
    h = [(p, rng.randrange(genes), rng.randrange(genes), float(rng.randrange(ties))) for p in (0, 1) for _ in range(n)]
    h += h[:5] + [(1, 1, 2, None), (2, 7, 7, 1.0)]
    df = spark.createDataFrame(h, "part long, query long, subject long, bitscore double").repartition(3)
    assert set(rows(c.families(df, subjects=subjects))) == walked(h, subjects)


def test_families_in_a_long_chain(spark):
    """Each gene's family comes from the gene before it; null genes count for nothing."""
    h = [(i + 1, i, 1000.0 - i) for i in range(300)] + [(None, 5, 9999.0), (5, None, 9999.0)]
    df = spark.createDataFrame(h, "query long, subject long, bitscore double")
    assert rows(c.families(df, ())) == rows(spark.createDataFrame([(i, 1) for i in range(301)], "gene long, family long"))
    assert c.families(df.limit(0), ()).count() == 0


def test_chains(spark):
    links = [(f"n{i}", f"n{i + 1}") for i in range(1000)] + [("a", "a"), ("b", None), ("c", "gone")]
    got = {r.node: (r.to, r.steps) for r in followed(spark.createDataFrame(links, "node string, to string"), Rounds(spark)).collect()}
    assert got["n0"] == ("n1000", 1000) and got["n999"] == ("n1000", 1)
    assert got["a"] == ("a", 0) and got["b"] == ("b", 0) and got["c"] == ("gone", 1)
    with pytest.raises(ValueError, match="circle"):
        followed(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "node string, to string"), Rounds(spark))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def greedy(seqs, identity, k, window):
    """(id, seq) -> the centroid of each, read one by one."""
    least = {}
    for i, s in seqs:
        least[s or ""] = min(i, least.get(s or "", i))
    marks = {s: set(c.minimizers(s, k, window).tolist()) for s in least}
    chosen, of = [], {}
    for s in sorted(least, key=lambda s: (-len(s), least[s])):
        for r in chosen:
            if marks[r] & marks[s] and edits(r, s) <= int((1 - identity) * max(len(r), len(s)) + 1e-9):
                of[s] = least[r]
                break
        else:
            chosen.append(s)
            of[s] = least[s]
    return sorted((i, of[s or ""]) for i, s in seqs)


def mutated(rng, n, letters="ACGT", size=(20, 60), families=8):
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(*size))) for _ in range(families)]
    out = []
    for i in range(n):
        s = list(rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 2, 5, 9))):
            j = rng.randrange(len(s))
            s[j : j + 1] = rng.choice(([], [rng.choice(letters)], [s[j], rng.choice(letters)]))
        out.append((f"s{i:03d}", "".join(s)))
    return out


@pytest.mark.parametrize("seed, identity, first", [(1, 0.9, 64), (2, 0.8, 2), (3, 0.7, 8)])
def test_centroids_against_a_plain_reading(spark, seed, identity, first):
    seqs = mutated(random.Random(seed), 120) + [("x", ""), ("y", None), ("z", "AC"), ("zz", "AC")]
    df = spark.createDataFrame([(i, s, "g") for i, s in seqs], "id string, seq string, grp string").repartition(3)
    got = c.centroids(df, identity, 4, 3, first=first)
    assert sorted((r.id, r.centroid) for r in got.collect()) == greedy(seqs, identity, 4, 3)


def test_groups_are_clustered_by_themselves(spark):
    a, b = mutated(random.Random(4), 30), mutated(random.Random(5), 30)
    df = spark.createDataFrame([(i, s, "a") for i, s in a] + [(i, s, None) for i, s in b], "id string, seq string, grp string")
    got = c.centroids(df, 0.8, 4, 3).collect()
    assert sorted((r.id, r.centroid) for r in got if r.grp == "a") == greedy(a, 0.8, 4, 3)
    assert sorted((r.id, r.centroid) for r in got if r.grp is None) == greedy(b, 0.8, 4, 3)
    assert c.centroids(df.limit(0), 0.8).count() == 0


def test_iterated_clusters(spark):
    """Clusters of four and more again at the next identity; the same identity again ends it where nothing comes apart."""
    seqs = mutated(random.Random(6), 80, families=5)
    want, now = set(), {"": seqs}
    for level, identity in enumerate((0.6, 0.8, 0.9)):
        after = {}
        for grp, some in now.items():
            text = dict(some)
            for i, centroid in greedy(some, identity, 4, 3):
                cluster = f"{grp}/{centroid}" if grp else centroid
                want.add((i, text[i], level, cluster))
                after.setdefault(cluster, []).append((i, text[i]))
        now = {k: x for k, x in after.items() if len(x) >= 4}
    df = spark.createDataFrame(seqs, "id string, seq string")
    assert set(rows(c.iterated(df, (0.6, 0.8, 0.9), 4, k=4, window=3))) == want
    assert c.iterated(df, (0.8, 0.8, 0.8, 0.8, 0.8), 2, k=4, window=3).agg(F.max("level")).first()[0] < 4
