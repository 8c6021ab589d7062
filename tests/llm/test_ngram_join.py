"""The set join against every pair compared, and its edge cases."""

import itertools
import random

import pytest

from strandline.llm import ngram_join as m

SCHEMA = "doc_id long, text string, n string, component string"


def sets(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    s = {i: sets(t) for i, t in rows}
    comp = {i: i for i in s}

    def top(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a, b in itertools.combinations(s, 2):
        both = len(s[a] & s[b])
        if s[a] and s[b] and 100 * both >= 80 * len(s[a] | s[b]):
            x, y = sorted((top(a), top(b)))
            comp[y] = x
    return sorted((i, len(s[i]), top(i)) for i in s)


def corpus(seed, n=260, words=(1, 70)):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 3)))
    passage = [word() for _ in range(25)]
    base = [[word() for _ in range(rng.randint(*words))] for _ in range(12)]
    out = []
    for i in range(n):
        t = list(rng.choice(base)) if rng.random() < 0.8 else [word() for _ in range(rng.randint(*words))]
        for _ in range(rng.choice((0, 0, 1, 1, 2, 3))):
            t[rng.randrange(len(t))] = word()
        if rng.random() < 0.3:
            t += passage
        out.append((i * 3, rng.choice((" ", "\n", "\t ")).join(t)))
    return out


@pytest.mark.parametrize("seed, words", [(1, (1, 70)), (2, (4, 30)), (3, (30, 90))])
def test_against_all_pairs(spark, seed, words, monkeypatch):
    monkeypatch.setattr(m, "BLOCK_DOCS", 16)
    rows = corpus(seed, words=words)
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA).repartition(5)
    assert sorted(map(tuple, m.near_duplicates(df).collect())) == brute(rows)


def test_exhaustive_rest_alone(spark, monkeypatch):
    """With no comparison allowed before, the blocks must find every component."""
    monkeypatch.setattr(m, "LIGHT_MOST", 0)
    monkeypatch.setattr(m, "BLOCK_DOCS", 7)
    rows = corpus(4, 150)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, m.near_duplicates(df).collect())) == brute(rows)


def test_many_ranges_and_small_batches(spark, monkeypatch):
    """More ranges than a batch has elements: few documents have any in one."""
    monkeypatch.setattr(m, "RANGE_ELEMENTS", 1)
    monkeypatch.setattr(m, "BATCH_MOST", 50)
    rows = corpus(6, 120)
    assert sorted(map(tuple, m.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())) == brute(rows)


def test_very_long_texts(spark):
    """A giant, its near copy and another giant, beside short texts; ties of size."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(150_000)]
    near = list(words)
    near[::5_000] = ["zzz"] * 30
    rows = [(9, " ".join(words)), (4, " ".join(near)), (7, " ".join(words[::-1])), (1, "a b c d e f"), (2, "a b c d e g"), (3, "x")]
    got = {r.doc_id: r.component_id for r in m.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {9: 4, 4: 4, 7: 7, 1: 1, 2: 2, 3: 3}


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "a b c d"), (7, "a b c d e"), (8, "A b c D e"), (9, "É a b c d"), (10, "é a b c d"), (None, "a b c d e")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in m.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (1, 6), 7: (1, 7), 8: (1, 7), 9: (1, 9), 10: (1, 10), None: (None, None)}


def test_empty_and_repeated(spark):
    assert m.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = m.near_duplicates(spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == [(1, 2, 1), (1, 2, 1), (2, 2, 1)]


def test_threshold_is_exact():
    for n, k in itertools.product(range(1, 40), repeat=2):
        least = m.least_overlap(n, k)
        assert 100 * least >= 80 * (n + k - least) and 100 * (least - 1) < 80 * (n + k - least + 1)


def test_boundary_follows_cost():
    assert m.boundary({8: 1000}, 1e6) >= 8
    assert m.boundary({20: 1000}, 1.0) < 20
