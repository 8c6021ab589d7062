"""Spelling variants against every pair of words, and against the SQL."""

import random
import re
import zlib
from collections import Counter

import pytest

from strandline.llm import spelling as m
from strandline.llm.common import Scratch

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(n):
    out = []
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def brute(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % 97 == 0:
                k = h % len(low)
                low = low[:k] + low[k + 1 :]
            n[low] += 1
    return grouped({w: k for w, k in n.items() if len(w) >= 5 and k >= 3})


COLUMNS = "word", "form", "root", "n", "n_near", "form_n"


def found(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("letters, size, seed", [("ab", (5, 9), 1), ("abcÀé", (5, 7), 2), ("abcdefghijklm", (5, 6), 3)])
def test_against_all_pairs(spark, letters, size, seed):
    """Few letters: words of one bigram many times over, and ties of counts."""
    rng = random.Random(seed)
    n = {"".join(rng.choice(letters) for _ in range(rng.randint(*size))): rng.choice((3, 3, 4, 6, 12, 50)) for _ in range(400)}
    for w in list(n)[:150]:
        i = rng.randrange(len(w))
        n.setdefault(rng.choice((w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :])), rng.choice((3, 25, 100)))
    n = {w: k for w, k in n.items() if len(w) >= 5}
    text = " ".join(w for w, k in n.items() for _ in range(k))
    rows = [(None, text[k : k + 500]) for k in range(0, len(text), 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(m.variants(df)) == brute(rows)
    pairs = m.near_pairs(spark.createDataFrame(list(n.items()), "word string, n long"), Scratch(spark)).collect()
    assert sorted((r.word, r.near) for r in pairs) == sorted((a, b) for a in n for b in n if one_edit(a, b))


def test_edge_cases(spark, monkeypatch):
    """Null and empty texts, repeated rows, odd characters, clashing columns, texts in blocks, words of a thousand letters, chains of forms."""
    monkeypatch.setattr(m, "BLOCK", 40)
    monkeypatch.setattr(m, "HELD", 5)
    chain = "xxxxx " * 3 + "xxxxy " * 6 + "xxxyy " * 12 + "xxyyy " * 24 + "xyyyy " * 48
    long = "ab" * 500
    texts = [None, "", "  12 3_4 ", "Straße STRASSE Ünïcode ÜNÏCODE ünïcode×÷ " * 4, chain, chain, f"{long} {long}c " * 3, "naïve naive " * 5, "naïve naive " * 5, "漢字word漢字words " * 9]
    rows = [(i if i % 4 else None, t) for i, t in enumerate(texts)] + [(7, "naïve naive")] * 3
    df = spark.createDataFrame([(i, t, 1, "w", "r") for i, t in rows], "doc_id int, text string, n int, word string, root string").repartition(2)
    got = found(m.variants(df))
    assert got == brute(rows)
    assert {r[0]: r[2] for r in got}["xxxxx"] == "xyyyy" and any(len(r[0]) > 999 for r in got)
    assert m.variants(df.where("doc_id = -1")).count() == 0


def test_query_against_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({m.OP11_SQL})").fetchall()
    assert found(m.op11_spelling(spark, SF)) == sorted(got) and len(got) > 100
    rows = con.execute("SELECT doc_id, text FROM documents").fetchall()
    assert len(got) == len(brute(rows))
