"""Alignment against one by byte offsets, the corpus counts against plain ones."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from strandline.llm import byte_bpe
from strandline.llm import sentencepiece_scan as sp
from strandline.llm import token_alignment as m

SF = "/root/testdata/sf0.001"


def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(byte_bpe.MODEL), sentencepiece.SentencePieceProcessor(model_file=sp.MODEL)
    a.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    byte = {chr(x if x in plain else next(rest)): x for x in range(256)}
    a_bytes = lambda i: b"" if a.id_to_token(i) in ("<|endoftext|>",) else bytes(byte[c] for c in a.id_to_token(i))
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return lambda t: a.encode(" " + t, add_special_tokens=False).ids, b.encode, a_bytes, b_bytes


def brute(texts):
    """Per text (n_a, n_b, groups, links) by offsets."""
    enc_a, enc_b, a_bytes, b_bytes = tokenizers()
    out = []
    for t in texts:
        if not t:
            out.append((0, 0, [], []))
            continue
        a, b = enc_a(t), enc_b(t)
        if b"".join(map(a_bytes, a)) != (" " + t).encode() or b"".join(map(b_bytes, b)) != (" " + t).encode():
            out.append((0, 0, [], []))
            continue
        ends = []
        for ids, of in ((a, a_bytes), (b, b_bytes)):
            at, e = 0, []
            for i in ids:
                at += len(of(i))
                e.append(at)
            ends.append(e)
        both = sorted(set(ends[0]) & set(ends[1]))
        groups = [([i for i, e in zip(a, ends[0]) if lo < e <= hi], [i for i, e in zip(b, ends[1]) if lo < e <= hi]) for lo, hi in zip([0, *both], both)] if len(a) < 400 else None
        links, i, j = [], 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            x, y = ends[0][i], ends[1][j]
            i, j = i + (x <= y), j + (y <= x)
        out.append((len(a), len(b), groups if groups is not None else both, links))
    return out


def counted(rows):
    """What link_strength should give, but for the digest of long texts."""
    found = brute([t for _, t in rows])
    docs = Counter(p for *_, links in found for p in set(links))
    top = defaultdict(int)
    for (a, _), n in docs.items():
        top[a] = max(top[a], n)
    out = []
    for (i, _), (n_a, n_b, groups, links) in zip(rows, found):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups) if groups and isinstance(groups[0], tuple) else None
        digest = "" if not n_a else hashlib.sha256(text.encode()).hexdigest() if text else None
        out.append((i, n_a, n_b, len(groups), len(links), sum(docs[p] == top[p[0]] for p in links), sum(docs[p] for p in links), digest))
    return out


def same(got, want):
    key = lambda r: repr(r[:7])
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert [r[:7] for r in got] == [r[:7] for r in want]
    assert all(w[7] is None or g[7] == w[7] for g, w in zip(got, want))


def odd(seed, n):
    rng = random.Random(seed)
    some = ["the ", "It's", "  ", "\n", "\t", "é", "漢字", "\U0001f600", "a", "zz9", " 12", "<|endoftext|>", "<s>", "<0x41>", "\xa0", "naïve ", "\x1c", "é", "."]
    return ["".join(rng.choice(some) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    same(m.op12_token_alignment(spark, SF).collect(), counted(rows))


@pytest.mark.parametrize("batch, block", [(50, 1 << 17), (4_000_000, 16)])
def test_odd_texts(spark, monkeypatch, batch, block):
    """Nulls, empty texts, repeated rows, bytes that B does not give back, and texts in many blocks and batches."""
    monkeypatch.setattr(m, "BATCH", batch)
    monkeypatch.setattr(byte_bpe, "BLOCK", block)
    texts = odd(1, 120) + [None, "", " ", "a▁b", "same text here", "same text here", " two  blanks ", "x" * 300, "one two three four " * 15]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5]]
    df = spark.createDataFrame([(i, t, "q", 3) for i, t in rows], "doc_id int, text string, p string, n int").repartition(3)
    same(m.link_strength(df).collect(), counted(rows))
    got = sorted((r.a, r.b) for r in m.groups(df).collect())
    assert got == sorted(([list(x) for x, _ in g], [list(y) for _, y in g]) for _, _, g, _ in brute([t for _, t in rows]))
    assert m.link_strength(df.where("doc_id = -1")).count() == 0


def test_memory_of_the_transducer(monkeypatch):
    """Forgetting changes nothing."""
    monkeypatch.setattr(m, "REMEMBERED", 3)
    of = m.Aligner(byte_bpe.MODEL, sp.MODEL)
    texts = odd(2, 60)
    want = [len(x[3]) for x in brute(texts)]
    got = [sum(len(p[2]) for p in found) if (found := list(parts)) and None not in found else 0 for parts in of.texts(texts)]
    assert got == want


def test_bytes_that_differ():
    t = m.Transducer([b"ab", b"c", b"a"], [b"a", b"bc", b"x"])
    assert t.align([0, 1], [0, 1]) == ([0 << 2 | 0, 0 << 2 | 1, 1 << 2 | 1], ["0,1|0,1"])
    assert t.align([2], [0]) == ([2 << 2], ["2|0"])
    for a, b in (([0, 1], [0]), ([0], [0, 1]), ([0], [2]), ([0, 1], [0, 2]), ([], [0]), ([2], [0, 0])):
        assert t.align(a, b) is None
    assert t.align([], []) == ([], [])


def test_a_very_long_text(spark):
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(80_000))
    same(m.link_strength(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect(), counted([(1, text)]))
