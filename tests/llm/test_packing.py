"""Packing: the reduction and best fit against every packing, the query against the tokenizer's own ids."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from strandline.llm import byte_bpe as b
from strandline.llm import packing as p

SF = "/root/testdata/sf0.001"


def fewest(lengths, capacity):
    """By trying every packing."""
    lengths, best, room = sorted(lengths, reverse=True), [len(lengths)], []

    def go(i):
        if len(room) >= best[0] or i == len(lengths):
            best[0] = min(best[0], len(room))
            return
        for k, r in enumerate(room):
            if r >= lengths[i] and r not in room[:k]:
                room[k] -= lengths[i]
                go(i + 1)
                room[k] += lengths[i]
        room.append(capacity - lengths[i])
        go(i + 1)
        room.pop()

    go(0)
    return best[0]


def total(plan):
    got = Counter()
    for times, has in plan:
        for w, k in has:
            got[w] += times * k
    return got


@pytest.mark.parametrize("seed", range(4))
def test_reduction_keeps_a_best_packing(seed):
    rng = random.Random(seed)
    for _ in range(300):
        capacity = rng.choice((10, 20, 37, 50))
        least = rng.choice((1, 3, capacity // 5, capacity // 4))
        lengths = [rng.randint(least, capacity) for _ in range(rng.randint(1, 9))]
        fixed, left = p.reduce(Counter(lengths), capacity)
        best = fewest(lengths, capacity)
        assert sum(n for n, _ in fixed) + fewest(list(Counter(left).elements()), capacity) == best
        plan = fixed + p.best_fit(left, capacity)
        assert total(plan) == Counter(lengths) and all(sum(w * k for w, k in has) <= capacity for _, has in plan)
        assert p.lower_bound(Counter(lengths), capacity) <= best <= sum(n for n, _ in plan)


def test_dominating_sets():
    count = Counter([7, 3, 2, 1])
    assert p.dominating(count, 7, p.sums(count, 10), 10) == (7, 3)  # fills up
    count = Counter([9, 5, 5, 2])
    assert p.dominating(count, 9, p.sums(count, 10), 10) == (9,)  # nothing fits
    count = Counter([6, 3, 2, 2])
    assert p.dominating(count, 6, p.sums(count, 10), 10) is None  # 2 + 2 is more than 3
    count = Counter([50, 30, 18, 16])
    assert p.dominating(count, 50, p.sums(count, 100), 100) == (50, 30, 18)  # at most two fit, and these are the longest


def test_best_fit_is_the_plain_one():
    """The same contents as one piece at a time."""
    rng = random.Random(9)
    for _ in range(200):
        capacity = rng.choice((17, 40, 64))
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 60))]
        room, has = [], []
        for w in sorted(lengths, reverse=True):
            fit = [i for i, r in enumerate(room) if r >= w]
            if not fit:
                room.append(capacity), has.append([])
                fit = [len(room) - 1]
            i = min(fit, key=lambda i: room[i])
            room[i] -= w
            has[i].append(w)
        assert len(room) == sum(n for n, _ in p.best_fit(Counter(lengths), capacity))


def test_large_counts_take_one_step_a_length():
    rng = random.Random(2)
    count = {w: rng.randint(1, 10**12) for w in range(1, 2049)}
    plan = p.patterns(count)
    assert total(plan) == count and len(plan) < 8 * 2048
    assert sum(n for n, _ in plan) <= 1.01 * p.lower_bound(count)


def check(rows, capacity):
    """No gaps, no overlaps, nothing over capacity; returns the number of sequences."""
    at = defaultdict(list)
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length))
    for parts in at.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= capacity
    return len(at)


def test_query_against_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(b.MODEL)
    want, count = {}, Counter()
    for d in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(d.text or "", add_special_tokens=False).ids + [0]
        cut = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        for no, (s, e) in enumerate(zip(cut, cut[1:])):
            want[d.doc_id, no] = (s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes()))
            count[e - s] += 1
    got = p.op13_packing(spark, SF).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    n = check(got, 2048)
    assert p.lower_bound(count) <= n <= sum(k for k, _ in p.patterns(count))


def test_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(p, "SHARD", 3)
    rows = [(1, None), (2, ""), (2, ""), (None, "one two three"), (3, "ab " * 40), (3, "ab " * 40), (4, "x" * 5000), (5, " " * 30), (6, "a<|endoftext|>b")]
    df = spark.createDataFrame([(i, t, "q", 7, 0, "r") for i, t in rows], "doc_id int, text string, ids string, length int, sequence_id int, part string")
    pieces = p.tokenized(df.repartition(3), capacity=16)
    packed = p.pack(pieces, 16)
    got = packed.collect()
    assert check(got, 16) and sorted(r.length for r in got if r.doc_id == 2) == [1, 1]
    assert all(r.length == 16 for r in got if r.piece) and len({(r.doc_id, r.piece, r.sequence_id, r.offset) for r in got}) == len(got)
    made = p.sequences(packed).collect()
    assert sum(r.n_tokens for r in made) == sum(r.length for r in got) and all(len(r.ids) == 4 * r.n_tokens <= 64 for r in made)
    by = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in made}
    for r in got:
        assert by[r.sequence_id][r.offset : r.offset + r.length].tobytes() == bytes(r.ids)
    assert p.op13_packing.__name__ and p.pack(p.tokenized(df.where("doc_id = 99"))).count() == 0
    odd = spark.createDataFrame([(1, None, "a"), (2, 0, "b"), (3, 17, "c"), (4, 16, "d")], "k long, length long, row string")
    assert sorted((r.k, r.sequence_id, r.offset, r.row) for r in p.pack(odd, 16).collect()) == [(1, None, None, "a"), (2, None, None, "b"), (3, None, None, "c"), (4, 0, 0, "d")]


def test_ids_are_the_library_s(monkeypatch):
    """Every kind of character, special tokens, texts that one engine refuses, and texts cut into blocks."""
    from tokenizers import Tokenizer

    library, bpe = Tokenizer.from_file(b.MODEL), b.byte_bpe(b.MODEL)
    rng = random.Random(4)
    texts = ["", " ", "a  b", "it's  we'll\n\n x", "a<|endoftext|> b", "\x1c\x85 　 x​", " " * 1_200_000 + "x", "漢字かな" * 500]
    texts += ["".join(chr(c) for c in range(at, at + 64) if not 0xD800 <= c < 0xE000) for at in range(0, 0x20000, 1280)]
    texts += ["".join(rng.choice("ab1 .'\n\t\x1c\xa0é漢\U0001f600   ") for _ in range(300)) for _ in range(200)]
    for special in (True, False):
        library.encode_special_tokens = not special
        for t in texts:
            want = library.encode(t, add_special_tokens=False).ids
            assert bpe.encode(t, special).tolist() == want
            for size in (1, 20):
                monkeypatch.setattr(b, "BLOCK", size)
                assert np.concatenate([bpe.encode(x, special) for x in b.blocks(t)]).tolist() == want
    assert b"".join(bpe.bytes[i] for i in bpe.encode(texts[5], False)) == texts[5].encode()
