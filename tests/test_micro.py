"""Golden cases of single operators."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from strandline.functions import text as t
from strandline.operators import annotation, coverage, hits, matrix, sequences
from strandline.operators.alignment import scores


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def seqs(spark, *s):
    return spark.createDataFrame([(i, f"s{i}", x) for i, x in enumerate(s)], "ord long, id string, seq string")


@pytest.mark.parametrize("f, s, want", [
    (t.reverse_complement, "ACGTN", "NACGT"), (t.reverse_complement, "acg", "CGT"), (t.degap, "..A-C.G-..", "AC.G"), (t.dna_letters, "AU.G-C U", "ATGCT"),
    (t.beautify, "a  b (c)!", "a_b_c"), (t.capital_first, "abC", "AbC"), (lambda c: t.wrap_lines(c, 3), "ABCDEFG", "ABC\nDEF\nG"), (t.canonical, "TTT", "AAA"), (t.first_token, "id some words", "id"),
])
def test_text(spark, f, s, want):
    assert one(spark, f(F.lit(s))) == want


def test_numbers_of_text(spark):
    assert one(spark, t.gc_percent(F.lit("GGCA"))) == 75.0
    assert one(spark, t.gc_percent(F.lit(""))) is None
    assert one(spark, t.kmers(F.lit("ACGT"), 3)) == ["ACG", "CGT"]
    assert one(spark, t.kmers(F.lit("AC"), 3)) == []
    assert one(spark, t.phred(F.lit("!I"))) == [0, 40]
    assert one(spark, t.quality_string(F.lit("0 40 2"))) == "!I#"
    assert one(spark, t.column_at(F.lit("a\tb\tc"), -1)) == "c"
    assert one(spark, t.column_at(F.lit("a"), 5)) is None


def test_chop_takes_the_tail(spark):
    got = rows(sequences.chop(seqs(spark, "x" * 25, "y" * 4, ""), 10).select("id", "piece", F.length("seq")))
    assert got == [("s0", 0, 10), ("s0", 1, 15), ("s1", 0, 4), ("s2", 0, 0)]


def test_chop_overlapping(spark):
    assert [r[2] for r in rows(sequences.chop_overlapping(seqs(spark, "abcdefgh"), 4, 1))] == ["abcd", "defg", "gh"]


def test_unchop(spark):
    d = spark.createDataFrame([("k141_5", 0, "AA"), ("k141_5", 1, "CC"), ("k141_5", 3, "GG")], "contig string, chunk int, seq string")
    assert rows(coverage.glue(d)) == [("k141_5.0-1", "AACC"), ("k141_5.3", "GG")]


def test_n50(spark):
    d = spark.createDataFrame([("a", 5), ("a", 3), ("a", 2), ("b", 4), ("b", 4), ("b", 4)], "g string, len long")
    assert rows(coverage.n50(d, "g")) == [("a", 5, 1), ("b", 4, 2)]


def test_gc_skew(spark):
    got = sequences.gc_skew(seqs(spark, "CCCG" * 3), 4, 0, 10).first()
    assert (got.gc, got.skew) == (100.0, 50.0)


def test_runs(spark):
    assert rows(sequences.character_runs(seqs(spark, "AANNNA", "", "NN"), "Nn", 2)) == [("s0", 2, 5, 3), ("s2", 0, 2, 2)]
    assert rows(sequences.character_runs(seqs(spark, "N" * 7), "N", 2, 3)) == [("s0", 0, 3, 3), ("s0", 3, 6, 3)]
    assert rows(sequences.spacers(sequences.find_all(seqs(spark, "xxABxxAB"), "AB"), 2)) == [("s0", 0, 2), ("s0", 4, 6)]


def test_majority(spark):
    d = spark.createDataFrame([("a", 0, 1), ("a", 1, 1), ("a", 2, None), ("a", 3, 2), ("b", 0, 1), ("b", 1, 1), ("b", 2, 2), ("c", 0, None)], "contig string, chunk int, bin long")
    assert rows(coverage.majority_bins(d)) == [("a", 4, None, True), ("b", 3, 1, False), ("c", 1, None, False)]
    assert rows(coverage.cross_bin_edges(d)) == [(1, 2, 2)]


def test_mean_coverage(spark):
    d = spark.createDataFrame([("c", 0, 1, 10, 20), ("c", 0, 2, 5, 20)], "contig string, sample int, depth int, bases long, len long")
    assert coverage.scaffold_coverage(d).first().coverage == 1.0
    wide = coverage.merge_coverage(spark.createDataFrame([("c",), ("d",)], "contig string"), d, [0, 1])
    assert rows(wide) == [("c", 1.0, 0.0), ("d", 0.0, 0.0)]


def test_equal_best_hits_share(spark):
    d = spark.createDataFrame([("q", "s1", 90.0), ("q", "s2", 90.0), ("q", "s3", 10.0)], "query string, subject string, bitscore double")
    assert [r[:2] for r in rows(hits.subject_scores(d, 10))] == [("s1", 0.5), ("s2", 0.5)]


def test_jaccard(spark):
    d = spark.createDataFrame([("a", "o1", 1), ("a", "o2", 1), ("b", "o1", 2), ("b", "o3", 1), ("c", "o9", 1)], "sample string, otu string, count long")
    assert rows(matrix.jaccard_pairs(d)) == [("a", "b", 1, 0.333333)]


@pytest.mark.parametrize("counts, want", [((999, 1), 2), ((1999, 1), 1)])
def test_abundance_floor(spark, counts, want):
    d = spark.createDataFrame([("a", f"o{i}", c) for i, c in enumerate(counts)], "sample string, otu string, count long")
    assert matrix.abundance_floor(d, 1000).count() == want


def test_overlap_includes_ends_and_counts_once(spark):
    a = spark.createDataFrame([("x", 10, 20), ("x", 0, 500), ("y", 1, 2)], "scaffold string, start int, stop int")
    b = spark.createDataFrame([("x", 20, 30), ("x", 21, 400), ("x", 600, 700)], "scaffold string, start int, stop int")
    got = rows(coverage.overlap_join(a, b, "scaffold").select("start", "stop", "r_start", "r_stop"))
    assert got == [(0, 500, 20, 30), (0, 500, 21, 400), (10, 20, 20, 30)]


def test_depth_and_islands(spark):
    d = spark.createDataFrame([("x", 1, 3), ("x", 3, 5), ("x", 9, 9)], "scaffold string, start int, stop int")
    assert rows(coverage.depth_profile(d)) == [("x", 1, 2, 1), ("x", 3, 3, 2), ("x", 4, 5, 1), ("x", 9, 9, 1)]
    assert rows(coverage.covered_islands(d, least=2)) == [("x", 1, 5, 2)]


def test_dereplicate(spark):
    d = seqs(spark, "AA", "CC", "AA")
    assert rows(sequences.dereplicate(d).select("representative", "size")) == [("s0", 2), ("s1", 1)]
    assert rows(sequences.dereplicate(d, F.col("ord")).select("representative", "size")) == [("s1", 1), ("s2", 2)]


def test_mates(spark):
    d = spark.createDataFrame([("p", 0, "A"), ("p", 1, "C"), ("q", 0, "G"), ("r", 1, "T")], "pair string, mate int, seq string")
    assert rows(sequences.mates(d)) == [("p", "A", "C", "pair"), ("q", "G", None, "forward only"), ("r", None, "T", "reverse only")]


def test_attributes_last_wins(spark):
    d = spark.createDataFrame([("a=1;b=2;a=3",), ("c=x=y",), ("",), (None,)], "attributes string")
    got = annotation.expanded(d, "attributes")
    assert rows(got) == [("3", "2", None), (None, None, "x=y"), (None, None, None), (None, None, None)]


def test_longest_prefix(spark):
    a = spark.createDataFrame([("s1_x",), ("s10",), ("z",)], "a string")
    b = spark.createDataFrame([("s1",), ("s1_",), ("s",)], "b string")
    assert rows(matrix.longest_prefix(a, b, "a", "b")) == [("s10", "s1"), ("s1_x", "s1_")]


def test_alignment_scores():
    assert scores("ACGT", ["ACGT", "AGT", "", "TTTT"]).tolist() == [4, 2, -4, -2]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "contig string, sample int, depth int, bases long, len long")
    assert coverage.scaffold_coverage(empty).count() == 0
    assert matrix.jaccard_pairs(spark.createDataFrame([], "sample string, otu string, count long")).count() == 0
    assert sequences.dereplicate(seqs(spark).limit(0) if False else spark.createDataFrame([], "ord long, id string, seq string")).count() == 0


@pytest.mark.parametrize("s, want", [("", ""), ("f", "MY"), ("foobar", "MZXW6YTBOI"), ("read 1;é", None), ("\u6f22", None)])
def test_base32(spark, s, want):
    import base64

    code = base64.b32encode(s.encode()).decode().rstrip("=")
    assert one(spark, t.base32(F.lit(s))) == code and (want is None or want == code)
    assert one(spark, t.from_base32(F.lit(code.lower() + "==="))) == s


def test_deep_taxonomies(spark):
    """A chain of a thousand nodes, walks without end, and a circle."""
    rows_ = [(i, i - 1, "x", f"n{i}") for i in range(1, 1001)] + [(0, 0, "phylum", "top"), (5000, 5000, "no rank", "root"), (5001, 5000, "y", "z"), (6001, 6000, "y", "lost")]
    nodes = spark.createDataFrame(rows_, "taxid int, parent int, rank string, name string")
    start = spark.createDataFrame([(1000,), (3,), (0,), (5001,), (6001,), (3,)], "taxid int")
    assert rows(annotation.climb(nodes, start, ("phylum",))) == [(0, "top", "phylum", 0), (1000, "top", "phylum", 1000), (3, "top", "phylum", 3), (3, "top", "phylum", 3)]
    with pytest.raises(ValueError, match="circle"):
        annotation.climb(spark.createDataFrame([(1, 2, "x", "a"), (2, 1, "x", "b")], "taxid int, parent int, rank string, name string"), start, ("phylum",))


def test_a_walk_too_far_is_an_error(spark):
    nodes = spark.createDataFrame([(i, i - 1, "x", f"n{i}") for i in range(1, 9)] + [(0, 0, "phylum", "top")], "taxid int, parent int, rank string, name string")
    assert annotation.climb(nodes, nodes.where("taxid = 8").select("taxid"), ("phylum",), 9).first().depth == 8
    with pytest.raises(Exception, match="more than 5 steps up from 8"):
        annotation.climb(nodes, nodes.where("taxid = 8").select("taxid"), ("phylum",), 5).collect()


@pytest.mark.parametrize("exclude", [False, True])
def test_listed_tokens_carry_no_header(spark, monkeypatch, exclude):
    """A short list needs no shuffle, a long one no header beside each token; null headers are in no list."""
    d = spark.createDataFrame([(1, "the cat " * 3), (2, "a dog"), (3, "THE end"), (4, ""), (5, None), (6, "a dog"), (7, "theatre")], "k int, header string")
    ids = spark.createDataFrame([("the",), ("END",), (None,)], "name string")
    plans = []
    for most in (1_000, 1):
        monkeypatch.setattr(hits, "SHORT_LIST", most, raising=False)
        got = hits.listed_tokens(d, ids, "header", "name", exclude)
        assert got.columns == ["k", "header"]
        assert sorted(r.k for r in got.collect()) == ([2, 4, 5, 6, 7] if exclude else [1, 3])
        plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert "Exchange" not in plans[0]
    assert not [x for x in plans[1].split("\n") if "Generate explode" in x and "header" in x.split("false, [")[0].split("), [")[-1]]


def test_places_of_more_rows_than_are_sampled(spark):
    """Ranges are cut by a sample, which differs from one evaluation to the next: the partitions and their sizes must be of one."""
    from strandline import catalog

    ranked_globally = catalog.hits.ranked_globally
    n = 60_000
    d = spark.range(0, n, 1, 8).select(((F.col("id") * 7_919) % n).alias("a"), F.concat(F.lit("x"), "id").alias("b"))
    ranked = ranked_globally(d, [F.desc("a")])
    assert ranked.columns == ["a", "b", "place"]
    assert ranked.where((F.col("a") + F.col("place") != n) | (F.length("b") < 2)).count() == 0 and ranked.count() == n


def test_base32_of_a_long_text(spark):
    """Linear in the text's length: the bits of a text are not made again for each of its digits."""
    import base64
    import time

    s = "a header of é and 中 " * 150
    want = base64.b32encode(s.encode()).decode().rstrip("=")
    began = time.time()
    got = spark.createDataFrame([(s,)], "s string").select(t.base32(F.col("s")).alias("code"), t.from_base32(t.base32(F.col("s"))).alias("back")).first()
    assert (got.code, got.back) == (want, s)
    assert time.time() - began < 20


def test_sketches_are_not_kept_by_subject(spark):
    from strandline.catalog import QUERIES

    plan = QUERIES["a50_approx_distinct"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.split("\n") if "approx_count_distinct" in x and "subject" in x.split("keys=[")[1].split("]")[0]]


def test_chains_that_have_ended_are_not_written_again(spark, monkeypatch):
    from strandline.operators.rounds import Rounds, followed

    pairs = [(k, k + 1) for k in range(40)] + [(k, k - 1 if k % 2 else None) for k in range(1_000, 2_000)] + [(5_000, 5_000), (5_001, 1_001)]
    written, kept = [], Rounds.counted

    def counted(self, df, **counts):
        out, seen = kept(self, df, **counts)
        written.append(out.count())
        return out, seen

    monkeypatch.setattr(Rounds, "counted", counted)
    links = spark.createDataFrame(pairs, "node long, to long")
    got = {r.node: (r.to, r.steps) for r in followed(links, Rounds(spark)).collect()}
    assert len(got) == len(pairs)
    assert all(got[k] == (40, 40 - k) for k in range(40)) and got[1_001] == (1_000, 1) and got[1_000] == (1_000, 0) and got[5_000] == (5_000, 0) and got[5_001] == (1_000, 2)
    assert max(written[2:]) < 50
