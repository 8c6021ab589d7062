"""Pipelines, settings and SQL functions."""

import pytest
from helpers import rows

from strandline import config
from strandline.functions.register import register
from strandline.plans import pipelines
from strandline.sources import formats


def test_prep_orders_files(spark):
    names = ["s1_ACGT_S1_L002_R1_001.fastq", "s1_ACGT_S1_L001_R1_002.fastq", "s1_ACGT_S1_L001_R1_001.fastq", "s1_ACGT_S1_L001_R2_001.fastq", "x.txt"]
    got = {(r["sample"], r.dir): r.files for r in pipelines.prep(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert got == {("s1", 1): [names[2], names[1], names[0]], ("s1", 2): [names[3]]}


def test_read_counts_and_qc(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">x\nA\n>y\nC\n")
    (tmp_path / "b.fastq").write_text("@r1\nACG\n+\n!!!\n@r1\nTT\n+\nII\n@r2\nACG\n+\nIII\n@r2\nTT\n+\nII\n@r3\nA\n+\nI\n@r3\nTT\n+\nII\n")
    got = {r.file.rsplit("/", 1)[-1]: r.reads for r in pipelines.read_counts(spark, [str(tmp_path / "a.fasta"), str(tmp_path / "b.fastq")]).collect()}
    assert got == {"a.fasta": 2, "b.fastq": 6}
    pairs = formats.interleaved_pairs(formats.fastq(spark, str(tmp_path / "b.fastq")))
    kept = pipelines.quality_control(pairs, 2).collect()
    assert [r.fwd.id for r in kept] == ["r2"]


def test_binning(spark):
    contigs = spark.createDataFrame([("a", "ACGT"), ("b", "GG"), ("c", "T")], "id string, seq string")
    chunks = spark.createDataFrame([("a", 0, 1), ("a", 1, 1), ("b", 0, 1), ("b", 1, 2)], "contig string, chunk int, bin long")
    binned, ambiguous, edges = pipelines.binning(contigs, chunks)
    assert rows(binned) == [(1, "a", "ACGT")] and rows(ambiguous) == [("b", 2)] and rows(edges) == [(1, 2, 1)]


def test_quality_changes(spark):
    d = spark.createDataFrame([("p", "s", "t1", "before", "FAIL"), ("p", "s", "t1", "after", "PASS"), ("p", "s", "t2", "before", "PASS"), ("p", "s", "t2", "after", "PASS"), ("p", "s", "t3", "before", "PASS")], "path string, prefix string, test string, infix string, mark string")
    assert [r[2] for r in rows(pipelines.quality_changes(d))] == ["t1", "t3"]


def test_settings(tmp_path):
    assert config.load(tmp_path) == config.Project()
    config.save(config.Project(name="x", threads=9, verbose=True), tmp_path)
    (tmp_path / "sub").mkdir()
    assert config.load(tmp_path / "sub") == config.Project(name="x", threads=9, verbose=True)
    (tmp_path / config.FILE).write_text("[project]\nwhat = 1\n")
    with pytest.raises(ValueError):
        config.load(tmp_path)


def test_sql_functions(spark):
    assert "revcomp" in register(spark)
    r = spark.sql("SELECT revcomp('ACGTN') a, gc_percent('GGCA') b, kmers('ACG', 2) c, canonical_kmer('TTT') d, mean_phred('!I') e, degap('.A-C.') f, gc_percent('') g").first()
    assert tuple(r) == ("NACGT", 75.0, ["AC", "CG"], "AAA", 20.0, "AC", None)


def test_quality_steps(spark):
    read = lambda p, m, s, q: (p, m, s, q * len(s))
    rows = [read(1, 0, "ACGTACGT", "I"), read(1, 1, "TTTTCCCC", "I"), read(2, 0, "ACGTACGT", "5"), read(2, 1, "TTTTCCCC", "5"), read(3, 0, "GGGGNNNN", "I"), read(3, 1, "CCCCAAAA", "I"), read(4, 0, "GATTACAG", "#"), read(4, 1, "AC", "I")]
    pairs, steps = pipelines.quality_steps(spark.createDataFrame(rows, "pair int, mate int, seq string, qual string"), 4, 20, 1)
    assert rows_of(pairs) == {1: ("ACGTACGT", "TTTTCCCC"), 3: ("N", "CCCCAAAA")}
    assert {r.step: r.reads for r in steps.collect()} == {"raw": 8, "distinct": 6, "good": 4, "long": 3}


def rows_of(pairs):
    return {r.pair: (r.fwd.seq, r.rev.seq) for r in pairs.collect()}


def test_assembly_report(spark):
    contigs = spark.createDataFrame([("c1", "AACCGGTT"), ("c2", "ACGT")], "id string, seq string")
    blast = spark.createDataFrame([("c1", "s1", 1, 4, 0), ("c1", "s2", 8, 5, 1), ("c1", "s3", 1, 4, 2), ("c2", "s1", 2, 3, 3)], "query string, subject string, qstart int, qend int, ord long")
    assert rows(pipelines.assembly_report(contigs, blast, 2)) == [("c1", "s1", 1, 1, 4, "AACC"), ("c1", "s2", 2, 8, 5, "GGTT"), ("c2", "s1", 1, 2, 3, "CG")]
