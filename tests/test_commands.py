"""Sub-commands over small files."""

import pytest
from helpers import rows

from strandline import commands


@pytest.fixture()
def inputs(tmp_path):
    (tmp_path / "a.fa").write_text(">x one\nAACCGGTTA\n>y\nACG\n>z\nACG\n")
    (tmp_path / "b.fq").write_text("@r1\nACGT\n+\nIIII\n")
    (tmp_path / "h.tsv").write_text("".join(f"q{k // 3}\ts{k}\t99\t5\t0\t0\t1\t5\t1\t5\t0.1\t{50 - k}\n" for k in range(6)))
    (tmp_path / "c.tsv").write_text("Contig\tDepth\tbases_with_depth\tcontigLen\tfraction_bases_with_depth\nk1\t1\t10\t20\t0.5\nk1\t2\t5\t20\t0.25\n")
    return lambda name: str(tmp_path / name)


@pytest.mark.parametrize("name, file, size, want", [
    ("lengths", "a.fa", 4, [("x", 9, 44.4444)]), ("revcomp", "b.fq", 1, [("r1", "ACGT")]), ("chop", "a.fa", 4, [("x.0", "AACC"), ("x.1", "GGTTA"), ("y.0", "ACG"), ("z.0", "ACG")]),
    ("dereplicate", "a.fa", 1, [("x;size=1", "AACCGGTTA"), ("y;size=2", "ACG")]), ("to-fasta", "b.fq", 1, [("r1", "ACGT")]), ("scaffold-coverage", "c.tsv", 1, [("k1", 1.0, 20)]),
])
def test_command(spark, inputs, name, file, size, want):
    assert rows(commands.run(spark, name, [inputs(file)], size)) == want


def test_commands_of_several_files(spark, inputs, tmp_path):
    assert [r.records for r in commands.run(spark, "count", [inputs("a.fa")], 1).collect()] == [3]
    assert [(r.n, r.l) for r in commands.run(spark, "n50", [inputs("a.fa")], 1).collect()] == [(9, 1)]
    assert [r.subject for r in commands.run(spark, "top-hits", [inputs("h.tsv")], 2).orderBy("subject").collect()] == ["s0", "s1", "s3", "s4"]
    lines = [r.value for r in commands.run(spark, "concat", [inputs("b.fq"), inputs("a.fa")], 1).collect()]
    assert lines[0] == "@r1" and lines[4] == ">x one" and len(lines) == 10
    out = str(tmp_path / "out")
    commands.run(spark, "revcomp", [inputs("a.fa")], 1, out)
    assert sorted(r.value for r in spark.read.text(out).collect()) == sorted([">x", "TAACCGGTT", ">y", "CGT", ">z", "CGT"])
