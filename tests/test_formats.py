"""Readers and writers on small files."""

import gzip
import struct
import zipfile

import pytest
from helpers import rows

from strandline.sources import files, formats, sinks


def put(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


FASTA = ">a one\nACG\nT\n>b >odd\n\n>c\nGG\n"
FASTQ = "@r1 x\nACGT\n+\nIIII\n@r2\nGG\n+\n@@\n"


def test_fasta_in_ranges(spark, tmp_path):
    p = put(tmp_path, "x.fasta", FASTA)
    want = [("a", "one", "ACGT"), ("b", ">odd", ""), ("c", "", "GG")]
    for most in (3, 9, 1 << 20):
        d = files.read(spark, p, "fasta", maxPartitionBytes=most)
        assert rows(d.select("id", "descr", "seq")) == want
    assert [r.id for r in d.orderBy("ord").collect()] == ["a", "b", "c"]


def test_fastq_in_ranges_and_packed(spark, tmp_path):
    p = put(tmp_path, "x.fastq", FASTQ)
    for most in (5, 11, 1 << 20):
        assert rows(files.read(spark, p, "fastq", maxPartitionBytes=most).select("id", "seq", "qual")) == [("r1", "ACGT", "IIII"), ("r2", "GG", "@@")]
    with gzip.open(tmp_path / "y.fastq.gz", "wt") as f:
        f.write(FASTQ)
    with zipfile.ZipFile(tmp_path / "z.fastq.zip", "w") as z:
        z.writestr("a.fastq", FASTQ)
    assert files.read(spark, [str(tmp_path / "y.fastq.gz"), str(tmp_path / "z.fastq.zip")], "fastq").count() == 4


def test_malformed_fastq(spark, tmp_path):
    p = put(tmp_path, "bad.fastq", "@r1\nACGT\n+\nIII\n@r2\nA\n+\nI\n@r3\nA\n")
    d = formats.fastq(spark, p, "PERMISSIVE")
    assert [(r.id, r.error) for r in d.orderBy("ord").collect()] == [("r1", "sequence and qualities differ in length"), ("r2", None), ("r3", "lines are missing")]
    with pytest.raises(Exception, match="differ in length"):
        formats.fastq(spark, p).collect()


def test_sniff(spark, tmp_path):
    a, b = put(tmp_path, "a", FASTA), put(tmp_path, "b", FASTQ)
    assert (files.sniff(a), files.sniff(b)) == ("fasta", "fastq")
    with pytest.raises(ValueError):
        formats.sequences(spark, [a, b])


def test_interleaved(spark, tmp_path):
    d = formats.interleaved_pairs(formats.fastq(spark, put(tmp_path, "i.fastq", FASTQ)))
    assert [(r.pair, r.fwd.id, r.rev.id) for r in d.collect()] == [(0, "r1", "r2")]


def test_fasta_with_quality(spark, tmp_path):
    d = formats.fasta_with_quality(spark, put(tmp_path, "a.fasta", ">a\nACG\n"), put(tmp_path, "a.qual", ">a\n0 40\n2\n"))
    assert rows(d) == [("a", "ACG", "!I#")]


def test_tables(spark, tmp_path):
    b = "# x\nq\ts\t99.5\t10\t0\t0\t1\t10\t1\t10\t1e-5\t50\n"
    assert formats.blast(spark, put(tmp_path, "b", b)).first().bitscore == 50.0
    assert formats.blast_ordered(spark, put(tmp_path, "b2", b)).first().pident == 99.5
    g = "##gff\nc\tp\tCDS\t1\t9\t.\t+\t0\tID=a;product=x y\n"
    assert formats.gff(spark, put(tmp_path, "g", g)).first().attributes == {"ID": "a", "product": "x y"}
    c = "Contig\tDepth\tbases_with_depth\tcontigLen\tfraction_bases_with_depth\nk\t1\t10\t20\t0.5\n"
    assert tuple(formats.genome_coverage(spark, put(tmp_path, "c", c)).first()) == ("k", 1, 10, 20, 0.5)
    assert rows(formats.scaffold_cov(spark, put(tmp_path, "v", "# coveragePerScaffold\ns\t1.5\t10\n"))) == [("s", 1.5, 10)]
    assert rows(formats.uclust(spark, put(tmp_path, "u", "S\t0\t9\t*\t*\t*\t*\t*\ta\t*\nH\t0\t9\t99\t+\t0\t0\t9M\tb\ta\nC\t0\t2\n"))) == [(0, "a", "a"), (0, "b", "a")]
    assert rows(formats.taxonomy_dump(spark, put(tmp_path, "n.dmp", "1\t|\t1\t|\tno rank\t|\n2\t|\t1\t|\tphylum\t|\n"), "taxid int, parent int, rank string")) == [(1, 1, "no rank"), (2, 1, "phylum")]
    assert rows(formats.checkm(spark, put(tmp_path, "k", "b1\t{'GC': 0.5, 'name': 'x'}\n"))) == [("b1", "GC", "0.5", 0.5), ("b1", "name", "x", None)]
    assert rows(formats.esom(spark, put(tmp_path, "e.cls", "% 2\n1\t7\n"), "num int, class int")) == [(1, 7)]
    assert rows(formats.typed_cells(spark, put(tmp_path, "t", "id\ta\tb\nr\t1\tx\n"))) == [("r", "a", "1", 1, 1.0), ("r", "b", "x", None, None)]
    assert rows(formats.alignments(spark, put(tmp_path, "s.sam", "@HD\nr1\t0\tc\t1\t60\t4M\t*\t0\t0\tACGT\tIIII\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI\n")).select("read", "pos")) == [("r1", 1)]


def test_matrices(spark, tmp_path):
    want = [("s1", "o1", 2), ("s1", "o2", 1), ("s2", "o1", 3)]
    assert rows(formats.shared(spark, put(tmp_path, "m", "label\tGroup\tnumOtus\to1\to2\n0.03\ts1\t2\t2\t1\n0.03\ts2\t2\t3\t0\n"))) == want
    assert rows(formats.count_table(spark, put(tmp_path, "n", "Representative_Sequence\ttotal\ts1\ts2\no1\t5\t2\t3\no2\t1\t1\t0\n"))) == want
    assert rows(formats.count_table(spark, put(tmp_path, "o", "#Compressed Format: groupIndex,abundance\nRepresentative_Sequence\ttotal\ts1\ts2\no1\t5\t1,2\t2,3\no2\t1\t1,1\n"))) == want
    with pytest.raises(ValueError):
        formats.shared(spark, put(tmp_path, "p", "label\tGroup\tnumOtus\to1\n0.03\ts1\t1\t2\n0.05\ts1\t1\t2\n"))
    assert rows(formats.groups(spark, put(tmp_path, "g", "a\tx\nb\tx\nc\ty\n"))) == [("x", 2), ("y", 1)]
    assert formats.cons_taxonomy(spark, put(tmp_path, "t", "OTU\tSize\tTaxonomy\no1\t5\tA(100);B(90);\n")).first().ranks == ["A", "B"]
    assert rows(formats.group_definitions(spark, put(tmp_path, "d", "l\ta,b\n"))) == [("a", "l"), ("b", "l"), ("l", "l")]
    assert rows(formats.sequence_table(spark, put(tmp_path, "q", "\tACG\tTTT\ns-1\t4\t0\n"))) == [("s_1", "dada2_1", "ACG", 4)]


GBK = """LOCUS       X1   12 bp
DEFINITION  A thing
            of two lines.
VERSION     X1.1  GI:77
REFERENCE   1
  TITLE     On things
  JOURNAL   Nature 1
FEATURES             Location/Qualifiers
     CDS             complement(1..9)
                     /locus_tag="t1"
                     /product="a long
                     name"
ORIGIN
        1 acgtacgtac gt
//
"""


def test_entries(spark, tmp_path):
    p = put(tmp_path, "x.gbk", GBK)
    e = formats.genbank(spark, p).first()
    assert (e.locus, e.length, e.definition, e.seq) == ("X1", 12, "A thing of two lines.", "ACGTACGTACGT")
    f = formats.features_of(formats.genbank(spark, p), "CDS").first()
    assert (f.start, f.stop, f.strand, f.locus_tag, f.product) == (1, 9, -1, "t1", "a long name")
    assert formats.split_entries(spark, p).first().locus == "X1"
    assert rows(formats.cited_entries(spark, p)) == [("77", "On things", "Nature 1", "ACGTACGTACGT")]
    m = put(tmp_path, "x.embl", 'ID   Y2; x\nDE   thing\nFT   CDS             3..8\nFT                   /gene="g"\nSQ   x\n     acgtac gt 8\n//\n')
    e = formats.embl(spark, m).first()
    assert (e.locus, e.seq, e.features[0].quals) == ("Y2", "ACGTACGT", {"gene": ["g"]})


def test_sections(spark, tmp_path):
    assert rows(formats.assembled_contigs(spark, put(tmp_path, "c", "##k 2 50\n#r1(0) [RC] x\n#r2(5) [] x\n"))) == [("k", 2, 50, "r1", True), ("k", 2, 50, "r2", False)]
    assert rows(formats.last_graph(spark, put(tmp_path, "l", "NODE\t1\t9\nACG\nNR\t-1\t2\n7\t0\t0\n8\t0\t0\nNR\t2\t1\n9\t0\t0\n"))) == [(1, 7), (1, 8), (2, 9)]
    assert rows(formats.cluster_overview(spark, put(tmp_path, "o", ">f1\na\tb\n>f2\nc\n"))) == [("f1", ["a", "b"]), ("f2", ["c"])]
    log = "--- [Thu Nov  5 10:00:00 2020] step one ---\nnoise\n--- [Thu Nov  5 10:01:30 2020] step two ---\n"
    assert [(r.step, r.seconds) for r in formats.step_log(spark, put(tmp_path, "log", log)).orderBy("ord").collect()] == [("step one", 90), ("step two", 0)]


def test_xml(spark, tmp_path):
    x = put(tmp_path, "t.xml", '<TSeqSet><TSeq><TSeq_seqtype value="protein"/><TSeq_gi>5</TSeq_gi><TSeq_taxid>9</TSeq_taxid><TSeq_sequence>MK</TSeq_sequence></TSeq><TSeq><TSeq_seqtype value="nucleotide"/><TSeq_gi>6</TSeq_gi></TSeq></TSeqSet>')
    assert rows(formats.tiny_seq(spark, x).select("gi", "taxid", "seq")) == [(5, 9, "MK")]
    d = put(tmp_path, "d.xml", '<r><DocSum><Id>3</Id><Item Name="Title">A b</Item><Item Name="X">c</Item></DocSum></r>')
    assert rows(formats.document_summaries(spark, d)) == [(3, "A b")]
    b = put(tmp_path, "b.xml", "<o><Iteration><Iteration_query-def>q</Iteration_query-def><Iteration_hits><Hit><Hit_def>h</Hit_def><Hit_hsps><Hsp><Hsp_bit-score>40</Hsp_bit-score><Hsp_evalue>0.1</Hsp_evalue><Hsp_identity>9</Hsp_identity><Hsp_align-len>10</Hsp_align-len></Hsp><Hsp><Hsp_bit-score>4</Hsp_bit-score><Hsp_evalue>9</Hsp_evalue><Hsp_identity>1</Hsp_identity><Hsp_align-len>10</Hsp_align-len></Hsp></Hit_hsps></Hit></Iteration_hits></Iteration></o>")
    assert rows(formats.blast_xml(spark, b, 10)) == [("q", "h", 90.0, 0.1, 40.0)]


def test_several_xml_roots_are_an_error(spark, tmp_path):
    one = '<r><DocSum><Id>3</Id><Item Name="Title">A b</Item></DocSum></r>\n'
    with pytest.raises(Exception, match="(?i)malformed"):
        formats.document_summaries(spark, put(tmp_path, "two.xml", one * 2)).collect()


def test_shared_folder(spark, tmp_path):
    assert files.shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_names(spark):
    d = spark.createDataFrame([("66145_CATTGAC_S1_L007_R1_001.fastq.gz",), ("run9_s2_ACGT_L001_R2_003.fastq",), ("other.txt",)], "name string")
    got = {r.name: r for r in formats.raw_names(d).collect()}
    a, b = got["66145_CATTGAC_S1_L007_R1_001.fastq.gz"], got["run9_s2_ACGT_L001_R2_003.fastq"]
    assert (a.sample, a.lane, a.dir, a.snum, a.suffix) == ("66145", 7, 1, 1, "fastq.gz")
    assert (b.run, b.sample, b.dir, b.fnum) == ("run9", "s2", 2, 3)
    assert got["other.txt"].sample is None
    h = spark.createDataFrame([("M:1:F:1:1101:15:20 1:N",), ("x",)], "header string")
    assert rows(formats.header_coordinates(h)) == [(1101, 15, 20)]


def test_fastqc(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "s_fastqc.zip", "w") as z:
        z.writestr("s_fastqc/summary.txt", "PASS\tBasic\ts.fq\nFAIL\tPer base\ts.fq\n")
    assert rows(formats.fastqc(spark, str(tmp_path))) == [("s_fastqc.zip", "FAIL", "Per base", "s.fq"), ("s_fastqc.zip", "PASS", "Basic", "s.fq")]


def test_writers_round_trip(spark, tmp_path):
    d = spark.createDataFrame([("a", "x y", "ACGTACG", 1), ("b", None, "GG", 2)], "id string, descr string, seq string, bin int")
    sinks.write_fasta(d, str(tmp_path / "f"), width=3)
    assert rows(formats.fasta(spark, str(tmp_path / "f")).select("id", "descr", "seq")) == [("a", "x y", "ACGTACG"), ("b", "", "GG")]
    sinks.write_fasta(d, str(tmp_path / "g"), by="bin")
    assert sorted(p.name for p in (tmp_path / "g").iterdir() if p.is_dir()) == ["bin=1", "bin=2"]
    q = spark.createDataFrame([("r1 x", "AC", "II")], "header string, seq string, qual string")
    sinks.write_fastq(q, str(tmp_path / "q"))
    assert rows(formats.fastq(spark, str(tmp_path / "q")).select("header", "seq", "qual")) == [("r1 x", "AC", "II")]
    m = spark.createDataFrame([("s1", "o1", 2), ("s2", "o2", 3)], "sample string, otu string, count long")
    sinks.write_shared(m.coalesce(1), str(tmp_path / "m"), ["o1", "o2"])
    part = next(str(p) for p in (tmp_path / "m").iterdir() if p.name.startswith("part"))
    assert rows(formats.shared(spark, part)) == [("s1", "o1", 2), ("s2", "o2", 3)]
    f = spark.createDataFrame([("c", "l1", 1, 250, "-", "CDS", None)], "scaffold string, locus string, start int, stop int, strand string, type string, product string")
    t = sinks.feature_table(f, spark.createDataFrame([("c", 250)], "scaffold string, len int")).first().value
    assert t.startswith(">250\t<1\tCDS") and "hypothetical protein" in t


def bam_record(name, flag, ref, pos, mapq, cigar, seq, qual):
    """One record by the format's description: sizes, numbers, name, operations, bases in halves of bytes, qualities."""
    ops = b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(o)) for n, o in cigar)
    codes = ["=ACMGRSVTWYHKDBN".index(c) for c in seq] + [0] * (len(seq) % 2)
    body = struct.pack("<iiBBHHHiiii", ref, pos - 1, len(name) + 1, mapq, 0, len(cigar), flag, len(seq), -1, -1, 0) + name.encode() + b"\0" + ops
    body += bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2])) + (bytes(ord(c) - 33 for c in qual) if qual != "*" else b"\xff" * len(seq)) + b"NMC\x01"
    return struct.pack("<i", len(body)) + body


def test_bam(spark, tmp_path):
    head = b"BAM\1" + struct.pack("<i", 4) + b"@HD\n" + struct.pack("<i", 2) + b"".join(struct.pack("<i", len(n) + 1) + n + b"\0" + struct.pack("<i", 100) for n in (b"c1", b"c2"))
    reads = [("r1", 0, 0, 1, 60, [(3, "M"), (1, "S")], "ACGT", "IIII"), ("r2", 16, 1, 7, 0, [(2, "M"), (10, "N"), (3, "M")], "NACGT", "*"), ("r3", 4, -1, 0, 0, [], "A", "I"), ("r4", 0, 1, 9, 3, [], "", "*")]
    blocks = [head, *(bam_record(*r) for r in reads), b""]
    (tmp_path / "x.bam").write_bytes(b"".join(gzip.compress(b) for b in blocks))
    path = str(tmp_path / "x.bam")
    assert rows(formats.alignments(spark, path)) == [("r1", 0, "c1", 1, 60, "3M1S", "ACGT", "IIII"), ("r2", 16, "c2", 7, 0, "2M10N3M", "NACGT", "*"), ("r4", 0, "c2", 9, 3, "*", "*", "*")]
    got = files.read(spark, path, "bam").orderBy("ord").collect()
    assert [r.read for r in got] == ["r1", "r2", "r3", "r4"] and got[2].contig == "*"
    (tmp_path / "cut.bam").write_bytes(gzip.compress(b"".join(blocks)[:-9]))
    with pytest.raises(Exception, match="ends within a record"):
        files.read(spark, str(tmp_path / "cut.bam"), "bam").collect()


def test_fasta_repair(spark, tmp_path):
    path = put(tmp_path, "x.fa", ">a b>c\nAC\n>d\nG\n")
    assert rows(files.read(spark, path, "fasta", repair="true").select("header", "seq")) == [("a b+c", "AC"), ("d", "G")]
    assert rows(files.read(spark, path, "fasta").select("header")) == [("a b>c",), ("d",)]


def packed_file(path, data, sizes, seed=1):
    """data in members of these sizes, in turn; some are empty."""
    import random

    from strandline.sources import bgzf

    rng, out = random.Random(seed), []
    while data:
        n = rng.choice(sizes)
        out.append(b"".join(bgzf.packed(iter([data[:n]])))[: -len(bgzf.END)])
        data = data[n:]
        if rng.random() < 0.1:
            out.append(bgzf.END)
    path.write_bytes(b"".join(out) + bgzf.END)
    assert gzip.decompress(path.read_bytes()) is not None
    return str(path)


def ranges_of(path, kind, most):
    """The rows of each range, as tasks read them."""
    reader = files.RecordReader({"path": path, "kind": kind, "maxpartitionbytes": str(most)})
    return [[tuple(r.values()) for b in reader.read(p) for r in b.to_pylist()] for p in reader.partitions()]


BAM_HEAD = b"BAM\1" + struct.pack("<i", 4) + b"@HD\n" + struct.pack("<i", 2) + b"".join(struct.pack("<i", len(n) + 1) + n + b"\0" + struct.pack("<i", 100) for n in (b"c1", b"c2"))


@pytest.mark.parametrize("sizes, most", [((700, 900), 500), ((5000,), 3000), ((40, 90), 200), ((60_000,), 20_000)])
def test_bam_in_ranges(spark, tmp_path, sizes, most):
    """Records of all sizes, over members and over whole ranges, each read once, in order."""
    import random

    rng = random.Random(sizes[0])
    text = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    reads = []
    for i in range(60 if sizes[0] < 100 else 300):
        n = rng.choice((0, 1, 5, 50, 100, 3000))
        reads.append((f"read{i}:{text(5, 'abc')}", rng.choice((0, 4, 16)), rng.choice((-1, 0, 1)), rng.randint(0, 9000), rng.randint(0, 60), [(n, "M")] if n else [], text(n, "ACGTN"), text(n, "!5?I") if n else "*"))
    path = packed_file(tmp_path / "x.bam", BAM_HEAD + b"".join(bam_record(*r) for r in reads), sizes)
    got = ranges_of(path, "bam", most)
    each = [r for some in got for r in some]
    assert [(r[2], r[3], r[5], r[6], r[8], r[9]) for r in each] == [(n, f, p, q, s or "*", u) for n, f, _, p, q, _, s, u in reads]
    assert [r[1] for r in each] == sorted(r[1] for r in each) and sum(map(bool, got)) > 2
    if most > 3000:
        assert rows(files.read(spark, path, "bam", maxPartitionBytes=str(most))) == sorted(each, key=repr)


@pytest.mark.parametrize("sizes, most", [((70, 300), 150), ((3000,), 900), ((11, 12), 60)])
def test_packed_text_in_ranges(spark, tmp_path, sizes, most):
    """Lines, FASTQ and FASTA packed by members are the same in ranges as in one."""
    import random

    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("ACGT@+>") for _ in range(n))
    fastq = "".join(f"@r{i} x\n{(s := text(rng.randint(1, 120)))}\n+\n{'@' * len(s)}\n" for i in range(150))
    fasta = "".join(f">s{i} about\n" + "".join(f"{text(40).replace('>', 'A')}\n" for _ in range(rng.randint(0, 9))) for i in range(120))
    for kind, data in (("fastq", fastq), ("fasta", fasta), ("lines", fastq + "\n\nlast")):
        plain = put(tmp_path, f"{kind}.txt", data)
        path = packed_file(tmp_path / f"{kind}.txt.gz", data.encode(), sizes)
        want = [tuple(r)[2:] for r in files.read(spark, plain, kind).orderBy("ord").collect()]
        got = ranges_of(path, kind, most)
        each = [r for some in got for r in some]
        assert [r[2:] for r in each] == want and sum(map(bool, got)) > 3 and [r[1] for r in each] == sorted({r[1] for r in each})
    assert files.sniff(str(tmp_path / "fastq.txt.gz")) == "fastq"


def test_written_bam(spark, tmp_path):
    """What is absent, letters of each kind, overwriting, and what is refused."""
    from strandline.sources import sinks

    schema = "read string, flag int, contig string, pos int, mapq int, cigar string, seq string, qual string, more int"
    reads = [("r1", 0, "c1", 1, 60, "3M1S", "ACGT", "IIII", 1), ("r2", 4, None, None, None, None, None, None, 2), (None, 16, "c2", 70_000, 3, "2M10N3M", "NACGT", "*", 3)]
    at = str(tmp_path / "bam")
    want = [("*", 16, "c2", 70_000, 3, "2M10N3M", "NACGT", "*"), ("r1", 0, "c1", 1, 60, "3M1S", "ACGT", "IIII"), ("r2", 4, "*", 0, 0, "*", "*", "*")]
    for n, mode in ((1, "append"), (2, "append"), (1, "overwrite")):
        sinks.write_bam(spark.createDataFrame(reads, schema).repartition(2), at, [("c1", 100), ("c2", 90_000)], mode)
        assert rows(files.read(spark, at, "bam").drop("file", "ord")) == sorted(want * n)
    assert not [x for x in (tmp_path / "bam").iterdir() if x.name.startswith("_held")]
    with pytest.raises(Exception, match="differ in length"):
        sinks.write_bam(spark.createDataFrame([("r", 0, None, 1, 1, "*", "ACG", "I", 0)], schema), at, [])
    assert not [x for x in (tmp_path / "bam").iterdir() if x.name.startswith("_held")]


def test_damaged_members(tmp_path):
    import io

    from strandline.sources import bgzf

    data = b"".join(bgzf.packed(iter([b"abc\n" * 50_000])))
    f = bgzf.Bgzf(io.BytesIO(data), len(data))
    assert f.read(1 << 20) == b"abc\n" * 50_000 and f.read(5) == b"" and f.tell() == len(data) << 16
    assert f.find(1) == bgzf.member_size(data[:64]) and f.find(len(data)) is None
    with pytest.raises(ValueError, match="not a whole member"):
        bgzf.Bgzf(io.BytesIO(data[:-40]), len(data) - 40).read(1 << 20)
    bad = bytearray(data)
    bad[bgzf.member_size(data[:64]) - 6] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        bgzf.Bgzf(io.BytesIO(bytes(bad)), len(bad)).read(10)


@pytest.mark.parametrize("first", [b">a x\nACG\n", b"@a x\nACG\n+\nIII\n"])
def test_files_that_hold_nothing_are_of_either_format(spark, tmp_path, first):
    """The first task writes a file even if it has no rows."""
    for name, data in (("1.gz", gzip.compress(b"")), ("2.gz", gzip.compress(first)), ("3.gz", b""), ("4.txt", b"")):
        (tmp_path / name).write_bytes(data)
    paths = [str(p) for p in sorted(tmp_path.iterdir())]
    assert rows(formats.sequences(spark, paths).select("id", "seq")) == [("a", "ACG")]
    assert formats.sequences(spark, paths[:1] + paths[2:]).count() == 0


@pytest.mark.parametrize("most", [1, 7, 40, 1 << 20])
def test_sections_in_ranges(spark, tmp_path, most):
    """Lines come under their heads whatever range these are in, and nothing is sorted by file; lines before the first head go."""
    text = "lost\n" + "".join(f">h{k}\n" + "".join(f"{k}\t{j}\n" for j in range(k % 4)) for k in range(20))
    d = formats.sectioned(spark, put(tmp_path, "x.txt", text), "^>", maxPartitionBytes=most)
    assert rows(d.select("head", "value")) == sorted((f">h{k}", f"{k}\t{j}") for k in range(20) for j in range(k % 4))
    plan = formats.cluster_overview(spark, put(tmp_path, "y.txt", text))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def test_sections_of_blocks(spark, tmp_path):
    from strandline.sources.bgzf import packed

    text = "".join(f"##o{k} 3 50\n#r{k}(0) [RC] x\n#s{k}(5) [] x\n" for k in range(9_000))
    (tmp_path / "x.gz").write_bytes(b"".join(packed(iter([text.encode()]))))
    d = formats.sectioned(spark, str(tmp_path / "x.gz"), "^##", maxPartitionBytes=3_000)
    assert d.rdd.getNumPartitions() > 3
    assert rows(d.select("head", "value")) == sorted((f"##o{k} 3 50", x) for k in range(9_000) for x in (f"#r{k}(0) [RC] x", f"#s{k}(5) [] x"))


def test_interleaved_pairs_in_blocks(spark, tmp_path, monkeypatch):
    """A file is numbered in blocks, whose parity may be odd; no window is of a whole file's records."""
    monkeypatch.setattr(formats, "BLOCK", 50, raising=False)
    text = "".join(f"@r{k}/{m}\n{'ACGTTT'[: 1 + k % 5]}\n+\n{'IIIIII'[: 1 + k % 5]}\n" for k in range(40) for m in (1, 2))
    for name in ("a", "b"):
        put(tmp_path, name, text)
    p = formats.interleaved_pairs(formats.fastq(spark, str(tmp_path)))
    assert rows(p.select("pair", "fwd.id", "rev.id")) == sorted([(k, f"r{k}/1", f"r{k}/2") for k in range(40)] * 2, key=repr)
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert all("_b" in x for x in plan.split("\n") if "Window" in x and "row_number" in x)


@pytest.mark.parametrize("row", [
    ("r1", 0, "c1", 5, 60, "3M1I2D", "ACGTN", "!I~+J"), ("r2", 4, None, None, None, None, "ACG", None), ("*", 16, "c0", 1, 0, "4M", "=ACM", "*"), ("é", 1, "c1", 9, 1, None, None, None),
    ("r5", 0, "c0", 1, 0, "1M", "A", "\xff"), ("r6", 0, "c0", 1, 0, "1M", "A", "Đ"),
])
def test_bam_record_there_and_back(row):
    b = files.bam_bytes(*row, {"c0": 0, "c1": 1})
    read, flag, contig, pos, mapq, cigar, seq, qual = row
    assert struct.unpack_from("<i", b)[0] == len(b) - 4
    assert files.alignment(b[4:], ["c0", "c1"]) == (read, flag, contig or "*", pos or 0, mapq or 0, cigar or "*", seq or "*", qual or "*")


@pytest.mark.parametrize("seq, qual", [("ACX", "III"), ("AC0", "III"), ("ACG", "II"), ("ACG", "I I"), ("acg", "III")])
def test_bam_records_that_are_none(seq, qual):
    with pytest.raises(ValueError):
        files.bam_bytes("r", 0, "c0", 1, 0, "3M", seq, qual, {"c0": 0})
