"""The event windows on a stream give what they give on a batch."""

from helpers import rows

from strandline.streaming import events


def test_stream_equals_batch(spark, tmp_path):
    d = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr("event_id", "cast(ts as timestamp) ts", "user_id", "event_type", "value")
    d.write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(d.schema).parquet(str(tmp_path / "in"))
    q = events.tumbling(s, "1 day").writeStream.format("memory").queryName("windows").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    got = rows(spark.table("windows").select("start", "event_type", "n"))
    assert got == rows(events.tumbling(d, "1 day").select("start", "event_type", "n"))


def grown(spark, tmp_path, kind, files_, steps):
    """Rows of a stream over files that grow by the given numbers of bytes between triggers, and how many rows each trigger had."""
    from strandline.sources import files

    at = tmp_path / kind
    at.mkdir()
    name = f"tail_{kind}"
    had, pos = [], dict.fromkeys(files_, 0)
    q = None
    for n in [*steps, None]:
        for f, data in files_.items():
            end = len(data) if n is None else min(len(data), pos[f] + n)
            with open(at / f, "ab") as out:
                out.write(data[pos[f] : end])
            pos[f] = end
            if n is None:
                (at / f"{f}.done").touch()
        if q is None:
            q = files.follow(spark, str(at), kind, maxPartitionBytes="700").writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / f"{kind}-state")).start()
        q.processAllAvailable()
        had.append(spark.table(name).count())
    q.stop()
    return rows(spark.table(name)), rows(files.read(spark, [str(at / f) for f in files_], kind)), had


def test_growing_files(spark, tmp_path):
    """Cut anywhere, records are whole, come once, and are those of a batch over the files in the end."""
    import random

    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("ACGT@+") for _ in range(n))
    fastq = "".join(f"@r{i} x\n{(s := text(rng.randint(1, 90)))}\n+\n{'@' * len(s)}\n" for i in range(60)).encode()
    fasta = "".join(f">s{i} d\n" + "".join(f"{text(30)}\n" for _ in range(rng.randint(0, 5))) for i in range(60)).encode()
    for kind, data in (("fastq", fastq), ("fasta", fasta), ("lines", fastq + b"no feed at the end")):
        got, want, had = grown(spark, tmp_path, kind, {"a.txt": data, "b.txt": data[: len(data) // 3 + 1] if kind == "lines" else b""}, [701, 1, 1500])
        assert got == want and had == sorted(had) and 0 < had[0] < had[2] < len(want)


def test_ends_of_whole_records(monkeypatch):
    """By a window at the end as by reading all."""
    import io

    from strandline.sources import tail

    monkeypatch.setattr(tail, "WINDOW", 16)
    fastq = b"".join(b"@r%d\n%s\n+\n%s\n" % (i, b"A" * (i % 40), b"@" * (i % 40)) for i in range(50))
    ends = [0]
    for i in range(50):
        ends.append(ends[-1] + len(b"@r%d\n+\n\n\n" % i) + 2 * (i % 40))
    for n in range(0, len(fastq), 7):
        got = tail.whole_end(io.BytesIO(fastq[:n]), n, 0, "fastq")
        assert got in ends and n - got <= 200 and got <= n
        assert tail.whole_end(io.BytesIO(fastq[:n]), n, got, "fastq") >= got
    assert tail.whole_end(io.BytesIO(b">a\nAC\n>b\nG"), 10, 0, "fasta") == 6 and tail.whole_end(io.BytesIO(b">a\nAC"), 5, 0, "fasta") == 0
    assert tail.whole_end(io.BytesIO(b"x" * 100), 100, 0, "lines") == 0 and tail.whole_end(io.BytesIO(b"ab\ncd"), 5, 0, "lines") == 3


def test_mates_on_a_stream_and_in_a_batch(spark, tmp_path):
    """Mates in one trigger, in several, too far apart, alone and repeated; a row behind the watermark is dropped; no state stays."""
    import datetime

    t = lambda minutes: datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minutes)
    steps = [
        [("a", 0, "A0", t(0)), ("a", 1, "A1", t(5)), ("b", 0, "B0", t(1)), ("c", 0, "C0", t(2)), ("d", 1, "D1", t(3))],
        [("b", 1, "B1", t(20)), ("c", 1, "C1", t(70)), ("d", 1, "D0", t(3)), (None, 0, "x", t(3)), ("e", 0, None, t(30)), ("e", 1, "E1", t(30))],
        [("f", 0, "F0", t(400))],
        [("late", 0, "L0", t(1)), ("g", 1, "G1", t(900))],
        [("h", 1, "H1", t(2000))],
        [("i", 1, "I1", t(4000))],
    ]
    schema = "pair string, mate int, seq string, ts timestamp"
    source = tmp_path / "mates"
    source.mkdir()
    q = None
    for k, some in enumerate(steps):
        spark.createDataFrame(some, schema).coalesce(1).write.parquet(str(source / f"{k}"))
        if q is None:
            stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(source))
            q = events.paired(stream, "1 hour", "1 hour").writeStream.format("memory").queryName("mates").outputMode("append").start()
        q.processAllAvailable()
    state = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    q.stop()
    batch = rows(events.paired(spark.createDataFrame([r for some in steps for r in some if r[0] != "late"], schema), "1 hour"))
    assert [r[:3] for r in batch if r[0] in "abcde"] == [("a", "A0", "A1"), ("b", "B0", "B1"), ("c", "C0", None), ("c", None, "C1"), ("d", None, "D0"), ("e", "", "E1")]
    # the last one waits for the watermark
    assert rows(spark.table("mates")) == [r for r in batch if r[0] != "i"] and state == 1
