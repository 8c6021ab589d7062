"""Ordered records of text files as a Python data source: format("records").

kind "lines": file, ord, value. kind "fasta": file, ord, header, id, descr, seq. kind "fastq": file, ord, header, id, strand, seq, qual,
error. kind "sections": file, ord, head, value of every line under a head line (option head: a regex). kind "bam": file, ord, read, flag, contig, pos, mapq, cigar, seq, qual of every alignment. ord is the byte at which a record starts, so order within a file survives any shuffle. Plain files are read in byte ranges, each
taking the records that start in it, and so are block-compressed ones (.bam, .gz by bgzip; see bgzf.py), ord being a virtual offset. Other
compressed files (.gz, .bz2, .zst, .zip) are one range each, ord counting uncompressed bytes.

Kind "bam" is written too (read, flag, contig, pos, mapq, cigar, seq, qual; option contigs: JSON of names and lengths), a file a task.

FASTA option repair "true" makes every ">" within a header a "+". FASTQ mode "FAILFAST" (default) raises on a malformed record, "PERMISSIVE" returns it with `error` set.
"""

from __future__ import annotations

import functools
import gzip
import io
import json
import re
import struct
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .bgzf import Bgzf, member_size, packed

SCHEMAS = {
    "lines": "file string, ord long, value string",
    "fasta": "file string, ord long, header string, id string, descr string, seq string",
    "fastq": "file string, ord long, header string, id string, strand string, seq string, qual string, error string",
    "sections": "file string, ord long, head string, value string",
    "bam": "file string, ord long, read string, flag int, contig string, pos int, mapq int, cigar string, seq string, qual string",
}
TYPES = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
PACKED = (".gz", ".bgz", ".bz2", ".zst", ".zip", ".bam")
#: Hadoop's names of stores, and those of the same in pyarrow.
STORES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs"}
BATCH = 4 << 20


def place(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("/"):
        path = path.removeprefix("file:") if path.startswith("file:") else f"./{path}"
        return (fs.LocalFileSystem(), path)
    scheme, _, rest = path.partition("://")
    return fs.FileSystem.from_uri(f"{STORES.get(scheme, scheme)}://{rest}" if rest else path)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, which the driver and all executors see. Unset, it is an error on a cluster and a temporary folder in local mode."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="strandline-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


class Range(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


def in_blocks(where: fs.FileSystem, path: str) -> bool:
    """Whether a file is block-compressed."""
    if not path.endswith((".gz", ".bam", ".bgz")):
        return False
    with where.open_input_file(path) as f:
        return member_size(f.read(64)) is not None


def opened(where: fs.FileSystem, path: str) -> Iterator:
    """The stream of a file, of each member of a zip."""
    if in_blocks(where, path):
        f = where.open_input_file(path)
        yield Bgzf(f, f.size())
    elif path.endswith(".zip"):
        with zipfile.ZipFile(where.open_input_file(path)) as z:
            for name in z.namelist():
                if not name.endswith("/"):
                    with z.open(name) as f:
                        yield io.BufferedReader(f)
    elif path.endswith(".bam"):
        # blocks of gzip, one after the other
        yield io.BufferedReader(gzip.GzipFile(fileobj=where.open_input_file(path)))
    elif path.endswith(PACKED):
        yield io.BufferedReader(where.open_input_stream(path, compression="detect"))
    else:
        yield io.BufferedReader(where.open_input_file(path))


def lines(f, start: int, end: int) -> Iterator[tuple[int, str]]:
    """(byte, line) of the lines that start in [start, end)."""
    if isinstance(f, Bgzf):
        yield from f.lines(start, end)
        return
    at = start
    if start:
        f.seek(start - 1)
        at += len(f.readline()) - 1
    while at < end and (raw := f.readline()):
        yield at, raw.decode("utf-8", "replace").rstrip("\r\n")
        at += len(raw)


def beyond(f, place: int, end: int) -> bool:
    """Whether a line at a place is another range's, this one ending at `end`."""
    return (place - 1 >> 16 if isinstance(f, Bgzf) else place) >= end


def sections(f, start: int, end: int, head: str) -> Iterator[tuple[int, str, str]]:
    """(byte, head, line) of the lines under the heads that start in [start, end), read one by one up to the next head, wherever it is."""
    heads, now = re.compile(head).search, None
    for pos, line in lines(f, start, 1 << 62):
        if heads(line):
            if beyond(f, pos, end):
                return
            now = line
        elif now is not None:
            yield pos, now, line
        elif beyond(f, pos, end):
            return


def fasta(f, start: int, end: int, repair: bool = False) -> Iterator[tuple]:
    """repair: a ">" within a header becomes "+"."""
    at, header, seq = 0, None, []
    for pos, line in lines(f, start, 1 << 62):
        if line.startswith(">"):
            if header is not None:
                yield (at, header, *split_header(header), "".join(seq))
            if beyond(f, pos, end):
                return
            at, header, seq = pos, line[1:].replace(">", "+") if repair else line[1:], []
        elif header is not None:
            seq.append(line.strip())
    if header is not None:
        yield (at, header, *split_header(header), "".join(seq))


def fastq(f, start: int, end: int, strict: bool) -> Iterator[tuple]:
    """Records of four lines. A range starts at the first "@" line with a "+" two lines on and qualities as long as the sequence."""
    it = lines(f, start, 1 << 62)
    held: list[tuple[int, str]] = []

    def fill(n: int) -> bool:
        while len(held) < n and (x := next(it, None)) is not None:
            held.append(x)
        return len(held) >= n

    if start:
        while fill(4) and not (held[0][1].startswith("@") and held[2][1].startswith("+") and len(held[1][1]) == len(held[3][1])):
            held.pop(0)
        if not fill(4) and not (len(held) > 2 and held[0][1].startswith("@") and held[2][1].startswith("+")):
            return
    while fill(1) and not beyond(f, held[0][0], end):
        whole = fill(4)
        if not whole and not "".join(x for _, x in held).strip():
            return
        (at, h), s, p, q = held[0], *(held[k][1] if k < len(held) else "" for k in (1, 2, 3))
        error = None if whole and h.startswith("@") and p.startswith("+") and len(s) == len(q) else "lines are missing" if not whole else "no @" if not h.startswith("@") else "no +" if not p.startswith("+") else "sequence and qualities differ in length"
        if error and strict:
            raise ValueError(f"byte {at}: {error}")
        yield (at, h[1:], split_header(h[1:])[0], p[1:], s, q, error)
        del held[:4]


#: Codes of bases and of CIGAR operations in BAM, in the order of their numbers.
BAM_BASES, BAM_OPERATIONS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
#: Bases as hexadecimal digits, two of which are a byte of a record, and back; characters below the least quality; qualities as they are
#: there, and as text.
BASE_DIGITS, DIGIT_BASES = str.maketrans(BAM_BASES, "0123456789abcdef"), str.maketrans("0123456789abcdef", BAM_BASES)
BASE_SET = frozenset(BAM_BASES)
BELOW = bytes(range(33))
FIELDS = struct.Struct("<iiBBHHHi").unpack_from
QUALITY_BYTES, QUALITY_TEXT = bytes((x - 33) % 256 for x in range(256)), bytes((x + 33) % 256 for x in range(256))


def bam_starts(contigs: int):
    """For Bgzf.records(): whether alignments, several if there are, follow each other from a place on."""

    def starts(data: bytes, k: int, whole: bool) -> bool:
        seen = 0
        while seen < 8 and k + 36 <= len(data):
            size, ref, pos, name, _, _, operations, _, n, ref2, pos2 = struct.unpack_from("<iiiBBHHHiii", data, k)
            if not (-1 <= ref < contigs and -1 <= ref2 < contigs and pos >= -1 and pos2 >= -1 and name and n >= 0) or 32 + name + 4 * operations + (n + 1) // 2 + n > size:
                return False
            text = data[k + 36 : k + 36 + name]
            if len(text) == name and (text[-1] or not all(32 < c < 127 for c in text[:-1])):
                return False
            k, seen = k + 4 + size, seen + 1
        return seen > 0 and (seen == 8 or k == len(data) or not whole)

    return starts


def bam(f, start: int = 0, end: int = 1 << 62) -> Iterator[tuple]:
    """Alignments of an inflated BAM stream, or of a range of a block-compressed one; positions from 1, "*" for what is absent, as in its
    text form."""
    at = 0

    def take(n: int) -> bytes:
        nonlocal at
        if len(x := f.read(n)) < n:
            raise ValueError(f"byte {at}: the file ends within a record")
        at += n
        return x

    number = lambda: struct.unpack("<i", take(4))[0]
    if take(4) != b"BAM\x01":
        raise ValueError("not a BAM file")
    take(number())
    contigs = []
    for _ in range(number()):
        contigs.append(take(number())[:-1].decode("utf-8", "replace"))
        take(4)
    blocks = isinstance(f, Bgzf)
    if blocks and start:
        # the header may go on into this range
        if (first := f.tell()) >> 16 >= start:
            f.seek(first)
        elif not f.records(start, end, bam_starts(len(contigs))):
            return
    while True:
        if blocks and (at := f.tell()) >= end << 16:
            return
        if not (head := f.read(4)):
            return
        place, at = at, at + len(head)
        if len(head) < 4:
            raise ValueError(f"byte {place}: the file ends within a record")
        yield (place, *alignment(take(int.from_bytes(head, "little", signed=True)), contigs))


def alignment(r: bytes, contigs: list[str]) -> tuple:
    """The fields of one record."""
    ref, pos, name, mapq, _, operations, flag, n = FIELDS(r)
    k = 32 + name
    steps = r[k : k + 4 * operations]
    at = k + len(steps)
    qual = r[at + (n + 1) // 2 : at + (n + 1) // 2 + n]
    seq = r[at : at + (n + 1) // 2].hex().translate(DIGIT_BASES)[:n]
    # qualities beyond 222, which no text has, are characters beyond a byte
    quality = "*" if not n or qual[0] == 255 else qual.translate(QUALITY_TEXT).decode("latin-1") if max(qual) < 223 else "".join(chr(x + 33) for x in qual)
    return (r[32 : k - 1].decode("utf-8", "replace"), flag, contigs[ref] if ref >= 0 else "*", pos + 1, mapq, cigar_text(steps), seq or "*", quality)


@functools.lru_cache(1 << 16)
def cigar_text(steps: bytes) -> str:
    """"*" if there are no steps."""
    return "".join(f"{x >> 4}{BAM_OPERATIONS[x & 15]}" for x in struct.unpack(f"<{len(steps) // 4}I", steps)) or "*"


@functools.lru_cache(1 << 16)
def cigar_bytes(cigar: str) -> tuple[bytes, int]:
    """The steps of a CIGAR, and the positions that they cover, 1 at least."""
    steps = [(int(n), BAM_OPERATIONS.index(x)) for n, x in re.findall(r"(\d+)(\D)", cigar)]
    return b"".join(struct.pack("<I", n << 4 | x) for n, x in steps), sum(n for n, x in steps if BAM_OPERATIONS[x] in "MDN=X") or 1


def bin_of(start: int, end: int) -> int:
    """The smallest bin of the format's index that holds [start, end), from 0; first numbers of the levels are fixed values."""
    for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if start >> shift == (end - 1) >> shift:
            return first + (start >> shift)
    return 0


def bam_bytes(read, flag, contig, pos, mapq, cigar, seq, qual, number: dict[str, int]) -> bytes:
    """A record; null and "*" are absent."""
    name, seq = (read or "*").encode(), "" if seq in (None, "*") else seq
    steps, covered = cigar_bytes(cigar or "")
    at, n = (pos or 0) - 1, len(seq)
    if not BASE_SET.issuperset(seq):
        raise ValueError(f"read {read}: {min(set(seq) - BASE_SET)} is no base")
    digits = seq.translate(BASE_DIGITS)
    quality = b"\xff" * n if qual in (None, "*") else qual.encode().translate(QUALITY_BYTES, BELOW) if qual.isascii() else bytes(ord(c) - 33 for c in qual)
    if len(quality) != n:
        raise ValueError(f"read {read}: sequence and qualities differ in length")
    ref = -1 if contig in (None, "*") else number[contig]
    size = 33 + len(name) + len(steps) + (n + 1) // 2 + n
    head = struct.pack("<iiiBBHHHiiii", size, ref, at, len(name) + 1, mapq or 0, bin_of(max(at, 0), max(at, 0) + covered), len(steps) // 4, flag or 0, n, -1, -1, 0)
    return b"".join((head, name, b"\0", steps, bytes.fromhex(digits + "0" if n % 2 else digits), quality))


def split_header(h: str) -> tuple[str, str]:
    id_, _, descr = h.strip().partition(" ")
    return id_.split("\t")[0], descr.strip()


class RecordReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options["path"].split(",") if p]
        self.kind = options.get("kind", "lines")
        self.repair = options.get("repair", "false").lower() == "true"
        self.head = options.get("head", "^>")
        self.strict = options.get("mode", "FAILFAST").upper() == "FAILFAST"
        self.most = int(options.get("maxpartitionbytes", 32 << 20))
        if self.kind not in SCHEMAS:
            raise ValueError(f"kind must be one of {', '.join(SCHEMAS)}")

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for p in self.paths:
            where, path = place(p)
            info = where.get_file_info(path)
            found = [info] if info.is_file else where.get_file_info(fs.FileSelector(path, recursive=True)) if info.type == fs.FileType.Directory else []
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(p)
            prefix = p[: len(p) - len(path)] if p.endswith(path) else ""
            for x in sorted((x for x in found if x.is_file and not x.base_name.startswith(("_", "."))), key=lambda x: x.path):
                step = x.size if (x.path.endswith(PACKED) and not in_blocks(where, x.path)) or not x.size else self.most
                out += [Range(prefix + x.path, a, min(x.size, a + step) if step == self.most else 1 << 62) for a in range(0, max(1, x.size), max(1, step))]
        return out or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        where, path = place(partition.path)
        names, types = zip(*((n, TYPES[t]) for n, t in (x.split() for x in SCHEMAS[self.kind].split(", "))))
        batch: list[tuple] = []
        size = 0
        for f in opened(where, path):
            read = {"lines": lines, "fasta": lambda f, a, b: fasta(f, a, b, self.repair), "sections": lambda f, a, b: sections(f, a, b, self.head), "bam": bam}.get(self.kind) or (lambda f, a, b: fastq(f, a, b, self.strict))
            for row in read(f, partition.start, partition.end):
                batch.append((partition.path, *row))
                size += sum([len(x) for x in row if x.__class__ is str]) + 100
                if size > BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*batch), types)], names=list(names))
                    batch, size = [], 0
        if batch:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*batch), types)], names=list(names))


#: What is written of an alignment.
COLUMNS = ("read", "flag", "contig", "pos", "mapq", "cigar", "seq", "qual")


def values(column: pa.Array) -> list:
    """to_pylist(), which makes an object of Arrow's for each value, at a fraction of its time."""
    return column.to_pylist() if column.null_count and not pa.types.is_string(column.type) else column.to_numpy(zero_copy_only=False).tolist()


class Part(WriterCommitMessage):
    def __init__(self, name: str):
        self.name = name


class BamWriter(DataSourceArrowWriter):
    """A file for each task, moved to its place when all tasks are done; files of tasks that were lost are deleted."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.contigs: list = json.loads(options.get("contigs", "[]"))
        self.held = f"_held-{uuid.uuid4().hex}"

    def write(self, batches) -> Part:
        from pyspark import TaskContext

        where, path = place(self.path)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.bam"
        where.create_dir(f"{path}/{self.held}")
        number = {n: k for k, (n, _) in enumerate(self.contigs)}
        text = "@HD\tVN:1.6\n" + "".join(f"@SQ\tSN:{n}\tLN:{size}\n" for n, size in self.contigs)
        head = b"BAM\x01" + struct.pack("<i", len(text.encode())) + text.encode() + struct.pack("<i", len(self.contigs))
        head += b"".join(struct.pack("<i", len(n.encode()) + 1) + n.encode() + b"\0" + struct.pack("<i", size) for n, size in self.contigs)

        def parts():
            yield head
            for row in (x for b in batches for x in zip(*(values(b.column(c)) for c in COLUMNS))):
                yield bam_bytes(*row, number)

        with where.open_output_stream(f"{path}/{self.held}/{name}", compression=None) as f:
            for member in packed(parts()):
                f.write(member)
        return Part(name)

    def commit(self, messages) -> None:
        where, path = place(self.path)
        if self.overwrite:
            for x in where.get_file_info(fs.FileSelector(path)):
                if x.is_file:
                    where.delete_file(x.path)
        for m in messages:
            if m is not None:
                where.move(f"{path}/{self.held}/{m.name}", f"{path}/{m.name}")
        where.delete_dir(f"{path}/{self.held}")

    def abort(self, messages) -> None:
        where, path = place(self.path)
        if where.get_file_info(f"{path}/{self.held}").type == fs.FileType.Directory:
            where.delete_dir(f"{path}/{self.held}")


class RecordSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "records"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("kind", "lines")]

    def reader(self, schema) -> RecordReader:
        return RecordReader(self.options)

    def streamReader(self, schema):
        from .tail import RecordStream

        return RecordStream(self.options)

    def writer(self, schema, overwrite: bool) -> BamWriter:
        if self.options.get("kind") != "bam":
            raise ValueError("of these kinds only bam is written here; see sinks.py")
        return BamWriter(self.options, overwrite)


def read(spark: SparkSession, path: str | list[str], kind: str = "lines", **options) -> DataFrame:
    spark.dataSource.register(RecordSource)
    return spark.read.format("records").options(kind=kind, **options).load(path if isinstance(path, str) else ",".join(path))


def follow(spark: SparkSession, path: str | list[str], kind: str = "lines", **options) -> DataFrame:
    """The records of files that still grow, as a stream (see tail.py)."""
    spark.dataSource.register(RecordSource)
    return spark.readStream.format("records").options(kind=kind, **options).load(path if isinstance(path, str) else ",".join(path))


def sniff(path: str) -> str | None:
    """"fastq" or "fasta" by the first byte of a file, None if it holds nothing."""
    where, at = place(path)
    some = next(opened(where, at), None) if where.get_file_info(at).size else None
    first = some.read(1) if some else b""
    if not first:
        return None
    kinds = {b"@": "fastq", b">": "fasta"}
    if first not in kinds:
        raise ValueError(f"{path}: neither FASTA nor FASTQ")
    return kinds[first]
