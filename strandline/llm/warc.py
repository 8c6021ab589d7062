"""WARC archives as a Python data source: format("warc").

Writing: one gzip member per record, files of about FILE_BYTES, and a manifest of the files of committed tasks, so that the files of
failed attempts are never read. Each member carries its compressed length in the gzip extra field "sl", which lets a reader step over
a payload without inflating it.

Reading: partitions are groups of whole files of about `maxPartitionBytes`. Filters on record_type, target_uri, record_id, refers_to and
payload_digest are taken over: a record's headers are inflated and parsed first, and a record that fails is stepped over. Option
payload: "full" (default), "digest" (length and SHA-1 of the payload, which stays in the reader) or "none" (never inflated).
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage

from .common import Scratch, small_or_shuffled, table

FILE_BYTES, LEVEL = 64 << 20, 3
SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
URN = "urn:strandline:page:"
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}


#: Hadoop's names of stores, and those of the same in pyarrow.
STORES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "wasbs": "abfss", "wasb": "abfs"}


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; Python workers have no Hadoop client, so a path that Spark reads by one must be of a
    kind that pyarrow has too (local, S3, GCS, Azure; HDFS with libhdfs)."""
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{STORES.get(scheme, scheme)}:{rest}")


def record(rid: str, kind: str, uri: str | None, refers: str | None, digest: str, size: int, payload: bytes) -> bytes:
    clean = lambda x: " ".join(x.split())
    block = b"" if kind == "revisit" else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{rid}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    head += [f"WARC-Target-URI: {clean(uri)}"] if uri is not None else []
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    head += [f"WARC-Refers-To: <{refers}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if refers else []
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member with its own length in the extra field."""
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    size = 24 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF) if size < 1 << 32 else b"xx" + struct.pack("<HII", 8, 0, 0)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def headers_of(text: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in text.decode("utf-8", "replace").split("\r\n")[1:])}


class Member:
    """One record of a file: its headers at once, its block only when asked for."""

    def __init__(self, f, start: int):
        self.f, self.start = f, start
        f.seek(start)
        self.raw = f.read(4096)
        self.size = 0
        if len(self.raw) >= 24 and self.raw[3] & 4 and self.raw[12:14] == b"sl":
            self.size = struct.unpack("<I", self.raw[16:20])[0]
        self.z = zlib.decompressobj(31)
        self.data = b""
        while b"\r\n\r\n" not in self.data:
            if not self.more():
                break
        head, _, self.data = self.data.partition(b"\r\n\r\n")
        self.headers = headers_of(head)

    def more(self, most: int = 1024) -> bool:
        """Inflate on; False at the member's end."""
        if self.z.eof:
            return False
        raw = self.raw or self.f.read(1 << 16)
        if not raw:
            return False
        got = self.z.decompress(raw, most)
        self.raw = self.z.unconsumed_tail or (self.z.unused_data if self.z.eof else b"")
        self.data += got
        return True

    def block(self) -> bytes:
        parts, self.data = [self.data], b""
        while self.more(1 << 20):
            parts.append(self.data)
            self.data = b""
        return b"".join(parts)[: int(self.headers.get("content-length", 0))]

    def end(self) -> int:
        """Where the next member starts."""
        if self.size:
            return self.start + self.size
        while self.more(1 << 20):
            self.data = b""
        return self.f.tell() - len(self.raw)


def bare(v: str | None, key: str) -> str | None:
    if v is None:
        return None
    return v.removeprefix("sha1:") if key == "payload_digest" else v.strip("<>") if key in ("record_id", "refers_to") else v


class Files(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload = options["path"], options.get("payload", "full")
        self.most = int(options.get("maxpartitionbytes", FILE_BYTES))
        self.wanted: list[tuple[str, str, object]] = []

    def pushFilters(self, filters) -> Iterator:
        for f in filters:
            key = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if key in HEADERS and isinstance(f, (EqualTo, In, StringStartsWith)):
                self.wanted.append((key, "start", f.value) if isinstance(f, StringStartsWith) else (key, "in", {f.value} if isinstance(f, EqualTo) else set(f.value)))
            elif key in HEADERS and isinstance(f, IsNotNull):
                self.wanted.append((key, "some", None))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        where, path = place(self.path)
        seen = where.get_file_info(fs.FileSelector(path, allow_not_found=True))
        listed = set()
        for x in seen:
            if x.base_name.startswith("_manifest"):
                with where.open_input_stream(x.path) as f:
                    listed |= set(json.loads(f.read()))
        files = sorted((x.path, x.size) for x in seen if x.base_name.endswith(".warc.gz") and (not listed or x.base_name in listed))
        out, size = [[]], 0
        for p, n in files:
            if out[-1] and size + n > self.most:
                out.append([])
                size = 0
            out[-1].append(p)
            size += n
        return [Files(x) for x in out if x] or [Files([])]

    def keeps(self, h: dict[str, str]) -> bool:
        for key, how, value in self.wanted:
            v = bare(h.get(HEADERS[key]), key)
            if v is None or (how == "in" and v not in value) or (how == "start" and not v.startswith(value)):
                return False
        return True

    def rows(self, f, size: int) -> Iterator[tuple]:
        at = 0
        while at < size:
            m = Member(f, at)
            h = m.headers
            if self.keeps(h):
                digest, n, payload = bare(h.get("warc-payload-digest"), "payload_digest"), h.get("x-payload-length"), None
                if self.payload != "none" and h.get("warc-type") == "response":
                    payload = m.block().partition(b"\r\n\r\n")[2]
                    if self.payload == "digest":
                        digest, n, payload = hashlib.sha1(payload).hexdigest(), len(payload), None
                yield (*(bare(h.get(HEADERS[k]), k) for k in ("record_id", "record_type", "target_uri", "refers_to")), digest, None if n is None else int(n), payload)
            at = m.end()

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        where = place(self.path)[0]
        types = (pa.string(),) * 5 + (pa.int64(), pa.binary())
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        batch, size = [], 0
        for p in partition.files:
            with where.open_input_file(p) as f:
                for row in self.rows(f, f.size()):
                    batch.append(row)
                    size += len(row[-1] or b"") + 300
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*batch), types)], names=names)
                        batch, size = [], 0
        if batch:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*batch), types)], names=names)


class Done(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Done:
        where, path = place(self.path)
        where.create_dir(path, recursive=True)
        files, out, size = [], None, 0
        for b in iterator:
            for r in zip(*(b.column(c).to_pylist() for c in ("record_id", "record_type", "target_uri", "refers_to", "payload_digest", "payload_bytes", "payload"))):
                if out is None:
                    files.append(f"{uuid.uuid4().hex}.warc.gz")
                    out, size = where.open_output_stream(f"{path}/{files[-1]}", compression=None), 0
                data = member(record(*r[:-1], r[-1] or b""))
                out.write(data)
                size += len(data)
                if size > FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Done(files)

    def commit(self, messages: list[Done]) -> None:
        where, path = place(self.path)
        where.create_dir(path, recursive=True)
        if self.overwrite:
            now = {f for m in messages if m for f in m.files}
            for x in where.get_file_info(fs.FileSelector(path)):
                if x.is_file and x.base_name not in now:
                    where.delete_file(x.path)
        with where.open_output_stream(f"{path}/_manifest-{uuid.uuid4().hex}.json") as f:
            f.write(json.dumps([f for m in messages if m for f in m.files]).encode())

    def abort(self, messages: list[Done]) -> None:
        where, path = place(self.path)
        for m in messages:
            for f in m.files if m else ():
                where.delete_file(f"{path}/{f}")


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


#: Payloads of fewer bytes are never written as revisits.
REVISIT_BYTES = 1000


def records(pages: DataFrame) -> DataFrame:
    """Rows of pages (page_id, url, html) as WARC records. Of equal payloads of REVISIT_BYTES or more, the largest page_id is the response."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    each = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).select("*", F.sha1("payload").alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    long = each.where(F.col("payload_bytes") >= REVISIT_BYTES)
    again = long.groupBy("payload_digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select(F.col("payload_digest").alias("d"), "first")
    kept = Scratch(pages.sparkSession).save(again, "again")
    joined = each.join(small_or_shuffled(kept, 5 * kept.count()), (F.col("payload_digest") == F.col("d")) & (F.col("payload_bytes") >= REVISIT_BYTES), "left")
    revisit = F.coalesce(F.col("first") > F.col("page_id"), F.col("first").isNotNull() & F.col("page_id").isNull())
    urn = lambda c: F.concat(F.lit(URN), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return joined.select(
        urn("page_id").alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.col("url").alias("target_uri"),
        F.when(revisit, urn("first")).alias("refers_to"), "payload_digest", "payload_bytes", F.when(~revisit, F.col("payload")).alias("payload"))


def write_and_read(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as read back from the archives that pages are written to.

    Responses give the length and digest of the payload that was read, revisits those of their headers. A null html is an empty payload;
    a row without page_id comes back without one, and is no other's response. Repeated rows of the largest page_id are all responses. Other
    columns are ignored, whatever their names; an empty table gives no rows. A record, its page and all, is held by one task at a time.
    """
    spark = pages.sparkSession
    register(spark)
    path = Scratch(spark).path("warc")
    records(pages).write.format("warc").mode("append").option("path", path).save()
    back = spark.read.format("warc").option("payload", "digest").load(path)
    page = lambda c: F.nullif(F.substring(F.col(c), len(URN) + 1, 40), F.lit("")).cast("long")
    return back.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


OP5_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT payload_digest, max(page_id) AS first FROM d WHERE payload_bytes >= {REVISIT_BYTES} GROUP BY 1)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, d.payload_digest,
  CASE WHEN first > page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first > page_id THEN first END AS refers_to
FROM d LEFT JOIN m ON m.payload_digest = d.payload_digest AND d.payload_bytes >= {REVISIT_BYTES}
"""


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_and_read(table(spark, sf_dir, "pages"))
