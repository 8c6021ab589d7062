"""Shared plumbing: input tables, tables cut from their lineage, connected components, word hashing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side of 8 to 16 byte keys is sent to every executor; larger sides are shuffled.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where it is unset, local mode (tests) gets a temporary one, and
    a cluster an error: its executors could not read what lies on the driver."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="strandline-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def small_batches(spark: SparkSession) -> SparkSession:
    """Send texts to Python in Arrow batches of at most 1000 rows and 8 MB: the default of 10,000 rows is sized for narrow rows, and its
    buffers stay with the executor, outside its heap."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > 1000 or int(spark.conf.get(name)) <= 0:
        spark.conf.set(name, "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores after it until df has no such column."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


class Scratch:
    """Tables written to the shared folder, so that lost executors cost a reread and never a recomputation.

    DataFrames that are returned read them lazily, so they stay until the driver's JVM ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = small_batches(spark)
        self.root = f"{shared_dir(spark)}/strandline-{uuid.uuid4().hex}"
        self.n = 0

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def save(self, df: DataFrame, name: str = "t") -> DataFrame:
        at = self.path(name)
        df.write.parquet(at)
        if self.n == 1:
            root = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
            root.getFileSystem(self.spark._jsc.hadoopConfiguration()).deleteOnExit(root)
        out = self.spark.read.schema(df.schema).parquet(at)
        out._scratch_path = at
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table of save() that no later plan reads."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def small_or_shuffled(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table if its count, in rows of up to 16 bytes, has shown it to be small; else Spark shuffles it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def components(edges: DataFrame, keep: Scratch) -> DataFrame:
    """Connected components of edges (a long, b long) as (id, component), the least id of each; ids without edges are absent.

    Alternating large-star and small-star rounds (Kiveris et al. 2014). Each is an aggregation and a join on the same key, so the
    degree of a node is never held in one task's memory.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            sym = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
            low = sym.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
            return sym.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        out = e.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def saved(e: DataFrame) -> tuple[DataFrame, tuple]:
        seen = Observation()
        kept = keep.save(e.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")), "cc")
        return kept, (seen.get["n"], seen.get["h"])

    now, mark = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    was = None
    while mark != was and mark[0]:
        was = mark
        new, mark = saved(star(star(now, True), False))
        keep.drop(now)
        now = new
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembered; emptied when it holds 120,000 words, so memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 120_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


WORDS = WordHashes()


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of 64-bit hashes (the constants of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def give_back() -> None:
    """Return freed memory to the system: Python workers are kept for the next stage, which may run beside a full JVM."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not glibc


def texts_of(batches, words_at_once: int = 300_000) -> Iterator[tuple[list[int], list[bytes]]]:
    """Arrow batches with doc_id and text -> lists of ids and of texts as UTF-8, cut so that a list holds about so many words."""
    ids: list[int] = []
    texts: list[bytes] = []
    size = 0
    for b in batches:
        at, text_at = b.schema.get_field_index("doc_id"), b.schema.get_field_index("text")
        for k in range(0, b.num_rows, 256):
            part = b.slice(k, 256)
            text = part.column(text_at).to_pylist()
            for i, t in zip(part.column(at).to_pylist() if at >= 0 else [None] * len(text), text):
                ids.append(i)
                texts.append((t or "").encode("utf-8", "surrogatepass"))
                size += len(texts[-1])
                if size > 6 * words_at_once or len(ids) >= 20_000:
                    yield ids, texts
                    ids, texts, size = [], [], 0
    if ids:
        yield ids, texts
    give_back()
