"""What operators that work in rounds need: tables cut from their lineage, and chains followed in logarithmically many rounds."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.files import shared_folder


class Rounds:
    """Tables written to the shared folder, so that a lost executor costs a reread. They stay until dropped or the driver's JVM ends."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/strandline-{uuid.uuid4().hex}"
        self.n = 0

    def _hadoop(self, at: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(at)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def save(self, df: DataFrame) -> DataFrame:
        self.n += 1
        at = f"{self.root}/{self.n:03d}"
        df.write.parquet(at)
        if self.n == 1:
            path, store = self._hadoop(self.root)
            store.deleteOnExit(path)
        out = self.spark.read.schema(df.schema).parquet(at)
        out._at = at
        return out

    def counted(self, df: DataFrame, **counts) -> tuple[DataFrame, dict]:
        """save(), and aggregates of the rows as they are written."""
        seen = Observation()
        return self.save(df.observe(seen, *(c.alias(k) for k, c in counts.items()))), seen.get

    def drop(self, df: DataFrame) -> None:
        path, store = self._hadoop(df._at)
        store.delete(path, True)


def followed(links: DataFrame, rounds: Rounds) -> DataFrame:
    """(node, to, steps) of links (node, to), each node once: to becomes the end of the chain that starts at the node, steps its length.

    A node that links to itself or to null is an end, and so is one without a row. Each round doubles the steps taken, so a chain of n
    links takes log2(n) rounds; a circle is an error. A row that has come to an end is done: later rounds read it only as what others come
    to, so they write and move the rest alone.
    """
    end = F.col("to").isNull() | (F.col("node") == F.col("to"))
    links = links.select("node", F.coalesce("to", "node").alias("to"), F.when(end, 0).otherwise(1).cast("long").alias("steps"))
    links, seen = rounds.counted(links, rows=F.count("*"))
    on = links.where("steps > 0").select(F.col("node").alias("at"), F.lit(True).alias("goes_on"))
    start = links.join(on, (F.col("steps") > 0) & (F.col("to") == F.col("at")), "left").select("node", "to", "steps", F.col("goes_on").isNull().alias("done"))
    most, taken = seen["rows"], 1
    now, seen = rounds.counted(start, left=F.count_if(~F.col("done")))
    rounds.drop(links)
    done = now.where("done")
    while seen["left"]:
        if taken > 2 * most:
            raise ValueError("links go in a circle")
        going = now.where("not done")
        ahead = done.where("steps > 0").unionByName(going).select(F.col("node").alias("at"), F.col("to").alias("next"), F.col("steps").alias("more"), F.col("done").alias("last"))
        # what a row that goes on has come to goes on too, so it has a row
        now, seen = rounds.counted(going.join(ahead, F.col("to") == F.col("at")).select("node", F.col("next").alias("to"), (F.col("steps") + F.col("more")).alias("steps"), F.col("last").alias("done")), left=F.count_if(~F.col("done")))
        done, taken = done.unionByName(now.where("done")), taken * 2
    return done.select("node", "to", "steps")
