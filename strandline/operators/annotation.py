"""Operators on annotation tables: rank profiles, taxonomy, attribute lists, renaming and graphs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .rounds import Rounds, followed


def rank_profile(genes: DataFrame, ranks: Sequence[str], top: int) -> DataFrame:
    """The `top` taxa of each bin and rank, with their share of the bin's genes: bin, rank, taxon, n, percent, place."""
    total = genes.groupBy("bin").agg(F.count("*").alias("genes"))
    n = genes.unpivot(["bin"], list(ranks), "rank", "taxon").groupBy("bin", "rank", "taxon").agg(F.count("*").alias("n"))
    place = F.row_number().over(W.partitionBy("bin", "rank").orderBy(F.desc("n"), "taxon"))
    return n.join(total, "bin").select("bin", "rank", "taxon", "n", F.round(100.0 * F.col("n") / F.col("genes"), 6).alias("percent"), place.alias("place")).where(F.col("place") <= top)


def copy_matrix(df: DataFrame, cluster: str, genome: str, names: dict[str, str]) -> DataFrame:
    """cluster x genome counts (names: genome -> column) and in how many genomes the cluster is."""
    wide = df.groupBy(cluster).pivot(genome, list(names)).agg(F.count(F.lit(1))).na.fill(0)
    cols = [F.col(f"`{k}`").alias(v) for k, v in names.items()]
    return wide.select(cluster, *cols).withColumn("presence", sum((F.col(v) > 0).cast("int") for v in names.values()))


def core(df: DataFrame, cluster: str, genome: str) -> DataFrame:
    """Clusters that are in every genome."""
    all_ = df.agg(F.count_distinct(genome).alias("_all"))
    return df.groupBy(cluster).agg(F.count_distinct(genome).alias("_n")).crossJoin(F.broadcast(all_)).where("_n = _all").select(cluster)


def tags(df: DataFrame, key: str, taxon: str) -> DataFrame:
    """Each key's sorted set of taxa as a tag; how often a tag is, and its share."""
    t = df.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(taxon)), ",").alias("tag"))
    n = t.groupBy("tag").agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("_t")))).select("tag", "n", F.round(100.0 * F.col("n") / F.col("_t"), 6).alias("percent"))


def star(facts: DataFrame, key: str, *dims: DataFrame) -> DataFrame:
    """facts with the columns of each dimension (unique by key), null where it has no row."""
    for d in dims:
        facts = facts.join(d, key, "left")
    return facts


def renamed(df: DataFrame, column: str, *maps: DataFrame) -> DataFrame:
    """column through maps (old, new) one after the other; what a map doesn't know stays."""
    for m in maps:
        df = df.join(m.select(F.col("old").alias(column), F.col("new").alias("_new")), column, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")
    return df


def climb(nodes: DataFrame, start: DataFrame, ranks: Sequence[str], most: int | None = None) -> DataFrame:
    """The first ancestor of each taxid with one of the ranks: taxid, name, rank, depth. A walk of more than `most` steps is an error, if it
    is given; so is a circle.

    All nodes (taxid, parent, rank, name) climb at once, twice as far each round, so taxonomies of any depth take few rounds (see
    rounds.followed). A walk that ends at a node of another rank, or leaves the table, gives no row.
    """
    top = F.col("rank").isin(*ranks)
    ends = followed(nodes.select(F.col("taxid").alias("node"), F.when(top, None).otherwise(F.col("parent")).alias("to")), Rounds(nodes.sparkSession))
    at = nodes.where(top).select(F.col("taxid").alias("to"), "name", "rank")
    depth = F.col("steps").cast("int")
    if most is not None:
        far = F.raise_error(F.concat(F.lit(f"more than {most} steps up from "), F.col("taxid").cast("string")))
        depth = F.when(F.col("steps") > most, far.cast("int")).otherwise(depth)
    return start.select("taxid").join(ends, F.col("taxid") == F.col("node")).join(at, "to").select("taxid", "name", "rank", depth.alias("depth"))


def attribute_map(attributes: Column, pair: str = ";", is_: str = "=") -> Column:
    """k=v;k=v as a map; of a repeated key the last value holds."""
    pairs = F.filter(F.transform(F.split(attributes, pair), lambda x: F.split(F.trim(x), is_, 2)), lambda x: F.size(x) == 2)
    return F.aggregate(pairs, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")), lambda m, x: F.map_concat(F.map_filter(m, lambda k, v: k != x[0]), F.create_map(x[0], x[1])))


def attribute_keys(df: DataFrame, column: str) -> DataFrame:
    """The keys of all attribute lists and how many rows have them."""
    return df.select(F.explode(F.map_keys(attribute_map(F.col(column)))).alias("key")).groupBy("key").agg(F.count("*").alias("n"))


def expanded(df: DataFrame, column: str, keys: Sequence[str] | None = None, most: int = 2000) -> DataFrame:
    """One column a key. Without keys they are found first, which is a pass over df; over `most` of them are an error, as a table of so
    many columns is of no use: attribute_map() is the form that needs none."""
    if keys is None:
        keys = [r.key for r in attribute_keys(df, column).orderBy("key").limit(most + 1).collect()]
        if len(keys) > most:
            raise ValueError(f"more than {most} keys")
    m = df.withColumn("_m", attribute_map(F.col(column)))
    return m.select(*(c for c in df.columns if c != column), *(F.col("_m")[k].alias(k) for k in keys))


def carried(df: DataFrame, part: str, order: str, column: str) -> DataFrame:
    """column with nulls replaced by the last value before, within a part."""
    return df.withColumn(column, F.last(column, ignorenulls=True).over(W.partitionBy(part).orderBy(order).rowsBetween(W.unboundedPreceding, 0)))


def prefix_group(column: Column, prefixes: Sequence[str], other: str) -> Column:
    out = F.when(column.startswith(prefixes[0]), prefixes[0])
    for p in prefixes[1:]:
        out = out.when(column.startswith(p), p)
    return out.otherwise(other)


def graph(features: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, label) and edges (source, relation, target) of features of at least `least` positions and their scaffolds."""
    f = features.where(F.abs(F.col("start") - F.col("stop")) + 1 >= least)
    scaffold = F.concat(F.lit("s"), F.col("scaffold").cast("string"))
    nodes = f.select(F.col("locus").cast("string").alias("id"), F.col("type").alias("label")).unionByName(f.select(scaffold.alias("id"), F.lit("scaffold").alias("label")).distinct())
    return nodes, f.select(F.col("locus").cast("string").alias("source"), F.concat(F.lit("is_"), "type", F.lit("_on")).alias("relation"), scaffold.alias("target"))
