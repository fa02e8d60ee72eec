"""Helpers shared by the training-data operators: word pattern, scratch tables, union-find."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runledger.session import checkpoint_dir, write_table

# A word of the contracts: a run of characters outside ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SEPARATORS = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    """The words of a text in order; an empty array for null, empty or blank text."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SEPARATORS, -1))


BROADCAST_ROWS = 600_000  # rows of one or two longs (some 50 MB as a hash table) that may go to every executor; more are shuffled


def small(df: DataFrame) -> DataFrame:
    """Mark a narrow, written table for broadcast if its count allows, else leave the join to shuffle."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def hash_sample(rows: DataFrame, group: str, key: str, k: int) -> DataFrame:
    """The k rows of each group with the least key hashes (all, if fewer).

    Counts bound the hash first, so that some 4k candidates of a group, not the group, meet in one task.
    """
    sizes = rows.groupBy(F.col(group).alias("__g")).agg(F.count(F.lit(1)).alias("__n"))
    hashed = rows.withColumn("__h", F.xxhash64(key)).join(small(sizes), F.col(group) == F.col("__g"))
    near = hashed.where((F.col("__h") / F.lit(2.0 ** 64) + 0.5) * F.col("__n") <= 4 * k)
    order = Window.partitionBy(group).orderBy("__h", key)
    return near.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= k).select(*rows.columns)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where the body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class Scratch:
    """Parquet tables under ``spark.checkpoint.dir``: lineage ends at a table all executors can read again.

    ``drop`` removes a table that no later plan reads; the tables behind a returned result stay.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        write_table(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        conf = self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = hadoop(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)
        self.release()

    def within(self, name: str) -> Scratch:
        """Tables of a step, below this one's folder."""
        inner = Scratch(self.spark, name)
        inner.root = f"{self.root}/{name}"
        return inner

    def keep(self, *names: str) -> None:
        """Remove all tables but those that a returned result reads."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        there = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        self.drop(*[n for n in there if n not in names])

    def release(self) -> None:
        """Let Spark's cleaner remove the shuffle files of plans that are no longer referenced."""
        gc.collect()
        self.spark._jvm.System.gc()


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    ``edges`` has columns ``a`` and ``b`` (long, any order, repeats allowed). Returns (id, component)
    for every node of an edge but the components' own smallest nodes, which are their own component.
    A round keeps at most one row per node and neighbour; only two counters reach the driver.
    """
    cur = scratch.table(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                        .distinct(), f"{name}-0")
    k = 0
    while True:
        parents = cur.groupBy("hi").agg(F.count(F.lit(1)).alias("n"))
        if (not parents.where("n > 1").limit(1).count()
                and not cur.join(cur.select(F.col("hi").alias("lo")), "lo", "left_semi").limit(1).count()):
            return cur.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
        k += 1
        both = cur.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(cur.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        small = small.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(small.select("hi", "m"))
        nxt = scratch.table(small.where("hi <> lo").distinct(), f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
        cur = nxt
