"""Operator 2, sharding by extendible hashing: a directory of hash prefixes, split only where too full.

Native DataFrame code. A histogram of bytes per fine prefix gives, with partial aggregation, the bytes
under every shorter prefix; a document's shard is its shortest prefix that fits the limit.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .mixing import KEY_BITS, hash_key

EXTRA_BITS = 4  # prefix bits of a pass beyond those that an even split would need


def _prefix(col: str, bits) -> F.Column:
    return F.expr(f"shiftright({col}, {KEY_BITS} - ({bits}))")


def shard(df: DataFrame, limit_bytes: int, key_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Assign every row to a shard of at most ``limit_bytes`` bytes of text.

    Returns (assignment, directory). Assignment: the key, ``bytes``, ``shard_id``, ``shard_bits`` (local
    depth) per row. Directory: ``shard_id``, ``shard_bits``, ``shard_bytes`` per shard. A shard id is the
    prefix in binary ('' for the undivided table).

    Rows that share all 60 hash bits (repeated keys) and together exceed the limit continue in numbered
    pages of the deepest bucket: a row over half the limit has a page alone, others fill halves in row
    order, so every page keeps the limit. A single row over the limit cannot fit any shard: it gets one
    of its own, outside the directory's prefixes, with ``shard_bits`` -1.
    Null text has 0 bytes; a null key hashes as ''; an empty table gives empty results.
    """
    scratch = Scratch(df.sparkSession, "shard")
    sized = scratch.table(df.select(
        F.col(key_col).alias("k"), hash_key(F.col(key_col)).alias("h"),
        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("bytes"),
        F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("rid")), "sized")
    fits = sized.where(F.col("bytes") <= limit_bytes)
    total = fits.agg(F.sum("bytes")).first()[0] or 0
    step = max(1, math.ceil(math.log2(max(1.0, total / limit_bytes)))) + EXTRA_BITS
    left, low, parts = fits, 0, []
    while True:
        high = min(KEY_BITS, low + step)
        hist = scratch.table(left.withColumn("p", _prefix("h", high)).groupBy("p").agg(F.sum("bytes").alias("bytes")), f"hist{high}")
        deep = hist.withColumn("bits", F.explode(F.sequence(F.lit(low), F.lit(high)))).withColumn(
            "q", F.expr(f"shiftright(p, {high} - bits)"))
        full = deep.groupBy("bits", "q").agg(F.sum("bytes").alias("b")).where(F.col("b") <= limit_bytes)
        best = deep.join(full, ["bits", "q"]).groupBy("p").agg(F.min("bits").alias("bits"))
        leaf = scratch.table(hist.join(best, "p", "left"), f"leaf{high}").select("p", "bits")
        placed = left.withColumn("p", _prefix("h", high)).join(leaf, "p", "left")
        parts.append(placed.where("bits is not null").select("k", "bytes", "h", "bits", F.lit(None).cast("long").alias("page")))
        over = leaf.where("bits is null")
        if not over.limit(1).count():
            break
        left = scratch.table(left.withColumn("p", _prefix("h", high)).join(over.select("p"), "p", "left_semi").drop("p"), f"left{high}")
        low = high
        if high == KEY_BITS:
            parts.append(_pages(left, limit_bytes))
            break
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    code = F.when(F.col("bits") > 0, F.lpad(F.conv(F.expr(f"shiftright(h, {KEY_BITS} - bits)").cast("string"), 10, 2), F.col("bits"), F.lit("0"))).otherwise("")
    code = F.when(F.col("page").isNull(), code).otherwise(F.concat(code, F.lit("/"), F.col("page").cast("string")))
    out = rows.select("k", "bytes", code.alias("shard_id"), F.col("bits").cast("long").alias("shard_bits"))
    giants = sized.where(F.col("bytes") > limit_bytes).select(
        "k", "bytes", F.concat(F.lit("own/"), F.col("rid").cast("string")).alias("shard_id"), F.lit(-1).cast("long").alias("shard_bits"))
    out = scratch.table(out.unionByName(giants).withColumnRenamed("k", key_col), "assigned")
    directory = out.groupBy("shard_id", "shard_bits").agg(F.sum("bytes").alias("shard_bytes"))
    return out, directory


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Pages of buckets that no hash bit divides: prefix sums over written partitions, then inside each."""
    half = limit / 2
    small = F.col("bytes") <= half
    counted = F.when(small, F.col("bytes")).otherwise(0)
    per = rows.groupBy("h", "pid").agg(F.sum(counted).alias("w"))
    base = per.select(F.col("h").alias("h2"), F.col("pid").alias("pid2"), (F.sum("w").over(Window.partitionBy("h").orderBy("pid")) - F.col("w")).alias("base"))
    run = F.sum(counted).over(Window.partitionBy("h", "pid").orderBy("rid")) - counted
    out = rows.join(base, (F.col("h") == F.col("h2")) & (F.col("pid") == F.col("pid2"))).withColumn("before", run + F.col("base"))
    page = F.when(small, F.floor(F.col("before") / half)).otherwise(-1 - F.col("rid")).cast("long")
    return out.select("k", "bytes", "h", F.lit(KEY_BITS).alias("bits"), page.alias("page"))
