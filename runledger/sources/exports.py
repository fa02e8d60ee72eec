"""Ordered text exports of groups of any size (SRC-01, SRC-02, SRC-05).

Rows are range-partitioned by (group, order) and every task writes its range as one numbered fragment
file, so a group may span many fragments and a fragment may hold many groups; the number of files
follows the data, not the groups. ``<path>-manifest`` says which lines of which fragment belong to which
group; the lines of a group, in the order of its fragments, are its exported text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runledger.operators.runs import attach
from runledger.session import cut_in_place
from runledger.sources.lines import number_lines, split_lines

_IN_TASK = (1 << 33) - 1  # the part of monotonically_increasing_id that counts rows within a task


def write_fragments(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], line: Column, path: str,
                    as_array: bool = False) -> None:
    """Write ``line`` of every row to fragments under ``path``, each group's in ``order_cols`` order (a
    total order within the group). A line with line breaks fills several lines; null lines are left out.

    ``as_array``: the lines of a group are JSON values and together one JSON array: the first is
    opened with ``[``, the others follow a comma, and a line ``]`` closes it.
    """
    g = list(group_cols)
    o = [f"_o{i}" for i in range(len(order_cols))]
    rows = df.select(*g, *[F.col(c).alias(n) for c, n in zip(order_cols, o)], F.lit(0).alias("_end"), line.alias("value")).filter("value IS NOT NULL")
    if as_array:
        first = rows.groupBy(*g).agg(F.min(F.struct(*o)).alias("_f")).select(*g, *[F.col(f"_f.{c}").alias(c) for c in o])
        opened = attach(rows, first.withColumn("_open", F.lit("[")), [*g, *o])
        rows = opened.select(*g, *o, "_end", F.concat(F.coalesce("_open", F.lit(",")), "value").alias("value")).unionByName(
            first.select(*g, *o, F.lit(1).alias("_end"), F.lit("]").alias("value")))
    rows = rows.select(*g, "_end", *o, F.posexplode(F.split("value", "\n")).alias("_part", "value"))
    keys = [*g, "_end", *o, "_part"]
    placed = cut_in_place(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .select(*g, "value", F.spark_partition_id().alias("fragment"), F.monotonically_increasing_id().alias("_at")))
    placed.select("value").write.mode("overwrite").option("lineSep", "\n").text(path)
    first_line = F.min(F.col("_at").bitwiseAND(F.lit(_IN_TASK)))
    placed.groupBy(*g, "fragment").agg(first_line.alias("first_line"), F.count(F.lit(1)).alias("n_lines")) \
          .write.mode("overwrite").parquet(f"{path.rstrip('/')}-manifest")


def read_fragments(spark: SparkSession, path: str) -> DataFrame:
    """(group..., line_no, line) of an export: the lines of every group numbered from 0."""
    manifest = spark.read.parquet(f"{path.rstrip('/')}-manifest")
    g = [c for c in manifest.columns if c not in ("fragment", "first_line", "n_lines")]
    before = Window.partitionBy(*g).orderBy("fragment").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("fragment", F.col("first_line").alias("_at"), F.lit(0).alias("_kind"), F.struct(
        *g, (F.coalesce(F.sum("n_lines").over(before), F.lit(0)) - F.col("first_line")).alias("_shift")).alias("_g"))
    lines = number_lines(split_lines(spark, path), keep_blank=True)
    lines = lines.select(F.regexp_extract("file", r"/part-(\d+)-[^/]*$", 1).cast("int").alias("fragment"), F.col("line_no").alias("_at"),
                         F.lit(1).alias("_kind"), "line")
    # within a fragment (one task's range of rows) every line belongs to the last group that has started
    w = Window.partitionBy("fragment").orderBy("_at", "_kind")
    both = lines.unionByName(starts, allowMissingColumns=True).withColumn("_g", F.last("_g", ignorenulls=True).over(w))
    return both.filter("_kind = 1").select(*[F.col(f"_g.{c}").alias(c) for c in g], (F.col("_at") + F.col("_g._shift")).alias("line_no"), "line")
