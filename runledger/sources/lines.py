"""Lines of text files with their place, read split: a file of any size spreads over many tasks, and many
small files share a pack."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runledger.session import broadcast_small, cut_lineage, path_exists

SPLIT_SCHEMA = "file string, block long, line string"
PACK_SEP = "\t"  # between the name and the line in a pack


def split_lines(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """(file, block, line) for every line under ``path`` (recursive), blank ones included; ``block`` is
    the offset at which the line's split starts. A missing path is an empty input. With ``packed`` the
    files are packs (:func:`write_packs`), and ``file`` is the pack's path and the packed file's name."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], SPLIT_SCHEMA)
    return _placed(spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).format("text").load(path), packed)


def stream_lines(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """:func:`split_lines` of files as they land."""
    return _placed(spark.readStream.option("lineSep", "\n").option("recursiveFileLookup", True).format("text").load(path), packed)


def _placed(raw: DataFrame, packed: bool) -> DataFrame:
    file, line = F.col("_metadata.file_path"), F.col("value")
    if packed:
        name = F.substring_index("value", PACK_SEP, 1)
        file, line = F.concat(file, F.lit("/"), name), F.substring("value", F.length(name) + 2, F.length("value"))
    return raw.select(file.alias("file"), F.col("_metadata.file_block_start").alias("block"), line.alias("line"))


def write_packs(df: DataFrame, name: Column, order_cols: Sequence[str], line: Column, path: str) -> None:
    """Many small text files as few packs: a pack's lines are led by the packed file's name and a tab. A
    packed file lies whole and in ``order_cols`` order in one pack, so a line's number follows from its
    place as in a file of its own, and the number of files follows the data, not the names. A line with
    line breaks fills several lines; names hold no tab and no line break."""
    checked = F.when(name.rlike(r"[\t\n]"), F.raise_error(F.lit("a packed file's name holds a tab or a line break"))).otherwise(name)
    rows = df.select(checked.alias("_name"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)], F.coalesce(line, F.lit("")).alias("_line"))
    led = F.concat(F.lit("\n"), "_name", F.lit(PACK_SEP))
    rows = rows.repartition("_name").sortWithinPartitions("_name", *[f"_o{i}" for i in range(len(order_cols))])
    rows.select(F.concat("_name", F.lit(PACK_SEP), F.replace(F.col("_line"), F.lit("\n"), led)).alias("value")).write.option("lineSep", "\n").text(path)


def number_lines(lines: DataFrame, keep_blank: bool = False) -> DataFrame:
    """(file, line_no, line) of :func:`split_lines` rows, numbered from 0 in file order.

    A split's lines come in order within one task, so a line's number is its place there plus the lines
    of the file's earlier splits: one narrow row per split is counted, ordered and joined back (by broadcast
    if they are few enough), and no file is gathered anywhere. Blank lines count as lines and are left out unless asked for.
    """
    at = lines.withColumn("_at", F.monotonically_increasing_id())
    counts = at.groupBy("file", "block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(counts.select("file", "block", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift")))
    out = at.join(broadcast_small(offsets), ["file", "block"]).select("file", (F.col("_at") + F.col("_shift")).alias("line_no"), "line")
    return out if keep_blank else out.filter(F.length(F.trim("line")) > 0)
