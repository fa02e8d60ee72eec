"""Containers of documents (SRC-13, SRC-16): many documents per file, found by an index.

Documents lie in hash buckets of their names, sorted by name; the number of buckets follows the bytes, not
the documents. ``<path>-index`` holds (name, file, row) of every document, so a lookup opens only the
files that hold a wanted name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.session import path_exists

BUCKET_BYTES = 128 << 20  # text bytes of a bucket, about
MOST_FILES = 1000         # files that a lookup names one by one; beyond, the container is scanned


def write_container(df: DataFrame, path: str, name_col: str = "name", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write (name, text) rows as a container; a repeated name keeps all its rows, a null text stays null."""
    rows = df.select(F.col(name_col).cast("string").alias("name"), F.col(text_col).cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    bucket = F.pmod(F.xxhash64("name"), F.lit(buckets)).cast("int")
    (rows.withColumn("bucket", bucket).repartition(buckets, "bucket").sortWithinPartitions("bucket", "name")
         .write.mode("overwrite").partitionBy("bucket").parquet(path))
    _container(df.sparkSession, path).select("name", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")) \
        .write.mode("overwrite").parquet(f"{path.rstrip('/')}-index")


def _container(spark: SparkSession, path: str, files=()) -> DataFrame:
    return spark.read.schema("name string, text string, bucket int").option("basePath", path).parquet(*(files or [path]))


def locate(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(name, file, row) of the wanted names that the container holds, from its index alone."""
    return spark.read.parquet(f"{path.rstrip('/')}-index").join(wanted.select("name").distinct(), "name", "left_semi")


def read_container(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """(name, text) of a container; with ``wanted`` rows (column ``name``), those rows with their text,
    the empty string where there is no such document. A missing container holds no documents."""
    if not path_exists(spark, path):
        docs = spark.createDataFrame([], "name string, text string")
    elif wanted is None:
        return _container(spark, path).select("name", "text")
    else:
        files = [r[0] for r in locate(spark, path, wanted).select("file").distinct().limit(MOST_FILES + 1).collect()]
        docs = _container(spark, path, files if len(files) <= MOST_FILES else ()).select("name", "text")
        if not files:
            docs = docs.limit(0)
    if wanted is None:
        return docs
    return wanted.join(docs, "name", "left").withColumn("text", F.coalesce("text", F.lit("")))
