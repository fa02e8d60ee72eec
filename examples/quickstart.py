"""Using the operators directly on your own DataFrames (here: the small driver tables).

    python examples/quickstart.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from runledger.functions import text as T  # noqa: E402
from runledger.operators import graph as G  # noqa: E402
from runledger.operators import runs  # noqa: E402
from runledger.session import get_spark  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = get_spark("runledger-quickstart", master="local[4]", shuffle_partitions=8)

    # attempt history: one run per user and day, attempts ordered by time, an error fails
    events = spark.read.parquet(f"{sf}/events.parquet")
    attempts = runs.attempts(events.select("user_id", F.to_date("ts").alias("day"), "ts", "event_id",
                                           (F.col("event_type") == "error").alias("failed")),
                             ["user_id", "day"], ["ts", "event_id"], "failed", max_attempts=4)
    attempts.groupBy("stop_reason").count().orderBy("stop_reason").show()

    # JSON inside model output, then a display-sized summary of long documents
    out = events.select(F.concat(F.lit("Answer:\n```json\n"), F.col("props"), F.lit("\n```")).alias("text"))
    out.select(T.extract_json("text").alias("json")).show(3, truncate=False)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs.select("doc_id", T.truncate_text("text", 80).alias("preview")).show(3, truncate=False)

    # prerequisites of a dependency tree (parts: each part depends on key div 2)
    edges = spark.read.parquet(f"{sf}/part.parquet").filter("p_partkey > 0").select(
        F.col("p_partkey").alias("node"), F.expr("p_partkey div 2").alias("depends_on"))
    G.closure(edges).groupBy("node").count().orderBy(F.desc("count"), "node").show(3)


if __name__ == "__main__":
    main()
