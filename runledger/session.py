"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Defaults that matter at scale: AQE re-plans joins and coalesces partitions at
# runtime, skew-join splitting handles hot keys, UTC keeps date arithmetic stable.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # many small run-log files: pack them into fewer read tasks
    "spark.sql.files.openCostInBytes": str(1 << 20),
}


def get_spark(app: str = "runledger", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session with the library defaults (AQE, skew joins, UTC, UI off) plus ``extra``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage; we never invent a
    machine-local folder there. Only a local-mode session (tests, one machine)
    without the setting gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for iterative operators")
        path = tempfile.mkdtemp(prefix="runledger-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_table(df: DataFrame, path: str) -> None:
    """Write ``df`` as a new Parquet table; its shuffle files go as soon as it is written.

    Left to Spark's cleaner they lie on disk until the driver's next garbage collection after the listeners
    are through with the query, beside those of the next ones.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.mode("errorifexists").parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written once as a table under the shared checkpoint folder and read from there: a lost
    executor costs its tasks only, and later plans see the table's real size (a checkpoint carries its
    plan's estimate on, which iterative joins multiply beyond any use). The table goes when the
    application ends."""
    spark = df.sparkSession
    root = f"{checkpoint_dir(spark).rstrip('/')}/runledger-cuts-{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    table = f"{root}/{uuid.uuid4().hex}"
    write_table(df, table)
    return spark.read.schema(df.schema).parquet(table)


def cut_in_place(df: DataFrame) -> DataFrame:
    """Reliable checkpoint for frames whose partitions and row order later steps rely on; never a
    local checkpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


BROADCAST_ROWS = 200_000  # rows of a few narrow columns (some 30 MB) that may go to every executor


def broadcast_small(written: DataFrame) -> DataFrame:
    """Mark a narrow, already written frame for broadcast if its count allows; else joins shuffle."""
    return F.broadcast(written) if written.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else written


def path_exists(spark: SparkSession, path: str) -> bool:
    """Driver-side metadata check through the Hadoop FileSystem of ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def constant_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small constant table as a SQL ``VALUES`` relation (a LocalRelation with exact
    size statistics, so Catalyst broadcasts it by size on its own)."""
    fields = [f.strip().split(" ", 1) for f in schema.split(",")]
    names = [n for n, _ in fields]
    body = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    df = spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")
    return df.select(*[df[n].cast(t).alias(n) for n, t in fields])
