"""Run-log and execution-log sources and sinks (SRC-01, SRC-02, SRC-03, SRC-13, SRC-16).

Log files are read split. Line order, which "last result line" depends on, comes from the place of each
line's split in its file (``lines.py``); "one bad line voids the file" is an aggregated flag per file. Text
exports are written as numbered fragments (``exports.py``), documents as containers (``containers.py``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.session import checkpoint_dir, path_exists
from runledger.sources.containers import read_container, write_container
from runledger.sources.exports import read_fragments, write_fragments
from runledger.sources.lines import number_lines, split_lines, write_packs

# Message fields of a run-log line (assistant text and the result line).
MESSAGE_SCHEMA = ("type string, subtype string, is_error boolean, duration_ms bigint, duration_api_ms bigint, "
                  "num_turns int, result string, session_id string, total_cost_usd double, "
                  "message struct<content: array<struct<text: string>>>, _corrupt_record string")
EXEC_LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) - ([A-Z]+) - (.*)$"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp dir)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/runledger-io/{name}-{uuid.uuid4().hex}"


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, value) with one row per file under ``path`` (recursive); a missing path is
    an empty input, as a missing document or state file is nothing to read."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "file string, value string")
    return (spark.read.text(path, wholetext=True, recursiveFileLookup=True)
                 .select(F.col("_metadata.file_path").alias("file"), "value"))


def file_lines(spark: SparkSession, path: str, keep_blank: bool = False, packed: bool = False) -> DataFrame:
    """(file, line_no, line) for every text file under ``path`` (recursive), files split among tasks."""
    return number_lines(split_lines(spark, path, packed), keep_blank)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) for every non-blank line under ``path`` (recursive), where lines stand on
    their own: files are split among tasks, so no file has to fit one row."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "file string, line string")
    return (spark.read.text(path, recursiveFileLookup=True)
                 .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
                 .filter(F.length(F.trim("line")) > 0))


def parse_messages(lines: DataFrame, mode: str = "strict") -> DataFrame:
    """SRC-01: messages of numbered run-log lines (file, line_no, line).

    ``strict`` (the source's rule): one unparseable line voids the whole file; ``permissive`` keeps good
    lines and flags the bad ones. The flag is aggregated per file (one row per file and map task), and
    the lines of voided files leave by an anti join, so no file is gathered.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError(mode)
    m = F.from_json("line", MESSAGE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    rows = lines.select("file", "line_no", m.alias("m"))
    rows = rows.select("file", "line_no", (F.col("m").isNull() | F.col("m._corrupt_record").isNotNull()).alias("corrupt"), "m.*").drop("_corrupt_record")
    if mode == "strict":
        rows = rows.join(rows.filter("corrupt").select("file").distinct(), "file", "left_anti")
    return rows


def read_run_log(spark: SparkSession, path: str, mode: str = "strict", packed: bool = False) -> DataFrame:
    """SRC-01: one row per message of every JSONL run log under ``path``, blank lines skipped
    (:func:`parse_messages`); with ``packed`` of the logs in packs (:func:`pack_run_logs`)."""
    return parse_messages(file_lines(spark, path, packed=packed), mode)


def pack_run_logs(df: DataFrame, name_col: str, order_cols: Sequence[str], line_col: str, path: str) -> None:
    """SRC-01: run logs by name, in packs of many logs (:func:`write_packs`): a file per run costs a
    listing and a rename on the driver, which millions of runs do not finish."""
    write_packs(df, F.col(name_col), order_cols, F.col(line_col), path)


def write_run_logs(df: DataFrame, run_col: str, order_cols: Sequence[str], line_col: str, path: str) -> None:
    """SRC-01: run logs as an export: few fragment files and a manifest instead of one file per run."""
    write_fragments(df, [run_col], order_cols, F.col(line_col), path)


def read_run_log_export(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """SRC-01: messages of a :func:`write_run_logs` export; the run stands in place of the file, so one
    bad line voids its run."""
    lines = read_fragments(spark, path)
    run = lines.columns[0]
    lines = lines.select(F.col(run).alias("file"), "line_no", "line").filter(F.length(F.trim("line")) > 0)
    return parse_messages(lines, mode).withColumnRenamed("file", run)


def result_messages(messages: DataFrame) -> DataFrame:
    """SRC-01: the result message of each file (the last ``type = result`` line)."""
    r = messages.filter(F.col("type") == "result")
    cols = [c for c in r.columns if c not in ("file", "line_no")]
    best = F.max(F.struct("line_no", *cols)).alias("_b")
    return r.groupBy("file").agg(best).select("file", *[F.col("_b." + c).alias(c) for c in ["line_no", *cols]])


def write_json_array(df: DataFrame, group_cols: Sequence[str], order_col: str, msg_col: str, path: str) -> None:
    """SRC-02: every group's messages (JSON texts) as one JSON array, in fragments: a group of any size
    is never gathered into one value."""
    write_fragments(df, group_cols, [order_col], F.col(msg_col), path, as_array=True)


def read_exec_log(spark: SparkSession, path: str) -> DataFrame:
    """SRC-03: ``timestamp - LEVEL - message`` lines; other lines keep nulls. Lines stand on
    their own, so large log files are split among tasks."""
    lines = text_lines(spark, path)
    ts = F.regexp_extract("line", EXEC_LINE, 1)
    return lines.select("file", F.when(ts != "", F.to_timestamp_ntz(ts, F.lit("yyyy-MM-dd HH:mm:ss"))).alias("ts"),
                        F.when(ts != "", F.regexp_extract("line", EXEC_LINE, 2)).alias("level"),
                        F.when(ts != "", F.regexp_extract("line", EXEC_LINE, 3)).otherwise(F.col("line")).alias("message"))


PROMPT_NAME = "/"  # separates run, agent and command in a prompt's name


def write_prompts(df: DataFrame, run_col: str, agent_col: str, text_col: str, order_col: str, path: str) -> DataFrame:
    """SRC-13: keep texts that start with ``/word``; one prompt per (run, agent, command), the last one
    wins; stored in a container under the name ``run/agent/command``. Returns what was written."""
    cmd = F.regexp_extract(F.col(text_col), r"^/(\w+)", 1)
    p = df.select(run_col, agent_col, order_col, text_col, cmd.alias("command")).filter(F.col("command") != "")
    keys = [run_col, agent_col, "command"]
    last = p.groupBy(*keys).agg(F.max(F.struct(order_col, text_col)).alias("_b")) \
            .select(*keys, F.col("_b." + text_col).alias("prompt"))
    write_container(last.withColumn("_name", F.concat_ws(PROMPT_NAME, *keys)), path, "_name", "prompt")
    return last


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """SRC-13: (run, agent, command, prompt) of a prompt container."""
    name = F.split("name", PROMPT_NAME)
    return read_container(spark, path).select(name[0].alias("run"), name[1].alias("agent"), name[2].alias("command"), F.col("text").alias("prompt"))


def read_docs(spark: SparkSession, path: str, wanted: DataFrame | None = None, name_col: str = "name") -> DataFrame:
    """SRC-16: whole documents (one row per file); with ``wanted`` names, a missing
    document gives the empty string."""
    d = whole_files(spark, path).withColumnRenamed("value", "text")
    if wanted is None:
        return d
    d = d.withColumn(name_col, F.regexp_extract("file", r"([^/]+)$", 1))
    return wanted.join(d, name_col, "left").withColumn("text", F.coalesce("text", F.lit("")))


def compact_run_logs(spark: SparkSession, path: str, out: str, mode: str = "permissive", packed: bool = False) -> None:
    """Compact run-log files into Parquet ranged by (file, line_no).

    The ranges follow the data: many small files share one, a large file spans several, and a reader
    of one file skips the row groups of others by their bounds. Writes are overwrite, so a retried job
    replaces its own output.
    """
    msgs = read_run_log(spark, path, mode, packed)
    msgs.repartitionByRange("file", "line_no").sortWithinPartitions("file", "line_no").write.mode("overwrite").parquet(out)
