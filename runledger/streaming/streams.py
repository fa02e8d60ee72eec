"""Structured Streaming forms of the run operators (ST-01..07).

Sinks are idempotent: every micro-batch is written with ``foreachBatch`` to
``<table>/batch_id=<id>`` in overwrite mode, so a replayed batch (after an executor or
driver restart) replaces itself instead of duplicating rows. Sinks whose rows replace each
other by key are folded into base versions (``versions.py``); readers take the last version
per key. Checkpoints live under the shared checkpoint folder.
"""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from runledger.operators.runs import MAX_ATTEMPTS, attach, attempts, latest, percentile_of_counts, running_total
from runledger.sources.lines import number_lines, stream_lines
from runledger.sources.logs import parse_messages
from runledger.streaming.versions import Versions


def _epoch():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def as_instant(ntz_col) -> "F.Column":
    """Wall-clock timestamp (NTZ) -> instant with the same digits in UTC; watermarks and
    windows need an instant, and this keeps day windows on wall-clock days whatever the
    session time zone."""
    c = F.col(ntz_col) if isinstance(ntz_col, str) else ntz_col
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), c))


def as_wallclock(instant_col) -> "F.Column":
    """Inverse of :func:`as_instant`."""
    c = F.col(instant_col) if isinstance(instant_col, str) else instant_col
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), _epoch())


class DroppedRows(StreamingQueryListener):
    """Rows dropped by the watermark, summed over every micro-batch of each query run."""

    def __init__(self):
        self.by_run: Counter = Counter()
        self.ended: set[str] = set()
        self.moved = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self.moved:
            self.by_run[str(event.progress.runId)] += sum(s.numRowsDroppedByWatermark or 0 for s in event.progress.stateOperators or [])

    def onQueryTerminated(self, event) -> None:
        with self.moved:
            self.ended.add(str(event.runId))
            self.moved.notify_all()

    def total(self, run_id: str, wait_s: float = 60.0) -> int:
        """The total of an ended run; its last event comes after all its progress events."""
        with self.moved:
            if not self.moved.wait_for(lambda: run_id in self.ended, wait_s):
                raise TimeoutError(f"no end of stream run {run_id} was reported")
            return self.by_run[run_id]


def run_available_now(stream_df: DataFrame, out_path: str, mode: str = "update", name: str = "q",
                      batch_fn=None, versions: Versions | None = None) -> dict:
    """Run a stream to the end of its current input (``availableNow``) with an
    idempotent per-batch sink; returns progress metrics and the sink's row schema.

    The stream's checkpoint lies beside the sink, so a second call with the same sink
    resumes after the batches already written instead of numbering them anew. With
    ``versions`` the batches are written through it and folded into base versions.
    """
    spark = stream_df.sparkSession
    seen = {}

    def sink(batch: DataFrame, batch_id: int) -> None:
        b = batch_fn(batch) if batch_fn else batch
        seen["schema"] = b.schema
        if versions is not None:
            versions.write(b, batch_id)
        else:
            b.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    dropped = DroppedRows()
    spark.streams.addListener(dropped)
    try:
        q = (stream_df.writeStream.outputMode(mode).foreachBatch(sink)
                      .option("checkpointLocation", f"{out_path.rstrip('/')}-checkpoint")
                      .trigger(availableNow=True).start())
        q.awaitTermination()
        total = dropped.total(str(q.runId))
    finally:
        spark.streams.removeListener(dropped)
    return {"rows_dropped_by_watermark": total, "schema": seen.get("schema")}


def read_versions(spark: SparkSession, path: str, keys: Sequence[str], value_cols: Sequence[str],
                  schema=None) -> DataFrame:
    """Latest version per key over the folded base and the batches after it (later batch wins).
    When no batch was written, an empty frame of ``schema`` (keys and values) is returned."""
    v = Versions(spark, path, keys)
    if schema is not None and not v.bases() and not v.batches():
        return spark.createDataFrame([], schema).select(*keys, *value_cols)
    return v.read().select(*keys, *value_cols)


def stream_run_log(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """ST-01: the lines of run logs as files (or packs of logs) land, each with its file and split; files
    are split among tasks. :func:`message_batch` makes messages of a micro-batch."""
    return stream_lines(spark, path, packed)


def message_batch(mode: str = "strict"):
    """ST-01: per micro-batch the messages of its files (:func:`parse_messages`). A file lands and is
    read whole within one batch, so its lines are numbered and one bad line voids it there."""
    def fn(batch: DataFrame) -> DataFrame:
        return parse_messages(number_lines(batch), mode)
    return fn


def assemble_stream(chunks: DataFrame, key_cols: Sequence[str], seq_col: str, text_col: str,
                    part_chars: int = 1 << 20) -> DataFrame:
    """ST-02: a streamed answer concatenated in sequence order, per key, in numbered parts.

    A chunk belongs to the part in which it begins, counting ``part_chars`` characters a part, so a part
    holds at most that many and one chunk more; the parts of a key in order are its answer. Characters
    before a chunk come from prefix sums over range partitions, so no answer is gathered into one value.
    """
    keys = list(key_cols)
    at = running_total(chunks, keys, [seq_col], F.coalesce(F.length(text_col), F.lit(0)), "_before")
    part = F.floor(F.col("_before") / part_chars).alias("part")
    arr = F.array_sort(F.collect_list(F.struct(F.col(seq_col).alias("s"), F.col(text_col).alias("t"))))
    return at.groupBy(*keys, part).agg(F.array_join(F.transform(arr, lambda x: x["t"]), "").alias("answer"),
                                       F.count(F.lit(1)).alias("n_chunks"))


def stream_attempts(events: DataFrame) -> DataFrame:
    """ST-03: the rows of the W-05 attempt rules on a stream of events."""
    return events.select("user_id", F.to_date("ts").alias("run_date"), "ts", "event_id",
                         (F.col("event_type") == "error").alias("failed"))


def first_attempts(max_attempts: int = MAX_ATTEMPTS["unit"]):
    """ST-03: per micro-batch the first ``max_attempts`` rows of every (user, day), the only
    ones of the batch that can count. The first k of all rows are the first k of these,
    whatever the arrival order, so no state is kept between batches."""
    def fn(batch: DataFrame) -> DataFrame:
        w = Window.partitionBy("user_id", "run_date").orderBy("ts", "event_id")
        return batch.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= max_attempts).drop("_r")
    return fn


def read_attempts(spark: SparkSession, out_path: str, max_attempts: int = MAX_ATTEMPTS["unit"]) -> DataFrame:
    """ST-03: attempts, outcome and stop reason per (user, day) over every written version."""
    rows = spark.read.parquet(out_path).drop("batch_id")
    return attempts(rows, ["user_id", "run_date"], ["ts", "event_id"], "failed", max_attempts)


def latest_batch(keys: Sequence[str], order_cols: Sequence[str], value_cols: Sequence[str]):
    """ST-04: per micro-batch reduction to the latest row per key; written as one
    version per batch, read back as last-writer-wins by (order_cols), so the result
    equals W-07 whatever the arrival order."""
    def fn(batch: DataFrame) -> DataFrame:
        return latest(batch, list(keys), list(order_cols), list(value_cols))
    return fn


def stream_quota(events: DataFrame, limits: DataFrame, user_col: str = "user_id", delay: str = "1 day") -> DataFrame:
    """ST-05: requests per user and day on a stream, allowed up to the user's limit
    (null = unlimited). Rows later than the watermark are dropped; the query progress
    counts them as Spark sees them at the stateful operator, i.e. after map-side partial
    aggregation (one per late user/day group and batch), returned by
    ``run_available_now`` as ``rows_dropped_by_watermark``."""
    ev = events.withColumn("event_time", as_instant("ts")).withWatermark("event_time", delay)
    agg = ev.groupBy(user_col, F.window("event_time", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n_requests"))
    agg = agg.join(limits.groupBy(user_col).agg(F.max("lim").alias("lim")), user_col, "left")  # counts, not events
    allowed = F.when(F.col("lim").isNull(), F.col("n_requests")).otherwise(F.least("n_requests", "lim"))
    return agg.select(user_col, F.to_date(as_wallclock(F.col("w.start"))).alias("run_date"), "n_requests",
                      allowed.cast("bigint").alias("n_allowed"), (F.col("n_requests") - allowed).cast("bigint").alias("n_rejected"))


def stream_alarms(events: DataFrame, n: int, width: str = "1 hour", user_col: str = "user_id",
                  delay: str | None = None) -> DataFrame:
    """ST-06: failed attempts per user in a tumbling window; at least ``n`` raises a
    medium alarm (window width and n are parameters)."""
    err = (events.filter(F.col("event_type") == "error").withColumn("event_time", as_instant("ts"))
                 .withWatermark("event_time", delay or width))
    agg = err.groupBy(user_col, F.window("event_time", width).alias("w")).agg(F.count(F.lit(1)).alias("n_failed"))
    return agg.filter(F.col("n_failed") >= n).select(user_col, as_wallclock(F.col("w.start")).alias("window_start"), "n_failed",
                                                     F.lit("medium").alias("severity"))


# Rate alarm thresholds (share of rows), used capacity and p99 latency limits.
ERROR_RATE_LIMIT = 0.05
SHARE_LIMITS = {"server_error": 0.01, "throttle": 0.02, "invocation_error": 0.01}
CAPACITY_LIMIT = 0.80
P99_LIMIT_MS = {"api": 3000.0, "fast": 500.0}


def value_counts(events: DataFrame, value: Column, flags: Mapping[str, Column], width: str, delay: str | None = None,
                 maxima: Mapping[str, Column] | None = None) -> DataFrame:
    """ST-07: per window and value the number of rows, of rows with each flag, and the greatest of
    each ``maxima``. Every state row and every emitted row has a fixed size, however many rows or
    distinct values a window holds; :func:`read_windows` ranks the values when the sink is read."""
    ev = events.withColumn("event_time", as_instant("ts")).withWatermark("event_time", delay or width)
    agg = ev.groupBy(F.window("event_time", width).alias("w"), value.alias("measured")).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(k) for k, c in flags.items()],
        *[F.max(c).alias(k) for k, c in (maxima or {}).items()])
    return agg.select(as_wallclock(F.col("w.start")).alias("window_start"), "measured", "n", *flags, *(maxima or {}))


WINDOW_KEYS = ("window_start", "measured")


def read_windows(spark: SparkSession, out_path: str, flags: Sequence[str], maxima: Sequence[str] = (), q: float = 0.99,
                 out_col: str = "p99_ms") -> DataFrame:
    """ST-07: per window the rows, the share of each flag, the greatest of each ``maxima`` and the exact
    percentile of the measured values (null where all are null), from the counts of a
    :func:`value_counts` sink."""
    counts = read_versions(spark, out_path, WINDOW_KEYS, ["n", *flags, *maxima])
    agg = counts.groupBy("window_start").agg(F.sum("n").alias("n"), *[(F.sum(k) / F.sum("n")).alias(k) for k in flags],
                                             *[F.max(k).alias(k) for k in maxima])
    return attach(agg, percentile_of_counts(counts, ["window_start"], "measured", "n", q, out_col), ["window_start"])


def stream_rate_alarms(events: DataFrame, width: str = "1 day", delay: str | None = None) -> DataFrame:
    """ST-07: the counted latencies and errors of every window; read with :func:`read_rate_alarms`."""
    return value_counts(events, F.col("value") * 10, {"error_rate": F.col("event_type") == "error"}, width, delay)


def read_rate_alarms(spark: SparkSession, out_path: str, min_count: int = 20) -> DataFrame:
    """ST-07: per window, error share > 5% and exact p99 latency against its limit, only for
    windows with at least ``min_count`` rows (tiny windows alarm on one error)."""
    agg = read_windows(spark, out_path, ["error_rate"])
    enough = F.col("n") >= min_count
    return agg.select("window_start", "n", F.round("error_rate", 6).alias("error_rate"), "p99_ms",
                      (enough & (F.col("error_rate") > ERROR_RATE_LIMIT)).alias("error_alarm"),
                      (enough & (F.col("p99_ms") > P99_LIMIT_MS["api"])).alias("latency_alarm"))


def stream_service_alarms(events: DataFrame, flags: Mapping[str, Column], used: Column, capacity: Column,
                          latency_ms: Column, width: str = "5 minutes", delay: str | None = None) -> DataFrame:
    """ST-07: the counted latencies, the flagged conditions of ``SHARE_LIMITS`` and the used capacity of
    every window; read with :func:`read_service_alarms`."""
    return value_counts(events, latency_ms, {k: flags[k] for k in SHARE_LIMITS}, width, delay, {"capacity_used": used / capacity})


def read_service_alarms(spark: SparkSession, out_path: str) -> DataFrame:
    """ST-07: per window the share of every flagged condition of ``SHARE_LIMITS`` against its
    limit, the greatest used share of capacity against 80%, and p99 against the fast limit."""
    agg = read_windows(spark, out_path, list(SHARE_LIMITS), ["capacity_used"])
    return agg.select(
        "window_start", "n", F.round("capacity_used", 6).alias("capacity_used"), "p99_ms",
        *[(F.col(k) > limit).alias(f"{k}_alarm") for k, limit in SHARE_LIMITS.items()],
        (F.col("capacity_used") > CAPACITY_LIMIT).alias("capacity_alarm"),
        (F.col("p99_ms") > P99_LIMIT_MS["fast"]).alias("fast_latency_alarm"))


def stream_latest(stream_df: DataFrame, out_path: str, keys: Sequence[str], order_cols: Sequence[str],
                  value_cols: Sequence[str], name: str = "latest", fold_every: int = 16) -> dict:
    """ST-04: latest state per key from a stream: each micro-batch's latest rows are written as
    one version (idempotent) and folded into a base version after every ``fold_every`` batches, so
    :func:`read_latest` equals W-07 whatever the arrival order and its cost follows the keys. Runs
    to the end of the current input; returns the run metrics."""
    return run_available_now(stream_df, out_path, "append", name, latest_batch(keys, order_cols, value_cols),
                             Versions(stream_df.sparkSession, out_path, keys, order_cols, fold_every))


def read_latest(spark: SparkSession, out_path: str, keys: Sequence[str], order_cols: Sequence[str],
                value_cols: Sequence[str]) -> DataFrame:
    """ST-04: the upserted table: last writer wins per key over the base and the versions after it."""
    return Versions(spark, out_path, keys, order_cols).read().select(*keys, *order_cols, *value_cols)
