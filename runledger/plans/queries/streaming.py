"""Structured Streaming queries (ST-01..07)."""

from __future__ import annotations

from pyspark.sql import functions as F

from runledger.plans.queries import quality as _quality, runs as _runs  # noqa: F401  (their oracles are reused)
from runledger.plans.queries.registry import ORACLE, register
from runledger.plans.queries.sources import _messages, _user_of_file, _write_run_logs
from runledger.plans.tables import table
from runledger.sources import logs as SL
from runledger.streaming import streams as SS
from runledger.streaming.versions import Versions


# Stream tests replay the events table as about 8 files in arbitrary order, one per trigger;
# the watermark is wide enough that no row is late (the data spans 30 days).
_STREAM_DELAY = "40 days"


def _event_stream(spark, sf):
    ev = table(spark, sf, "events")
    path = SL.scratch_path(spark, "event-stream")
    # files are cut by rows as they are written: no shuffle of the table
    ev.write.option("maxRecordsPerFile", max(1, -(-ev.count() // 8))).parquet(path)
    return spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(path)


@register("stream_run_log", ORACLE["run_log_permissive"])
def q_stream_run_log(spark, sf):
    """ST-01: the messages of run logs picked up as files land (availableNow), permissive."""
    out = SL.scratch_path(spark, "st01")
    SS.run_available_now(SS.stream_run_log(spark, _write_run_logs(spark, sf), packed=True), out, "append", "st01", SS.message_batch("permissive"))
    return _messages(spark.read.parquet(out), _user_of_file())


@register("stream_run_log_strict", ORACLE["run_log_strict"])
def q_stream_run_log_strict(spark, sf):
    """ST-01 (strict): files with a bad line yield nothing."""
    out = SL.scratch_path(spark, "st01s")
    SS.run_available_now(SS.stream_run_log(spark, _write_run_logs(spark, sf), packed=True), out, "append", "st01s", SS.message_batch("strict"))
    return _messages(spark.read.parquet(out), _user_of_file())


_ANSWER_PART = 400  # characters of an answer part here, so that answers have several


@register("assemble_answers", f"""WITH c AS (SELECT conv_id, turn, text,
    sum(coalesce(length(text), 0)) OVER (PARTITION BY conv_id ORDER BY turn) - coalesce(length(text), 0) AS before
  FROM conversations WHERE role = 'assistant')
SELECT conv_id, CAST(before // {_ANSWER_PART} AS BIGINT) AS part, string_agg(text, '' ORDER BY turn) AS answer, count(*) AS n_chunks
  FROM c GROUP BY 1, 2""")
def q_assemble_answers(spark, sf):
    """ST-02: streamed answer chunks (assistant turns) concatenated in order, in numbered parts."""
    cv = table(spark, sf, "conversations").filter(F.col("role") == "assistant")
    return SS.assemble_stream(cv, ["conv_id"], "turn", "text", _ANSWER_PART)


@register("stream_attempts", ORACLE["attempt_history"])
def q_stream_attempts(spark, sf):
    """ST-03: attempt state machine on the event stream (out-of-order files); equals W-05."""
    out = SL.scratch_path(spark, "st03")
    SS.run_available_now(SS.stream_attempts(_event_stream(spark, sf)), out, "append", "st03", SS.first_attempts())
    return SS.read_attempts(spark, out)


@register("stream_latest_state", ORACLE["latest_state"])
def q_stream_latest_state(spark, sf):
    """ST-04: latest state per user upserted batch by batch; equals W-07."""
    out = SL.scratch_path(spark, "st04")
    s = _event_stream(spark, sf).withColumnRenamed("event_type", "current_phase")
    SS.stream_latest(s, out, ["user_id"], ["ts", "event_id"], ["current_phase", "value"], "st04", fold_every=3)
    return SS.read_latest(spark, out, ["user_id"], ["ts", "event_id"], ["current_phase", "value"])


@register("stream_quota", ORACLE["daily_quota"])
def q_stream_quota(spark, sf):
    """ST-05: daily quota on the stream (window + watermark); equals W-08."""
    lim = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"),
                                              F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None).cast("int"))
                                              .otherwise(F.lit(3)).alias("lim"))
    out = SL.scratch_path(spark, "st05")
    SS.run_available_now(SS.stream_quota(_event_stream(spark, sf), lim, delay=_STREAM_DELAY), out, "update", "st05",
                         versions=Versions(spark, out, ["user_id", "run_date"]))
    return SS.read_versions(spark, out, ["user_id", "run_date"], ["n_requests", "n_allowed", "n_rejected"])


@register("stream_alarms", """SELECT user_id, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n_failed,
  'medium' AS severity FROM events WHERE event_type = 'error' GROUP BY 1, 2 HAVING count(*) >= 2""")
def q_stream_alarms(spark, sf):
    """ST-06: at least 2 failed attempts by one user within an hour raises an alarm."""
    out = SL.scratch_path(spark, "st06")
    SS.run_available_now(SS.stream_alarms(_event_stream(spark, sf), 2, "1 hour", delay=_STREAM_DELAY), out, "update", "st06")
    v = SS.read_versions(spark, out, ["user_id", "window_start"], ["n_failed", "severity"])
    return v.select("user_id", "window_start", "n_failed", "severity")


@register("stream_rate_alarms", """SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n,
  round(avg(CAST(event_type = 'error' AS DOUBLE)), 6) AS error_rate, quantile_disc(value * 10, 0.99) AS p99_ms,
  count(*) >= 20 AND avg(CAST(event_type = 'error' AS DOUBLE)) > 0.05 AS error_alarm,
  count(*) >= 20 AND quantile_disc(value * 10, 0.99) > 3000.0 AS latency_alarm FROM events GROUP BY 1""")
def q_stream_rate_alarms(spark, sf):
    """ST-07: daily error share and p99 latency alarms (window widened for sparse data)."""
    out = SL.scratch_path(spark, "st07")
    sink = Versions(spark, out, SS.WINDOW_KEYS, fold_every=3)
    SS.run_available_now(SS.stream_rate_alarms(_event_stream(spark, sf), "1 day", _STREAM_DELAY), out, "update", "st07", versions=sink)
    return SS.read_rate_alarms(spark, out, 20)


@register("stream_service_alarms", """WITH a AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n,
  avg(CAST(event_type = 'error' AND value > 100 AS DOUBLE)) AS se, avg(CAST(value > 200 AS DOUBLE)) AS th,
  avg(CAST(event_type = 'error' AND value < 5 AS DOUBLE)) AS ie, max(value / 300) AS cap, quantile_disc(value * 4, 0.99) AS p99_ms
  FROM events GROUP BY 1)
SELECT window_start, n, round(cap, 6) AS capacity_used, p99_ms, se > 0.01 AS server_error_alarm, th > 0.02 AS throttle_alarm,
  ie > 0.01 AS invocation_error_alarm, cap > 0.80 AS capacity_alarm, p99_ms > 500.0 AS fast_latency_alarm FROM a""")
def q_stream_service_alarms(spark, sf):
    """ST-07: daily 5xx, throttle and invocation-error shares, used capacity and the fast p99 limit
    (event values stand in for status, load and latency)."""
    out = SL.scratch_path(spark, "st07s")
    err, v = F.col("event_type") == "error", F.col("value")
    s = SS.stream_service_alarms(_event_stream(spark, sf), {"server_error": err & (v > 100), "throttle": v > 200, "invocation_error": err & (v < 5)},
                                 v, F.lit(300.0), v * 4, "1 day", _STREAM_DELAY)
    SS.run_available_now(s, out, "update", "st07s", versions=Versions(spark, out, SS.WINDOW_KEYS, fold_every=3))
    return SS.read_service_alarms(spark, out)
