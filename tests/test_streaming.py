"""Stream = batch, with the production watermark; stopped streams resume."""

import time

from pyspark.sql import functions as F

from runledger.operators import runs
from runledger.plans.tables import table
from runledger.sources import logs as SL
from runledger.streaming import streams as SS
from runledger.streaming.versions import Versions

from .conftest import SF_SMALL


def _in_order_stream(spark, max_days=12):
    ev = table(spark, SF_SMALL, "events")
    path = SL.scratch_path(spark, "ordered-stream")
    days = sorted(r[0] for r in ev.select(F.to_date("ts").alias("d")).distinct().collect())[:max_days]
    for d in days:  # one file per day, written in day order (file order = arrival order)
        ev.filter(F.to_date("ts") == F.lit(d)).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.01)
    return ev.filter(F.to_date("ts") <= F.lit(days[-1])), spark.readStream.schema(ev.schema) \
        .option("maxFilesPerTrigger", 1).parquet(path)


def test_attempts_stream_equals_batch(spark):
    batch_src, stream = _in_order_stream(spark)
    out = SL.scratch_path(spark, "st03-order")
    SS.run_available_now(SS.stream_attempts(stream), out, "append", "st03e", SS.first_attempts())
    got = {tuple(r) for r in SS.read_attempts(spark, out).collect()}
    ev = batch_src.select("user_id", F.to_date("ts").alias("run_date"), "ts", "event_id",
                          (F.col("event_type") == "error").alias("failed"))
    want = {tuple(r) for r in runs.attempts(ev, ["user_id", "run_date"], ["ts", "event_id"], "failed").collect()}
    assert got == want


def test_stopped_stream_resumes_where_it_was(spark):
    """New files after a stop are one more version; what is written already stays."""
    ev = table(spark, SF_SMALL, "events")
    path, out = SL.scratch_path(spark, "resume-in"), SL.scratch_path(spark, "resume-out")
    for part in (0, 1, 2):
        ev.filter(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(ev.schema).parquet(path)
        SS.run_available_now(SS.stream_attempts(stream), out, "append", "resume", SS.first_attempts())
    assert {r.batch_id for r in spark.read.parquet(out).select("batch_id").distinct().collect()} == {0, 1, 2}
    rows = ev.select("user_id", F.to_date("ts").alias("run_date"), "ts", "event_id", (F.col("event_type") == "error").alias("failed"))
    want = {tuple(r) for r in runs.attempts(rows, ["user_id", "run_date"], ["ts", "event_id"], "failed").collect()}
    assert {tuple(r) for r in SS.read_attempts(spark, out).collect()} == want


def test_quota_stream_in_order_equals_batch(spark):
    batch_src, stream = _in_order_stream(spark)
    lim = table(spark, SF_SMALL, "customer").select(F.col("c_custkey").alias("user_id"), F.lit(3).alias("lim"))
    out = SL.scratch_path(spark, "st05-order")
    metrics = SS.run_available_now(SS.stream_quota(stream, lim, delay="1 day"), out, "update", "st05o")
    got = {tuple(r) for r in SS.read_versions(spark, out, ["user_id", "run_date"],
                                               ["n_requests", "n_allowed", "n_rejected"]).collect()}
    from runledger.operators import quality as Q
    ev = batch_src.select("user_id", F.to_date("ts").alias("run_date")).join(lim, "user_id", "left")
    want = {tuple(r) for r in Q.quota(ev, ["user_id", "run_date"], "lim").select(
        "user_id", "run_date", "n_requests", F.col("n_allowed").cast("bigint"), F.col("n_rejected").cast("bigint")).collect()}
    assert got == want and metrics["rows_dropped_by_watermark"] == 0


def test_quota_late_rows_are_dropped_and_counted(spark):
    ev = table(spark, SF_SMALL, "events")
    path = SL.scratch_path(spark, "late-stream")
    days = sorted(r[0] for r in ev.select(F.to_date("ts").alias("d")).distinct().collect())
    early, late_day = days[:10], days[0]
    for d in early:
        ev.filter(F.to_date("ts") == F.lit(d)).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.01)
    # the first day again, arriving after the watermark (1 day) has passed it
    ev.filter(F.to_date("ts") == F.lit(late_day)).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(path)
    lim = table(spark, SF_SMALL, "customer").select(F.col("c_custkey").alias("user_id"), F.lit(3).alias("lim"))
    out = SL.scratch_path(spark, "st05-late")
    metrics = SS.run_available_now(SS.stream_quota(stream, lim, delay="1 day"), out, "update", "st05l")
    late = ev.filter(F.to_date("ts") == F.lit(late_day))
    # Spark counts what reaches the stateful operator: partial (user, day) groups, not events
    assert 0 < metrics["rows_dropped_by_watermark"] <= late.count()
    assert metrics["rows_dropped_by_watermark"] == late.select("user_id").distinct().count()
    got = SS.read_versions(spark, out, ["user_id", "run_date"], ["n_requests"])
    want = ev.filter(F.to_date("ts") == F.lit(late_day)).groupBy("user_id").count()
    # the late copy did not double the first day's counts
    joined = got.filter(F.col("run_date") == F.lit(late_day)).join(want, "user_id")
    assert joined.filter(F.col("n_requests") != F.col("count")).count() == 0


def test_alarms_stream_in_order_equals_batch(spark):
    batch_src, stream = _in_order_stream(spark)
    out = SL.scratch_path(spark, "st06-order")
    SS.run_available_now(SS.stream_alarms(stream, 2, "1 hour"), out, "update", "st06o")
    got = {tuple(r) for r in SS.read_versions(spark, out, ["user_id", "window_start"], ["n_failed"]).collect()}
    b = (batch_src.filter(F.col("event_type") == "error")
                  .groupBy("user_id", F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n_failed"))
                  .filter(F.col("n_failed") >= 2).select("user_id", F.col("w.start").cast("timestamp_ntz"), "n_failed"))
    assert got == {tuple(r) for r in b.collect()}


def test_rate_alarms_stream_in_order_equals_batch(spark):
    batch_src, stream = _in_order_stream(spark)
    out = SL.scratch_path(spark, "st07-order")
    SS.run_available_now(SS.stream_rate_alarms(stream, "1 day"), out, "update", "st07o")
    got = {tuple(r) for r in SS.read_rate_alarms(spark, out, 20).collect()}
    b = (batch_src.groupBy(F.window("ts", "1 day").alias("w"))
                  .agg(F.count(F.lit(1)).alias("n"),
                       F.round(F.avg((F.col("event_type") == "error").cast("double")), 6).alias("error_rate"),
                       F.expr("percentile_disc(0.99) WITHIN GROUP (ORDER BY value * 10)").alias("p99_ms")))
    want = {(r.w.start, r.n, r.error_rate, r.p99_ms, r.n >= 20 and r.error_rate > 0.05, r.n >= 20 and r.p99_ms > 3000.0)
            for r in b.collect()}
    assert got == want


def test_p99_of_a_window_with_a_million_latencies(spark):
    """Counted values in fixed-size state rows give the exact order statistic."""
    n = 1_000_000
    ev = spark.range(n).select(F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("ts"), (F.col("id") % 50 == 0).alias("bad"),
                               F.when(F.col("id") % 1000 != 7, F.xxhash64("id") / 1e6).alias("ms"))
    path, out = SL.scratch_path(spark, "many-in"), SL.scratch_path(spark, "many-out")
    ev.repartition(3).write.parquet(path)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(path)
    counts = SS.value_counts(stream, F.col("ms"), {"bad": F.col("bad")}, "5 minutes")
    SS.run_available_now(counts, out, "update", "many", versions=Versions(spark, out, SS.WINDOW_KEYS, fold_every=2))
    got = SS.read_windows(spark, out, ["bad"]).collect()
    want = ev.agg(F.expr("percentile_disc(0.99) WITHIN GROUP (ORDER BY ms)")).first()[0]
    assert [(r.n, r.bad, r.p99_ms) for r in got] == [(n, 0.02, want)]


def test_folded_versions_equal_all_versions(spark):
    """The newest version of a key wins across folds; replaced folders go, an unfinished fold counts for nothing."""
    out = SL.scratch_path(spark, "fold")
    v = Versions(spark, out, ["k"], fold_every=3)
    want = {}
    for b in range(10):
        rows = [(k, f"{b}-{k}") for k in range(b % 4, 8)]
        want.update(rows)
        v.write(spark.createDataFrame(rows, "k long, v string"), b)
        assert {r.k: r.v for r in v.read().collect()} == want
    assert v.bases() == [5, 8] and v.batches() == [9]
    v.write(spark.createDataFrame([(0, "7-again")], "k long, v string"), 7)  # a replay below the base changes nothing
    spark.createDataFrame([(0, "half", 99)], "k long, v string, batch_id long").write.parquet(out + "-base/upto=99")
    p, fs = v._fs(out + "-base/upto=99/_SUCCESS")
    fs.delete(p, True)
    assert {r.k: r.v for r in v.read().collect()} == want


def test_ordered_versions_keep_the_greatest_row(spark):
    out = SL.scratch_path(spark, "fold-order")
    v = Versions(spark, out, ["k"], ["ts"], fold_every=2)
    for b, ts in enumerate([5, 9, 3, 8, 1]):
        v.write(spark.createDataFrame([(1, ts, f"at {ts}")], "k long, ts long, v string"), b)
    assert [tuple(r) for r in v.read().collect()] == [(1, 9, "at 9")]


def test_dropped_rows_are_summed_over_more_batches_than_progress_keeps(spark):
    """150 batches after the watermark has passed: every late row is counted, not those of the last 100 only."""
    path, out = SL.scratch_path(spark, "late-in"), SL.scratch_path(spark, "late-out")
    schema = "user_id long, ts timestamp_ntz"
    row = lambda u, day: spark.createDataFrame([(u, f"2024-01-{day:02d} 12:00:00")], "user_id long, ts string").select(
        "user_id", F.col("ts").cast("timestamp_ntz"))
    row(0, 20).coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.05)
    row(0, 20).coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.05)
    late = spark.range(150).select("id", F.lit("2024-01-01 12:00:00").cast("timestamp_ntz").alias("ts")).toDF("user_id", "ts")
    late.repartition(150).write.option("maxRecordsPerFile", 1).mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    lim = spark.createDataFrame([(0, 3)], "user_id long, lim int")
    metrics = SS.run_available_now(SS.stream_quota(stream, lim, delay="1 day"), out, "update", "late")
    assert metrics["rows_dropped_by_watermark"] == 150
