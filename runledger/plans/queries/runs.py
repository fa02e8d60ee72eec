"""Run queries: attempts, latest state, counts, KPIs, slots (W-*, A-01..07, A-19, FN-13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from runledger.functions import text as T
from runledger.operators import runs
from runledger.plans import bindings as B
from runledger.plans import oracle as O
from runledger.plans.queries.registry import register
from runledger.plans.tables import table


@register("attempt_history", f"""
WITH a AS ({O.ATTEMPT_EVENTS}),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, run_date ORDER BY ts, event_id) AS attempt FROM a),
s AS (SELECT *, CASE WHEN NOT failed THEN 'passed' WHEN attempt = 4 THEN 'max_attempts' END AS stop_reason
      FROM n WHERE attempt <= 4),
c AS (SELECT *, min(CASE WHEN stop_reason IS NOT NULL THEN attempt END)
        OVER (PARTITION BY user_id, run_date) AS cut FROM s)
SELECT user_id, run_date, count(*) AS attempts, count_if(failed) AS failed_attempts,
       arg_max(CASE WHEN failed THEN 'failed' ELSE 'passed' END, attempt) AS final_status,
       coalesce(arg_max(stop_reason, attempt), 'incomplete') AS stop_reason
FROM c WHERE attempt <= coalesce(cut, 4) GROUP BY user_id, run_date""")
def q_attempt_history(spark, sf):
    """W-05 + A-01 flagship: attempts per user/day, cut at the first stop."""
    ev = B.attempt_events(spark, sf)
    return runs.attempts(ev, ["user_id", "run_date"], ["ts", "event_id"], "failed",
                         runs.MAX_ATTEMPTS["unit"])



@register("last_result", f"""WITH m AS ({O.MESSAGES})
SELECT run_id, max(seq) AS seq, arg_max(result, seq) AS result FROM m WHERE type = 'result' GROUP BY run_id""")
def q_last_result(spark, sf):
    """W-01: last result message per run (last assistant turn per conversation)."""
    return runs.last_result(B.messages(spark, sf), "run_id", "seq")


@register("tail_error", f"""WITH m AS ({O.EVENT_MESSAGES}),
t AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY seq DESC) AS rn FROM m QUALIFY rn <= 5),
h AS (SELECT * FROM t WHERE type = 'assistant' AND length(text) > 0
      AND (contains(lower(text), 'error') OR contains(lower(text), 'failed')))
SELECT run_id, max(seq) AS seq, arg_max(substring(text, 1, 500), seq) AS error_text FROM h GROUP BY run_id""")
def q_tail_error(spark, sf):
    """W-02: newest error-looking assistant text among each run's last five messages."""
    return runs.tail_error(B.event_messages(spark, sf), "run_id", "seq", n=5)


@register("tail_output", f"""WITH m AS ({O.EVENT_MESSAGES}),
t AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY seq DESC) AS rn FROM m QUALIFY rn <= 5),
h AS (SELECT * FROM t WHERE type = 'assistant' AND length(text) > 0)
SELECT run_id, max(seq) AS seq, arg_max('Claude Code output: ' || substring(text, 1, 500), seq) AS error_text
FROM h GROUP BY run_id""")
def q_tail_output(spark, sf):
    """W-02 (no-result variant): newest non-empty assistant text among the last five."""
    return runs.tail_error(B.event_messages(spark, sf), "run_id", "seq", n=5, require_words=False,
                           prefix=T.OUTPUT_PREFIX)


@register("latest_mention", """WITH c AS (SELECT conv_id, turn,
    CASE WHEN role = 'assistant' THEN '[ADW-AGENTS] ' || text ELSE text END AS body FROM conversations),
h AS (SELECT * FROM c WHERE NOT contains(body, '[ADW-AGENTS]') AND contains(body, 'de'))
SELECT conv_id, max(turn) AS turn, arg_max(body, turn) AS body FROM h GROUP BY conv_id""")
def q_latest_mention(spark, sf):
    """W-03 + FL-03: newest non-bot comment containing a keyword, per conversation."""
    cv = table(spark, sf, "conversations")
    c = cv.select("conv_id", "turn", F.when(F.col("role") == "assistant", F.concat(F.lit("[ADW-AGENTS] "), F.col("text")))
                  .otherwise(F.col("text")).alias("body"))
    return runs.latest_mention(c, "de", "conv_id", "body", ["turn"])


@register("ordered_comments", """SELECT user_id, event_id, event_type, value,
  row_number() OVER (PARTITION BY user_id ORDER BY ts ASC NULLS FIRST, event_id) AS position FROM events""")
def q_ordered_comments(spark, sf):
    """W-04: position of each event in its user's thread, missing timestamps first."""
    ev = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return runs.ordered_comments(ev, "user_id", "ts", ["event_id"]) \
               .select("user_id", "event_id", "event_type", "value", F.col("position").cast("bigint").alias("position"))


_BACKOFF_SQL = """WITH r AS (SELECT user_id, CAST(ts AS DATE) AS run_date, count(*) AS attempts FROM events GROUP BY ALL),
x AS (SELECT *, attempts - 1 AS retries FROM r)
SELECT user_id, run_date, attempts, retries,
  CASE WHEN retries <= 0 THEN 0 WHEN retries <= 3 THEN [1, 3, 5][retries] ELSE 5 + 2 * (retries - 3) END AS last_delay_s,
  CASE WHEN retries <= 0 THEN 0 WHEN retries <= 3 THEN [1, 4, 9][retries]
       ELSE 9 + (retries - 3) * 5 + (retries - 3) * (retries - 2) END AS total_wait_s FROM x"""


@register("retry_backoff", _BACKOFF_SQL)
def q_retry_backoff(spark, sf):
    """W-06: delays 1, 3, 5 then +2 each; total wait per user/day run (closed form)."""
    ev = B.attempt_events(spark, sf)
    r = ev.groupBy("user_id", "run_date").agg(F.count(F.lit(1)).alias("attempts"))
    return runs.backoff(r).select("user_id", "run_date", "attempts", F.col("retries").cast("bigint").alias("retries"),
                                  F.col("last_delay_s").cast("bigint").alias("last_delay_s"),
                                  F.col("total_wait_s").cast("bigint").alias("total_wait_s"))


@register("latest_state", """SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id,
  arg_max(event_type, (ts, event_id)) AS current_phase, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id""")
def q_latest_state(spark, sf):
    """W-07: latest state per user (last writer wins by ts, event_id)."""
    ev = table(spark, sf, "events").withColumnRenamed("event_type", "current_phase")
    return runs.latest(ev, "user_id", ["ts", "event_id"], ["current_phase", "value"])


@register("top_orders", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
  ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000""")
def q_top_orders(spark, sf):
    """W-09: first 1000 orders by price (the limit is the operator), total order."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return runs.top_k(o, 1000, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@register("test_counts", f"""WITH t AS ({O.TEST_RESULTS})
SELECT user_id, run_date, count_if(passed) AS passed, count_if(NOT passed) AS failed, count(passed) AS total,
  bool_and(passed IS NOT NULL) AS parse_ok,
  CASE WHEN NOT bool_and(passed IS NOT NULL) OR count(passed) = 0 THEN 'unknown'
       WHEN count_if(NOT passed) > 0 THEN 'failed' ELSE 'passed' END AS status FROM t GROUP BY ALL""")
def q_test_counts(spark, sf):
    """A-01: passed / failed / total per run with parse flag and status."""
    return runs.test_counts(B.test_results(spark, sf), ["user_id", "run_date"])


@register("severity_counts", f"""WITH r AS ({O.REVIEW_ISSUES})
SELECT run_id, count_if(issue_severity = 'blocker') AS n_blocker, count_if(issue_severity = 'tech_debt') AS n_tech_debt,
  count_if(issue_severity = 'skippable') AS n_skippable,
  count_if(issue_severity NOT IN ('blocker', 'tech_debt', 'skippable')) AS n_out_of_domain, count(*) AS n_issues
FROM r GROUP BY run_id""")
def q_severity_counts(spark, sf):
    """A-02: review findings per severity, per review run (a source's block of 100 documents)."""
    return runs.severity_counts(B.review_issues(spark, sf), "run_id")


@register("suite_summary", f"""WITH t AS ({O.TEST_RESULTS}),
u AS (SELECT *, CASE WHEN test_name IN ('view', 'click', 'signup') THEN 'unit' ELSE 'e2e' END AS suite FROM t),
a AS (SELECT user_id, run_date, count_if(suite = 'unit' AND passed) AS unit_passed, count_if(suite = 'e2e' AND passed) AS e2e_passed,
  count_if(suite = 'unit' AND NOT passed) AS unit_failed, count_if(suite = 'e2e' AND NOT passed) AS e2e_failed FROM u GROUP BY ALL)
SELECT *, unit_failed + e2e_failed AS total_failures,
  CASE WHEN unit_failed + e2e_failed > 0 THEN 'failed' ELSE 'passed' END AS overall_status FROM a""")
def q_suite_summary(spark, sf):
    """A-03 + U-05: unit and E2E suites unioned, one overall status per run."""
    t = B.test_results(spark, sf)
    unit = t.filter(F.col("test_name").isin("view", "click", "signup"))
    e2e = t.filter(~F.col("test_name").isin("view", "click", "signup"))
    return runs.suite_summary(unit, e2e, ["user_id", "run_date"])


@register("stack_health", """SELECT s_nationkey, count(*) AS n_items, count_if(s_acctbal < 0) AS n_unhealthy,
  coalesce(bool_and(s_acctbal >= 0) AND count(*) > 0, false) AS all_healthy FROM supplier GROUP BY s_nationkey""")
def q_stack_health(spark, sf):
    """A-04: all-healthy flag per nation of suppliers (healthy = non-negative balance)."""
    s = table(spark, sf, "supplier").withColumn("ok", F.col("s_acctbal") >= 0)
    return runs.health(s, "s_nationkey", "ok")


@register("stack_health_messages", """SELECT s_nationkey, s_name || ': balance ' || CAST(s_acctbal AS DECIMAL(18,2)) AS message
  FROM supplier WHERE s_acctbal < 0""")
def q_stack_health_messages(spark, sf):
    """A-04: one message row per unhealthy supplier."""
    s = table(spark, sf, "supplier").withColumn("ok", F.col("s_acctbal") >= 0)
    msg = F.concat(F.col("s_name"), F.lit(": balance "), F.col("s_acctbal").cast("decimal(18,2)").cast("string"))
    return runs.health_messages(s, "s_nationkey", "ok", msg)


@register("resolution_counts", """WITH i AS (SELECT user_id, CAST(ts AS DATE) AS iteration,
    count_if(event_type <> 'error') AS resolved, count_if(event_type = 'error') AS unresolved FROM events GROUP BY ALL),
s AS (SELECT *, coalesce(max(CAST(resolved = 0 AS INT)) OVER (PARTITION BY user_id ORDER BY iteration
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM i)
SELECT user_id, iteration, resolved, unresolved, resolved = 0 AS stop_here FROM s WHERE s = 0""")
def q_resolution_counts(spark, sf):
    """A-05: resolved / unresolved per daily iteration, up to the first day resolving nothing."""
    ev = table(spark, sf, "events").select("user_id", F.to_date("ts").alias("iteration"),
                                           (F.col("event_type") != "error").alias("resolved"))
    return runs.resolution_counts(ev, "user_id", "iteration", "resolved")


_PHASES = list(B.PRIORITY_PHASE.values())


@register("phase_matrix", f"""WITH p AS ({O.PHASE_ROWS})
SELECT run_id, {", ".join(f"max(CASE WHEN phase = '{x}' THEN completed END) AS phase_{x}" for x in _PHASES)},
  count_if(completed) AS n_completed, count_if(failed) AS n_failed FROM p GROUP BY run_id""")
def q_phase_matrix(spark, sf):
    """A-06: phase completion matrix and counters per run (customer)."""
    return runs.phase_matrix(B.phase_rows(spark, sf), "run_id", "phase", "completed", _PHASES, "failed")


@register("run_kpis", """SELECT user_id, count(*) AS n_runs, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_cost,
  round(avg(value), 4) AS avg_duration, quantile_disc(value, 0.95) AS p95_duration,
  round(avg(CAST(event_type = 'error' AS DOUBLE)), 6) AS error_rate FROM events GROUP BY user_id""")
def q_run_kpis(spark, sf):
    """A-07: cost, duration (avg, p95) and error rate per user."""
    ev = table(spark, sf, "events").withColumn("is_error", F.col("event_type") == "error")
    return runs.run_kpis(ev, "user_id", "value", "value", "is_error")


@register("run_ports", f"""WITH r AS ({O.RUN_IDS})
SELECT o_orderkey, run_id, {O.base36_bucket('run_id')} AS bucket, 9100 + {O.base36_bucket('run_id')} AS backend_port,
  9200 + {O.base36_bucket('run_id')} AS frontend_port FROM r""")
def q_run_ports(spark, sf):
    """FN-13: stable slot (base 36 of the first 8 alphanumerics, mod 15) and ports."""
    r = B.run_ids(spark, sf)
    b, f = runs.ports(F.col("run_id"))
    return r.select("o_orderkey", "run_id", runs.stable_bucket(F.col("run_id")).alias("bucket"), b, f)


@register("bucket_load", f"""WITH r AS ({O.RUN_IDS}), b AS (SELECT {O.base36_bucket('run_id')} AS bucket FROM r)
SELECT bucket, count(*) AS n_ids, count(*) - 1 AS collisions FROM b GROUP BY bucket""")
def q_bucket_load(spark, sf):
    """A-19: ids per slot and collisions."""
    r = B.run_ids(spark, sf).select(runs.stable_bucket(F.col("run_id")).alias("bucket"))
    return runs.bucket_load(r)


@register("attempt_history_full", f"""WITH a AS (SELECT user_id, CAST(ts AS DATE) AS run_date, ts, event_id,
    event_type = 'error' AS failed, value > 300 AS run_error, value >= 20 AS resolved FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, run_date ORDER BY ts, event_id) AS attempt FROM a),
s AS (SELECT *, CASE WHEN run_error THEN 'run_error' WHEN NOT failed THEN 'passed' WHEN attempt = 4 THEN 'max_attempts'
      WHEN NOT resolved THEN 'no_resolution' END AS stop_reason FROM n WHERE attempt <= 4),
c AS (SELECT *, min(CASE WHEN stop_reason IS NOT NULL THEN attempt END) OVER (PARTITION BY user_id, run_date) AS cut FROM s)
SELECT user_id, run_date, count(*) AS attempts, count_if(failed) AS failed_attempts,
       arg_max(CASE WHEN stop_reason = 'run_error' THEN 'error' WHEN failed THEN 'failed' ELSE 'passed' END, attempt) AS final_status,
       coalesce(arg_max(stop_reason, attempt), 'incomplete') AS stop_reason
FROM c WHERE attempt <= coalesce(cut, 4) GROUP BY user_id, run_date""")
def q_attempt_history_full(spark, sf):
    """W-05 with all four stop rules: run error (value > 300), passed, max attempts,
    no resolution (value < 20 after a failure)."""
    ev = B.attempt_events(spark, sf).withColumn("run_error", F.col("value") > 300) \
          .withColumn("resolved", F.col("value") >= 20)
    return runs.attempts(ev, ["user_id", "run_date"], ["ts", "event_id"], "failed", 4, "run_error", "resolved")


@register("run_kpis_by_agent", """SELECT event_type AS agent, CAST(user_id % 3 AS INTEGER) AS model, count(*) AS n_runs,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_cost, round(avg(value), 4) AS avg_duration, quantile_disc(value, 0.95) AS p95_duration,
  round(avg(CAST(value > 200 AS DOUBLE)), 6) AS error_rate, round(avg(value * 0.5), 4) AS avg_api_duration,
  CAST(sum(1 + event_id % 7) AS BIGINT) AS n_turns FROM events GROUP BY 1, 2""")
def q_run_kpis_by_agent(spark, sf):
    """A-07: cost, wall and API time, turns and error rate per agent and model (event type and user stand in)."""
    ev = table(spark, sf, "events").select(
        F.col("event_type").alias("agent"), (F.col("user_id") % 3).cast("int").alias("model"), "value",
        (F.col("value") > 200).alias("is_error"), (F.col("value") * 0.5).alias("api"), (1 + F.col("event_id") % 7).alias("turns"))
    return runs.run_kpis(ev, ["agent", "model"], "value", "value", "is_error", "api", "turns")
