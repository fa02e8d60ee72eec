"""State, outcome, rendering and filter queries (FN-02, FN-09, FN-14, FN-15, FN-21..23, FL-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from runledger.functions import render as RD
from runledger.functions import state as ST
from runledger.functions import text as T
from runledger.operators import filters as FL
from runledger.operators import runs
from runledger.plans import bindings as B
from runledger.plans import oracle as O
from runledger.plans.queries.config import _CAT_SQL, _SENS
from runledger.plans.queries.registry import register
from runledger.plans.tables import table


_WF_TEXT_SQL = f"""'Here is the result:' || {O.NL} || '```json' || {O.NL} || '{{"adw_slash_command": "/' ||
  CASE o_orderpriority WHEN '1-URGENT' THEN 'adw_plan_iso' WHEN '2-HIGH' THEN 'adw_sdlc_ZTE_iso' WHEN '3-MEDIUM' THEN 'adw_build_iso'
  WHEN '4-NOT SPECIFIED' THEN 'adw_deploy_iso' ELSE '' END || '", "adw_id": "r' || o_orderkey || '"' ||
  CASE WHEN o_totalprice > 200000 THEN ', "model_set": "heavy"' ELSE '' END || '}}' || {O.NL} || '```'"""


def _wf_text():
    pri = F.col("o_orderpriority")
    cmd = (F.when(pri == "1-URGENT", "adw_plan_iso").when(pri == "2-HIGH", "adw_sdlc_ZTE_iso")
            .when(pri == "3-MEDIUM", "adw_build_iso").when(pri == "4-NOT SPECIFIED", "adw_deploy_iso").otherwise(""))
    return F.concat(F.lit('Here is the result:\n```json\n{"adw_slash_command": "/'), cmd, F.lit('", "adw_id": "r'),
                    F.col("o_orderkey").cast("string"), F.lit('"'),
                    F.when(F.col("o_totalprice") > 200000, F.lit(', "model_set": "heavy"')).otherwise(F.lit("")),
                    F.lit("}\n```"))


_ALLOWED_SQL = ", ".join(f"'{w}'" for w in ST.WORKFLOWS)


@register("extract_workflow", f"""WITH src AS (SELECT o_orderkey, {_WF_TEXT_SQL} AS text FROM orders),
{O.extract_json_ctes('src', 'text', 'o_orderkey')},
c AS (SELECT o_orderkey, json_text, replace(coalesce(json_extract_string(json_text, '$.adw_slash_command'), ''), '/', '') AS cmd FROM fj)
SELECT o_orderkey, CASE WHEN cmd IN ({_ALLOWED_SQL}) THEN cmd END AS workflow_command,
  CASE WHEN cmd IN ({_ALLOWED_SQL}) THEN json_extract_string(json_text, '$.adw_id') END AS run_id,
  CASE WHEN cmd IN ({_ALLOWED_SQL}) THEN coalesce(json_extract_string(json_text, '$.model_set'), 'base') ELSE 'base' END AS model_set
FROM c""")
def q_extract_workflow(spark, sf):
    """FN-09: workflow, run id and model set from classifier output, allow-listed."""
    o = table(spark, sf, "orders")
    w = ST.extract_workflow(_wf_text())
    return o.select("o_orderkey", w.workflow_command.alias("workflow_command"), w.run_id.alias("run_id"),
                    w.model_set.alias("model_set"))


_STATE_SQL = """'{"run": ' || props || ', "phase": "' || event_type || '", "value": ' || value || '}'"""


@register("state_get_path", f"""WITH s AS (SELECT event_id, event_type, {_STATE_SQL} AS state FROM events)
SELECT event_id, json_extract_string(state, '$.run.k') AS k, coalesce(json_extract_string(state, '$.phase.x'), 'none') AS bad_path,
  coalesce(json_extract_string(state, '$.missing'), 'none') AS missing, event_type AS phase FROM s""")
def q_state_get_path(spark, sf):
    """FN-14: dotted paths in state documents: nested key, path through a non-object,
    missing key (both default), and a core attribute by exact name."""
    ev = table(spark, sf, "events")
    state = F.concat(F.lit('{"run": '), F.col("props"), F.lit(', "phase": "'), F.col("event_type"), F.lit('", "value": '),
                     F.col("value").cast("string"), F.lit("}"))
    core = {"phase": F.col("event_type")}
    return ev.select("event_id", ST.get_path(state, "run.k").alias("k"),
                     ST.get_path(state, "phase.x", "none").alias("bad_path"),
                     ST.get_path(state, "missing", "none").alias("missing"),
                     ST.get_path(state, "phase", core=core).alias("phase"))


@register("allowlist_attrs", """WITH m AS (SELECT c_custkey, c_name AS name, c_mktsegment AS segment,
    CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS VARCHAR) END AS balance FROM customer)
SELECT c_custkey, array_to_string(list_sort(list_filter(['name=' || name, 'segment=' || segment, 'balance=' || balance,
  'market=' || segment], lambda x: x IS NOT NULL)), ';') AS attrs FROM m""")
def q_allowlist_attrs(spark, sf):
    """FN-15: customer attributes: allow-list (name, segment, balance), nulls dropped,
    segment also copied as market."""
    c = table(spark, sf, "customer")
    m = F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment"),
                     F.lit("nation"), F.col("c_nationkey").cast("string"),
                     F.lit("balance"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string")))
    kept = ST.allowlist_map(m, ["name", "segment", "balance"], {"segment": "market"})
    return c.select("c_custkey", F.array_join(F.array_sort(F.transform(F.map_entries(kept),
                                                                       lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
                    .alias("attrs"))


_RESULT_SQL = """SELECT user_id, CAST(ts AS DATE) AS run_date, ts, event_id,
  CASE WHEN event_type = 'error' AND value > 40 THEN 'error_during_execution' ELSE 'success' END AS subtype,
  event_type = 'error' AS is_error, repeat(props || ' ', CAST(floor(value) * 4 AS INT) + 1) AS result
  FROM events WHERE event_type <> 'view'"""


def _results(spark, sf):
    ev = table(spark, sf, "events")
    return ev.filter(F.col("event_type") != "view").select(
        "user_id", F.to_date("ts").alias("run_date"), "ts", "event_id",
        F.when((F.col("event_type") == "error") & (F.col("value") > 40), "error_during_execution").otherwise("success")
        .alias("subtype"), (F.col("event_type") == "error").alias("is_error"),
        F.repeat(F.concat(F.col("props"), F.lit(" ")), (F.floor("value") * 4).cast("int") + 1).alias("result"))


_OUTCOME_SQL = f"""WITH r AS ({_RESULT_SQL}),
l AS (SELECT user_id, run_date, max((ts, event_id)) AS k, arg_max(subtype, (ts, event_id)) AS subtype,
      arg_max(is_error, (ts, event_id)) AS is_error, arg_max(result, (ts, event_id)) AS result FROM r GROUP BY ALL),
runs AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS run_date FROM events),
o AS (SELECT runs.user_id, runs.run_date, l.k IS NOT NULL AS has, l.subtype, coalesce(l.is_error, false) AS err,
      coalesce(l.result, '') AS txt FROM runs LEFT JOIN l ON l.user_id = runs.user_id AND l.run_date = runs.run_date)
SELECT user_id, run_date,
  CASE WHEN NOT has THEN 'No result message found in Claude Code output'
       WHEN subtype = 'error_during_execution' THEN 'Error during execution: Agent encountered an error and did not return a result'
       WHEN err AND length(txt) > 1000 THEN {O.truncate('txt', 800)} ELSE txt END AS output,
  CASE WHEN NOT has OR subtype = 'error_during_execution' THEN false ELSE NOT err END AS success,
  CASE WHEN has AND subtype = 'error_during_execution' THEN 'error_during_execution' ELSE 'none' END AS retry_code FROM o"""


@register("classify_outcome", _OUTCOME_SQL)
def q_classify_outcome(spark, sf):
    """FN-21: outcome and retry code per user/day run from its last result event."""
    runs_ = B.attempt_events(spark, sf)
    return ST.classify_outcome(runs_, _results(spark, sf), ["user_id", "run_date"], ["ts", "event_id"])


@register("retryable_outcomes", f"""SELECT * FROM ({_OUTCOME_SQL}) WHERE NOT success AND retry_code <> 'none'
  AND retry_code IN ('claude_code_error', 'timeout_error', 'execution_error', 'error_during_execution')""")
def q_retryable_outcomes(spark, sf):
    """FL-06: runs whose outcome allows another attempt."""
    return FL.retryable(q_classify_outcome(spark, sf))


@register("failed_labels", """SELECT doc_id, quality, toxic FROM labels WHERE NOT (quality = 1)""")
def q_failed_labels(spark, sf):
    """FL-01: failed results (quality check not passed)."""
    lb = table(spark, sf, "labels").withColumn("passed", F.col("quality") == 1)
    return FL.failed(lb).drop("passed")


@register("passed_labels", """SELECT doc_id, quality, toxic FROM labels WHERE quality = 1""")
def q_passed_labels(spark, sf):
    """FL-01: passed results."""
    lb = table(spark, sf, "labels").withColumn("passed", F.col("quality") == 1)
    return FL.passed(lb).drop("passed")


@register("blocker_issues", f"""SELECT * FROM ({O.REVIEW_ISSUES}) WHERE issue_severity = 'blocker'""")
def q_blocker_issues(spark, sf):
    """FL-02: review findings that block."""
    return FL.blockers(B.review_issues(spark, sf))


_PATH_SQL = """CASE WHEN contains(url, '/en/') THEN 'specs/' WHEN contains(url, '/fr/') THEN 'specs/patch/' ELSE 'docs/' END
  || page_id || CASE WHEN contains(url, '#') THEN '.txt' ELSE '.md' END"""


@register("spec_paths", f"""SELECT page_id, path, contains(path, 'specs/patch/') AS is_patch FROM
  (SELECT page_id, {_PATH_SQL} AS path FROM pages) WHERE starts_with(path, 'specs/') AND ends_with(path, '.md')""")
def q_spec_paths(spark, sf):
    """FL-05: spec documents among paths derived from page URLs."""
    p = table(spark, sf, "pages")
    u = F.col("url")
    path = F.concat(F.when(u.contains("/en/"), "specs/").when(u.contains("/fr/"), "specs/patch/").otherwise("docs/"),
                    F.col("page_id").cast("string"), F.when(u.contains("#"), ".txt").otherwise(".md"))
    return FL.spec_paths(p.select("page_id", path.alias("path")))


@register("render_vars", """SELECT o_orderkey, 'Order ' || o_orderkey || ' for customer ' || o_custkey || ' is ' || o_orderstatus
  || ' ({{ missing }})' AS text FROM orders""")
def q_render_vars(spark, sf):
    """FN-22: ``{{ var }}`` placeholders filled from a per-row map; unknown ones stay."""
    o = table(spark, sf, "orders")
    rec = o.select("o_orderkey", F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"),
                   F.col("o_orderstatus").alias("status"))
    tpl = "Order {{ id }} for customer {{ customer }} is {{ status }} ({{ missing }})"
    return RD.render(rec, tpl).select("o_orderkey", F.col("rendered").alias("text"))


@register("render_plans", f"""WITH s AS (SELECT 'ORD-' || o_orderkey AS id, 'Ship order ' || o_orderkey AS title,
    year(o_orderdate) AS sprint, o_orderpriority AS priority, round(o_totalprice / 1000, 1) AS estimated_hours,
    'As customer ' || o_custkey || ' I want my order' AS user_story,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'Status ' || o_orderstatus END AS description,
    CASE WHEN o_orderstatus = 'O' AND o_orderkey > 0 THEN 'ORD-' || (o_orderkey - 1) ELSE 'None' END AS deps FROM orders),
c AS (SELECT 'ORD-' || l_orderkey AS id, string_agg('- [ ] Ship ' || l_quantity || ' of part ' || l_partkey, {O.NL}
      ORDER BY l_linenumber, 'Ship ' || l_quantity || ' of part ' || l_partkey) AS cl FROM lineitem GROUP BY 1)
SELECT s.id, 'plans/' || lower(s.id) || '_plan.md' AS plan_file,
  '# Implementation Plan: ' || title || {O.NL} || {O.NL} || '**Story ID:** ' || s.id || {O.NL} || '**ADW ID:** batch'
  || {O.NL} || '**Sprint:** ' || coalesce(CAST(sprint AS VARCHAR), 'TBD') || {O.NL} || '**Priority:** ' || coalesce(priority, 'P1')
  || {O.NL} || '**Estimated Hours:** ' || coalesce(CAST(estimated_hours AS VARCHAR), 'TBD') || {O.NL} || {O.NL} || '## User Story'
  || {O.NL} || coalesce(user_story, 'N/A') || {O.NL} || {O.NL} || '## Description' || {O.NL} || coalesce(description, 'N/A')
  || {O.NL} || {O.NL} || '## Dependencies' || {O.NL} || deps || {O.NL} || {O.NL} || '## Acceptance Criteria' || {O.NL}
  || coalesce(c.cl, '') || {O.NL} AS plan FROM s LEFT JOIN c ON c.id = s.id""")
def q_render_plans(spark, sf):
    """FN-22: implementation plan per order with its lines as the acceptance checklist."""
    o = table(spark, sf, "orders")
    sid = F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string"))
    stories = o.select(sid.alias("id"), F.concat(F.lit("Ship order "), F.col("o_orderkey").cast("string")).alias("title"),
                       F.year("o_orderdate").alias("sprint"), F.col("o_orderpriority").alias("priority"),
                       F.round(F.col("o_totalprice") / 1000, 1).alias("estimated_hours"),
                       F.concat(F.lit("As customer "), F.col("o_custkey").cast("string"), F.lit(" I want my order")).alias("user_story"),
                       F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("Status "), F.col("o_orderstatus"))).alias("description"),
                       F.when((F.col("o_orderstatus") == "O") & (F.col("o_orderkey") > 0),
                              F.array(F.concat(F.lit("ORD-"), (F.col("o_orderkey") - 1).cast("string"))))
                       .otherwise(F.array().cast("array<string>")).alias("dependencies"))
    li = table(spark, sf, "lineitem")
    crit = F.concat(F.lit("Ship "), F.col("l_quantity").cast("string"), F.lit(" of part "), F.col("l_partkey").cast("string"))
    criteria = li.select(F.concat(F.lit("ORD-"), F.col("l_orderkey").cast("string")).alias("id"),
                         F.struct(F.col("l_linenumber"), crit).alias("position"), crit.alias("criterion"))
    return RD.render_plan(stories, criteria, "batch")


_ENV_SQL = f"""WITH c AS ({O.CONFIG_VALUES}), s AS ({O.CONFIG_SCHEMA}),
v AS (SELECT c.run_id, c.key, 'Configuration value for ' || s.key AS description,
  CASE WHEN {O.contains_any('c.key', _SENS['generic'])} THEN 'your-secret-value-here'
       WHEN {O.json_type('c.value_json')} = 'str' THEN json_extract_string('[' || c.value_json || ']', '$[0]')
       WHEN {O.json_type('c.value_json')} = 'bool' THEN upper(substr(c.value_json, 1, 1)) || substr(c.value_json, 2)
       ELSE c.value_json END AS val,
  {_CAT_SQL.replace('key', 'c.key')} AS category FROM c LEFT JOIN s ON s.key = c.key),
r AS (SELECT *, CASE category {" ".join(f"WHEN '{n}' THEN {i + 1}" for i, n in enumerate(RD.CATEGORY_ORDER))} END AS rank FROM v),
b AS (SELECT run_id, category, rank, string_agg(CASE WHEN length(description) > 0 THEN '# ' || description || {O.NL} ELSE '' END
      || key || '=' || coalesce(val, '') || {O.NL}, {O.NL} ORDER BY key) AS lines FROM r GROUP BY ALL),
t AS (SELECT run_id, string_agg('# ' || category || {O.NL} || {O.NL} || lines || {O.NL}, '' ORDER BY rank) AS body FROM b GROUP BY run_id)
SELECT run_id, regexp_replace('# Auto-generated environment configuration template' || {O.NL} || '# ADW ID: ' || run_id || {O.NL}
  || '# Environment: dev' || {O.NL} || {O.NL} || body, '\\n$', '') AS template FROM t"""


@register("render_env_template", _ENV_SQL)
def q_render_env_template(spark, sf):
    """FN-22: ``.env.example`` per customer config, grouped by category, secrets masked."""
    desc = B.config_schema(spark).select("key", F.concat(F.lit("Configuration value for "), F.col("key")).alias("description"))
    return RD.render_env_template(B.config_values(spark, sf), ["run_id"], desc)


_REPORT_ROWS_SQL = f"""SELECT user_id, CAST(ts AS DATE) AS run_date, event_id, event_type AS test_name, value >= 1 AS passed,
  '### ' || event_type || {O.NL} || {O.NL} || '```json' || {O.NL} || '{{' || {O.NL} || '  "test_name": ' || to_json(event_type)
  || ',' || {O.NL} || '  "passed": ' || CASE WHEN value >= 1 THEN 'true' ELSE 'false' END || ',' || {O.NL}
  || '  "execution_command": ' || to_json('pytest -k ' || event_type) || ',' || {O.NL}
  || '  "test_purpose": ' || to_json('check ' || event_type) || ',' || {O.NL} || '  "error": '
  || CASE WHEN value >= 1 THEN 'null' ELSE to_json('value ' || value) END || {O.NL} || '}}' || {O.NL} || '```' || {O.NL} || {O.NL}
  AS block FROM events"""


@register("test_report", f"""WITH t AS ({_REPORT_ROWS_SQL}),
a AS (SELECT user_id, run_date, coalesce(string_agg(CASE WHEN NOT passed THEN block END, '' ORDER BY event_id), '') AS f,
  coalesce(string_agg(CASE WHEN passed THEN block END, '' ORDER BY event_id), '') AS p,
  count_if(passed) AS np, count_if(NOT passed) AS nf, count(*) AS n FROM t GROUP BY ALL)
SELECT user_id, run_date, CASE WHEN nf > 0 THEN {O.NL} || '## ❌ Failed Tests' || {O.NL} || {O.NL} || f ELSE '' END
  || CASE WHEN np > 0 THEN '## ✅ Passed Tests' || {O.NL} || {O.NL} || p ELSE '' END || '## Summary' || {O.NL} || '- **Passed**: ' || np
  || {O.NL} || '- **Failed**: ' || nf || {O.NL} || '- **Total**: ' || n AS report FROM a""")
def q_test_report(spark, sf):
    """FN-23: Markdown test report per user/day run (failed, passed, summary)."""
    ev = table(spark, sf, "events")
    t = ev.select("user_id", F.to_date("ts").alias("run_date"), "event_id", F.col("event_type").alias("test_name"),
                  (F.col("value") >= 1).alias("passed"), "value")
    t = t.select("user_id", "run_date", "event_id", "test_name", "passed",
                 F.concat(F.lit("pytest -k "), F.col("test_name")).alias("execution_command"),
                 F.concat(F.lit("check "), F.col("test_name")).alias("test_purpose"),
                 F.when(~F.col("passed"), F.concat(F.lit("value "), F.col("value").cast("string"))).alias("error"))
    return RD.test_report(t, ["user_id", "run_date"], "event_id")


@register("review_report", f"""WITH r AS (SELECT ri.*, 'document ' || ri.review_issue_number AS issue_description FROM ({O.REVIEW_ISSUES}) ri),
a AS (SELECT run_id, {", ".join(f"coalesce(string_agg(CASE WHEN issue_severity = '{s}' THEN '- #' || review_issue_number || ': ' || issue_description || {O.NL} END, '' ORDER BY review_issue_number), '') AS l_{s}, count_if(issue_severity = '{s}') AS n_{s}" for s in ("blocker", "tech_debt", "skippable"))} FROM r GROUP BY run_id)
SELECT run_id, {" || ".join(f"CASE WHEN n_{s} > 0 THEN '## {s} (' || n_{s} || ')' || {O.NL} || l_{s} || {O.NL} ELSE '' END" for s in ("blocker", "tech_debt", "skippable"))}
  || 'Summary: blocker: ' || n_blocker || ', tech_debt: ' || n_tech_debt || ', skippable: ' || n_skippable AS report FROM a""")
def q_review_report(spark, sf):
    """FN-23 (review kind): findings grouped by severity per run, with a summary."""
    r = B.review_issues(spark, sf).withColumn("issue_description",
                                             F.concat(F.lit("document "), F.col("review_issue_number").cast("string")))
    return RD.review_report(r, ["run_id"], "review_issue_number")


_OUTPUT_SQL = """CASE WHEN event_type = 'error' THEN 'the tests crashed' ELSE '```json' || chr(10) || '[{"test_name": "a", "passed": '
  || CASE WHEN value >= 1 THEN 'true' ELSE 'false' END || '}, {"test_name": "b", "passed": ' || CASE WHEN value >= 50 THEN 'true' ELSE 'false' END
  || '}]' || chr(10) || '```' END"""


@register("test_counts_from_output", f"""WITH o AS (SELECT event_id, {_OUTPUT_SQL} AS text, event_type, value FROM events)
SELECT event_id, CASE WHEN event_type = 'error' THEN 0 ELSE CAST(value >= 1 AS INT) + CAST(value >= 50 AS INT) END AS passed,
  CASE WHEN event_type = 'error' THEN 0 ELSE 2 - CAST(value >= 1 AS INT) - CAST(value >= 50 AS INT) END AS failed,
  CASE WHEN event_type = 'error' THEN 0 ELSE 2 END AS total, event_type <> 'error' AS parse_ok,
  CASE WHEN event_type = 'error' THEN 'unknown' WHEN value < 50 THEN 'failed' ELSE 'passed' END AS status FROM o""")
def q_test_counts_from_output(spark, sf):
    """FN-02 + A-01: test results parsed from each run's output; unparseable output
    counts 0/0/0 as in the source but reports parse_ok = false and status unknown."""
    ev = table(spark, sf, "events")
    item = lambda name, cond: F.concat(F.lit('{"test_name": "' + name + '", "passed": '),
                                       F.when(cond, F.lit("true")).otherwise(F.lit("false")), F.lit("}"))
    text = F.when(F.col("event_type") == "error", F.lit("the tests crashed")).otherwise(
        F.concat(F.lit("```json\n["), item("a", F.col("value") >= 1), F.lit(", "), item("b", F.col("value") >= 50), F.lit("]\n```")))
    p = T.parse_typed(text, "array<struct<test_name:string,passed:boolean>>")
    rows = ev.select("event_id", p.alias("p")).select("event_id", F.col("p.error").isNull().alias("parse_ok"),
                                                       F.explode_outer("p.value").alias("t"))
    rows = rows.select("event_id", "parse_ok", F.col("t.passed").alias("passed"))
    out = runs.test_counts(rows, ["event_id"], "passed", "parse_ok")
    return out.select("event_id", F.col("passed").cast("int").alias("passed"), F.col("failed").cast("int").alias("failed"),
                      F.col("total").cast("int").alias("total"), "parse_ok", "status")


_PROC_SQL = """SELECT user_id, CAST(ts AS DATE) AS run_date,
  CASE WHEN max(value) > 300 THEN 'timeout' WHEN max(value) > 250 THEN 'exception' END AS failure,
  'worker lost at ' || CAST(max(event_id) AS VARCHAR) AS failure_text,
  CASE WHEN max(value) > 150 THEN CAST(floor(max(value)) AS INT) % 7 + 1 ELSE 0 END AS exit_code,
  CASE WHEN count(*) > 6 THEN 'last line ' || count(*) END AS stdout,
  CASE WHEN min(value) < 0.5 THEN 'warning: low value' END AS stderr FROM events GROUP BY ALL"""


def _processes(spark, sf):
    ev = table(spark, sf, "events")
    return ev.groupBy("user_id", F.to_date("ts").alias("run_date")).agg(
        F.when(F.max("value") > 300, "timeout").when(F.max("value") > 250, "exception").alias("failure"),
        F.concat(F.lit("worker lost at "), F.max("event_id").cast("string")).alias("failure_text"),
        F.when(F.max("value") > 150, F.pmod(F.floor(F.max("value")).cast("int"), F.lit(7)) + 1).otherwise(F.lit(0))
        .alias("exit_code"),
        F.when(F.count(F.lit(1)) > 6, F.concat(F.lit("last line "), F.count(F.lit(1)).cast("string"))).alias("stdout"),
        F.when(F.min("value") < 0.5, F.lit("warning: low value")).alias("stderr"))


@register("classify_process_outcome", f"""WITH r AS ({_RESULT_SQL}),
l AS (SELECT user_id, run_date, max((ts, event_id)) AS k, arg_max(subtype, (ts, event_id)) AS subtype,
      arg_max(is_error, (ts, event_id)) AS is_error, arg_max(result, (ts, event_id)) AS result FROM r GROUP BY ALL),
p AS ({_PROC_SQL}),
o AS (SELECT p.*, l.k IS NOT NULL AS has, l.subtype, coalesce(l.is_error, false) AS err, coalesce(l.result, '') AS txt,
      CASE WHEN l.k IS NOT NULL AND l.is_error THEN coalesce(l.result, 'Unknown error') END AS structured
      FROM p LEFT JOIN l ON l.user_id = p.user_id AND l.run_date = p.run_date),
m AS (SELECT *, CASE
  WHEN length(structured) > 0 THEN 'Claude Code error: ' || structured
  WHEN coalesce(length(stdout) > 0, false) AND NOT coalesce(length(stderr) > 0, false) THEN 'Claude Code error: ' || stdout
  WHEN coalesce(length(stderr) > 0, false) AND NOT coalesce(length(stdout) > 0, false) THEN 'Claude Code error: ' || stderr
  WHEN coalesce(length(stdout) > 0, false) AND coalesce(length(stderr) > 0, false)
    THEN 'Claude Code error: ' || stderr || {O.NL} || 'Stdout: ' || stdout
  ELSE 'Claude Code error: Command failed with exit code ' || exit_code END AS emsg FROM o)
SELECT user_id, run_date,
  CASE WHEN failure = 'timeout' THEN 'Error: Claude Code command timed out after 5 minutes'
       WHEN failure = 'exception' THEN 'Error executing Claude Code: ' || coalesce(failure_text, '')
       WHEN exit_code <> 0 THEN {O.truncate('emsg', 800)}
       WHEN NOT has THEN 'No result message found in Claude Code output'
       WHEN subtype = 'error_during_execution' THEN 'Error during execution: Agent encountered an error and did not return a result'
       WHEN err AND length(txt) > 1000 THEN {O.truncate('txt', 800)} ELSE txt END AS output,
  CASE WHEN failure IN ('timeout', 'exception') OR exit_code <> 0 OR NOT has OR subtype = 'error_during_execution' THEN false
       ELSE NOT err END AS success,
  CASE WHEN failure = 'timeout' THEN 'timeout_error' WHEN failure = 'exception' THEN 'execution_error'
       WHEN exit_code <> 0 THEN 'claude_code_error'
       WHEN has AND subtype = 'error_during_execution' THEN 'error_during_execution' ELSE 'none' END AS retry_code FROM m""")
def q_classify_process_outcome(spark, sf):
    """FN-21 with process status per run: timeouts, launcher exceptions and non-zero
    exits (FN-20 error text) before the result-based rules."""
    return ST.classify_outcome(_processes(spark, sf), _results(spark, sf), ["user_id", "run_date"], ["ts", "event_id"],
                               exit_col="exit_code", stdout_col="stdout", stderr_col="stderr",
                               failure_col="failure", failure_text_col="failure_text")


_STACK_RUN_SQL = "'deploy-' || s_nationkey || '-' || (s_suppkey // 100)"


@register("deploy_report", f"""WITH s AS (SELECT {_STACK_RUN_SQL} AS run_id, s_name AS stack_name,
    CASE WHEN s_acctbal >= 0 THEN 'deployed' ELSE 'failed' END AS status,
    '- **' || s_name || '**: ' || CASE WHEN s_acctbal >= 0 THEN 'deployed' ELSE 'failed' END
      || {O.NL} || '  - acct: `' || s_suppkey || '`' || {O.NL} || '  - nation: `' || s_nationkey || '`' AS line FROM supplier),
a AS (SELECT run_id, string_agg(line, {O.NL} ORDER BY stack_name) AS lines, bool_and(status = 'deployed') AS ok,
      count_if(status = 'deployed') AS up, count(*) AS n FROM s GROUP BY run_id)
SELECT run_id, ok AS success, '## ' || CASE WHEN ok THEN '✅ Deployment Successful' ELSE '❌ Deployment Failed' END
  || {O.NL} || {O.NL} || '**ADW ID:** ' || run_id || {O.NL} || '**Environment:** staging' || {O.NL} || {O.NL}
  || '### Deployed Stacks' || {O.NL} || lines || {O.NL} || {O.NL} || '### Health Checks' || {O.NL} || '```' || {O.NL}
  || up || ' of ' || n || ' stacks deployed' || {O.NL} || '```' || {O.NL} || {O.NL} || '### Next Steps' || {O.NL}
  || CASE WHEN ok THEN '- Infrastructure is ready for testing' || {O.NL} || '- Run `/test_infra` to validate infrastructure'
     ELSE '- Review deployment errors and retry' || {O.NL} || '- Check CloudFormation console for details' END || {O.NL} AS report
FROM a""")
def q_deploy_report(spark, sf):
    """FN-23 (deploy): deployment summary per run of up to 100 supplier stacks, with
    stack outputs, health line and next steps."""
    s = table(spark, sf, "supplier")
    stacks = s.select(F.concat(F.lit("deploy-"), F.col("s_nationkey").cast("string"), F.lit("-"),
                               F.expr("s_suppkey div 100").cast("string")).alias("run_id"),
                      F.col("s_name").alias("stack_name"),
                      F.when(F.col("s_acctbal") >= 0, "deployed").otherwise("failed").alias("status"),
                      F.create_map(F.lit("acct"), F.col("s_suppkey").cast("string"),
                                   F.lit("nation"), F.col("s_nationkey").cast("string")).alias("outputs"))
    return RD.report(stacks, "deploy", ["run_id"], "stack_name", environment="staging")


@register("infra_report", f"""WITH o AS (SELECT DISTINCT l_suppkey AS s_suppkey FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1996-01-08'),
c AS (SELECT 'deploy-' || s.s_nationkey || '-' || (s.s_suppkey // 100) AS run_id, s.s_name,
    CASE WHEN o.s_suppkey IS NULL THEN 'Stack ' || s.s_name || ' not found'
         WHEN s.s_acctbal <= 0 THEN 'Stack ' || s.s_name || ' status is failed' END AS error,
    o.s_suppkey IS NOT NULL AS seen FROM supplier s LEFT JOIN o ON o.s_suppkey = s.s_suppkey),
a AS (SELECT run_id, coalesce(string_agg(CASE WHEN error IS NOT NULL THEN '- ' || error || {O.NL} END, '' ORDER BY s_name), '') AS errs,
      count(error) AS n_err, count_if(seen) AS n_seen, count(*) AS n FROM c GROUP BY run_id)
SELECT run_id, n_err = 0 AS healthy, '## 🏗️ Infrastructure Test Results' || {O.NL} || {O.NL} || '### CDK Stack Validation' || {O.NL}
  || CASE WHEN n_err = 0 THEN '✅ All CDK stacks are healthy and deployed' || {O.NL} ELSE '❌ Stack validation failed:' || {O.NL} || errs END
  || {O.NL} || '### Infrastructure Tests' || {O.NL}
  || CASE WHEN n_seen > 0 THEN n_seen || ' of ' || n || ' stacks responded' ELSE '⚠️ No infrastructure test results available' END
  AS report FROM a""")
def q_infra_report(spark, sf):
    """FN-23 (infra): stack validation (expected vs observed, J-04) and test output per
    run of up to 100 stacks."""
    s = table(spark, sf, "supplier")
    li = table(spark, sf, "lineitem")
    seen = (li.filter((F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
                      & (F.col("l_shipdate") < F.lit("1996-01-08").cast("timestamp_ntz")))
              .select(F.col("l_suppkey").alias("s_suppkey")).distinct().withColumn("seen", F.lit(True)))
    run = F.concat(F.lit("deploy-"), F.col("s_nationkey").cast("string"), F.lit("-"), F.expr("s_suppkey div 100").cast("string"))
    c = s.join(seen, "s_suppkey", "left").select(
        run.alias("run_id"), "s_name",
        F.when(F.col("seen").isNull(), F.concat(F.lit("Stack "), F.col("s_name"), F.lit(" not found")))
         .when(F.col("s_acctbal") <= 0, F.concat(F.lit("Stack "), F.col("s_name"), F.lit(" status is failed"))).alias("error"),
        F.coalesce(F.col("seen"), F.lit(False)).alias("seen"))
    per_run = c.groupBy("run_id").agg(F.count_if("seen").alias("_s"), F.count(F.lit(1)).alias("_m"))
    c = c.join(per_run, "run_id").withColumn(
        "test_results", F.when(F.col("_s") > 0, F.concat(F.col("_s").cast("string"), F.lit(" of "), F.col("_m").cast("string"),
                                                         F.lit(" stacks responded"))))
    return RD.report(c, "infra", ["run_id"], "s_name")
