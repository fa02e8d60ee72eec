"""Lookup, reconcile and upsert queries (J-01..06, J-11, J-12, U-02..05)."""

from __future__ import annotations

from pyspark.sql import functions as F

from runledger.operators import reconcile as R
from runledger.plans import bindings as B
from runledger.plans import oracle as O
from runledger.plans.queries.registry import register
from runledger.plans.tables import table


_ROUTE_VALUES = ", ".join(f"('{c}', '{s}', '{m}')" for c, s, m in R.ROUTING_RULES)
_ROUTE_INPUT_SQL = """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '/implement' WHEN '2-HIGH' THEN '/test'
    WHEN '3-MEDIUM' THEN '/review' WHEN '4-NOT SPECIFIED' THEN '/document' ELSE '/deploy' END AS command,
    CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_totalprice > 300000 THEN 'heavy'
         WHEN o_totalprice < 20000 THEN 'turbo' ELSE 'base' END AS model_set FROM orders"""


@register("route_model", f"""WITH i AS ({_ROUTE_INPUT_SQL}),
r AS (SELECT * FROM (VALUES {_ROUTE_VALUES}) AS t(command, model_set, model))
SELECT i.o_orderkey, i.command, i.model_set, coalesce(r1.model, r2.model, 'sonnet') AS model FROM i
LEFT JOIN r r1 ON i.command = r1.command AND coalesce(i.model_set, 'base') = r1.model_set
LEFT JOIN r r2 ON i.command = r2.command AND r2.model_set = 'base'""")
def q_route_model(spark, sf):
    """J-01: model per request from the routing table, base fallback, then default."""
    o = table(spark, sf, "orders")
    cmd = (F.when(F.col("o_orderpriority") == "1-URGENT", "/implement").when(F.col("o_orderpriority") == "2-HIGH", "/test")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "/review")
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "/document").otherwise("/deploy"))
    ms = (F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string")).when(F.col("o_totalprice") > 300000, "heavy")
           .when(F.col("o_totalprice") < 20000, "turbo").otherwise("base"))
    req = o.select("o_orderkey", cmd.alias("command"), ms.alias("model_set"))
    return R.route(req, R.routing_rules(spark))


@register("missing_customers", """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN
  (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')""")
def q_missing_customers(spark, sf):
    """J-02: required (all customers) minus present (with an urgent finished order)."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    present = (table(spark, sf, "orders").filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
               .select(F.col("o_custkey").alias("c_custkey")))
    return R.missing(c, present, "c_custkey")


_OBSERVED_SQL = """SELECT DISTINCT l_suppkey AS s_suppkey FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1996-01-08'"""


def _observed_stacks(spark, sf):
    li = table(spark, sf, "lineitem")
    return (li.filter((F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
                      & (F.col("l_shipdate") < F.lit("1996-01-08").cast("timestamp_ntz")))
              .select(F.col("l_suppkey").alias("s_suppkey")).distinct())


@register("reconcile_stacks", f"""WITH o AS ({_OBSERVED_SQL}),
obs AS (SELECT s.s_suppkey, CASE WHEN s.s_acctbal > 0 THEN 'deployed' ELSE 'failed' END AS status
        FROM supplier s JOIN o ON s.s_suppkey = o.s_suppkey)
SELECT s.s_suppkey, obs.status, CASE WHEN obs.status IS NULL THEN 'not_found'
  WHEN obs.status <> 'deployed' THEN 'wrong_status' ELSE 'ok' END AS result
FROM supplier s LEFT JOIN obs ON s.s_suppkey = obs.s_suppkey""")
def q_reconcile_stacks(spark, sf):
    """J-04: expected stacks (all suppliers) vs observed (shipping in the first week of 1996)."""
    s = table(spark, sf, "supplier")
    expected = s.select("s_suppkey", F.lit("deployed").alias("expected_status"))
    observed = (s.join(_observed_stacks(spark, sf), "s_suppkey")
                 .select("s_suppkey", F.when(F.col("s_acctbal") > 0, "deployed").otherwise("failed").alias("status")))
    return R.reconcile(expected, observed, "s_suppkey").select("s_suppkey", "status", "result")


@register("reconcile_three_way", """WITH c AS (SELECT c_custkey, c_acctbal >= 0 AS in_a FROM customer),
b AS (SELECT DISTINCT o_custkey AS c_custkey FROM orders),
g AS (SELECT DISTINCT o.o_custkey AS c_custkey FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
      WHERE l.l_returnflag = 'R')
SELECT c.c_custkey, CASE WHEN NOT in_a THEN 'No worktree_path in state'
    WHEN b.c_custkey IS NULL THEN 'Worktree directory not found: trees/' || c.c_custkey
    WHEN g.c_custkey IS NULL THEN 'Worktree not registered with git' END AS error,
  CASE WHEN NOT in_a OR b.c_custkey IS NULL OR g.c_custkey IS NULL THEN false ELSE true END AS valid
FROM c LEFT JOIN b ON c.c_custkey = b.c_custkey LEFT JOIN g ON c.c_custkey = g.c_custkey""")
def q_reconcile_three_way(spark, sf):
    """J-05: state (non-negative balance), filesystem (has orders), registry (a returned line)."""
    c = table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") >= 0).alias("in_a"))
    o = table(spark, sf, "orders")
    b = o.select(F.col("o_custkey").alias("c_custkey"))
    li = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    g = o.join(li, "o_orderkey", "left_semi").select(F.col("o_custkey").alias("c_custkey"))
    reasons = (F.lit("No worktree_path in state"),
               F.concat(F.lit("Worktree directory not found: trees/"), F.col("c_custkey").cast("string")),
               F.lit("Worktree not registered with git"))
    return R.reconcile3(c, b, g, "c_custkey", reasons)


@register("lookup_first", """SELECT n.n_nationkey AS nationkey, n.n_name, f.c_custkey, f.c_name FROM nation n LEFT JOIN
  (SELECT c_nationkey, min(c_custkey) AS c_custkey, arg_min(c_name, c_custkey) AS c_name FROM customer GROUP BY 1) f
  ON f.c_nationkey = n.n_nationkey""")
def q_lookup_first(spark, sf):
    """J-06: first customer (source order = key) of each nation."""
    req = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    items = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"), "c_custkey", "c_name")
    return R.lookup_first(req, items, "nationkey", "c_custkey", ["c_name"])


@register("match_branches", """WITH b AS (SELECT l_orderkey AS number,
    'feat-issue-' || l_orderkey || '-adw-' || l_linenumber || '-' || lower(l_returnflag) AS branch FROM lineitem)
SELECT o.o_orderkey AS number, o.o_orderstatus AS state, m.branch FROM orders o
LEFT JOIN (SELECT number, min(branch) AS branch FROM b GROUP BY number) m ON m.number = o.o_orderkey""")
def q_match_branches(spark, sf):
    """J-11: branch per issue by the -issue-N- substring (parsed, equi join)."""
    li = table(spark, sf, "lineitem")
    br = li.select(F.concat(F.lit("feat-issue-"), F.col("l_orderkey").cast("string"), F.lit("-adw-"),
                            F.col("l_linenumber").cast("string"), F.lit("-"), F.lower("l_returnflag")).alias("branch"))
    issues = table(spark, sf, "orders").select(F.col("o_orderkey").alias("number"), F.col("o_orderstatus").alias("state"))
    return R.match_branches(br, issues)


@register("first_of", """WITH s0 AS (SELECT o_custkey AS c_custkey, min('specs/state-' || o_orderkey || '.md') AS v
    FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
s1 AS (SELECT o_custkey AS c_custkey, min('specs/branch-' || o_orderkey || '.md') AS v FROM orders
    WHERE o_orderstatus = 'O' GROUP BY 1),
s2 AS (SELECT o_custkey AS c_custkey, min('specs/issue-' || o_orderkey || '.md') AS v FROM orders GROUP BY 1)
SELECT c.c_custkey, coalesce(s0.v, s1.v, s2.v) AS path,
  CASE WHEN s0.v IS NOT NULL THEN 0 WHEN s1.v IS NOT NULL THEN 1 WHEN s2.v IS NOT NULL THEN 2 END AS source
FROM customer c LEFT JOIN s0 ON s0.c_custkey = c.c_custkey LEFT JOIN s1 ON s1.c_custkey = c.c_custkey
LEFT JOIN s2 ON s2.c_custkey = c.c_custkey""")
def q_first_of(spark, sf):
    """J-12: plan file from state, else branch, else pattern; ties by the smallest path."""
    o = table(spark, sf, "orders")
    p = lambda prefix: F.concat(F.lit(prefix), F.col("o_orderkey").cast("string"), F.lit(".md")).alias("path")
    s0 = o.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey"), p("specs/state-"))
    s1 = o.filter(F.col("o_orderstatus") == "O").select(F.col("o_custkey").alias("c_custkey"), p("specs/branch-"))
    s2 = o.select(F.col("o_custkey").alias("c_custkey"), p("specs/issue-"))
    keys = table(spark, sf, "customer").select("c_custkey")
    return R.first_of(keys, [s0, s1, s2], "c_custkey")


_UPSERT_SQL = """WITH t AS (SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier),
s AS (SELECT s_suppkey, s_name || ' (fixed)' AS s_name, s_nationkey, 0.0 AS s_acctbal FROM supplier WHERE s_acctbal < 0
      UNION ALL SELECT -(n_nationkey + 1), 'Supplier#new-' || n_name, n_nationkey, 0.0 FROM nation)
SELECT * FROM s UNION ALL SELECT * FROM t WHERE s_suppkey NOT IN (SELECT s_suppkey FROM s)"""


@register("upsert_suppliers", _UPSERT_SQL)
def q_upsert_suppliers(spark, sf):
    """U-02: whole-record upsert of corrected and new supplier records."""
    t = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    fixed = t.filter(F.col("s_acctbal") < 0).select("s_suppkey", F.concat("s_name", F.lit(" (fixed)")).alias("s_name"),
                                                      "s_nationkey", F.lit(0.0).alias("s_acctbal"))
    n = table(spark, sf, "nation")
    new = n.select((-(F.col("n_nationkey") + 1)).cast("long").alias("s_suppkey"),
                   F.concat(F.lit("Supplier#new-"), F.col("n_name")).alias("s_name"),
                   F.col("n_nationkey").alias("s_nationkey"), F.lit(0.0).alias("s_acctbal"))
    return R.upsert(t, fixed.unionByName(new), "s_suppkey")


@register("upsert_stack_columns", f"""WITH t AS (SELECT s_name AS stack_name,
    CASE WHEN s_acctbal >= 0 THEN 'deployed' ELSE 'failed' END AS status, 'region-' || s_nationkey AS region,
    'acct=' || s_suppkey AS outputs, 'nation=' || s_nationkey AS parameters FROM supplier),
o AS ({_OBSERVED_SQL}),
s AS (SELECT s.s_name AS stack_name, 'deployed' AS status, 'shipped=' || s.s_suppkey AS outputs
      FROM supplier s JOIN o ON s.s_suppkey = o.s_suppkey
      UNION ALL SELECT 'Stack#' || n_name, 'pending', 'new' FROM nation)
SELECT coalesce(t.stack_name, s.stack_name) AS stack_name,
  CASE WHEN s.stack_name IS NOT NULL THEN s.status ELSE t.status END AS status, t.region,
  CASE WHEN s.stack_name IS NOT NULL THEN s.outputs ELSE t.outputs END AS outputs, t.parameters
FROM t FULL OUTER JOIN s ON t.stack_name = s.stack_name""")
def q_upsert_stack_columns(spark, sf):
    """U-03: status and outputs replaced from observed stacks, region and parameters kept."""
    sup = table(spark, sf, "supplier")
    t = sup.select(F.col("s_name").alias("stack_name"),
                   F.when(F.col("s_acctbal") >= 0, "deployed").otherwise("failed").alias("status"),
                   F.concat(F.lit("region-"), F.col("s_nationkey").cast("string")).alias("region"),
                   F.concat(F.lit("acct="), F.col("s_suppkey").cast("string")).alias("outputs"),
                   F.concat(F.lit("nation="), F.col("s_nationkey").cast("string")).alias("parameters"))
    obs = sup.join(_observed_stacks(spark, sf), "s_suppkey").select(
        F.col("s_name").alias("stack_name"), F.lit("deployed").alias("status"),
        F.concat(F.lit("shipped="), F.col("s_suppkey").cast("string")).alias("outputs"))
    new = table(spark, sf, "nation").select(F.concat(F.lit("Stack#"), F.col("n_name")).alias("stack_name"),
                                            F.lit("pending").alias("status"), F.lit("new").alias("outputs"))
    return R.upsert_cols(t, obs.unionByName(new), "stack_name", ["status", "outputs"])


@register("merge_attrs", """WITH e AS (SELECT user_id, ts, event_id, 'k' AS k, json_extract_string(props, '$.k') AS v FROM events
  UNION ALL SELECT user_id, ts, event_id, event_type, CAST(value AS VARCHAR) FROM events),
l AS (SELECT user_id, k, arg_max(v, (ts, event_id)) AS v FROM e GROUP BY user_id, k)
SELECT user_id, string_agg(k || '=' || v, ';' ORDER BY k || '=' || v) AS attrs FROM l GROUP BY user_id""")
def q_merge_attrs(spark, sf):
    """U-04: per user, attribute maps merged in event order (later value wins per key)."""
    ev = table(spark, sf, "events")
    m = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), F.col("event_type"), F.col("value").cast("string"))
    df = ev.select("user_id", "ts", "event_id", m.alias("attrs"))
    out = R.merge_attrs(df, ["user_id"], ["ts", "event_id"], "attrs")
    return out.select("user_id", F.array_join(F.array_sort(F.transform(F.map_entries("attrs"),
                                                                       lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
                      .alias("attrs"))


@register("union_suites", f"""WITH t AS ({O.TEST_RESULTS})
SELECT user_id, run_date, event_id, test_name, passed, 'unit' AS suite, NULL::VARCHAR AS status, NULL::VARCHAR AS test_path
FROM t WHERE test_name IN ('view', 'click', 'signup')
UNION ALL SELECT user_id, run_date, event_id, test_name, passed, 'e2e',
  CASE WHEN passed THEN 'passed' ELSE 'failed' END, 'e2e/' || test_name FROM t WHERE test_name NOT IN ('view', 'click', 'signup')""")
def q_union_suites(spark, sf):
    """U-05: unit and E2E results in one frame, E2E-only columns null for unit rows."""
    t = B.test_results(spark, sf)
    unit = t.filter(F.col("test_name").isin("view", "click", "signup"))
    e2e = t.filter(~F.col("test_name").isin("view", "click", "signup")).withColumn(
        "status", F.when(F.col("passed"), "passed").otherwise("failed")).withColumn(
        "test_path", F.concat(F.lit("e2e/"), F.col("test_name")))
    return R.union_suites(unit, e2e)
