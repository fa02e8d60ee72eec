"""Security, quality, cost, retention and quota queries (J-13..16, A-08..22, W-08, W-10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from runledger.operators import quality as Q
from runledger.operators import rulescan as RS
from runledger.operators import security as S
from runledger.plans import bindings as B
from runledger.plans.queries.registry import register
from runledger.plans.tables import table


_REQ_SQL = """SELECT event_id, user_id,
  CASE event_type WHEN 'view' THEN 'GET' WHEN 'click' THEN 'PUT' WHEN 'purchase' THEN 'POST'
       WHEN 'signup' THEN 'DELETE' ELSE 'GET' END AS method,
  CASE event_type WHEN 'view' THEN '/api/v1/tasks' WHEN 'click' THEN '/api/v1/tasks/' || json_extract_string(props, '$.k')
       WHEN 'purchase' THEN '/api/v1/users' WHEN 'signup' THEN '/api/v1/users/' || user_id
       ELSE '/api/v1/admin/metrics/' || json_extract_string(props, '$.k') END AS endpoint,
  CASE WHEN event_type = 'click' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) * 150 + user_id % 7 END AS resource_id
  FROM events"""


def _requests(spark, sf):
    ev = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    et = F.col("event_type")
    method = (F.when(et == "view", "GET").when(et == "click", "PUT").when(et == "purchase", "POST")
               .when(et == "signup", "DELETE").otherwise("GET"))
    endpoint = (F.when(et == "view", F.lit("/api/v1/tasks")).when(et == "click", F.concat(F.lit("/api/v1/tasks/"), k))
                 .when(et == "purchase", F.lit("/api/v1/users"))
                 .when(et == "signup", F.concat(F.lit("/api/v1/users/"), F.col("user_id").cast("string")))
                 .otherwise(F.concat(F.lit("/api/v1/admin/metrics/"), k)))
    rid = F.when(et == "click", k.cast("bigint") * 150 + F.col("user_id") % 7)
    return ev.select("event_id", "user_id", method.alias("method"), endpoint.alias("endpoint"), rid.alias("resource_id"))


_MEMBERS_SQL = """SELECT c_custkey AS user_id, 'user' AS role FROM customer
  UNION ALL SELECT c_custkey, 'manager' FROM customer WHERE c_mktsegment = 'MACHINERY'
  UNION ALL SELECT c_custkey, 'admin' FROM customer WHERE c_mktsegment = 'AUTOMOBILE'"""


def _members(spark, sf):
    c = table(spark, sf, "customer")
    return (c.select(F.col("c_custkey").alias("user_id"), F.lit("user").alias("role"))
             .unionByName(c.filter(F.col("c_mktsegment") == "MACHINERY").select(F.col("c_custkey").alias("user_id"), F.lit("manager").alias("role")))
             .unionByName(c.filter(F.col("c_mktsegment") == "AUTOMOBILE").select(F.col("c_custkey").alias("user_id"), F.lit("admin").alias("role"))))


def _policy_sql(ep: str, m: str) -> str:
    norm = f"regexp_replace({ep}, '/[0-9]+(/|$)', '/{{id}}\\1', 'g')"
    parts = [f"WHEN {norm} = '{e}' AND {m} = '{mt}' THEN '{r}'" for e, mt, r in S.ENDPOINT_POLICY if not e.endswith("/*")]
    parts += [f"WHEN starts_with({norm}, '{e[:-1]}')" + (f" AND {m} = '{mt}'" if mt != "ALL" else "") + f" THEN '{r}'"
              for e, mt, r in sorted([x for x in S.ENDPOINT_POLICY if x[0].endswith("/*")], key=lambda x: -len(x[0]))]
    return "CASE " + " ".join(parts) + " END"


@register("authorise_requests", f"""WITH r AS (SELECT *, {_policy_sql('endpoint', 'method')} AS required_role FROM ({_REQ_SQL})),
m AS ({_MEMBERS_SQL}),
j AS (SELECT r.*, EXISTS (SELECT 1 FROM m WHERE m.user_id = r.user_id AND m.role = r.required_role) AS has,
  EXISTS (SELECT 1 FROM m WHERE m.user_id = r.user_id AND m.role = 'admin') AS adm,
  o.o_orderkey AS rid, CASE WHEN o.o_orderkey % 11 <> 0 THEN o.o_custkey END AS owner FROM r LEFT JOIN orders o ON o.o_orderkey = r.resource_id),
d AS (SELECT *, CASE WHEN NOT has THEN 'User lacks required role: ' || coalesce(required_role, 'None')
  WHEN resource_id IS NOT NULL AND rid IS NULL THEN 'Resource not found'
  WHEN resource_id IS NOT NULL AND adm THEN 'Admin override'
  WHEN resource_id IS NOT NULL AND owner IS DISTINCT FROM user_id THEN 'User does not own this resource' ELSE 'Authorized' END AS reason FROM j)
SELECT event_id, user_id, method, endpoint, resource_id, required_role,
  reason IN ('Admin override', 'Authorized') AS authorized, reason FROM d""")
def q_authorise_requests(spark, sf):
    """J-13: decision per request (events) from roles (customer segments) and resources (orders,
    some without an owner)."""
    owner = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey"))
    res = table(spark, sf, "orders").select(F.col("o_orderkey").alias("resource_id"), owner.alias("owner_id"))
    return S.authorise(_requests(spark, sf), _members(spark, sf), res)


@register("rls_manager_view", """WITH t AS (SELECT m.c_custkey AS member_id FROM customer m
    JOIN customer mgr ON mgr.c_custkey = 7 AND m.c_nationkey = mgr.c_nationkey)
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey = 7 OR o_custkey IN (SELECT member_id FROM t)""")
def q_rls_manager_view(spark, sf):
    """J-14: orders visible to manager 7 (own and team = customers of the same nation)."""
    c = table(spark, sf, "customer")
    teams = c.alias("m").join(c.alias("g"), F.col("m.c_nationkey") == F.col("g.c_nationkey")).select(
        F.col("g.c_custkey").alias("manager_id"), F.col("m.c_custkey").alias("member_id"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return S.rls(o, "o_custkey", 7, "manager", teams.filter(F.col("manager_id") == 7))


@register("rls_user_view", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey = 7""")
def q_rls_user_view(spark, sf):
    """J-14: orders visible to plain user 7 (own rows only)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return S.rls(o, "o_custkey", 7, "user")


@register("cls_customer_view", """SELECT c_custkey, c_nationkey, c_mktsegment,
  CASE WHEN c_custkey = 7 THEN lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
  CASE WHEN c_custkey = 7 THEN '+' || c_nationkey || '-' || c_custkey END AS phone_number,
  CASE WHEN c_custkey = 7 THEN c_acctbal END AS payment_info FROM customer""")
def q_cls_customer_view(spark, sf):
    """J-15: customer records as user 7 sees them: hash dropped, others' PII hidden."""
    c = table(spark, sf, "customer")
    df = c.select("c_custkey", "c_nationkey", "c_mktsegment",
                  F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
                  F.concat(F.lit("+"), F.col("c_nationkey").cast("string"), F.lit("-"), F.col("c_custkey").cast("string"))
                  .alias("phone_number"),
                  F.col("c_acctbal").alias("payment_info"), F.sha2(F.col("c_name"), 256).alias("password_hash"))
    return S.cls(df, 7, "user", "c_custkey", ["email", "phone_number", "payment_info"], ["password_hash"])


_FK = [("orders.o_custkey -> customer", "orders", "o_custkey", "customer", "c_custkey", None),
       ("lineitem.l_orderkey -> orders", "lineitem", "l_orderkey", "orders", "o_orderkey", None),
       ("lineitem.l_partkey -> part", "lineitem", "l_partkey", "part", "p_partkey", None),
       ("lineitem.l_suppkey -> supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey", None),
       ("customer.c_nationkey -> nation", "customer", "c_nationkey", "nation", "n_nationkey", None),
       ("supplier.s_nationkey -> nation", "supplier", "s_nationkey", "nation", "n_nationkey", None),
       ("nation.n_regionkey -> region", "nation", "n_regionkey", "region", "r_regionkey", None),
       ("labels.doc_id -> documents", "labels", "doc_id", "documents", "doc_id", None),
       ("orders.o_custkey -> customer[BUILDING]", "orders", "o_custkey", "customer", "c_custkey", "c_mktsegment = 'BUILDING'")]


@register("fk_violations", " UNION ALL ".join(
    f"SELECT '{n}' AS fk, count(*) AS n_violations FROM {ch} WHERE {cc} IS NOT NULL AND {cc} NOT IN "
    f"(SELECT {pc} FROM {pa}{' WHERE ' + w if w else ''})" for n, ch, cc, pa, pc, w in _FK))
def q_fk_violations(spark, sf):
    """J-16: declared foreign keys with violation counts, plus one deliberate break
    (orders against the customers of one segment)."""
    checks = []
    for n, ch, cc, pa, pc, w in _FK:
        parent = table(spark, sf, pa)
        if w:
            parent = parent.filter(F.expr(w))
        checks.append((n, table(spark, sf, ch), cc, parent, pc))
    return Q.fk_violations(checks)


@register("rate_metrics", """SELECT o_orderpriority, count(*) AS n,
  round(avg(CAST(o_orderstatus IN ('F', 'O') AS DOUBLE)), 6) AS success_rate,
  round(avg(CAST(o_orderstatus = 'P' AS DOUBLE)), 6) AS rollback_rate,
  round(avg(CAST(o_orderstatus IN ('F', 'O') AS DOUBLE)), 6) >= 0.95 AS meets_success,
  round(avg(CAST(o_orderstatus = 'P' AS DOUBLE)), 6) <= 0.10 AS meets_rollback FROM orders GROUP BY 1""")
def q_rate_metrics(spark, sf):
    """A-08: deployment success (F or O) and rollback (P) rates per priority vs targets."""
    o = table(spark, sf, "orders").select("o_orderpriority", F.col("o_orderstatus").isin("F", "O").alias("ok"),
                                          (F.col("o_orderstatus") == "P").alias("rb"))
    return Q.rate_metrics(o, ["o_orderpriority"], "ok", "rb")


@register("latency_gate", """SELECT event_type, quantile_disc(value * 10, 0.95) AS p95,
  CAST(CASE WHEN event_type = 'purchase' THEN 100.0 ELSE 500.0 END AS DOUBLE) AS target,
  quantile_disc(value * 10, 0.95) <= CASE WHEN event_type = 'purchase' THEN 100.0 ELSE 500.0 END AS passed
  FROM events GROUP BY event_type""")
def q_latency_gate(spark, sf):
    """A-09: p95 latency (value x 10 ms) per event type; purchases are DB calls (100 ms),
    the rest API calls (500 ms)."""
    ev = table(spark, sf, "events").select("event_type", (F.col("value") * 10).alias("latency_ms"))
    target = F.when(F.col("event_type") == "purchase", F.lit(Q.P95_TARGET_MS["db"])).otherwise(F.lit(Q.P95_TARGET_MS["api"]))
    return Q.latency_gate(ev, ["event_type"], "latency_ms", target)


_GATES = [("orders", ">=", 5.0, True, False, False), ("avg_price", "<=", 200000.0, False, True, False),
          ("urgent_share", "<=", 0.3, True, False, True), ("open_orders", ">=", 1.0, False, False, False)]
_MEASURED_SQL = """SELECT o_custkey AS run_id, 'orders' AS metric, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY 1
  UNION ALL SELECT o_custkey, 'avg_price', CASE WHEN o_custkey % 10 <> 7 THEN avg(o_totalprice) END FROM orders GROUP BY 1
  UNION ALL SELECT o_custkey, 'urgent_share', avg(CAST(o_orderpriority = '1-URGENT' AS DOUBLE)) FROM orders WHERE o_custkey % 10 <> 3 GROUP BY 1
  UNION ALL SELECT o_custkey, 'open_orders', CAST(count_if(o_orderstatus = 'O') AS DOUBLE) FROM orders GROUP BY 1"""


def _gate_sql(env: str) -> str:
    vals = ", ".join(f"('{m}', '{op}', {t}, {str(r).lower()}, {str(c).lower()}, {str(p).lower()})" for m, op, t, r, c, p in _GATES)
    return f"""WITH m AS ({_MEASURED_SQL}), t AS (SELECT * FROM (VALUES {vals}) AS t(metric, op, target, required, critical, production_only)),
r AS (SELECT c_custkey AS run_id FROM customer UNION SELECT run_id FROM m),
g AS (SELECT r.run_id, t.required OR t.critical AS counts, coalesce(CASE t.op WHEN '>=' THEN m.value >= t.target
  WHEN '<=' THEN m.value <= t.target WHEN '>' THEN m.value > t.target WHEN '<' THEN m.value < t.target
  WHEN '==' THEN m.value = t.target END, false) AS ok FROM r CROSS JOIN t LEFT JOIN m ON m.metric = t.metric AND m.run_id = r.run_id
  WHERE NOT t.production_only OR {str(env == 'production').lower()})
SELECT run_id, count(*) AS n_gates, count_if(NOT ok) AS n_failed,
  coalesce(bool_and(CASE WHEN counts THEN ok END), true) AS passed FROM g GROUP BY run_id"""


def _measured(spark, sf):
    """Four metrics per customer; some runs miss a required metric, some have a null one."""
    o = table(spark, sf, "orders")
    per = o.groupBy(F.col("o_custkey").alias("run_id")).agg(
        F.count(F.lit(1)).cast("double").alias("orders"), F.avg("o_totalprice").alias("avg_price"),
        F.avg((F.col("o_orderpriority") == "1-URGENT").cast("double")).alias("urgent_share"),
        F.count_if(F.col("o_orderstatus") == "O").cast("double").alias("open_orders"))
    per = per.withColumn("avg_price", F.when(F.col("run_id") % 10 != 7, F.col("avg_price")))
    rows = per.select("run_id", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                                                   for m in ("orders", "avg_price", "urgent_share", "open_orders")])))
    return rows.filter((F.col("metric") != "urgent_share") | (F.col("run_id") % 10 != 3))


for _env in ("staging", "production"):
    def _mkg(env):
        def q(spark, sf):
            from runledger.session import constant_table
            t = constant_table(spark, _GATES, "metric string, op string, target double, required boolean, "
                                              "critical boolean, production_only boolean")
            runs = table(spark, sf, "customer").select(F.col("c_custkey").alias("run_id"))
            return Q.evaluate_gates(_measured(spark, sf), t, ["run_id"], env, runs)
        q.__doc__ = f"A-10: gate evaluation per customer run in {env}; customers without orders fail every gate."
        return q
    register(f"evaluate_gates_{_env}", _gate_sql(_env))(_mkg(_env))


@register("cost_rollup", """WITH u AS (SELECT l_partkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS q FROM lineitem GROUP BY 1),
j AS (SELECT p.p_type, p.p_brand, u.q * CAST(p.p_retailprice AS DECIMAL(18,2)) AS c FROM u JOIN part p ON p.p_partkey = u.l_partkey),
a AS (SELECT p_type, p_brand, sum(c) AS m FROM j GROUP BY 1, 2)
SELECT p_type, p_brand, CAST(m AS DOUBLE) AS monthly, CAST(m * 0.50 AS DOUBLE) AS monthly_low, CAST(m * 1.00 AS DOUBLE) AS monthly_medium,
  CAST(m * 1.70 AS DOUBLE) AS monthly_high, CAST(m * 12 AS DOUBLE) AS annual FROM a""")
def q_cost_rollup(spark, sf):
    """A-11: quantity x unit price per service (type) and category (brand), scenarios, annual."""
    return Q.cost_rollup(table(spark, sf, "lineitem"), table(spark, sf, "part").withColumnRenamed("p_partkey", "l_partkey"),
                         "l_partkey", "l_quantity", "p_retailprice", ["p_type", "p_brand"])


@register("estimate_variance", """WITH a AS (SELECT l_orderkey AS o_orderkey,
    CAST(sum(CAST(l_extendedprice * (1 - l_discount) * (1 + l_tax) AS DECIMAL(18,2))) AS DOUBLE) AS actual FROM lineitem GROUP BY 1),
v AS (SELECT o.o_orderkey, round(CASE WHEN o.o_totalprice <> 0 THEN abs(a.actual - o.o_totalprice) / abs(o.o_totalprice) END, 6) AS variance
  FROM orders o LEFT JOIN a ON a.o_orderkey = o.o_orderkey)
SELECT o_orderkey, variance, variance <= 0.15 AS within_15, variance <= 0.2 AS within_20, variance <= 0.3 AS within_30 FROM v""")
def q_estimate_variance(spark, sf):
    """A-12: order total (estimate) vs sum of its line charges (actual)."""
    li = table(spark, sf, "lineitem")
    charge = (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).cast("decimal(18,2)")
    act = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(charge).cast("double").alias("actual"))
    est = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return Q.variance(est, act, "o_orderkey", "o_totalprice", "actual")


@register("turnaround", """SELECT user_id, CAST(ts AS DATE) AS run_date,
  CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 60000000) AS BIGINT) AS minutes, count(*) AS iterations,
  floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 60000000) <= 1440 AS within_review,
  floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 60000000) <= 20 AS within_deploy, count(*) <= 3 AS within_iterations
  FROM events GROUP BY ALL""")
def q_turnaround(spark, sf):
    """A-13: duration and iterations per user/day run against the stated limits."""
    ev = B.attempt_events(spark, sf)
    return Q.turnaround(ev, ["user_id", "run_date"], "ts").withColumn("minutes", F.col("minutes").cast("bigint"))


@register("adoption", """SELECT (SELECT count(DISTINCT user_id) FROM events) AS active_users,
  (SELECT count(*) FROM customer) AS base_users,
  round((SELECT count(DISTINCT user_id) FROM events) / (SELECT count(*) FROM customer), 6) AS adoption_rate""")
def q_adoption(spark, sf):
    """A-14: distinct active users over the customer base."""
    return Q.adoption(table(spark, sf, "events"), "user_id", table(spark, sf, "customer"))


@register("unique_violations", """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
  GROUP BY 1, 2 HAVING count(*) > 1""")
def q_unique_violations(spark, sf):
    """A-16: (l_orderkey, l_linenumber) pairs that are not unique."""
    return Q.unique_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD")


@register("domain_violations", f"""SELECT 'customer' AS entity, * FROM (
  SELECT 'c_name' AS field, 'required' AS rule, count_if(c_name IS NULL OR length(c_name) = 0) AS n_violations FROM customer
  UNION ALL SELECT 'c_name', 'max_length 18', count_if(length(c_name) > 18) FROM customer
  UNION ALL SELECT 'c_acctbal', 'min_value 0', count_if(c_acctbal < 0) FROM customer
  UNION ALL SELECT 'c_mktsegment', 'enum', count_if(c_mktsegment NOT IN ({", ".join(f"'{x}'" for x in _SEGMENTS)})) FROM customer)
UNION ALL SELECT 'part', * FROM (
  SELECT 'p_size' AS field, 'min_value 1' AS rule, count_if(p_size < 1) AS n_violations FROM part
  UNION ALL SELECT 'p_size', 'max_value 45', count_if(p_size > 45) FROM part
  UNION ALL SELECT 'p_name', 'validation', count_if(NOT regexp_matches(p_name, '^[a-z]+ [a-z]+$')) FROM part
  UNION ALL SELECT 'p_brand', 'validation', count_if(NOT regexp_matches(p_brand, '^Brand#[0-9]{{1,2}}$')) FROM part)""")
def q_domain_violations(spark, sf):
    """A-17: field constraints (required, max length, min/max value, pattern, enum), one pass per entity."""
    c, p = table(spark, sf, "customer"), table(spark, sf, "part")
    cr = [("c_name", "required", Q.required(F.col("c_name"))),
          ("c_name", "max_length 18", Q.max_length(F.col("c_name"), 18)),
          ("c_acctbal", "min_value 0", Q.min_value(F.col("c_acctbal"), 0)),
          ("c_mktsegment", "enum", Q.enum(F.col("c_mktsegment"), _SEGMENTS))]
    pr = [("p_size", "min_value 1", Q.min_value(F.col("p_size"), 1)),
          ("p_size", "max_value 45", Q.max_value(F.col("p_size"), 45)),
          ("p_name", "validation", Q.matches(F.col("p_name"), "^[a-z]+ [a-z]+$")),
          ("p_brand", "validation", Q.matches(F.col("p_brand"), "^Brand#[0-9]{1,2}$"))]
    return Q.domain_violations(c, "customer", cr).unionByName(Q.domain_violations(p, "part", pr))


@register("secret_scan", f"""SELECT doc_id, CAST(len(regexp_extract_all(text, '{Q.SECRET_PATTERN}')) AS INTEGER) AS n_hits FROM documents
  WHERE len(regexp_extract_all(text, '{Q.SECRET_PATTERN}')) > 0""")
def q_secret_scan(spark, sf):
    """A-18: documents with hard-coded secrets (the target is zero)."""
    return Q.secret_scan(table(spark, sf, "documents"), "doc_id", "text")


_SECRET_RULES_SQL = """SELECT * FROM (VALUES
  ('token', '(?i)token[ \\t]*[:=][ \\t]*"[^"\\n]{8,}"'), ('secret', '(?i)secret[ \\t]*[:=][ \\t]*"[^"\\n]{8,}"'),
  ('password', '(?i)password[ \\t]*[:=][ \\t]*"[^"\\n]{8,}"'), ('api_key', '(?i)api[_-]?key[ \\t]*[:=][ \\t]*"[^"\\n]{8,}"'),
  ('private_key', '-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----'), ('bearer', '(?i)bearer [0-9a-z._~+/-]{16,}')) AS t(rule, pattern)"""


@register("secret_hits", f"""WITH r AS ({_SECRET_RULES_SQL}), d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS line, unnest(ls) AS t FROM d)
SELECT doc_id, rule, CAST(line AS INTEGER) AS line, unnest(regexp_extract_all(t, pattern)) AS match FROM l, r""")
def q_secret_hits(spark, sf):
    """A-18: every hard-coded secret with its rule and line (many rules in one pass)."""
    hits = RS.scan(table(spark, sf, "documents"), RS.secret_rules(spark), "text", ("doc_id",))
    return hits.select("doc_id", "rule", "line", "match")


@register("retention_orders", """SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '1999-01-01') AS INTEGER) AS age_days,
  CASE WHEN date_diff('day', CAST(o_orderdate AS DATE), DATE '1999-01-01') > 365 THEN 'expire'
       WHEN date_diff('day', CAST(o_orderdate AS DATE), DATE '1999-01-01') > 90 THEN 'cold' ELSE 'keep' END AS retention
  FROM orders""")
def q_retention_orders(spark, sf):
    """A-20: data retention classes of orders as of 1999-01-01."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return Q.retention(o, "o_orderdate", "data", "1999-01-01").drop("o_orderdate")


@register("retention_logs", """SELECT event_id, CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS INTEGER) AS age_days,
  CASE WHEN date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') > 30 THEN 'expire' ELSE 'keep' END AS retention FROM events""")
def q_retention_logs(spark, sf):
    """A-20: log retention (30 days) of events as of 2024-02-01."""
    ev = table(spark, sf, "events").select("event_id", "ts")
    return Q.retention(ev, "ts", "logs", "2024-02-01").drop("ts")


@register("rotation_overdue", """WITH l AS (SELECT o_custkey, max(o_orderdate) AS last_rotated FROM orders GROUP BY 1),
k AS (SELECT c.c_custkey, CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'db_credentials' WHEN 'BUILDING' THEN 'api_keys'
  ELSE 'jwt_secret' END AS kind, l.last_rotated FROM customer c LEFT JOIN l ON l.o_custkey = c.c_custkey)
SELECT c_custkey, kind, last_rotated, CAST(date_diff('day', CAST(last_rotated AS DATE), DATE '1999-01-01') AS INTEGER) AS days_since,
  CASE kind WHEN 'db_credentials' THEN 30 WHEN 'api_keys' THEN 90 END AS period_days,
  coalesce(date_diff('day', CAST(last_rotated AS DATE), DATE '1999-01-01') >
    CASE kind WHEN 'db_credentials' THEN 30 WHEN 'api_keys' THEN 90 END, false) AS overdue FROM k""")
def q_rotation_overdue(spark, sf):
    """A-21: secrets overdue for rotation; the last order stands for the last rotation."""
    last = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("last_rotated"))
    c = table(spark, sf, "customer")
    kind = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", "db_credentials")
             .when(F.col("c_mktsegment") == "BUILDING", "api_keys").otherwise("jwt_secret"))
    df = c.select("c_custkey", kind.alias("kind")).join(last, "c_custkey", "left")
    return Q.overdue(df, "kind", "last_rotated", "1999-01-01")


@register("sprint_load", """SELECT strftime(l_shipdate, '%Y-%m') AS sprint,
  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS points, CAST(18000.0 AS DOUBLE) AS velocity,
  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) > 18000.0 AS overloaded FROM lineitem GROUP BY 1""")
def q_sprint_load(spark, sf):
    """A-22: shipped quantity per month (sprint) against a velocity of 18000."""
    li = table(spark, sf, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("sprint"), "l_quantity")
    return Q.sprint_load(li, "sprint", "l_quantity", 18000)


@register("daily_quota", """WITH e AS (SELECT e.user_id, CAST(e.ts AS DATE) AS run_date,
    CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE 3 END AS lim FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id)
SELECT user_id, run_date, count(*) AS n_requests, CASE WHEN max(lim) IS NULL THEN count(*) ELSE least(count(*), max(lim)) END AS n_allowed,
  count(*) - CASE WHEN max(lim) IS NULL THEN count(*) ELSE least(count(*), max(lim)) END AS n_rejected FROM e GROUP BY ALL""")
def q_daily_quota(spark, sf):
    """W-08: 3 requests per user/day (scaled-down free tier); admins unlimited."""
    ev = B.attempt_events(spark, sf)
    lim = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"),
                                              F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None).cast("int"))
                                              .otherwise(F.lit(3)).alias("lim"))
    return Q.quota_of(ev, lim, ["user_id", "run_date"], "user_id").select(
        "user_id", "run_date", "n_requests", F.col("n_allowed").cast("bigint").alias("n_allowed"),
        F.col("n_rejected").cast("bigint").alias("n_rejected"))


@register("top_files_per_context", """SELECT p_brand, p_partkey, p_name, CAST(rank AS INTEGER) AS rank FROM (SELECT p_brand, p_partkey, p_name,
  row_number() OVER (PARTITION BY p_brand ORDER BY CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'STANDARD' THEN 2 ELSE 3 END,
    p_name, p_partkey) AS rank FROM part) WHERE rank <= 10""")
def q_top_files_per_context(spark, sf):
    """W-10: ten files per context (brand) by priority (type), then name."""
    p = table(spark, sf, "part")
    pri = F.when(F.col("p_type") == "ECONOMY", 1).when(F.col("p_type") == "STANDARD", 2).otherwise(3)
    return Q.top_k_per_group(p, ["p_brand"], [pri, F.col("p_name"), F.col("p_partkey")], 10).select(
        "p_brand", "p_partkey", "p_name", "rank")


@register("retention_sessions", """SELECT event_id, ts + INTERVAL 1 DAY AS expires_at,
  CASE WHEN ts + INTERVAL 1 DAY <= TIMESTAMP '2024-01-15 12:00:00' THEN 'expire' ELSE 'keep' END AS retention FROM events""")
def q_retention_sessions(spark, sf):
    """A-20 (sessions): each event opens a session that expires one day later; classes as
    of 2024-01-15 12:00."""
    ev = table(spark, sf, "events").select("event_id", (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("expires_at"))
    return Q.session_retention(ev, "expires_at", "2024-01-15 12:00:00")
