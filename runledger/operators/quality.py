"""Quality gates, metrics, data checks, cost and time rules (J-16, A-08..14, A-16..18,
A-20..22, W-08, W-10).

Checks are single-pass aggregates (``count_if`` per rule) so they combine map-side;
per-row results stay rows. Thresholds and policies are parameters; defaults are the
targets the source states.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.operators.runs import with_percentile
from runledger.operators.skew import enrich

# Stated targets.
SUCCESS_RATE_TARGET = 0.95
ROLLBACK_RATE_TARGET = 0.10
P95_TARGET_MS = {"api": 500.0, "db": 100.0}
VARIANCE_TOLERANCES = (0.15, 0.20, 0.30)
REVIEW_MAX_MINUTES = 24 * 60
DEPLOY_MAX_MINUTES = 20
MAX_ITERATIONS = 3
# Retention in days (cold tier after, expire after); None = no such step.
RETENTION_POLICY = {"data": (90, 365), "logs": (None, 30), "audit": (None, 90)}
# Rotation period in days per secret kind; None = never rotated.
ROTATION_POLICY = {"db_credentials": 30, "api_keys": 90, "jwt_secret": None}
# Daily request quota per plan; None = unlimited.
DAILY_QUOTA = {"free": 100, "standard": 10000, "admin": None}
# Our scenario multipliers for the cost roll-up (the source gives totals, not factors).
COST_SCENARIOS = {"low": 0.5, "medium": 1.0, "high": 1.7}
SECRET_PATTERN = r'(?i)(token|secret|password|api[_-]?key)\s*[:=]\s*"[^"]{8,}"'

_OPS = {">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b,
        "<": lambda a, b: a < b, "==": lambda a, b: a == b}


def fk_violations(checks: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """J-16: one row per declared foreign key with its violation count.

    Each check is (name, child, child_col, parent, parent_col); null child keys do not
    violate. Child keys are counted first (map-side combine, so a hot key is one row
    before any shuffle), then anti-joined with the parent keys and summed.
    """
    out = None
    for name, child, ccol, parent, pcol in checks:
        keys = (child.select(F.col(ccol).alias("_k")).filter(F.col("_k").isNotNull())
                     .groupBy("_k").agg(F.count(F.lit(1)).alias("_n")))
        bad = keys.join(parent.select(F.col(pcol).alias("_k")), "_k", "left_anti")
        row = bad.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_violations")).select(F.lit(name).alias("fk"), "n_violations")
        out = row if out is None else out.unionByName(row)
    return out


def rate_metrics(df: DataFrame, group_cols: Sequence[str], success_col: str, rollback_col: str,
                 success_target: float = SUCCESS_RATE_TARGET, rollback_target: float = ROLLBACK_RATE_TARGET) -> DataFrame:
    """A-08: success and rollback rates against their targets."""
    agg = df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(F.col(success_col).cast("double")), 6).alias("success_rate"),
        F.round(F.avg(F.col(rollback_col).cast("double")), 6).alias("rollback_rate"))
    return agg.withColumn("meets_success", F.col("success_rate") >= success_target) \
              .withColumn("meets_rollback", F.col("rollback_rate") <= rollback_target)


def latency_gate(df: DataFrame, group_cols: Sequence[str], value_col: str, target) -> DataFrame:
    """A-09: exact p95 per group against a target; a group without values has no p95 and
    does not pass."""
    t = F.lit(target) if not isinstance(target, Column) else target
    agg = df.groupBy(*group_cols).agg(F.first(t, ignorenulls=True).alias("target"))
    out = with_percentile(agg, df, list(group_cols), value_col, 0.95, "p95")
    return out.select(*group_cols, "p95", "target",
                      F.coalesce(F.col("p95") <= F.col("target"), F.lit(False)).alias("passed"))


def evaluate_gates(measured: DataFrame, targets: DataFrame, run_cols: Sequence[str], environment: str,
                   runs: DataFrame | None = None) -> DataFrame:
    """A-10: each gate compares a measured metric to its target with its operator; a run
    passes when every applicable required or critical gate passes. Gates marked
    production-only apply only in production. Every run of ``measured``, and of ``runs`` where
    given (the runs that should have been measured), is held against every applicable gate: one
    that was not measured, or whose value is null, fails.

    Of repeated measurements of a metric the greatest counts. Passed gates are counted per
    run and compared with the number of gates, so runs x gates is never built.
    """
    gates = targets.filter(~F.col("production_only") | F.lit(environment == "production"))
    counts = F.col("required") | F.col("critical")
    total = gates.agg(F.count(F.lit(1))).scalar()
    needed = gates.agg(F.count_if(counts)).scalar()
    if runs is not None:  # a row of no metric makes a run known
        unmeasured = runs.select(*run_cols, F.lit(None).cast("string").alias("metric"), F.lit(None).cast("double").alias("value"))
        measured = measured.select(*run_cols, "metric", "value").unionByName(unmeasured)
    one = measured.groupBy(*run_cols, "metric").agg(F.max("value").alias("value"))
    ok = F.lit(None).cast("boolean")
    for op, fn in _OPS.items():
        ok = F.coalesce(ok, F.when(F.col("op") == op, fn(F.col("value"), F.col("target"))))
    ok = F.coalesce(ok, F.lit(False))
    per = one.join(gates, "metric", "left").groupBy(*run_cols).agg(
        F.count_if(ok).alias("_ok"), F.count_if(ok & counts).alias("_needed"))
    return per.select(*run_cols, total.alias("n_gates"), (total - F.col("_ok")).alias("n_failed"),
                      (F.col("_needed") == needed).alias("passed"))


def cost_rollup(usage: DataFrame, prices: DataFrame, key: str, qty_col: str, price_col: str,
                group_cols: Sequence[str], scenarios: Mapping[str, float] = COST_SCENARIOS) -> DataFrame:
    """A-11: monthly cost = usage x unit price (decimal), per group, with scenarios and
    the annual figure. Usage is summed per price key before the join, so the join sees
    one row per key and a hot key never shuffles raw rows."""
    u = usage.groupBy(key).agg(F.sum(F.col(qty_col).cast("decimal(18,2)")).alias("_qty"))
    j = u.join(prices.select(key, *group_cols, F.col(price_col).cast("decimal(18,2)").alias("_price")), key)
    monthly = F.sum(F.col("_qty") * F.col("_price"))
    agg = j.groupBy(*group_cols).agg(monthly.alias("_m"))
    cols = [F.col("_m").cast("double").alias("monthly")]
    cols += [(F.col("_m") * F.lit(f).cast("decimal(4,2)")).cast("double").alias(f"monthly_{s}") for s, f in scenarios.items()]
    cols.append((F.col("_m") * 12).cast("double").alias("annual"))
    return agg.select(*group_cols, *cols)


def variance(est: DataFrame, act: DataFrame, key: str, est_col: str, act_col: str,
             tolerances: Sequence[float] = VARIANCE_TOLERANCES) -> DataFrame:
    """A-12: |actual - estimate| / estimate per key, null when the estimate is 0, and
    one within-tolerance flag per tolerance."""
    j = est.join(act, key, "left")
    v = F.when(F.col(est_col) != 0, F.abs(F.col(act_col) - F.col(est_col)) / F.abs(F.col(est_col)))
    out = j.select(key, F.round(v, 6).alias("variance"))
    for t in tolerances:
        out = out.withColumn(f"within_{int(round(t * 100))}", F.col("variance") <= t)
    return out


def turnaround(df: DataFrame, run_cols: Sequence[str], ts_col: str) -> DataFrame:
    """A-13: duration in whole minutes and iterations per run against the stated limits."""
    mins = F.expr(f"timestampdiff(MICROSECOND, min({ts_col}), max({ts_col}))") / F.lit(60000000)
    agg = df.groupBy(*run_cols).agg(F.floor(mins).alias("minutes"), F.count(F.lit(1)).alias("iterations"))
    return (agg.withColumn("within_review", F.col("minutes") <= REVIEW_MAX_MINUTES)
               .withColumn("within_deploy", F.col("minutes") <= DEPLOY_MAX_MINUTES)
               .withColumn("within_iterations", F.col("iterations") <= MAX_ITERATIONS))


def adoption(active: DataFrame, user_col: str, base: DataFrame) -> DataFrame:
    """A-14: distinct active users over the target base (one row)."""
    a = active.agg(F.count_distinct(user_col).alias("n")).withColumn("k", F.lit("active"))
    b = base.agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit("base"))
    one = a.unionByName(b).agg(F.max(F.when(F.col("k") == "active", F.col("n"))).alias("active_users"),
                               F.max(F.when(F.col("k") == "base", F.col("n"))).alias("base_users"))
    return one.withColumn("adoption_rate", F.round(F.col("active_users") / F.col("base_users"), 6))


def unique_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A-16: key values that occur more than once, with their count."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def domain_violations(df: DataFrame, entity: str, rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """A-17: violations per (field, rule) in one pass: one ``count_if`` per rule, then
    the single result row is unpivoted. A rule's predicate is true for a violation."""
    aggs = [F.count_if(F.coalesce(pred, F.lit(False))).alias(f"_r{i}") for i, (_, _, pred) in enumerate(rules)]
    row = df.agg(*aggs)
    stack = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(r).alias("rule"), F.col(f"_r{i}").alias("n_violations"))
                      for i, (f, r, _) in enumerate(rules)])
    return row.select(F.inline(stack)).select(F.lit(entity).alias("entity"), "field", "rule", "n_violations")


def required(c: Column) -> Column:
    """A-17 rule: violated when the value is missing or empty."""
    return c.isNull() | (F.length(c.cast("string")) == 0)


def max_length(c: Column, n: int) -> Column:
    """A-17 rule: violated when longer than ``n`` characters."""
    return F.length(c) > n


def min_value(c: Column, v) -> Column:
    """A-17 rule: violated below ``v``."""
    return c < v


def max_value(c: Column, v) -> Column:
    """A-17 rule: violated above ``v``."""
    return c > v


def matches(c: Column, pattern: str) -> Column:
    """A-17 rule: violated when the value does not match ``pattern``."""
    return ~c.rlike(pattern)


def enum(c: Column, values: Sequence[str]) -> Column:
    """A-17 rule: violated outside the allowed values."""
    return ~c.isin(*values)


def secret_scan(docs: DataFrame, id_col: str, text_col: str, pattern: str = SECRET_PATTERN) -> DataFrame:
    """A-18: hard-coded secret hits per document (documents with at least one hit)."""
    hits = F.size(F.regexp_extract_all(F.col(text_col), F.lit(pattern), 0))
    return docs.select(id_col, hits.alias("n_hits")).filter(F.col("n_hits") > 0)


def retention(df: DataFrame, date_col: str, kind: str, as_of: str, policy: Mapping = RETENTION_POLICY) -> DataFrame:
    """A-20: keep / cold / expire by age in days at ``as_of`` (a parameter, never now)."""
    cold, expire = policy[kind]
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date(F.col(date_col)))
    cls = F.when(age > expire, F.lit("expire"))
    if cold is not None:
        cls = cls.when(age > cold, F.lit("cold"))
    return df.withColumn("age_days", age).withColumn("retention", cls.otherwise(F.lit("keep")))


def session_retention(df: DataFrame, expires_col: str, as_of: str) -> DataFrame:
    """A-20 (sessions): a session expires at its own timestamp, not by age; ``as_of`` is
    a wall-clock timestamp parameter."""
    at = F.lit(as_of).cast("timestamp_ntz")
    return df.withColumn("retention", F.when(F.col(expires_col) <= at, F.lit("expire")).otherwise(F.lit("keep")))


def overdue(df: DataFrame, kind_col: str, last_col: str, as_of: str, policy: Mapping = ROTATION_POLICY) -> DataFrame:
    """A-21: days since the last rotation against the kind's period; never-rotated kinds
    are never overdue."""
    m = F.create_map(*[x for k, v in policy.items() for x in (F.lit(k), F.lit(v).cast("int"))])
    limit = m[F.col(kind_col)]
    days = F.datediff(F.lit(as_of).cast("date"), F.to_date(F.col(last_col)))
    return df.withColumn("days_since", days).withColumn("period_days", limit) \
             .withColumn("overdue", F.coalesce(days > limit, F.lit(False)))


def sprint_load(df: DataFrame, sprint_col: str, points_col: str, velocity) -> DataFrame:
    """A-22: committed points per sprint against velocity."""
    agg = df.groupBy(sprint_col).agg(F.sum(F.col(points_col).cast("decimal(18,2)")).cast("double").alias("points"))
    return agg.withColumn("velocity", F.lit(float(velocity))) \
              .withColumn("overloaded", F.col("points") > F.col("velocity"))


def quota_limit(plan, limits: Mapping = DAILY_QUOTA) -> Column:
    """W-08: daily request limit of a plan (free, standard, admin); null = unlimited, and an
    unknown plan gets the smallest listed limit."""
    p = F.col(plan) if isinstance(plan, str) else plan
    finite = [v for v in limits.values() if v is not None]
    out = F.when(F.lit(False), F.lit(None).cast("int"))
    for name, v in limits.items():
        out = out.when(p == name, F.lit(v).cast("int"))
    return out.otherwise(F.lit(min(finite)).cast("int"))


def quota(df: DataFrame, run_cols: Sequence[str], limit_col: str) -> DataFrame:
    """W-08 (summary): the first ``limit`` requests of a user-day pass, the rest are
    rejected. Counting is enough for the split (min(n, limit)), so it aggregates
    map-side; a null limit means unlimited."""
    agg = df.groupBy(*run_cols).agg(F.count(F.lit(1)).alias("n_requests"), F.max(limit_col).alias("_lim"))
    allowed = F.when(F.col("_lim").isNull(), F.col("n_requests")).otherwise(F.least("n_requests", "_lim"))
    return agg.select(*run_cols, "n_requests", allowed.alias("n_allowed"),
                      (F.col("n_requests") - allowed).alias("n_rejected"))


def quota_of(requests: DataFrame, limits: DataFrame, run_cols: Sequence[str], key: str, limit_col: str = "lim") -> DataFrame:
    """W-08 from the limits table (one row per ``key`` counts: the greatest): requests are counted
    per ``run_cols`` first, so a user's limit is joined to its days, not to its requests."""
    counts = requests.groupBy(*run_cols).agg(F.count(F.lit(1)).alias("n_requests"))
    one = limits.groupBy(key).agg(F.max(limit_col).alias("_lim"))
    allowed = F.when(F.col("_lim").isNull(), F.col("n_requests")).otherwise(F.least("n_requests", "_lim"))
    return enrich(counts, one, [key]).select(*run_cols, "n_requests", allowed.alias("n_allowed"),
                                             (F.col("n_requests") - allowed).alias("n_rejected"))


def quota_rows(df: DataFrame, run_cols: Sequence[str], order_cols: Sequence[str], limit_col: str) -> DataFrame:
    """W-08 (row form): each request marked allowed or rejected in arrival order."""
    w = Window.partitionBy(*run_cols).orderBy(*order_cols)
    rn = F.row_number().over(w)
    return df.withColumn("allowed", F.col(limit_col).isNull() | (rn <= F.col(limit_col)))


def top_k_per_group(df: DataFrame, keys: Sequence[str], rank_cols: Sequence[Column], k: int = 10) -> DataFrame:
    """W-10: first k rows per group by a total order (``row_number() <= k`` lets Spark
    keep only k rows per group on the map side)."""
    w = Window.partitionBy(*keys).orderBy(*rank_cols)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
