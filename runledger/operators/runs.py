"""Run-level ordered operators and aggregates (attempts, latest state, counts, KPIs).

Ordering rules are always total: every ``order_cols`` list should end in a unique id.
Per-run "first/last" questions use ``max``/``min`` over structs, which aggregate
partially on the map side, so a hot run never lands whole in one task. Where a
rank is needed (first k attempts), ``row_number() <= k`` lets Spark insert a
map-side ``WindowGroupLimit`` so at most k rows per run cross the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.session import cut_lineage

# Retry limits per loop kind (unit tests, E2E tests, review, infra tests).
MAX_ATTEMPTS = {"unit": 4, "e2e": 2, "review": 3, "infra": 2}
# Retry delays in seconds; beyond the list each delay grows by 2.
RETRY_DELAYS = (1, 3, 5)


def _cols(cols: Sequence[str] | str) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def latest(df: DataFrame, keys: Sequence[str] | str, order_cols: Sequence[str],
           value_cols: Sequence[str] | None = None) -> DataFrame:
    """W-07: last writer wins per key (the row with the greatest ``order_cols``)."""
    keys, order_cols = _cols(keys), list(order_cols)
    value_cols = [c for c in (value_cols or df.columns) if c not in keys and c not in order_cols]
    best = F.max(F.struct(*order_cols, *value_cols)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_best." + c).alias(c)
                                                       for c in order_cols + value_cols])


def first_row(df: DataFrame, keys: Sequence[str] | str, order_cols: Sequence[str],
              value_cols: Sequence[str] | None = None) -> DataFrame:
    """Mirror of :func:`latest`: the row with the smallest ``order_cols`` per key."""
    keys, order_cols = _cols(keys), list(order_cols)
    value_cols = [c for c in (value_cols or df.columns) if c not in keys and c not in order_cols]
    best = F.min(F.struct(*order_cols, *value_cols)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_best." + c).alias(c)
                                                       for c in order_cols + value_cols])


def last_result(messages: DataFrame, run_cols: Sequence[str] | str = "run_id",
                seq_col: str = "seq", type_col: str = "type", result_type: str = "result",
                value_cols: Sequence[str] = ("result",)) -> DataFrame:
    """W-01: the last message of type ``result`` per run (runs without one are absent)."""
    only = messages.filter(F.col(type_col) == result_type)
    return latest(only, run_cols, [seq_col], value_cols)


def tail_error(messages: DataFrame, run_cols: Sequence[str] | str = "run_id",
               seq_col: str = "seq", type_col: str = "type", text_col: str = "text",
               n: int = 5, require_words: bool = True, prefix: str = "") -> DataFrame:
    """W-02: newest assistant text among the last ``n`` messages of a run.

    ``require_words`` keeps only texts containing "error" or "failed" (any case), the
    failed-run variant; without it any non-empty assistant text counts (the no-result
    variant). The text is cut to its first 500 characters.
    """
    run_cols = _cols(run_cols)
    w = Window.partitionBy(*run_cols).orderBy(F.col(seq_col).desc())
    tail = (messages.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n))
    cond = (F.col(type_col) == "assistant") & (F.coalesce(F.length(text_col), F.lit(0)) > 0)
    if require_words:
        low = F.lower(F.col(text_col))
        cond = cond & (low.contains("error") | low.contains("failed"))
    hits = tail.filter(cond).select(*run_cols, seq_col,
                                    F.concat(F.lit(prefix), F.substring(text_col, 1, 500)).alias("error_text"))
    return latest(hits, run_cols, [seq_col], ["error_text"])


def ordered(df: DataFrame, ts_col: str, tie_cols: Sequence[str]) -> DataFrame:
    """W-04: order by timestamp with missing timestamps first, then a unique tie key."""
    return df.orderBy(F.col(ts_col).asc_nulls_first(), *[F.col(c).asc() for c in tie_cols])


def attempt_rows(df: DataFrame, run_cols: Sequence[str] | str, order_cols: Sequence[str],
                 failed_col: str, max_attempts: int = MAX_ATTEMPTS["unit"],
                 error_col: str | None = None, resolved_col: str | None = None) -> DataFrame:
    """W-05 (row form): number attempts per run, keep attempts up to the first stop.

    Stop reasons, checked in this order for each attempt: ``run_error`` (the run itself
    failed), ``passed`` (zero failures), ``max_attempts`` (the limit is a true limit),
    ``no_resolution`` (nothing was resolved after a failed attempt).
    """
    run_cols = _cols(run_cols)
    w = Window.partitionBy(*run_cols).orderBy(*order_cols)
    numbered = (df.withColumn("attempt", F.row_number().over(w))
                  .filter(F.col("attempt") <= max_attempts))
    reason = F.when(F.lit(False), F.lit(None))
    if error_col:
        reason = reason.when(F.col(error_col), "run_error")
    reason = reason.when(~F.col(failed_col), "passed").when(F.col("attempt") == max_attempts, "max_attempts")
    if resolved_col:
        reason = reason.when(~F.col(resolved_col), "no_resolution")
    numbered = numbered.withColumn("stop_reason", reason)
    cut = F.min(F.when(F.col("stop_reason").isNotNull(), F.col("attempt"))).over(Window.partitionBy(*run_cols))
    return (numbered.withColumn("_cut", cut)
                    .filter(F.col("attempt") <= F.coalesce(F.col("_cut"), F.lit(max_attempts)))
                    .drop("_cut"))


def attempts(df: DataFrame, run_cols: Sequence[str] | str, order_cols: Sequence[str],
             failed_col: str, max_attempts: int = MAX_ATTEMPTS["unit"],
             error_col: str | None = None, resolved_col: str | None = None) -> DataFrame:
    """W-05 (run form): attempts used, failed attempts, final outcome and stop reason.

    The final outcome is the last kept attempt; a run error is ``error``, never passed
    (even with zero failures counted). A run whose data ends before any stop gets stop
    reason ``incomplete``.
    """
    run_cols = _cols(run_cols)
    rows = attempt_rows(df, run_cols, order_cols, failed_col, max_attempts, error_col, resolved_col)
    last = F.max(F.struct("attempt", F.col(failed_col).alias("failed"), "stop_reason")).alias("_last")
    return (rows.groupBy(*run_cols)
                .agg(F.count(F.lit(1)).alias("attempts"),
                     F.count_if(F.col(failed_col)).alias("failed_attempts"), last)
                .select(*run_cols, "attempts", "failed_attempts",
                        F.when(F.col("_last.stop_reason") == "run_error", "error")
                         .when(F.col("_last.failed"), "failed").otherwise("passed").alias("final_status"),
                        F.coalesce(F.col("_last.stop_reason"), F.lit("incomplete")).alias("stop_reason")))


def retry_delay(k: Column) -> Column:
    """W-06: delay before retry ``k`` (1-based): 1, 3, 5, then +2 each."""
    listed = F.array(*[F.lit(d) for d in RETRY_DELAYS])
    n = len(RETRY_DELAYS)
    return F.when(k <= 0, F.lit(0)).when(k <= n, F.element_at(listed, k.cast("int"))) \
            .otherwise(F.lit(RETRY_DELAYS[-1]) + 2 * (k - n))


def total_backoff(retries: Column) -> Column:
    """W-06: total wait over ``retries`` retries, closed form (no per-retry rows)."""
    n = len(RETRY_DELAYS)
    prefix = F.array(*[F.lit(sum(RETRY_DELAYS[:i + 1])) for i in range(n)])
    extra = retries - n
    return (F.when(retries <= 0, F.lit(0))
             .when(retries <= n, F.element_at(prefix, retries.cast("int")))
             .otherwise(F.lit(sum(RETRY_DELAYS)) + extra * RETRY_DELAYS[-1] + extra * (extra + 1)))


def backoff(runs: DataFrame, attempts_col: str = "attempts") -> DataFrame:
    """W-06 on a run table: retries = attempts - 1, delay of the last retry, total wait."""
    r = F.col(attempts_col) - 1
    return runs.withColumn("retries", r).withColumn("last_delay_s", retry_delay(r)) \
               .withColumn("total_wait_s", total_backoff(r))


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """W-09: first k rows by a total order (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def test_counts(df: DataFrame, run_cols: Sequence[str] | str, passed_col: str = "passed",
                parse_ok_col: str | None = None) -> DataFrame:
    """A-01: passed, failed and total per run, plus ``parse_ok`` and a status.

    Rows with a null ``passed`` (unparseable output) count nowhere, as in the source,
    but the run reports ``parse_ok = false`` and status ``unknown`` instead of passed.
    """
    run_cols = _cols(run_cols)
    ok = F.col(parse_ok_col) if parse_ok_col else F.col(passed_col).isNotNull()
    agg = df.groupBy(*run_cols).agg(
        F.count_if(F.col(passed_col)).alias("passed"),
        F.count_if(~F.col(passed_col)).alias("failed"),
        F.count(F.col(passed_col)).alias("total"),
        F.bool_and(ok).alias("parse_ok"))
    status = (F.when(~F.col("parse_ok") | (F.col("total") == 0), "unknown")
               .when(F.col("failed") > 0, "failed").otherwise("passed"))
    return agg.withColumn("status", status)


# Review severities in the code's domain, most severe first.
SEVERITIES = ("blocker", "tech_debt", "skippable")


def severity_counts(df: DataFrame, run_cols: Sequence[str] | str, sev_col: str = "issue_severity",
                    domain: Sequence[str] = SEVERITIES) -> DataFrame:
    """A-02: finding counts per severity as columns; values outside the domain counted apart."""
    run_cols = _cols(run_cols)
    aggs = [F.count_if(F.col(sev_col) == s).alias(f"n_{s}") for s in domain]
    aggs.append(F.count_if(~F.col(sev_col).isin(*domain)).alias("n_out_of_domain"))
    aggs.append(F.count(F.lit(1)).alias("n_issues"))
    return df.groupBy(*run_cols).agg(*aggs)


def suite_summary(unit: DataFrame, e2e: DataFrame, run_cols: Sequence[str] | str,
                  passed_col: str = "passed") -> DataFrame:
    """A-03/U-05: union both suites, count per suite and give one overall status."""
    run_cols = _cols(run_cols)
    both = unit.withColumn("suite", F.lit("unit")).unionByName(
        e2e.withColumn("suite", F.lit("e2e")), allowMissingColumns=True)
    agg = both.groupBy(*run_cols).agg(
        *[F.count_if((F.col("suite") == s) & F.col(passed_col)).alias(f"{s}_passed") for s in ("unit", "e2e")],
        *[F.count_if((F.col("suite") == s) & ~F.col(passed_col)).alias(f"{s}_failed") for s in ("unit", "e2e")])
    failures = F.col("unit_failed") + F.col("e2e_failed")
    return agg.withColumn("total_failures", failures) \
              .withColumn("overall_status", F.when(failures > 0, "failed").otherwise("passed"))


def health(df: DataFrame, group_cols: Sequence[str] | str, ok_col: str, expected: DataFrame | None = None) -> DataFrame:
    """A-04: all-healthy flag per group; an empty group is unhealthy.

    With ``expected`` (the groups that should exist), a group without any item is
    reported with zero counts and ``all_healthy = false``. Counts only: per-item
    messages are rows (``health_messages``), not one joined string, so a group of any
    size stays distributed.
    """
    group_cols = _cols(group_cols)
    agg = df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_if(~F.col(ok_col)).alias("n_unhealthy"),
        F.coalesce(F.bool_and(F.col(ok_col)) & (F.count(F.lit(1)) > 0), F.lit(False)).alias("all_healthy"))
    if expected is None:
        return agg
    return (expected.select(*group_cols).distinct().join(agg, group_cols, "left")
                    .select(*group_cols, F.coalesce("n_items", F.lit(0)).alias("n_items"),
                            F.coalesce("n_unhealthy", F.lit(0)).alias("n_unhealthy"),
                            F.coalesce("all_healthy", F.lit(False)).alias("all_healthy")))


def health_messages(df: DataFrame, group_cols: Sequence[str] | str, ok_col: str,
                    message: Column) -> DataFrame:
    """A-04: one message row per unhealthy item."""
    return df.filter(~F.col(ok_col)).select(*_cols(group_cols), message.alias("message"))


def resolution_counts(df: DataFrame, run_cols: Sequence[str] | str, iter_col: str,
                      resolved_col: str) -> DataFrame:
    """A-05: resolved/unresolved per iteration, keeping iterations up to the first one
    that resolved nothing (the loop stops there)."""
    run_cols = _cols(run_cols)
    per_iter = df.groupBy(*run_cols, iter_col).agg(
        F.count_if(F.col(resolved_col)).alias("resolved"),
        F.count_if(~F.col(resolved_col)).alias("unresolved"))
    w = Window.partitionBy(*run_cols).orderBy(iter_col).rowsBetween(Window.unboundedPreceding, -1)
    stopped_before = F.coalesce(F.max((F.col("resolved") == 0).cast("int")).over(w), F.lit(0))
    return per_iter.withColumn("_s", stopped_before).filter(F.col("_s") == 0).drop("_s") \
                   .withColumn("stop_here", F.col("resolved") == 0)


def phase_matrix(df: DataFrame, run_cols: Sequence[str] | str, phase_col: str,
                 completed_col: str, phases: Sequence[str], failed_col: str | None = None) -> DataFrame:
    """A-06: one column per phase (max completed; null when never seen) and counters.

    ``phases`` is a fixed list so the pivot needs no extra distinct job.
    """
    run_cols = _cols(run_cols)
    aggs = [F.max(F.when(F.col(phase_col) == p, F.col(completed_col))).alias(f"phase_{p}") for p in phases]
    aggs.append(F.count_if(F.col(completed_col)).alias("n_completed"))
    if failed_col:
        aggs.append(F.count_if(F.col(failed_col)).alias("n_failed"))
    return df.groupBy(*run_cols).agg(*aggs)


def exact_percentile(df: DataFrame, group_cols: Sequence[str] | str, value_col: str, q: float,
                     out_col: str) -> DataFrame:
    """The smallest value whose rank reaches ``q`` of a group's non-null rows, exact at
    every size: values are counted first (map-side), then ranked (:func:`percentile_of_counts`)."""
    g = _cols(group_cols)
    counts = df.groupBy(*g, F.col(value_col).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    return percentile_of_counts(counts, g, "_v", "_c", q, out_col)


def percentile_of_counts(counts: DataFrame, group_cols: Sequence[str] | str, value_col: str, count_col: str,
                         q: float, out_col: str) -> DataFrame:
    """The percentile of counted values (one row per group and value, nulls left out): ranks come
    from prefix sums of the counts over range partitions, so a hot group is never held or
    sorted in one task."""
    g = _cols(group_cols)
    rows = counts.filter(F.col(value_col).isNotNull()).select(*g, F.col(value_col).alias("_v"), F.col(count_col).alias("_c"))
    n = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = cut_lineage(rows.repartitionByRange(n, *g, "_v").withColumn("_pid", F.spark_partition_id()))
    sums = part.groupBy(*g, "_pid").agg(F.sum("_c").alias("_s"))
    w = Window.partitionBy(*g).orderBy("_pid")
    whole = Window.partitionBy(*g)
    base = sums.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(g)], F.col("_pid").alias("_p"), "_s",
                       (F.sum("_s").over(w) - F.col("_s")).alias("_before"), F.sum("_s").over(whole).alias("_all"))
    need = F.ceil(F.col("_all") * F.lit(q))
    # only the partition in which the rank falls is sorted
    at = base.filter((F.col("_before") < need) & (F.col("_before") + F.col("_s") >= need)).drop("_s")
    rows = part.join(at, _all_equal([(c, f"_g{i}") for i, c in enumerate(g)] + [("_pid", "_p")]))
    run = F.col("_before") + F.sum("_c").over(Window.partitionBy(*g).orderBy("_v"))
    return rows.withColumn("_run", run).filter(F.col("_run") >= need).groupBy(*g).agg(F.min("_v").alias(out_col))


def _all_equal(pairs: Sequence[tuple[str, str]]) -> Column:
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def with_percentile(agg: DataFrame, df: DataFrame, group_cols: Sequence[str] | str, value_col: str, q: float,
                    out_col: str) -> DataFrame:
    """``agg`` (one row per group) with the group's exact percentile; null where a group has no value."""
    return attach(agg, exact_percentile(df, group_cols, value_col, q, out_col), _cols(group_cols))


def attach(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Left join on ``cols`` where null equals null, without repeating them."""
    other = right.withColumnsRenamed({c: f"_k{i}" for i, c in enumerate(cols)})
    return left.join(other, _all_equal([(c, f"_k{i}") for i, c in enumerate(cols)]), "left").drop(*[f"_k{i}" for i in range(len(cols))])


def run_kpis(df: DataFrame, group_cols: Sequence[str] | str, cost_col: str, duration_col: str,
             error_col: str, api_duration_col: str | None = None, turns_col: str | None = None) -> DataFrame:
    """A-07: cost (exact decimal sum), wall time average and exact p95, error rate per group, and where
    their columns are named, API time (average) and turns (total)."""
    group_cols = _cols(group_cols)
    more = []
    if api_duration_col:
        more.append(F.round(F.avg(api_duration_col), 4).alias("avg_api_duration"))
    if turns_col:
        more.append(F.sum(F.col(turns_col).cast("long")).alias("n_turns"))
    agg = df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.sum(F.col(cost_col).cast("decimal(18,2)")).cast("double").alias("total_cost"),
        F.round(F.avg(duration_col), 4).alias("avg_duration"),
        F.round(F.avg(F.col(error_col).cast("double")), 6).alias("error_rate"), *more)
    out = with_percentile(agg, df, group_cols, duration_col, 0.95, "p95_duration")
    return out.select(*group_cols, "n_runs", "total_cost", "avg_duration", "p95_duration", "error_rate",
                      *[c for c in ("avg_api_duration", "n_turns") if c in out.columns])


def stable_bucket(id_col: Column, n: int = 15) -> Column:
    """FN-13: base-36 value of the alphanumerics among the first 8 characters, mod n.

    ASCII alphanumerics only (Spark ``conv`` stops at the first bad character); ids
    without any get ``pmod(xxhash64(id), n)``, a stable replacement for a salted hash.
    """
    chars = F.regexp_replace(F.substring(id_col, 1, 8), "[^0-9A-Za-z]", "")
    as_num = F.conv(chars, 36, 10).cast("decimal(20,0)")
    return F.when(F.length(chars) > 0, F.pmod(as_num, F.lit(n)).cast("int")) \
            .otherwise(F.pmod(F.xxhash64(id_col), F.lit(n)).cast("int"))


# Base ports of the backend and frontend slots.
BACKEND_PORT_BASE, FRONTEND_PORT_BASE = 9100, 9200


def ports(id_col: Column, n: int = 15) -> tuple[Column, Column]:
    """FN-13: backend and frontend port of a run id's slot."""
    b = stable_bucket(id_col, n)
    return (F.lit(BACKEND_PORT_BASE) + b).alias("backend_port"), (F.lit(FRONTEND_PORT_BASE) + b).alias("frontend_port")


def bucket_load(df: DataFrame, bucket_col: str = "bucket") -> DataFrame:
    """A-19: ids per slot and the collisions that follow (ids beyond the first)."""
    return df.groupBy(bucket_col).agg(F.count(F.lit(1)).alias("n_ids")) \
             .withColumn("collisions", F.col("n_ids") - 1)


def ordered_positions(df: DataFrame, key_cols: Sequence[str] | str, order_cols: Sequence[str],
                      n_partitions: int | None = None, position_col: str = "position") -> DataFrame:
    """W-04 at scale: 1-based position of each row inside its key, in ``order_cols`` order
    (a total order), without putting a hot key in one task.

    Rows are range-partitioned on (key, order), so a hot key spans many partitions, and
    written once to the checkpoint folder with their partition number and sequence. Row
    and (partition, key) counts are both read from that one frame: range bounds are
    sampled, so evaluating the partitioning twice could cut the rows differently. A
    position is the offset inside the partition plus the key's rows in earlier ones.
    """
    keys = _cols(key_cols)
    n = n_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = cut_lineage(df.repartitionByRange(n, *keys, *order_cols).sortWithinPartitions(*keys, *order_cols)
                      .withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()))
    counts = s.groupBy("_pid", *keys).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    offsets = offsets.withColumnsRenamed({c: f"_o_{c}" for c in ["_pid", *keys]})
    same = F.col("_pid") == F.col("_o__pid")
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    return (s.join(offsets, same)
             .withColumn(position_col, F.col("_mid") - F.col("_first") + 1 + F.col("_before"))
             .select(*df.columns, position_col))


def running_total(df: DataFrame, key_cols: Sequence[str] | str, order_cols: Sequence[str], value: Column,
                  out_col: str, n_partitions: int | None = None) -> DataFrame:
    """Sum of ``value`` (a long, not null) over the rows of the same key that come before, in
    ``order_cols`` order (a total order); a hot key spans many tasks, as in :func:`ordered_positions`."""
    keys = _cols(key_cols)
    n = n_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = cut_lineage(df.withColumn("_w", value.cast("long")).repartitionByRange(n, *keys, *order_cols)
                      .withColumn("_pid", F.spark_partition_id()))
    sums = s.groupBy("_pid", *keys).agg(F.sum("_w").alias("_s"))
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_pid", *keys, F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_shift"))
    here = F.sum("_w").over(Window.partitionBy("_pid", *keys).orderBy(*order_cols)) - F.col("_w")  # keys of one partition
    return attach(s.withColumn("_here", here), offsets, ["_pid", *keys]).withColumn(out_col, F.col("_here") + F.col("_shift")) \
        .select(*df.columns, out_col)


def latest_mention(comments: DataFrame, keyword: str, run_cols: Sequence[str] | str = "number",
                   body_col: str = "body", order_cols: Sequence[str] = ("created_at", "id")) -> DataFrame:
    """W-03: the newest comment per issue that is not bot-tagged and contains ``keyword``
    (ties broken by the id); issues without one are absent."""
    from runledger.operators.filters import human_mentions
    hits = human_mentions(comments, keyword, body_col)
    return latest(hits, run_cols, list(order_cols), [c for c in comments.columns
                                                    if c not in _cols(run_cols) and c not in order_cols])


def ordered_comments(df: DataFrame, key_cols: Sequence[str] | str, ts_col: str, tie_cols: Sequence[str]) -> DataFrame:
    """W-04: position of each comment in its issue, missing timestamps first, then the
    tie key (skew-safe, see :func:`ordered_positions`)."""
    return ordered_positions(df, key_cols, [F.col(ts_col).asc_nulls_first(), *[F.col(c) for c in tie_cols]])
