"""Lookups, reconciliation and upserts (J-01, J-02, J-04..06, J-11, J-12, U-02..05, U-07).

Joins are equi joins; Catalyst/AQE pick broadcast or sort-merge from size estimates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.operators.runs import first_row, latest

# Model per slash command and model set.
ROUTING_RULES = (
    ("/classify_issue", "base", "sonnet"), ("/classify_issue", "heavy", "sonnet"),
    ("/classify_adw", "base", "sonnet"), ("/classify_adw", "heavy", "sonnet"),
    ("/generate_branch_name", "base", "sonnet"), ("/generate_branch_name", "heavy", "sonnet"),
    ("/implement", "base", "sonnet"), ("/implement", "heavy", "opus"),
    ("/test", "base", "sonnet"), ("/test", "heavy", "sonnet"),
    ("/resolve_failed_test", "base", "sonnet"), ("/resolve_failed_test", "heavy", "opus"),
    ("/test_e2e", "base", "sonnet"), ("/test_e2e", "heavy", "sonnet"),
    ("/resolve_failed_e2e_test", "base", "sonnet"), ("/resolve_failed_e2e_test", "heavy", "opus"),
    ("/review", "base", "sonnet"), ("/review", "heavy", "sonnet"),
    ("/document", "base", "sonnet"), ("/document", "heavy", "opus"),
    ("/commit", "base", "sonnet"), ("/commit", "heavy", "sonnet"),
    ("/pull_request", "base", "sonnet"), ("/pull_request", "heavy", "sonnet"),
    ("/chore", "base", "sonnet"), ("/chore", "heavy", "opus"),
    ("/bug", "base", "sonnet"), ("/bug", "heavy", "opus"),
    ("/feature", "base", "sonnet"), ("/feature", "heavy", "opus"),
    ("/patch", "base", "sonnet"), ("/patch", "heavy", "opus"),
    ("/install_worktree", "base", "sonnet"), ("/install_worktree", "heavy", "sonnet"),
    ("/track_agentic_kpis", "base", "sonnet"), ("/track_agentic_kpis", "heavy", "sonnet"),
)
DEFAULT_MODEL = "sonnet"


def routing_rules(spark) -> DataFrame:
    """J-01: the fixed routing table as a small constant relation."""
    from runledger.session import constant_table
    return constant_table(spark, ROUTING_RULES, "command string, model_set string, model string")


def route(df: DataFrame, rules: DataFrame, command_col: str = "command", set_col: str = "model_set",
          default: str = DEFAULT_MODEL) -> DataFrame:
    """J-01: model for (command, model set); else the command's base model; else default.
    A missing model set means ``base``."""
    ms = F.coalesce(F.col(set_col), F.lit("base"))
    exact = rules.select(F.col("command").alias("_c1"), F.col("model_set").alias("_s1"), F.col("model").alias("_m1"))
    base = rules.filter(F.col("model_set") == "base").select(F.col("command").alias("_c2"), F.col("model").alias("_m2"))
    out = (df.withColumn("_ms", ms)
             .join(exact, (F.col(command_col) == F.col("_c1")) & (F.col("_ms") == F.col("_s1")), "left")
             .join(base, F.col(command_col) == F.col("_c2"), "left"))
    return out.withColumn("model", F.coalesce("_m1", "_m2", F.lit(default))) \
              .drop("_c1", "_s1", "_m1", "_c2", "_m2", "_ms")


def missing(required: DataFrame, present: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """J-02: required rows with no present partner (left anti join)."""
    return required.join(present.select(*([on] if isinstance(on, str) else on)).distinct(), on, "left_anti")


def reconcile(expected: DataFrame, observed: DataFrame, on: Sequence[str] | str,
              expected_status: str = "expected_status", observed_status: str = "status") -> DataFrame:
    """J-04: each expected row is ``not_found``, ``wrong_status`` or ``ok``."""
    j = expected.join(observed, on, "left")
    res = (F.when(F.col(observed_status).isNull(), "not_found")
            .when(F.col(observed_status) != F.col(expected_status), "wrong_status").otherwise("ok"))
    return j.withColumn("result", res)


def reconcile3(base: DataFrame, b: DataFrame, c: DataFrame, on: Sequence[str] | str,
               reasons: tuple[Column, Column, Column]) -> DataFrame:
    """J-05: three-source consistency, first failing reason wins.

    ``base`` carries the first check as a boolean column ``in_a``; ``b`` and ``c`` are
    key sets (semi-join style flags). ``reasons`` are the three failure texts.
    """
    on = [on] if isinstance(on, str) else list(on)
    fb = b.select(*on).distinct().withColumn("_in_b", F.lit(True))
    fc = c.select(*on).distinct().withColumn("_in_c", F.lit(True))
    j = base.join(fb, on, "left").join(fc, on, "left")
    reason = (F.when(~F.col("in_a"), reasons[0]).when(F.col("_in_b").isNull(), reasons[1])
               .when(F.col("_in_c").isNull(), reasons[2]))
    return j.select(*on, reason.isNull().alias("valid"), reason.alias("error")).drop("_in_b", "_in_c")


def lookup_first(requests: DataFrame, items: DataFrame, key: str, position_col: str,
                 value_cols: Sequence[str]) -> DataFrame:
    """J-06: for each requested key the first item in source order (null when none).

    First-per-key is a partial aggregate (min over a struct), not a full sort."""
    firsts = first_row(items, key, [position_col], list(value_cols))
    return requests.join(firsts, key, "left")


def match_branches(branches: DataFrame, issues: DataFrame, branch_col: str = "branch",
                   number_col: str = "number") -> DataFrame:
    """J-11: branch to issue by the ``-issue-N-`` substring, as parse + equi join.

    The substring test becomes an extracted number, so the planner uses a hash or
    sort-merge join instead of a nested loop. Of several matches the smallest name is
    kept (the source keeps the first listed, which depends on listing order).
    """
    b = branches.select(F.col(branch_col).alias("branch"),
                        F.regexp_extract(F.col(branch_col), r"-issue-(\d+)-", 1).alias("_n"))
    b = b.filter(F.col("_n") != "").select("branch", F.col("_n").cast("long").alias(number_col))
    best = b.groupBy(number_col).agg(F.min("branch").alias("branch"))  # partial aggregation before the join
    return issues.join(best, number_col, "left")


def first_of(keys: DataFrame, sources: Sequence[DataFrame], key: str, value_col: str = "path") -> DataFrame:
    """J-12: fallback chain; the first source with a value wins, ties by the smallest value.

    All sources are unioned with their rank and reduced by one ``min(struct(rank,
    value))`` per key (one shuffle, partial aggregation), then joined to the keys.
    """
    ranked = None
    for i, s in enumerate(sources):
        r = s.select(key, F.struct(F.lit(i).alias("source"), F.col(value_col).alias("v")).alias("_p")) \
             .filter(F.col(value_col).isNotNull())
        ranked = r if ranked is None else ranked.unionByName(r)
    best = ranked.groupBy(key).agg(F.min("_p").alias("_b"))
    return keys.join(best, key, "left").select(*keys.columns, F.col("_b.v").alias(value_col),
                                               F.col("_b.source").alias("source"))


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """U-02: whole-record upsert: a source row replaces the target row with its key,
    new keys are appended."""
    keys = [key] if isinstance(key, str) else list(key)
    t = target.withColumn("_prio", F.lit(0))
    s = source.withColumn("_prio", F.lit(1))
    cols = [c for c in target.columns if c not in keys]
    return latest(t.unionByName(s), keys, ["_prio"], cols).drop("_prio")


def upsert_cols(target: DataFrame, source: DataFrame, key: Sequence[str] | str, cols: Sequence[str]) -> DataFrame:
    """U-03: partial upsert: ``cols`` come from the source when it has the key, all
    other columns are kept; source-only keys are appended with what they carry."""
    keys = [key] if isinstance(key, str) else list(key)
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cols]).withColumn("_hit", F.lit(True))
    j = target.withColumn("_tgt", F.lit(True)).join(s, keys, "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in cols:
            out.append(F.when(F.col("_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def merge_attrs(df: DataFrame, run_cols: Sequence[str], order_cols: Sequence[str], map_col: str) -> DataFrame:
    """U-04: shallow merge of attribute maps in order (later value wins per key).

    Folding ``map_concat`` over a run is the same as last-writer-wins per (run, key),
    which aggregates partially; the final map per run is bounded by its key count.
    """
    e = df.select(*run_cols, *order_cols, F.explode(map_col).alias("k", "v"))
    last = latest(e, [*run_cols, "k"], list(order_cols), ["v"])
    return last.groupBy(*run_cols).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias(map_col))


def union_suites(unit: DataFrame, e2e: DataFrame) -> DataFrame:
    """U-05: concatenate suites, columns aligned by name, missing ones null."""
    return unit.withColumn("suite", F.lit("unit")).unionByName(e2e.withColumn("suite", F.lit("e2e")),
                                                                allowMissingColumns=True)


def append_results(df: DataFrame, path: str, partition_cols: Sequence[str] = (), batch_col: str | None = None) -> None:
    """U-07: append a batch to the run-history table (Parquet, optional partitioning).

    With ``batch_col`` the write is idempotent: the batch's own partition is overwritten
    (dynamic partition overwrite), so re-running a batch after a failure replaces its
    rows instead of adding them twice. Without it, a plain append.
    """
    if batch_col:
        cols = [batch_col, *[c for c in partition_cols if c != batch_col]]
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(*cols).parquet(path))
        return
    w = df.write.mode("append")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
