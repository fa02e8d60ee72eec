"""Run state and outcome functions (FN-09, FN-14, FN-15, FN-21)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.functions.text import error_text, extract_json, truncate_text
from runledger.operators.runs import latest

# Workflow commands accepted from the classifier.
WORKFLOWS = ("adw_plan_iso", "adw_patch_iso", "adw_build_iso", "adw_test_iso", "adw_review_iso",
             "adw_document_iso", "adw_ship_iso", "adw_sdlc_ZTE_iso", "adw_plan_build_iso",
             "adw_plan_build_test_iso", "adw_plan_build_test_review_iso", "adw_plan_build_document_iso",
             "adw_plan_build_review_iso", "adw_sdlc_iso")
# Outcome texts and retry codes.
NO_RESULT = "No result message found in Claude Code output"
EXEC_ERROR = "Error during execution: Agent encountered an error and did not return a result"
TIMEOUT_TEXT = "Error: Claude Code command timed out after 5 minutes"
EXCEPTION_PREFIX = "Error executing Claude Code: "
UNKNOWN_ERROR = "Unknown error"
RETRY_CODES = ("claude_code_error", "timeout_error", "execution_error", "error_during_execution", "none")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def extract_workflow(text, allowed: Sequence[str] | None = None) -> Column:
    """FN-09: struct(workflow_command, run_id, model_set) from classifier output.

    The command loses every ``/``; only allowed commands are kept, otherwise all
    fields are empty with model set ``base``. A missing model set is ``base``.
    """
    allowed = WORKFLOWS if allowed is None else allowed
    j = extract_json(text)
    cmd = F.replace(F.coalesce(F.get_json_object(j, "$.adw_slash_command"), F.lit("")), F.lit("/"), F.lit(""))
    ok = (F.length(cmd) > 0) & cmd.isin(*allowed)
    return F.struct(F.when(ok, cmd).alias("workflow_command"),
                    F.when(ok, F.get_json_object(j, "$.adw_id")).alias("run_id"),
                    F.when(ok, F.coalesce(F.get_json_object(j, "$.model_set"), F.lit("base"))).otherwise(F.lit("base"))
                    .alias("model_set"))


def get_path(state_json, path: str, default=None, core: Mapping[str, Column] | None = None) -> Column:
    """FN-14: dotted-path lookup in a state document with a default.

    A core attribute named exactly ``path`` wins; a missing key, a JSON null or a
    non-object on the way gives the default (null -> default is our fix).
    """
    if core and path in core:
        return F.coalesce(core[path], F.lit(default)) if default is not None else core[path]
    v = F.get_json_object(_c(state_json), "$." + path)
    return F.coalesce(v, F.lit(default)) if default is not None else v


def allowlist_map(m, keys: Sequence[str], aliases: Mapping[str, str] | None = None) -> Column:
    """FN-15: keep the named keys whose value is not null, then add alias copies."""
    allowed = F.array(*[F.lit(k) for k in keys])
    kept = F.map_filter(_c(m), lambda k, v: F.array_contains(allowed, k) & v.isNotNull())
    for src, dst in (aliases or {}).items():
        extra = F.map_filter(kept, lambda k, v: k == F.lit(src))
        base = F.map_filter(kept, lambda k, v: k != F.lit(dst))  # the alias replaces an existing key
        kept = F.map_concat(base, F.transform_keys(extra, lambda k, v: F.lit(dst)))
    return kept


def classify_outcome(runs: DataFrame, results: DataFrame, run_cols: Sequence[str], seq_cols: Sequence[str],
                     subtype_col: str = "subtype", error_col: str = "is_error", text_col: str = "result",
                     exit_col: str | None = None, stdout_col: str | None = None, stderr_col: str | None = None,
                     failure_col: str | None = None, failure_text_col: str | None = None) -> DataFrame:
    """FN-21: outcome and retry code from each run's process status and last result.

    ``runs`` may carry the process status: ``failure_col`` ('timeout' or 'exception',
    with ``failure_text_col``), ``exit_col``, ``stdout_col`` and ``stderr_col``.
    Checked in order: timeout -> ``timeout_error``; exception -> ``execution_error``;
    non-zero exit -> ``claude_code_error`` with FN-20's error text (an error result's
    text first); no result -> failure, code ``none``; ``error_during_execution`` ->
    retryable failure; otherwise success is ``not is_error`` and error texts over 1000
    characters are cut to 800.
    """
    run_cols = list(run_cols)
    extra = [c for c in (exit_col, stdout_col, stderr_col, failure_col, failure_text_col) if c]
    last = latest(results, run_cols, list(seq_cols), [subtype_col, error_col, text_col])
    j = runs.select(*run_cols, *extra).dropDuplicates(run_cols).join(last, run_cols, "left")
    has = F.col(seq_cols[0]).isNotNull()
    during = has & (F.col(subtype_col) == "error_during_execution")
    err = F.coalesce(F.col(error_col), F.lit(False))
    text = F.coalesce(F.col(text_col), F.lit(""))
    output = (F.when(~has, truncate_text(F.lit(NO_RESULT), 800))
               .when(during, F.lit(EXEC_ERROR))
               .when(err & (F.length(text) > 1000), truncate_text(text, 800))
               .otherwise(text))
    success = F.when(~has | during, F.lit(False)).otherwise(~err)
    code = F.when(during, F.lit("error_during_execution")).otherwise(F.lit("none"))
    if exit_col:
        bad_exit = F.coalesce(F.col(exit_col) != 0, F.lit(False))
        structured = F.when(has & err, F.coalesce(F.col(text_col), F.lit(UNKNOWN_ERROR)))
        out_t = F.col(stdout_col) if stdout_col else F.lit(None).cast("string")
        err_t = F.col(stderr_col) if stderr_col else F.lit(None).cast("string")
        output = F.when(bad_exit, error_text(structured, out_t, err_t, F.col(exit_col))).otherwise(output)
        success = F.when(bad_exit, F.lit(False)).otherwise(success)
        code = F.when(bad_exit, F.lit("claude_code_error")).otherwise(code)
    if failure_col:
        msg = F.coalesce(F.col(failure_text_col), F.lit("")) if failure_text_col else F.lit("")
        output = (F.when(F.col(failure_col) == "timeout", F.lit(TIMEOUT_TEXT))
                   .when(F.col(failure_col) == "exception", F.concat(F.lit(EXCEPTION_PREFIX), msg)).otherwise(output))
        success = F.when(F.col(failure_col).isin("timeout", "exception"), F.lit(False)).otherwise(success)
        code = (F.when(F.col(failure_col) == "timeout", F.lit("timeout_error"))
                 .when(F.col(failure_col) == "exception", F.lit("execution_error")).otherwise(code))
    return j.select(*run_cols, output.alias("output"), success.alias("success"), code.alias("retry_code"))
