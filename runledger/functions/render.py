"""Documents rendered from records (FN-22) and grouped report text (FN-23).

A rendered document belongs to one run/story, so its lines are gathered per run with an
ordered ``collect_list`` whose size is that run's own item count.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.functions import config as C
from runledger.functions.text import fill_template

# Document texts ({name} marks a filled-in value).
FAILED_HEADER = "## ❌ Failed Tests"
PASSED_HEADER = "## ✅ Passed Tests"
NO_RESULTS = "❌ No test results found"
TEST_SUMMARY = "## Summary\n- **Passed**: {passed}\n- **Failed**: {failed}\n- **Total**: {total}"
ENV_HEAD = "# Auto-generated environment configuration template\n# ADW ID: {run}\n# Environment: {environment}\n\n"
PLAN_TEMPLATE = """# Implementation Plan: {title}

**Story ID:** {id}
**ADW ID:** {run}
**Sprint:** {sprint}
**Priority:** {priority}
**Estimated Hours:** {hours}

## User Story
{user_story}

## Description
{description}

## Dependencies
{dependencies}

## Acceptance Criteria
{criteria}
"""
PLAN_DEFAULTS = {"sprint": "TBD", "priority": "P1", "hours": "TBD", "user_story": "N/A", "description": "N/A",
                 "dependencies": "None"}
DEPLOY_TEMPLATE = """## {status}

**ADW ID:** {run}
**Environment:** {environment}

### Deployed Stacks
{stacks}

### Health Checks
```
{health}
```

### Next Steps
{next_steps}
"""
DEPLOY_OK = "✅ Deployment Successful"
DEPLOY_FAILED = "❌ Deployment Failed"
NO_STACKS = "No stacks deployed"
NEXT_OK = "- Infrastructure is ready for testing\n- Run `/test_infra` to validate infrastructure"
NEXT_FAILED = "- Review deployment errors and retry\n- Check CloudFormation console for details"
INFRA_TEMPLATE = "## 🏗️ Infrastructure Test Results\n\n### CDK Stack Validation\n{validation}\n### Infrastructure Tests\n{tests}"
INFRA_OK = "✅ All CDK stacks are healthy and deployed\n"
INFRA_FAILED = "❌ Stack validation failed:\n"
NO_INFRA_RESULTS = "⚠️ No infrastructure test results available"
CATEGORY_ORDER = tuple(name for name, _ in C.CATEGORIES) + (C.OTHER_CATEGORY,)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ordered_join(items: Column, order: Column, sep: str = "") -> Column:
    """Aggregate: join ``items`` of a group in ``order``."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), items.alias("v")))),
                                    lambda x: x["v"]), sep)


def render_vars(template, variables) -> Column:
    """FN-22: replace every ``{{ name }}`` with its value from a map column."""
    return F.aggregate(F.map_entries(_c(variables)), _c(template),
                       lambda acc, e: F.replace(acc, F.concat(F.lit("{{ "), e["key"], F.lit(" }}")),
                                                F.coalesce(e["value"], F.lit(""))))


def render_plan(stories: DataFrame, criteria: DataFrame, run_id: str, key: str = "id") -> DataFrame:
    """FN-22: implementation plan text per story with an acceptance checklist.

    ``stories``: id, title, sprint, priority, estimated_hours, user_story, description,
    dependencies (array<string>); ``criteria``: id, position, criterion.
    """
    cl = criteria.groupBy(key).agg(ordered_join(F.concat(F.lit("- [ ] "), F.col("criterion")), F.col("position"), "\n")
                                   .alias("_checklist"))
    s = stories.join(cl, key, "left")
    deps = F.when(F.size(F.coalesce("dependencies", F.array())) > 0, F.array_join("dependencies", ", ")) \
            .otherwise(F.lit(PLAN_DEFAULTS["dependencies"]))
    d = PLAN_DEFAULTS
    text = fill_template(PLAN_TEMPLATE, {
        "title": F.col("title"), "id": F.col(key), "run": F.lit(run_id),
        "sprint": F.coalesce(F.col("sprint").cast("string"), F.lit(d["sprint"])),
        "priority": F.coalesce(F.col("priority"), F.lit(d["priority"])),
        "hours": F.coalesce(F.col("estimated_hours").cast("string"), F.lit(d["hours"])),
        "user_story": F.coalesce(F.col("user_story"), F.lit(d["user_story"])),
        "description": F.coalesce(F.col("description"), F.lit(d["description"])),
        "dependencies": deps, "criteria": F.coalesce(F.col("_checklist"), F.lit(""))})
    return s.select(key, F.concat(F.lit("plans/"), F.lower(F.col(key)), F.lit("_plan.md")).alias("plan_file"),
                    text.alias("plan"))


def env_value(value_json) -> Column:
    """Python ``str()`` of a JSON literal as the template writes it."""
    t = C.json_type(value_json)
    return (F.when(t == "str", C.json_string_value(value_json))
             .when(t == "bool", F.initcap(_c(value_json))).otherwise(_c(value_json)))


def render_env_template(config: DataFrame, run_cols: Sequence[str], descriptions: DataFrame | None = None,
                        environment: str = "dev", include_secrets: bool = False) -> DataFrame:
    """FN-22: ``.env.example`` text per run: header, then per non-empty category a
    heading and one ``KEY=value`` (with an optional description comment) per key.
    Secret values become the template placeholder unless ``include_secrets``."""
    run_cols = list(run_cols)
    df = config if descriptions is None else config.join(descriptions, "key", "left")
    desc = F.col("description") if descriptions is not None else F.lit(None).cast("string")
    val = env_value("value_json")
    if not include_secrets:
        val = C.mask_value("key", val, "template")
    cat = C.categorise("key")
    cat_rank = F.array_position(F.array(*[F.lit(c) for c in CATEGORY_ORDER]), cat)
    line = F.concat(F.when(F.length(desc) > 0, F.concat(F.lit("# "), desc, F.lit("\n"))).otherwise(F.lit("")),
                    F.col("key"), F.lit("="), F.coalesce(val, F.lit("")), F.lit("\n"))
    per_cat = (df.select(*run_cols, cat.alias("category"), cat_rank.alias("rank"), "key", line.alias("line"))
                 .groupBy(*run_cols, "category", "rank")
                 .agg(ordered_join(F.col("line"), F.col("key"), "\n").alias("_lines")))
    block = F.concat(F.lit("# "), F.col("category"), F.lit("\n\n"), F.col("_lines"), F.lit("\n"))
    body = per_cat.groupBy(*run_cols).agg(ordered_join(block, F.col("rank"), "").alias("_body"))
    head = fill_template(ENV_HEAD, {"run": F.concat_ws("-", *[F.col(c).cast("string") for c in run_cols]),
                                    "environment": F.lit(environment)})
    return body.select(*run_cols, F.regexp_replace(F.concat(head, F.col("_body")), r"\n\z", "").alias("template"))


def test_json(name: Column, passed: Column, command: Column, purpose: Column, error: Column) -> Column:
    """The JSON block of one test result, two-space indented, keys in model order."""
    js = lambda c: F.when(c.isNull(), F.lit("null")).otherwise(
        F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", ""))
    return F.concat(F.lit('{\n  "test_name": '), js(name), F.lit(',\n  "passed": '),
                    F.when(passed, F.lit("true")).otherwise(F.lit("false")),
                    F.lit(',\n  "execution_command": '), js(command), F.lit(',\n  "test_purpose": '), js(purpose),
                    F.lit(',\n  "error": '), js(error), F.lit("\n}"))


def test_report(results: DataFrame, run_cols: Sequence[str], order_col: str) -> DataFrame:
    """FN-23: Markdown report per run: failed section, passed section, summary.

    ``results``: run..., order_col, test_name, passed, execution_command,
    test_purpose, error.
    """
    run_cols = list(run_cols)
    block = F.concat(F.lit("### "), F.col("test_name"), F.lit("\n\n```json\n"),
                     test_json(F.col("test_name"), F.col("passed"), F.col("execution_command"),
                               F.col("test_purpose"), F.col("error")), F.lit("\n```\n\n"))
    agg = results.groupBy(*run_cols).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), "passed", block.alias("t")))).alias("_all"),
        F.count_if(F.col("passed")).alias("_np"), F.count_if(~F.col("passed")).alias("_nf"), F.count(F.lit(1)).alias("_n"))
    failed, passed = (F.array_join(F.filter("_all", keep)["t"], "") for keep in (lambda x: ~x["passed"], lambda x: x["passed"]))
    text = F.concat(
        F.when(F.col("_nf") > 0, F.concat(F.lit("\n" + FAILED_HEADER + "\n\n"), failed)).otherwise(F.lit("")),
        F.when(F.col("_np") > 0, F.concat(F.lit(PASSED_HEADER + "\n\n"), passed)).otherwise(F.lit("")),
        fill_template(TEST_SUMMARY, {"passed": F.col("_np").cast("string"), "failed": F.col("_nf").cast("string"),
                                     "total": F.col("_n").cast("string")}))
    return agg.select(*run_cols, F.when(F.col("_n") == 0, F.lit(NO_RESULTS)).otherwise(text).alias("report"))


def review_report(issues: DataFrame, run_cols: Sequence[str], order_col: str,
                  severities: Sequence[str] = ("blocker", "tech_debt", "skippable")) -> DataFrame:
    """FN-23 (review): per run, one section per severity present (most severe first)
    listing its findings, then a summary line with the counts."""
    run_cols = list(run_cols)
    line = F.concat(F.lit("- #"), F.col("review_issue_number").cast("string"), F.lit(": "), F.col("issue_description"))
    agg = issues.groupBy(*run_cols).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col("issue_severity").alias("s"), F.concat(line, F.lit("\n")).alias("t")))).alias("_all"),
        *[F.count_if(F.col("issue_severity") == s).alias(f"_n_{s}") for s in severities])
    def found(severity: str) -> Column:
        return F.array_join(F.filter("_all", lambda x: x["s"] == severity)["t"], "")

    parts = [F.when(F.col(f"_n_{s}") > 0, F.concat(F.lit(f"## {s} ("), F.col(f"_n_{s}").cast("string"), F.lit(")\n"),
                                                   found(s), F.lit("\n"))).otherwise(F.lit("")) for s in severities]
    summary = F.concat_ws(", ", *[F.concat(F.lit(f"{s}: "), F.col(f"_n_{s}").cast("string")) for s in severities])
    return agg.select(*run_cols, F.concat(*parts, F.lit("Summary: "), summary).alias("report"))


def deploy_report(stacks: DataFrame, run_cols: Sequence[str], environment: str, name_col: str = "stack_name",
                  status_col: str = "status", outputs_col: str = "outputs") -> DataFrame:
    """FN-23 (deploy): per run, success (every stack deployed), one line per stack (by
    name) with its outputs (by key), a health line and the next steps."""
    run_cols = list(run_cols)
    outs = F.array_join(F.transform(F.array_sort(F.map_entries(F.coalesce(outputs_col, F.create_map().cast("map<string,string>")))),
                                    lambda e: F.concat(F.lit("\n  - "), e["key"], F.lit(": `"), e["value"], F.lit("`"))), "")
    line = F.concat(F.lit("- **"), F.col(name_col), F.lit("**: "), F.col(status_col), outs)
    agg = stacks.groupBy(*run_cols).agg(ordered_join(line, F.col(name_col), "\n").alias("_lines"),
                                        F.bool_and(F.col(status_col) == "deployed").alias("_ok"),
                                        F.count_if(F.col(status_col) == "deployed").alias("_up"),
                                        F.count(F.lit(1)).alias("_n"))
    ok = F.coalesce(F.col("_ok"), F.lit(False))
    text = fill_template(DEPLOY_TEMPLATE, {
        "status": F.when(ok, F.lit(DEPLOY_OK)).otherwise(F.lit(DEPLOY_FAILED)),
        "run": F.concat_ws("-", *[F.col(c).cast("string") for c in run_cols]), "environment": F.lit(environment),
        "stacks": F.when(F.length("_lines") > 0, F.col("_lines")).otherwise(F.lit(NO_STACKS)),
        "health": F.concat(F.col("_up").cast("string"), F.lit(" of "), F.col("_n").cast("string"), F.lit(" stacks deployed")),
        "next_steps": F.when(ok, F.lit(NEXT_OK)).otherwise(F.lit(NEXT_FAILED))})
    return agg.select(*run_cols, ok.alias("success"), text.alias("report"))


def infra_report(checks: DataFrame, run_cols: Sequence[str], order_col: str, error_col: str = "error",
                 results_col: str = "test_results") -> DataFrame:
    """FN-23 (infra): per run, stack validation (healthy, or the list of errors in order)
    and the infrastructure test output (or a warning when there is none)."""
    run_cols = list(run_cols)
    agg = checks.groupBy(*run_cols).agg(
        ordered_join(F.when(F.col(error_col).isNotNull(), F.concat(F.lit("- "), F.col(error_col), F.lit("\n")))
                     .otherwise(F.lit("")), F.col(order_col)).alias("_errs"),
        F.count(F.col(error_col)).alias("_n_err"), F.max(results_col).alias("_res"))
    validation = F.when(F.col("_n_err") == 0, F.lit(INFRA_OK)).otherwise(F.concat(F.lit(INFRA_FAILED), F.col("_errs")))
    tests = F.when(F.length(F.col("_res")) > 0, F.col("_res")).otherwise(F.lit(NO_INFRA_RESULTS))
    text = fill_template(INFRA_TEMPLATE, {"validation": validation, "tests": tests})
    return agg.select(*run_cols, (F.col("_n_err") == 0).alias("healthy"), text.alias("report"))


def report(df: DataFrame, kind: str, run_cols: Sequence[str], order_col: str, **kw) -> DataFrame:
    """FN-23: grouped report text by kind: ``tests``, ``review``, ``deploy`` or ``infra``."""
    if kind == "tests":
        return test_report(df, run_cols, order_col)
    if kind == "review":
        return review_report(df, run_cols, order_col)
    if kind == "deploy":
        return deploy_report(df, run_cols, kw.get("environment", "dev"))
    if kind == "infra":
        return infra_report(df, run_cols, order_col)
    raise ValueError(kind)


def render(df: DataFrame, template: str, **kw) -> DataFrame:
    """FN-22: render a document per record. ``template`` is ``plan`` (kw: criteria,
    run_id), ``env`` (kw: run_cols, descriptions, environment) or a text with
    ``{{ name }}`` slots filled from the columns of the same name (slots without a column
    stay as they are)."""
    if template == "plan":
        return render_plan(df, kw["criteria"], kw.get("run_id", ""), kw.get("key", "id"))
    if template == "env":
        return render_env_template(df, kw["run_cols"], kw.get("descriptions"), kw.get("environment", "dev"))
    names = sorted(n for n in set(re.findall(r"\{\{ (\w+) \}\}", template)) if n in df.columns)
    variables = F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("string"))])
    return df.withColumn("rendered", render_vars(F.lit(template), variables))
