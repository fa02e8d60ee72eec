"""Golden cases for rendered documents and reports."""

from pyspark.sql import functions as F

from runledger.functions import render as RD


def test_plan_defaults_and_checklist(spark):
    stories = spark.createDataFrame([("S-1", "Title", None, None, None, None, None, [])],
                                    "id string, title string, sprint int, priority string, estimated_hours double, "
                                    "user_story string, description string, dependencies array<string>")
    crit = spark.createDataFrame([("S-1", 2, "second"), ("S-1", 1, "first")], "id string, position int, criterion string")
    r = RD.render_plan(stories, crit, "run9").collect()[0]
    assert r.plan_file == "plans/s-1_plan.md"
    assert "**Sprint:** TBD\n**Priority:** P1\n**Estimated Hours:** TBD" in r.plan
    assert "## Dependencies\nNone" in r.plan
    assert r.plan.endswith("## Acceptance Criteria\n- [ ] first\n- [ ] second\n")


def test_env_template_masks_and_groups(spark):
    cfg = spark.createDataFrame([(1, "DB_HOST", '"db"'), (1, "API_TOKEN", '"t0p"'), (1, "DEBUG", "true"), (1, "NAME", "7")],
                                "run int, key string, value_json string")
    text = RD.render_env_template(cfg, ["run"]).collect()[0].template
    assert text.startswith("# Auto-generated environment configuration template\n# ADW ID: 1\n# Environment: dev\n\n")
    assert "# Database Configuration\n\nDB_HOST=db\n" in text
    assert "API_TOKEN=your-secret-value-here" in text and "DEBUG=True" in text
    assert text.index("# Database") < text.index("# API") < text.index("# Development") < text.index("# Other")
    assert not text.endswith("\n\n")


def test_reports(spark):
    rv = spark.createDataFrame([("r", 2, "blocker", "b2"), ("r", 1, "blocker", "b1"), ("r", 3, "skippable", "s")],
                               "run string, review_issue_number int, issue_severity string, issue_description string")
    t = RD.report(rv, "review", ["run"], "review_issue_number").collect()[0].report
    assert t.startswith("## blocker (2)\n- #1: b1\n- #2: b2\n\n## skippable (1)\n")
    assert t.endswith("Summary: blocker: 2, tech_debt: 0, skippable: 1")
    st = spark.createDataFrame([("d", "s2", "deployed", {"url": "u"}), ("d", "s1", "failed", None)],
                               "run string, stack_name string, status string, outputs map<string,string>")
    d = RD.report(st, "deploy", ["run"], "stack_name", environment="prod").collect()[0]
    assert not d.success and d.report.startswith("## ❌ Deployment Failed")
    assert "- **s1**: failed\n- **s2**: deployed\n  - url: `u`" in d.report
    checks = spark.createDataFrame([("d", "a", None, None), ("d", "b", "Stack b not found", None)],
                                   "run string, s string, error string, test_results string")
    i = RD.report(checks, "infra", ["run"], "s").collect()[0]
    assert not i.healthy and "❌ Stack validation failed:\n- Stack b not found\n" in i.report
    assert i.report.endswith("⚠️ No infrastructure test results available")


def test_render_dispatch(spark):
    df = spark.createDataFrame([(1, "x")], "id int, name string")
    got = RD.render(df, "{{ name }}#{{ id }} {{ other }}").collect()[0].rendered
    assert got == "x#1 {{ other }}"
