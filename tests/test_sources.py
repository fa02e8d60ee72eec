"""Source and sink cases from FIXTURES.md, on small files written in a scratch folder."""

import json
import os

from pyspark.sql import functions as F

from runledger.sources import config_files as SC
from runledger.sources import documents as SD
from runledger.sources import logs as SL


def _write(spark, name, files):
    root = SL.scratch_path(spark, name).replace("file:", "")
    for rel, text in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write(text)
    return root


def _line(**kw):
    return json.dumps(kw)


def test_run_log_cases(spark):
    ok = "\n".join([_line(type="assistant", message={"content": [{"text": "hi"}]}), "",
                    _line(type="result", result="first", is_error=False),
                    _line(type="assistant", message={"content": []}),
                    _line(type="result", result="second", is_error=True, session_id="s1")]) + "\n"
    bad = _line(type="result", result="x") + "\n{not json\n"
    none = _line(type="assistant", message={"content": [{"text": "only text"}]}) + "\n"
    during = _line(type="result", subtype="error_during_execution", is_error=True) + "\n"
    root = _write(spark, "logs", {"a.jsonl": ok, "b.jsonl": bad, "c.jsonl": none, "d.jsonl": during})
    strict = SL.read_run_log(spark, root, "strict")
    files = {os.path.basename(r.file): r.n for r in strict.groupBy("file").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert files == {"a.jsonl": 4, "c.jsonl": 1, "d.jsonl": 1}  # blank skipped, b voided
    res = {os.path.basename(r.file): (r.result, r.is_error, r.subtype) for r in SL.result_messages(strict).collect()}
    assert res == {"a.jsonl": ("second", True, None), "d.jsonl": (None, True, "error_during_execution")}
    perm = SL.read_run_log(spark, root, "permissive")
    assert perm.filter("corrupt").count() == 1 and perm.count() == 8


def test_kv_cases(spark):
    text = "# comment\n\nA=1\nB = two words \nno equals here\nC=x=y\nA=3\n   # indented comment\n"
    root = _write(spark, "kv", {"x/dotenv": text})
    got = {r.key: r.value for r in SC.read_kv(spark, root).collect()}
    assert got == {"A": "3", "B": "two words", "C": "x=y"}


def test_kv_write_then_read(spark):
    df = spark.createDataFrame([("g", "K1", "v1", 1), ("g", "K2", "v2", 2), ("h", "K1", "z", 1)],
                               "grp string, key string, value string, seq int")
    root = SL.scratch_path(spark, "kvw")
    SC.write_kv(df, root, ["grp"], order_col="seq")
    back = {(r.grp, r.key): r.value for r in SC.read_kv_export(spark, root).collect()}
    assert back == {("g", "K1"): "v1", ("g", "K2"): "v2", ("h", "K1"): "z"}


def test_config_docs_json_and_yaml(spark):
    root = _write(spark, "cfg", {"run1/base.json": '{"a": 1, "b": "x", "n": {"k": [1, 2]}}', "run1/dev.json": "",
                                 "run2/base.yaml": "a: 2\nb: y\n", "run2/dev.yaml": "b: z\nc: true\n"})
    js = {r.key: r.value_json for r in SC.read_config_docs(spark, root + "/run1", "json").collect()}
    assert js == {"a": "1", "b": '"x"', "n": '{"k":[1,2]}'}  # the empty env file is ignored
    ym = SC.read_config_docs(spark, root + "/run2", "yaml").withColumn("run_id", F.lit("run2")) \
           .withColumn("layer", F.when(F.col("file").endswith("dev.yaml"), "dev").otherwise("base"))
    merged = {r.key: r.value for r in SC.layered(ym, {"base": 0, "dev": 1}).collect()}
    assert merged == {"a": "2", "b": '"z"', "c": "true"}


def test_params_paths(spark):
    df = spark.createDataFrame([("/p/run/DB/HOST", "h"), ("/p/run/API_KEY", "k"), ("/p/runner/X", "no")], "name string, value string")
    got = {r.key for r in SC.params_under(df, "/p/run").collect()}
    assert got == {"DB_HOST", "API_KEY"}
    kv = spark.createDataFrame([("DB_PASSWORD", "s"), ("APP_NAME", "a"), ("MONKEY", "m")], "key string, value string")
    out = {r.name: r.type for r in SC.to_params(kv, "/p/run").collect()}
    assert out == {"/p/run/DB/PASSWORD": "SecureString", "/p/run/APP/NAME": "String", "/p/run/MONKEY": "SecureString"}
    existing = spark.createDataFrame([("/p/run/APP/NAME",)], "name string")
    assert {r.name for r in SC.to_params(kv, "/p/run", existing, overwrite=False).collect()} == {
        "/p/run/DB/PASSWORD", "/p/run/MONKEY"}


def test_state_snapshot(spark):
    core = {"adw_id": "r1", "issue_number": "7", "branch_name": None, "model_set": "base"}
    ext = {"current_phase": "build", "model_set": "heavy", "planning": {"done": True, "n": 2}}
    root = _write(spark, "state", {"r1/state.json": json.dumps({**{k: v for k, v in core.items() if v is not None}, **ext})})
    st = SD.read_state(spark, root).collect()[0]
    assert st.adw_id == "r1" and st.branch_name is None and st.model_set == "heavy"
    row = SD.read_state(spark, root).select(SD.state_get("planning.n"), SD.state_get("current_phase.x", "dflt"),
                                            SD.state_get("branch_name", "none")).collect()[0]
    assert tuple(row) == ("2", "dflt", "none")


def test_to_state_json_drops_nulls_extended_wins(spark):
    df = spark.createDataFrame([("r1", None, "base", "heavy")], "adw_id string, branch_name string, model_set string, ms2 string")
    out = df.select(SD.to_state_json(F.struct("adw_id", "branch_name", "model_set"),
                                     F.struct(F.col("ms2").alias("model_set")))).collect()[0][0]
    assert json.loads(out) == {"adw_id": "r1", "model_set": "heavy"}


def test_issues_and_stacks(spark):
    issue = {"number": 5, "title": "t", "body": "b", "state": "open", "author": {"login": "u"},
             "comments": [{"id": "c1", "author": {"login": "bot"}, "body": "[ADW-AGENTS] x", "createdAt": "2024-01-01T00:00:00Z"},
                          {"id": "c2", "author": {"login": "me"}, "body": "please fix", "createdAt": "2024-01-02T10:00:00Z"}],
             "createdAt": "2024-01-01T00:00:00Z", "updatedAt": "2024-01-03T00:00:00Z", "url": "u"}
    stacks = [{"stack_name": "s1", "status": "deployed", "outputs": {"url": "x"}}, {"stack_name": "s2"}]
    root = _write(spark, "docs", {"issues/5.json": json.dumps(issue), "stacks/list.json": json.dumps(stacks)})
    cm = SD.issue_comments(SD.read_issues(spark, root + "/issues")).orderBy("pos").collect()
    assert [c.comment_id for c in cm] == ["c1", "c2"] and str(cm[1].created_at) == "2024-01-02 10:00:00"
    st = {r.stack_name: r.status for r in SD.read_stacks(spark, root + "/stacks").collect()}
    assert st == {"s1": "deployed", "s2": "unknown"}
    names = spark.createDataFrame([("s1",), ("s9",)], "stack_name string")
    assert {r.stack_name: r.status for r in SD.stack_lookup(SD.read_stacks(spark, root + "/stacks"), names).collect()} == {
        "s1": "deployed", "s9": "unknown"}


def test_read_docs_missing_is_empty(spark):
    root = _write(spark, "specs", {"a/1_brief.md": "hello\nworld"})
    wanted = spark.createDataFrame([("1_brief.md",), ("2_missing.md",)], "name string")
    got = {r.name: r.text for r in SL.read_docs(spark, root, wanted).collect()}
    assert got == {"1_brief.md": "hello\nworld", "2_missing.md": ""}


def test_exec_log(spark):
    root = _write(spark, "exec", {"x.log": "2024-01-01 10:00:00 - INFO - started\n  traceback line\n"
                                           "2024-01-01 10:00:05 - ERROR - failed - badly\n"})
    rows = SL.read_exec_log(spark, root).orderBy(F.col("ts").asc_nulls_last()).collect()
    assert [(r.level, r.message) for r in rows] == [("INFO", "started"), ("ERROR", "failed - badly"), (None, "  traceback line")]
    assert str(rows[1].ts) == "2024-01-01 10:00:05"


def test_explode_list_keeps_empty(spark):
    df = spark.createDataFrame([(1, '{"stories": [{"id": "a"}, {"id": "b"}]}'), (2, '{"other": 1}')], "k int, doc string")
    got = [(r.k, r.pos, r.id) for r in SD.explode_list(df, "doc", "$.stories", "struct<id: string>", ["k"]).orderBy("k", "pos").collect()]
    assert got == [(1, 0, "a"), (1, 1, "b"), (2, None, None)]


def test_append_history_idempotent_by_batch(spark):
    from runledger.operators import reconcile as R
    path = SL.scratch_path(spark, "hist")
    b1 = spark.createDataFrame([(1, "a", True), (1, "b", False)], "batch long, test string, passed boolean")
    b2 = spark.createDataFrame([(2, "a", True)], "batch long, test string, passed boolean")
    R.append_results(b1, path, batch_col="batch")
    R.append_results(b2, path, batch_col="batch")
    R.append_results(b1, path, batch_col="batch")  # a replayed batch replaces itself
    assert spark.read.parquet(path).count() == 3
    plain = SL.scratch_path(spark, "hist-plain")
    R.append_results(b2, plain)
    R.append_results(b2, plain)  # plain append adds
    assert spark.read.parquet(plain).count() == 2


def test_missing_inputs_are_empty(spark):
    gone = SL.scratch_path(spark, "never-written")
    assert SD.read_state(spark, gone).count() == 0
    wanted = spark.createDataFrame([("a.md",)], "name string")
    assert [r.text for r in SL.read_docs(spark, gone, wanted).collect()] == [""]
    assert SL.read_run_log(spark, gone).count() == 0
