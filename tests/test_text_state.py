"""Golden cases for the remaining text and state functions."""

from pyspark.sql import functions as F

from runledger.functions import state as ST
from runledger.functions import text as T


def _col(spark, values, fn, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col("s"))).collect()]


def test_command_repo_branch(spark):
    assert _col(spark, ["/implement now", "no slash", "/ space", "/a_b-c"], T.command_of) == ["implement", None, None, "a_b"]
    assert _col(spark, ["https://github.com/o/r.git", "https://github.com/o/r"], T.repo_path) == ["o/r", "o/r"]
    p = _col(spark, ["* remotes/origin/feat-issue-12-adw-ab12-x", "plain"], lambda c: T.parse_branch(c))
    assert (p[0].branch, p[0].issue_number, p[0].run_id) == ("feat-issue-12-adw-ab12-x", 12, "ab12")
    assert (p[1].issue_number, p[1].run_id) == (None, None)


def test_tags(spark):
    df = spark.createDataFrame([("r1", "ops", "hi", None), ("r1", "ops", "hi", "s9")], "r string, a string, t string, s string")
    got = [r[0] for r in df.select(T.tag_message("r", "a", "t", F.col("s"))).collect()]
    assert got == [f"{T.BOT_TAG} r1_ops: hi", f"{T.BOT_TAG} r1_ops_s9: hi"]
    assert _col(spark, [f"{T.BOT_TAG} x", "y"], T.ensure_tag) == [f"{T.BOT_TAG} x", f"{T.BOT_TAG} y"]


def test_error_text_precedence(spark):
    df = spark.createDataFrame([("boom", "out", "err", 1), (None, "out", None, 1), (None, None, "err", 1),
                                (None, "out", "err", 1), (None, "", None, 3)],
                               "s string, o string, e string, c int")
    got = [r[0] for r in df.select(T.error_text("s", "o", "e", "c")).collect()]
    p = T.ERROR_PREFIX
    assert got == [p + "boom", p + "out", p + "err", p + "err\nStdout: out", p + "Command failed with exit code 3"]


def test_chunks_edges(spark):
    df = spark.createDataFrame([(1, ""), (2, "abcdefghij")], "id int, t string")
    got = [(r.id, r.chunk_no, r.chunk) for r in T.chunk_text(df, "t", 4, 0.25, keep=["id"]).orderBy("id", "chunk_no").collect()]
    assert got == [(2, 0, "abcd"), (2, 1, "defg"), (2, 2, "ghij"), (2, 3, "j")]  # step 3; empty text gives none


def test_extract_workflow(spark):
    texts = ['```json\n{"adw_slash_command": "/adw_plan_iso", "adw_id": "r1"}\n```',
             '{"adw_slash_command": "/adw_unknown", "adw_id": "r2", "model_set": "heavy"}',
             '{"adw_slash_command": "adw_sdlc_iso", "adw_id": "r3", "model_set": "heavy"}', "no json"]
    got = [(r.workflow_command, r.run_id, r.model_set) for r in _col(spark, texts, ST.extract_workflow)]
    assert got == [("adw_plan_iso", "r1", "base"), (None, None, "base"), ("adw_sdlc_iso", "r3", "heavy"),
                   (None, None, "base")]


def test_get_path_and_allowlist(spark):
    s = '{"run": {"k": 5, "n": null}, "phase": "build"}'
    df = spark.createDataFrame([(s, "core")], "j string, c string")
    r = df.select(ST.get_path("j", "run.k"), ST.get_path("j", "phase.x", "d"), ST.get_path("j", "run.n", "d"),
                  ST.get_path("j", "phase", core={"phase": F.col("c")})).collect()[0]
    assert tuple(r) == ("5", "d", "d", "core")  # a JSON null falls back to the default (our fix)
    m = spark.createDataFrame([({"a": "1", "b": None, "c": "3", "alias": "old"},)], "m map<string,string>")
    kept = m.select(ST.allowlist_map("m", ["a", "b", "alias"], {"a": "alias"})).collect()[0][0]
    assert kept == {"a": "1", "alias": "1"}  # null dropped, c not allowed, alias copy replaces the old value


def test_classify_outcome_branches(spark):
    runs_ = spark.createDataFrame([(1,), (2,), (3,), (4,)], "run int")
    res = spark.createDataFrame([(1, 1, "success", False, "all good"), (2, 1, "error_during_execution", True, None),
                                 (3, 1, "success", True, "e" * 1200)], "run int, seq int, subtype string, is_error boolean, result string")
    got = {r.run: (r.success, r.retry_code, len(r.output)) for r in ST.classify_outcome(runs_, res, ["run"], ["seq"]).collect()}
    assert got[1] == (True, "none", len("all good"))
    assert got[2][:2] == (False, "error_during_execution")
    assert got[3][:2] == (False, "none") and got[3][2] <= 800
    assert got[4][:2] == (False, "none")  # no result message
