"""Golden cases for lookups, reconciliation, context assembly and run aggregates."""

import pytest
from pyspark.sql import functions as F

from runledger.functions import text as T
from runledger.operators import graph as G
from runledger.operators import reconcile as R
from runledger.operators import runs


def test_reconcile_two_and_three_way(spark):
    exp = spark.createDataFrame([("a", "deployed"), ("b", "deployed"), ("c", "deployed")], "name string, expected_status string")
    obs = spark.createDataFrame([("a", "deployed"), ("b", "failed")], "name string, status string")
    assert {r.name: r.result for r in R.reconcile(exp, obs, "name").collect()} == {
        "a": "ok", "b": "wrong_status", "c": "not_found"}
    base = spark.createDataFrame([(1, True), (2, False), (3, True), (4, True)], "k int, in_a boolean")
    b = spark.createDataFrame([(1,), (2,), (4,)], "k int")
    c = spark.createDataFrame([(1,)], "k int")
    reasons = (F.lit("A"), F.lit("B"), F.lit("C"))
    assert {r.k: r.error for r in R.reconcile3(base, b, c, "k", reasons).collect()} == {1: None, 2: "A", 3: "B", 4: "C"}


def test_missing_lookup_first_and_fallback(spark):
    req = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    present = spark.createDataFrame([(2,), (2,)], "k int")
    assert {r.k for r in R.missing(req, present, "k").collect()} == {1, 3}
    items = spark.createDataFrame([(1, 5, "late"), (1, 2, "early"), (2, 9, "only")], "k int, pos int, v string")
    got = {r.k: r.v for r in R.lookup_first(req, items, "k", "pos", ["v"]).collect()}
    assert got == {1: "early", 2: "only", 3: None}
    s0 = spark.createDataFrame([(1, "b.md"), (1, "a.md")], "k int, path string")
    s1 = spark.createDataFrame([(1, "z.md"), (2, "y.md")], "k int, path string")
    fo = {r.k: (r.path, r.source) for r in R.first_of(req, [s0, s1], "k").collect()}
    assert fo == {1: ("a.md", 0), 2: ("y.md", 1), 3: (None, None)}


def test_match_branches_substring_rule(spark):
    br = spark.createDataFrame([("feat-issue-7-adw-x-a",), ("feat-issue-7-adw-a-b",), ("issue-70-x",),
                                ("fix-issue-70-adw-q-c",)], "branch string")
    issues = spark.createDataFrame([(7,), (70,), (8,)], "number long")
    got = {r.number: r.branch for r in R.match_branches(br, issues).collect()}
    assert got == {7: "feat-issue-7-adw-a-b", 70: "fix-issue-70-adw-q-c", 8: None}


F6 = {2: [1], 3: [2], 4: [3], 5: [4], 6: [5], 11: [5], 7: [6, 11], 8: [7], 9: [8], 10: [9], 12: [9], 13: [9], 14: [9]}


def test_blocked_and_context_on_the_file_graph(spark):
    edges = spark.createDataFrame([("g", n, d) for n, ds in F6.items() for d in ds], "graph_id string, node long, depends_on long")
    nodes = spark.createDataFrame([("g", n) for n in range(1, 15)], "graph_id string, node long")
    done = spark.createDataFrame([("g", n) for n in (1, 2, 3, 4, 5, 6)], "graph_id string, node long")
    bl = {r.node: r.blocking_prereq for r in G.blocked(nodes, edges, done, ["graph_id"]).collect()}
    assert bl[7] == 11 and bl[6] is None and bl[2] is None and bl[8] == 7
    docs = spark.createDataFrame([("g", n, f"T{n}", f"text {n} " + "x" * (3000 if n == 2 else 10)) for n in (1, 2, 5, 6)],
                                 "graph_id string, node long, title string, text string")
    ctx = {r.node: (r.n_docs, r.context) for r in
           G.assemble_context(nodes, G.closure(edges, ["graph_id"]), docs, ["graph_id"], "smart").collect()}
    n_docs, text = ctx[9]  # prerequisites 1..8 and 11; documents exist for 2, 5, 6 (1 is the brief)
    assert n_docs == 3
    assert text.startswith("# Project Context\n\nNo project file provided.\n\n# Discovery Brief (File 1)\n\ntext 1 ")
    assert text.index("(File 2)") < text.index("(File 5)") < text.index("(File 6)")
    assert "[... CONTEXT SUMMARIZED FOR LENGTH ...]" in text  # file 2 is 7 steps back and long
    assert ctx[1][0] == 0


def test_run_aggregates(spark):
    t = spark.createDataFrame([(1, True), (1, False), (2, True), (3, None)], "run int, passed boolean")
    got = {r.run: (r.passed, r.failed, r.total, r.parse_ok, r.status) for r in runs.test_counts(t, "run").collect()}
    assert got == {1: (1, 1, 2, True, "failed"), 2: (1, 0, 1, True, "passed"), 3: (0, 0, 0, False, "unknown")}
    sev = spark.createDataFrame([(1, "blocker"), (1, "nit"), (1, "skippable")], "run int, issue_severity string")
    r = runs.severity_counts(sev, "run").collect()[0]
    assert (r.n_blocker, r.n_tech_debt, r.n_skippable, r.n_out_of_domain, r.n_issues) == (1, 0, 1, 1, 3)
    h = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "g string, ok boolean")
    assert {r.g: (r.all_healthy, r.n_unhealthy) for r in runs.health(h, "g", "ok").collect()} == {
        "a": (False, 1), "b": (True, 0)}
    res = spark.createDataFrame([(1, 1, True), (1, 1, False), (1, 2, False), (1, 3, True)], "run int, it int, ok boolean")
    assert [(r.it, r.resolved, r.stop_here) for r in runs.resolution_counts(res, "run", "it", "ok").orderBy("it").collect()] == [
        (1, 1, False), (2, 0, True)]  # iteration 3 never runs
    ph = spark.createDataFrame([(1, "plan", True), (1, "build", False), (1, "plan", False)], "run int, phase string, done boolean")
    m = runs.phase_matrix(ph, "run", "phase", "done", ["plan", "build", "test"]).collect()[0]
    assert (m.phase_plan, m.phase_build, m.phase_test, m.n_completed) == (True, False, None, 1)


def test_tail_error_last_five_newest_first(spark):
    rows = [(1, i, "assistant", t) for i, t in enumerate(["an error early", "ok", "ok", "fine", "it failed here", "ok", "done"])]
    df = spark.createDataFrame(rows, "run int, seq int, type string, text string")
    got = runs.tail_error(df, "run", "seq", n=5).collect()
    assert [(r.seq, r.error_text) for r in got] == [(4, "it failed here")]  # seq 0 is outside the last five
    assert runs.last_result(df.withColumn("type", F.lit("result")).withColumnRenamed("text", "result"), "run").collect()[0].seq == 6


def test_health_empty_group_is_unhealthy(spark):
    items = spark.createDataFrame([("a", True)], "g string, ok boolean")
    expected = spark.createDataFrame([("a",), ("b",)], "g string")
    got = {r.g: (r.n_items, r.all_healthy) for r in runs.health(items, "g", "ok", expected).collect()}
    assert got == {"a": (1, True), "b": (0, False)}


def test_nodes_with_the_same_documents_share_one_body(spark, monkeypatch):
    """400 nodes far behind the same documents (one of them twice): sections are gathered for one node."""
    made, cut = [], G.cut_lineage
    monkeypatch.setattr(G, "cut_lineage", lambda df: (made.append(cut(df)), made[-1])[1])
    nodes = spark.range(100, 502).select(F.lit("g").alias("graph_id"), F.col("id").alias("node"))
    pairs = nodes.filter("node < 500").crossJoin(spark.createDataFrame([(1,), (2,), (3,), (4,)], "prereq long")).union(
        spark.createDataFrame([("g", 500, 3), ("g", None, 2)], "graph_id string, node long, prereq long"))
    docs = spark.createDataFrame([("g", 1, "T1", "brief"), ("g", 2, "T2", "two"), ("g", 3, "T3", "a"), ("g", 3, "T3", "b")], "graph_id string, node long, title string, text string")
    got = {r.node: (r.n_docs, r.context.split("(File 1)\n\n")[1]) for r in G.assemble_context(nodes, pairs, docs, ["graph_id"]).collect()}
    both = "\n\n# T3 (File 3)\n\na\n\n# T3 (File 3)\n\nb"
    assert all(got[n] == (3, "brief\n\n\n# T2 (File 2)\n\ntwo" + both) for n in range(100, 500))
    assert got[500] == (2, "brief\n" + both) and got[501] == (0, "brief\n")
    assert [d.count() for d in made if "_refs" in d.columns and "_first" in d.columns] == [2]


def _contexts_by_hand(pairs, docs, brief_node=1):
    want = {}
    for node, refs in pairs.items():
        parts = sorted((p, f"\n\n# {t} (File {p})\n\n{x if node - p <= 5 or len(x) <= 2000 else x[:1000] + T.SUMMARY_MARKER + x[-1000:]}")
                       for p in refs if p != brief_node for q, t, x in docs if q == p)
        want[node] = (len(parts), "".join(x for _, x in parts))
    return want


@pytest.mark.parametrize("block,light", [(4096, 4 << 20), (64, 0), (1, 4 << 20)])
def test_sections_go_to_a_block_of_nodes_once(spark, monkeypatch, block, light):
    """A tree of 300 nodes, some documents long, one number twice, references repeated: contexts as by hand from shared sections."""
    made, cut = [], G.cut_lineage
    monkeypatch.setattr(G, "cut_lineage", lambda df: (made.append(cut(df)), made[-1])[1])
    monkeypatch.setattr(G, "BLOCK_REFS", block)
    monkeypatch.setattr(G, "LIGHT_TEXT", light)
    up = {n: [n >> k for k in range(1, n.bit_length())] for n in range(2, 301)}
    up[299] += up[299][-3:]
    docs = [(n, f"T{n}", f"text {n} " + "xy" * (1500 if n % 5 == 0 else n % 7)) for n in range(1, 301) if n % 11] + [(4, "T4", "a second one"), (9, "T9", "nine again")]
    nodes = spark.createDataFrame([(n,) for n in range(1, 301)], "node long")
    pairs = spark.createDataFrame([(n, p) for n, ps in up.items() for p in ps], "node long, prereq long")
    frame = spark.createDataFrame(docs, "node long, title string, text string")
    got = {r.node: (r.n_docs, r.context.split("(File 1)\n\n", 1)[1]) for r in G.assemble_context(nodes, pairs, frame).collect()}
    brief = next(x for n, _, x in docs if n == 1)
    assert got == {n: (k, f"{brief}\n{body}") for n, (k, body) in ({1: (0, "")} | _contexts_by_hand(up, docs)).items()}
    [refs] = [d for d in made if "_place" in d.columns]
    sent, blocks = refs.select("_block", "_place").distinct().count(), refs.select("_block").distinct().count()
    assert refs.count() > 3 * sent if block == 4096 else blocks > 10
