"""Operator golden cases: attempts, overlay, validation, graph, reconcile, security."""

import random

from pyspark.sql import functions as F

from runledger.operators import config as CFG
from runledger.operators import graph as G
from runledger.operators import reconcile as R
from runledger.operators import runs
from runledger.operators import security as S

from . import models as M

F6 = {2: [1], 3: [2], 4: [3], 5: [4], 6: [5], 11: [5], 7: [6, 11], 8: [7], 9: [8], 10: [9], 12: [9], 13: [9], 14: [9]}


def _edges(spark, graph):
    rows = [("g", n, d) for n, ds in graph.items() for d in ds]
    return spark.createDataFrame(rows, "graph_id string, node long, depends_on long")


def test_closure_of_the_file_graph(spark):
    cl = G.closure(_edges(spark, F6), ["graph_id"])
    got = {r.prereq for r in cl.filter("node = 7").collect()}
    assert got == {1, 2, 3, 4, 5, 6, 11}


def test_waves_of_the_file_graph(spark):
    nodes = spark.createDataFrame([("g", n) for n in range(1, 15)], "graph_id string, node long")
    lv = {r.node: r.level for r in G.dag_levels(nodes, _edges(spark, F6), ["graph_id"]).collect()}
    waves = {}
    for n, l in lv.items():
        waves.setdefault(l, set()).add(n)
    assert [waves[k] for k in sorted(waves)] == [{1}, {2}, {3}, {4}, {5}, {6, 11}, {7}, {8}, {9}, {10, 12, 13, 14}]


def test_cycle_and_missing_prerequisite(spark):
    g = {2: [1], 3: [4], 4: [3], 5: [99]}
    nodes = spark.createDataFrame([("g", n) for n in (1, 2, 3, 4, 5)], "graph_id string, node long")
    lv = {r.node: (r.level, r.reason) for r in G.dag_levels(nodes, _edges(spark, g), ["graph_id"]).collect()}
    assert lv[1] == (1, None) and lv[2] == (2, None)
    assert lv[3][0] is None and lv[4][0] is None and lv[5][0] is None
    cl = {(r.node, r.prereq) for r in G.closure(_edges(spark, g), ["graph_id"]).collect()}
    assert (3, 3) in cl and (4, 4) in cl  # a node on a cycle is its own prerequisite
    assert (2, 2) not in cl


def test_closure_model_random(spark):
    rng = random.Random(11)
    g = {}
    for n in range(2, 60):
        g[n] = sorted({rng.randrange(1, n) for _ in range(rng.randint(1, 3))})
    g[5].append(40)  # a cycle 5 -> 40 -> ... -> 5 is possible
    got = {(r.node, r.prereq) for r in G.closure(_edges(spark, g), ["graph_id"]).collect()}
    pairs = {(n, d) for n, ds in g.items() for d in ds}
    # the closure is the least set that holds the edges and gains nothing by one more join
    assert pairs <= got and {(a, d) for a, b in got for c, d in pairs if b == c} <= got
    while True:
        more = pairs | {(a, d) for a, b in pairs for c, d in pairs if b == c}
        if more == pairs:
            break
        pairs = more
    assert got == pairs


def test_attempt_stop_rules(spark):
    rows = []
    cases = {1: [False], 2: [True, False, True], 3: [True, True, True, True, False], 4: [True, True],
             5: [True, True, True]}
    for run, flags in cases.items():
        for i, f in enumerate(flags):
            rows.append((run, i, f, i == 1 and run == 5, not (run == 4 and i == 1)))
    df = spark.createDataFrame(rows, "run long, seq long, failed boolean, err boolean, resolved boolean")
    got = {r.run: (r.attempts, r.failed_attempts, r.final_status, r.stop_reason)
           for r in runs.attempts(df, "run", ["seq"], "failed", 4).collect()}
    for run in (1, 2, 3):
        assert got[run] == M.attempts(cases[run], 4)
    assert got[3] == (4, 4, "failed", "max_attempts")
    full = {r.run: r.stop_reason for r in runs.attempts(df, "run", ["seq"], "failed", 4, "err", "resolved").collect()}
    assert full[5] == "run_error" and full[4] == "no_resolution"
    status = {r.run: r.final_status for r in runs.attempts(df, "run", ["seq"], "failed", 4, "err", "resolved").collect()}
    assert status[5] == "error"  # a run error is never reported as passed


def test_attempts_model_random(spark):
    rng = random.Random(5)
    rows, flags = [], {}
    for run in range(200):
        fl = [rng.random() < 0.6 for _ in range(rng.randint(1, 7))]
        flags[run] = fl
        order = list(range(len(fl)))
        rng.shuffle(order)
        rows += [(run, i, fl[i]) for i in order]
    df = spark.createDataFrame(rows, "run long, seq long, failed boolean")
    got = {r.run: (r.attempts, r.failed_attempts, r.final_status, r.stop_reason)
           for r in runs.attempts(df, "run", ["seq"], "failed", 4).collect()}
    assert got == {run: M.attempts(fl, 4) for run, fl in flags.items()}


def test_overlay_later_layer_and_line_win(spark):
    rows = [("ports", 0, "A", "1", 0), ("local", 1, "A", "2", 0), ("base", 2, "A", "3", 0),
            ("base", 2, "A", "3b", 1), ("environment", 3, "B", "x", 0), ("cloud", 4, "B", "y", 0)]
    df = spark.createDataFrame(rows, "layer string, priority int, key string, value string, seq long")
    got = {r.key: (r.value, r.layer) for r in CFG.overlay(df).collect()}
    assert got == {"A": ("3b", "base"), "B": ("y", "cloud")}


def test_validate_traps(spark):
    cfg = spark.createDataFrame([(1, "PORT", '"0"'), (1, "COUNT", "true"), (1, "NAME", '""'), (1, "URL", '"xhttp://a"'),
                                 (1, "FLAG", "0"), (1, "EXTRA", "5")], "run_id long, key string, value_json string")
    schema = spark.createDataFrame([("PORT", "string", "^[0-9]+$", True), ("COUNT", "integer", None, True),
                                    ("NAME", "string", None, True), ("URL", "string", "https?://", False),
                                    ("FLAG", "boolean", None, True), ("GONE", "string", None, True)],
                                   "key string, type string, pattern string, required boolean")
    errs = {r.error for r in CFG.validate(cfg, schema).collect()}
    assert errs == {"Missing required field: NAME",  # empty string is falsy
                    "Missing required field: FLAG",  # 0 is falsy
                    "Missing required field: GONE",
                    "FLAG: Expected boolean, got int",
                    "URL: Does not match pattern https?://"}  # anchored at the start only; bool passes integer


def test_sync_plan_directions(spark):
    local = spark.createDataFrame([("A", "1"), ("B", "2"), ("C", "3")], "key string, value string")
    cloud = spark.createDataFrame([("B", "2"), ("C", "9"), ("D", "4")], "key string, value string")
    l2c = {r.key: r.action for r in CFG.sync_plan(local, cloud, "local_to_cloud").collect()}
    c2l = {r.key: r.action for r in CFG.sync_plan(local, cloud, "cloud_to_local").collect()}
    assert l2c == {"A": "insert", "B": "same", "C": "update", "D": "untouched"}
    assert c2l == {"A": "delete", "B": "same", "C": "update", "D": "insert"}
    only = {r.key for r in CFG.sync_plan(local, cloud, "local_to_cloud", ["A"]).filter("action = 'insert'").collect()}
    assert only == {"A"}


def test_route_fallbacks(spark):
    req = spark.createDataFrame([("/implement", "heavy"), ("/implement", None), ("/implement", "turbo"),
                                 ("/unknown", "heavy")], "command string, model_set string")
    got = [r.model for r in R.route(req, R.routing_rules(spark)).orderBy("command", "model_set").collect()]
    assert sorted(got) == sorted(["opus", "sonnet", "sonnet", "sonnet"])


def test_upserts(spark):
    t = spark.createDataFrame([("a", "deployed", "eu", "o1"), ("b", "failed", "us", "o2")],
                              "stack_name string, status string, region string, outputs string")
    s = spark.createDataFrame([("b", "deployed", "o3"), ("c", "pending", "o4")], "stack_name string, status string, outputs string")
    got = {r.stack_name: tuple(r) for r in R.upsert_cols(t, s, "stack_name", ["status", "outputs"]).collect()}
    assert got["b"] == ("b", "deployed", "us", "o3") and got["a"] == ("a", "deployed", "eu", "o1")
    assert got["c"] == ("c", "pending", None, "o4")
    full = {r.stack_name: tuple(r) for r in R.upsert(t, t.filter("stack_name = 'b'").withColumn("region", F.lit("ap")),
                                                     "stack_name").collect()}
    assert full["b"][2] == "ap"


def test_authorise_order_of_checks(spark):
    req = spark.createDataFrame([(1, "PUT", "/api/v1/tasks/10", 10), (2, "PUT", "/api/v1/tasks/10", 10),
                                 (3, "PUT", "/api/v1/tasks/99", 99), (1, "GET", "/api/v1/admin/x/y", None),
                                 (4, "PUT", "/api/v1/tasks/10", 10), (1, "GET", "/api/v1/users", None)],
                                "user_id long, method string, endpoint string, resource_id long")
    mem = spark.createDataFrame([(1, "user"), (2, "user"), (3, "user"), (3, "admin"), (4, "admin")], "user_id long, role string")
    res = spark.createDataFrame([(10, 1)], "resource_id long, owner_id long")
    got = [(r.user_id, r.endpoint, r.reason) for r in S.authorise(req, mem, res).collect()]
    assert (1, "/api/v1/tasks/10", "Authorized") in got
    assert (2, "/api/v1/tasks/10", "User does not own this resource") in got
    assert (3, "/api/v1/tasks/99", "Resource not found") in got
    assert (1, "/api/v1/admin/x/y", "User lacks required role: admin") in got
    assert (4, "/api/v1/tasks/10", "User lacks required role: user") in got  # admins still need the role group
    assert (1, "/api/v1/users", "User lacks required role: manager") in got


def test_forest_levels_with_cycle_and_missing(spark):
    g = {2: [1], 3: [2], 4: [3], 6: [5], 5: [6], 7: [6], 8: [99]}  # chain, 2-cycle with a tail, missing
    nodes = spark.createDataFrame([("g", n) for n in range(1, 9)], "graph_id string, node long")
    lv = {r.node: r.level for r in G.dag_levels(nodes, _edges(spark, g), ["graph_id"]).collect()}
    assert lv == {1: 1, 2: 2, 3: 3, 4: 4, 5: None, 6: None, 7: None, 8: None}
