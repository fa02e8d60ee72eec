"""Golden cases for quality, security and config operators on hand-built rows."""

from pyspark.sql import functions as F

from runledger.operators import config as CFG
from runledger.operators import quality as Q
from runledger.operators import reconcile as R
from runledger.operators import security as S


def test_fill_defaults_nested(spark):
    df = spark.createDataFrame([('{"a": 5, "n": {"b": "x"}}',), ("{}",), ('{"a": "bad"}',)], "j string")
    spec = {"a": 1, "n": {"b": "dflt", "c": True}}
    got = [tuple(r) for r in df.select(CFG.fill_defaults(F.col("j"), spec).alias("s")).select("s.a", "s.n.b", "s.n.c").collect()]
    assert got == [(5, "x", True), (1, "dflt", True), (1, "dflt", True)]


def test_service_needs_last_entry_wins_and_defaults(spark):
    rows = [(1, 1, "Lambda", None, 256, None, None, None), (1, 2, "Lambda", "nodejs18.x", None, None, None, None),
            (1, 3, "S3", None, None, None, None, None), (2, 1, "RDS", None, None, None, "mysql", None),
            (3, 1, "SageMaker", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "p int, position int, service string, runtime string, memory bigint, "
                                     "timeout bigint, engine string, instanceClass string")
    got = {r.p: r for r in CFG.service_needs(df, ["p"]).collect()}
    assert (got[1].compute_serverless, got[1].compute_runtime, got[1].compute_memory) == (True, "nodejs18.x", 512)
    assert got[1].storage_object and got[1].storage_versioning and got[1].database_relational is None
    assert (got[2].database_engine, got[2].database_instance_class) == ("mysql", "db.t3.micro")
    assert got[3].compute_serverless is None and got[3].networking_api_type == "REST"


def test_merge_attrs_later_wins_per_key(spark):
    df = spark.createDataFrame([(1, 1, {"a": "1", "b": "x"}), (1, 2, {"a": "2"}), (1, 3, {"c": "z"})],
                               "run int, seq int, attrs map<string,string>")
    got = R.merge_attrs(df, ["run"], ["seq"], "attrs").collect()[0].attrs
    assert got == {"a": "2", "b": "x", "c": "z"}


def test_evaluate_gates(spark):
    measured = spark.createDataFrame([(1, "cov", 0.9), (1, "p95", 450.0), (2, "cov", 0.7), (2, "p95", 600.0)],
                                     "run int, metric string, value double")
    targets = spark.createDataFrame([("cov", ">=", 0.8, True, False, False), ("p95", "<=", 500.0, False, True, True)],
                                    "metric string, op string, target double, required boolean, critical boolean, "
                                    "production_only boolean")
    stg = {r.run: (r.n_gates, r.n_failed, r.passed) for r in Q.evaluate_gates(measured, targets, ["run"], "staging").collect()}
    prod = {r.run: (r.n_gates, r.n_failed, r.passed) for r in Q.evaluate_gates(measured, targets, ["run"], "production").collect()}
    assert stg == {1: (1, 0, True), 2: (1, 1, False)}
    assert prod == {1: (2, 0, True), 2: (2, 2, False)}


def test_cost_rollup_and_variance(spark):
    usage = spark.createDataFrame([(1, 2.0), (1, 3.0), (2, 1.0)], "k int, qty double")
    prices = spark.createDataFrame([(1, "svc", 10.10), (2, "svc", 0.5)], "k int, service string, price double")
    r = Q.cost_rollup(usage, prices, "k", "qty", "price", ["service"]).collect()[0]
    assert (r.monthly, r.monthly_low, r.monthly_high, r.annual) == (51.0, 25.5, 86.7, 612.0)
    est = spark.createDataFrame([(1, 100.0), (2, 0.0), (3, 50.0)], "k int, e double")
    act = spark.createDataFrame([(1, 118.0), (2, 5.0)], "k int, a double")
    v = {x.k: (x.variance, x.within_15, x.within_20) for x in Q.variance(est, act, "k", "e", "a").collect()}
    assert v == {1: (0.18, False, True), 2: (None, None, None), 3: (None, None, None)}


def test_retention_and_rotation(spark):
    df = spark.createDataFrame([(1, "2023-12-01"), (2, "2023-06-01"), (3, "2022-01-01")], "id int, d string") \
              .withColumn("d", F.to_date("d"))
    got = {r.id: r.retention for r in Q.retention(df, "d", "data", "2024-01-01").collect()}
    assert got == {1: "keep", 2: "cold", 3: "expire"}
    rot = spark.createDataFrame([("db_credentials", "2023-11-01"), ("api_keys", "2023-11-01"), ("jwt_secret", "2000-01-01")],
                                "kind string, last string").withColumn("last", F.to_date("last"))
    assert {r.kind: r.overdue for r in Q.overdue(rot, "kind", "last", "2024-01-01").collect()} == {
        "db_credentials": True, "api_keys": False, "jwt_secret": False}


def test_quota_and_top_k(spark):
    df = spark.createDataFrame([(1, i, 3) for i in range(5)] + [(2, i, None) for i in range(4)], "u int, i int, lim int")
    got = {r.u: (r.n_requests, r.n_allowed, r.n_rejected) for r in Q.quota(df, ["u"], "lim").collect()}
    assert got == {1: (5, 3, 2), 2: (4, 4, 0)}
    rows = {r.i for r in Q.quota_rows(df, ["u"], ["i"], "lim").filter("allowed AND u = 1").collect()}
    assert rows == {0, 1, 2}
    top = Q.top_k_per_group(df, ["u"], [F.col("i").desc()], 2).select("u", "i").collect()
    assert sorted(tuple(r) for r in top) == [(1, 3), (1, 4), (2, 2), (2, 3)]


def test_fk_domain_secret_checks(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert Q.fk_violations([("c.k -> p", child, "k", parent, "k")]).collect()[0].n_violations == 2
    df = spark.createDataFrame([("abc", 5), ("", -1), (None, 9)], "name string, n int")
    rules = [("name", "required", Q.required(F.col("name"))), ("n", "min 0", Q.min_value(F.col("n"), 0)),
             ("name", "pattern", Q.matches(F.col("name"), "^[a-z]+$"))]
    got = {(r.field, r.rule): r.n_violations for r in Q.domain_violations(df, "t", rules).collect()}
    assert got == {("name", "required"): 2, ("n", "min 0"): 1, ("name", "pattern"): 1}
    docs = spark.createDataFrame([(1, 'x token = "abcdefghij" y password: "12345678"'), (2, 'token = "short"')], "id int, t string")
    assert {r.id: r.n_hits for r in Q.secret_scan(docs, "id", "t").collect()} == {1: 2}


def test_rls_and_cls(spark):
    orders = spark.createDataFrame([(1, 10), (2, 11), (3, 12)], "o int, owner int")
    teams = spark.createDataFrame([(10, 11)], "manager_id int, member_id int")
    assert {r.o for r in S.rls(orders, "owner", 10, "manager", teams).collect()} == {1, 2}
    assert {r.o for r in S.rls(orders, "owner", 12, "user").collect()} == {3}
    assert S.rls(orders, "owner", 99, "admin").count() == 3
    users = spark.createDataFrame([(10, "a@x", "h1"), (11, "b@x", "h2")], "uid int, email string, pw string")
    seen = {r.uid: r.email for r in S.cls(users, 10, "user", "uid", ["email"], ["pw"]).collect()}
    assert seen == {10: "a@x", 11: None}
    assert "pw" not in S.cls(users, 10, "admin", "uid", ["email"], ["pw"]).columns


def test_quota_limit_by_plan(spark):
    df = spark.createDataFrame([("free",), ("standard",), ("admin",), ("other",)], "plan string")
    assert [r[0] for r in df.select(Q.quota_limit("plan")).collect()] == [100, 10000, None, 100]
