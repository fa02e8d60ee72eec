"""Rules that must not change with size or with missing input."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from runledger.operators import config as CFG
from runledger.operators import graph as G
from runledger.operators import quality as Q
from runledger.operators import runs
from runledger.operators import security as S


def test_positions_with_payload_columns(spark):
    n = 1_000_000
    df = spark.range(n).select((F.col("id") % 3).alias("k"), F.xxhash64("id").alias("ts"), "id", F.md5(F.col("id").cast("string")).alias("payload"))
    got = runs.ordered_positions(df, "k", ["ts", "id"], n_partitions=7)
    assert got.columns == [*df.columns, "position"]
    want = df.withColumn("want", F.row_number().over(Window.partitionBy("k").orderBy("ts", "id"))).select("id", "want")
    assert got.join(want, "id").filter("position <> want").count() == 0 and got.count() == n


def test_percentile_is_exact_in_one_large_group(spark):
    n = 1_000_000
    df = spark.range(n).select(F.lit("g").alias("g"), (F.pmod(F.xxhash64("id"), F.lit(10 ** 9)) / 1000.0).alias("v")).union(
        spark.sql("SELECT 'null group', CAST(NULL AS DOUBLE)")).union(spark.sql("SELECT 'one', 7.0D"))
    got = {r.g: r.p for r in runs.exact_percentile(df, "g", "v", 0.95, "p").collect()}
    rank = -(-n * 95 // 100)
    want = df.filter("g = 'g'").orderBy("v").limit(rank).agg(F.max("v")).first()[0]
    assert got == {"g": want, "one": 7.0}
    gate = {r.g: (r.p95, r.passed) for r in Q.latency_gate(df, ["g"], "v", 100.0).collect()}
    assert gate["null group"] == (None, False) and gate["one"] == (7.0, True)


def test_resource_without_owner_is_denied(spark):
    req = spark.createDataFrame([(1, "GET", "/api/users/1", 5), (1, "GET", "/api/users/1", 6)], "user_id long, method string, endpoint string, resource_id long")
    policy = (("/api/users/{id}", "GET", "user"),)
    members = spark.createDataFrame([(1, "user")], "user_id long, role string")
    res = spark.createDataFrame([(5, None), (6, 1)], "resource_id long, owner_id long")
    got = {r.resource_id: r.authorized for r in S.authorise(req, members, res, policy).collect()}
    assert got == {5: False, 6: True}


def test_unmeasured_or_null_gate_fails(spark):
    targets = spark.createDataFrame([("a", ">=", 1.0, True, False, False), ("b", ">=", 1.0, True, False, False)],
                                    "metric string, op string, target double, required boolean, critical boolean, production_only boolean")
    measured = spark.createDataFrame([(1, "a", 2.0), (1, "b", 2.0), (2, "a", 2.0), (3, "a", 2.0), (3, "b", None), (4, "other", 1.0)],
                                     "run int, metric string, value double")
    got = {r.run: (r.n_gates, r.n_failed, r.passed) for r in Q.evaluate_gates(measured, targets, ["run"], "staging").collect()}
    assert got == {1: (2, 0, True), 2: (2, 1, False), 3: (2, 1, False), 4: (2, 2, False)}


def test_run_without_measurements_fails_every_gate(spark):
    targets = spark.createDataFrame([("a", ">=", 1.0, True, False, False), ("b", ">=", 1.0, False, False, False)],
                                    "metric string, op string, target double, required boolean, critical boolean, production_only boolean")
    measured = spark.createDataFrame([(1, "a", 2.0, "x"), (9, "b", 2.0, "x")], "run int, metric string, value double, note string")
    runs_ = spark.createDataFrame([(1,), (2,), (2,)], "run int")
    got = {r.run: (r.n_gates, r.n_failed, r.passed) for r in Q.evaluate_gates(measured, targets, ["run"], "staging", runs_).collect()}
    assert got == {1: (2, 1, True), 2: (2, 2, False), 9: (2, 1, False)}


def test_a_user_with_half_of_all_requests_fills_no_task(spark):
    """The hot user's rows and the rows without a user are dealt over the tasks; nothing is lost or doubled."""
    from runledger.operators import skew
    n = 400_000
    user = F.when(F.col("id") % 2 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 5000)
    df = spark.range(n).select("id", user.cast("long").alias("user_id"))
    lookup = spark.range(0, 5000, 3).select(F.col("id").alias("user_id"), (F.col("id") * 10).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = skew.enrich(df, lookup, ["user_id"], parts=16, hot_rows=1000)
        sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
        plain = [r[0] for r in df.join(lookup, "user_id", "left").groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(plain) > n / 2 and max(sizes) < 2 * n / len(sizes)
    want = df.join(lookup, "user_id", "left")
    assert out.select("id", "user_id", "v").exceptAll(want.select("id", "user_id", "v")).isEmpty() and out.count() == n
    hot = skew.hot_keys(df, ["user_id"], 16, 1000)
    assert {r.user_id for r in hot.collect()} == {7, None}
    for how in ("inner", "left_semi", "left_anti"):
        assert skew.enrich(df, lookup, ["user_id"], how, parts=16, hot_rows=1000).count() == df.join(lookup, "user_id", how).count()


def test_run_without_config_misses_every_required_key(spark):
    schema = spark.createDataFrame([("A", "string", None, True), ("B", "integer", None, True), ("C", "string", None, False)],
                                   "key string, type string, pattern string, required boolean")
    config = spark.createDataFrame([(1, "A", '"x"'), (1, "B", "3")], "run_id int, key string, value_json string")
    every = spark.createDataFrame([(1,), (2,)], "run_id int")
    got = {(r.run_id, r.key) for r in CFG.validate(config, schema, runs=every).collect()}
    assert got == {(2, "A"), (2, "B")}


def test_long_chain_closure_and_levels(spark):
    n = 200
    e = spark.range(1, n).select("id", (F.col("id") - 1).alias("up")).toDF("node", "depends_on")
    assert G.closure(e).count() == n * (n - 1) // 2
    levels = G.dag_levels(spark.range(n).toDF("node"), e).collect()
    assert all(r.level == r.node + 1 for r in levels)
