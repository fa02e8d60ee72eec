"""Stand-in workflow tables built from the driver tables with plain column expressions.

Each binding has a DuckDB twin in ``runledger.plans.oracle`` that repeats the same
rules, so every registered query can be checked value by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.plans.tables import table


def attempt_events(spark: SparkSession, sf: str) -> DataFrame:
    """Attempt rows: run = (user_id, day of ts), order (ts, event_id), failed = error event."""
    ev = table(spark, sf, "events")
    return ev.select("user_id", F.to_date("ts").alias("run_date"), "ts", "event_id",
                     (F.col("event_type") == "error").alias("failed"), "event_type", "value")


def test_results(spark: SparkSession, sf: str) -> DataFrame:
    """Unit test results: test_name = event_type, passed = value >= 1, run = user/day."""
    ev = table(spark, sf, "events")
    return ev.select("user_id", F.to_date("ts").alias("run_date"), "event_id",
                     F.col("event_type").alias("test_name"), (F.col("value") >= 1).alias("passed"))


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Run-log messages: run = conv_id, seq = turn, type = role with assistant as result."""
    cv = table(spark, sf, "conversations")
    return cv.select(F.col("conv_id").alias("run_id"), F.col("turn").alias("seq"),
                     F.when(F.col("role") == "assistant", "result").otherwise(F.col("role")).alias("type"),
                     F.col("text").alias("result"))


def review_issues(spark: SparkSession, sf: str) -> DataFrame:
    """Review findings: toxic -> blocker, else low quality -> tech_debt, else skippable.

    A review run is a source's block of 100 document ids, so a run's findings stay
    bounded as the corpus grows (sources alone are a fixed, small set).
    """
    lb = table(spark, sf, "labels")
    docs = table(spark, sf, "documents").select("doc_id", "source")
    sev = (F.when(F.col("toxic") == 1, "blocker").when(F.col("quality") == 0, "tech_debt")
            .otherwise("skippable"))
    run = F.concat(F.col("source"), F.lit("/"), F.expr("doc_id div 100").cast("string"))
    return lb.join(docs, "doc_id").select(run.alias("run_id"),
                                          F.col("doc_id").alias("review_issue_number"),
                                          sev.alias("issue_severity"))


NL = "\n"


def wrapped_events(spark: SparkSession, sf: str) -> DataFrame:
    """Model-style output around ``events.props``: fenced (tagged and bare), prose, list,
    and an unclosed bracket, one shape per event type."""
    ev = table(spark, sf, "events")
    p = F.col("props")
    text = (F.when(F.col("event_type") == "view",
                   F.concat(F.lit("Results:\n```json\n"), p, F.lit("\n```\nDone.")))
             .when(F.col("event_type") == "click", F.concat(F.lit("```\n"), p, F.lit("\n```")))
             .when(F.col("event_type") == "signup", F.concat(F.lit("list: ["), p, F.lit("] end")))
             .when(F.col("event_type") == "purchase", F.concat(F.lit("The answer is "), p, F.lit(" as requested.")))
             .otherwise(F.concat(F.lit("oops [ "), p)))
    return ev.select("event_id", "event_type", text.alias("text"))


def config_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Four config layers keyed REGION_n / NATION_n from region, nation and customer."""
    r, n, c = (table(spark, sf, t) for t in ("region", "nation", "customer"))
    lay = lambda df, layer, prio, key, value, seq: df.select(
        F.lit(layer).alias("layer"), F.lit(prio).alias("priority"), key.alias("key"),
        value.cast("string").alias("value"), seq.cast("long").alias("seq"))
    return (lay(r, "ports", 0, F.concat(F.lit("REGION_"), F.col("r_regionkey").cast("string")), F.col("r_name"), F.col("r_regionkey"))
            .unionByName(lay(n, "local", 1, F.concat(F.lit("NATION_"), F.col("n_nationkey").cast("string")),
                             F.col("n_regionkey"), F.col("n_nationkey")))
            .unionByName(lay(n, "base", 2, F.concat(F.lit("REGION_"), F.col("n_regionkey").cast("string")),
                             F.col("n_name"), F.col("n_nationkey")))
            .unionByName(lay(c, "environment", 3, F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")),
                             F.col("c_name"), F.col("c_custkey"))))


def config_values(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer (run) a config with typed JSON values, one row per key (stack, one scan)."""
    c = table(spark, sf, "customer")
    s = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    ck = F.col("c_custkey").cast("string")
    nk = F.col("c_nationkey").cast("string")
    seg = F.lower("c_mktsegment")
    entries = [
        ("API_URL", F.when(F.col("c_mktsegment") == "MACHINERY", s('"https://api', ck, '.example.com"'))
                     .otherwise(s('"ftp://files', ck, '"'))),
        ("DB_PORT", F.when(F.col("c_nationkey") % 2 == 0, s('"', (F.col("c_nationkey") + 5000).cast("string"), '"'))
                     .otherwise(s('"54x', nk, '"'))),
        ("MAX_CONN", nk),
        ("RATIO", F.col("c_acctbal").cast("string")),
        ("DEBUG", F.when(F.col("c_acctbal") > 0, "true").otherwise("false")),
        ("ADMIN_EMAIL", F.when(F.col("c_mktsegment") == "BUILDING", s('"admin@', seg, '"'))
                         .otherwise(s('"ops@', seg, '.example.com"'))),
        ("SECRET_TOKEN", s('"', F.col("c_name"), '"')),
        ("TIMEOUT", F.when(F.col("c_custkey") % 3 == 0, F.lit('"30"')).otherwise(F.lit("30"))),
    ]
    kv = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value_json")) for k, v in entries])
    return c.select(F.col("c_custkey").alias("run_id"), F.inline(kv))


def config_schema(spark: SparkSession) -> DataFrame:
    """Declared schema rows (configuration metadata, not data)."""
    rows = [("API_URL", "string", "^https?://", True), ("DB_PORT", "string", "^[0-9]+$", True),
            ("MAX_CONN", "integer", None, True), ("RATIO", "number", None, False),
            ("DEBUG", "boolean", None, True), ("ADMIN_EMAIL", "string", "^[^@]+@[^@]+\\.[^@]+$", True),
            ("TIMEOUT", "integer", None, False), ("REGION", "string", None, True)]
    from runledger.session import constant_table
    return constant_table(spark, rows, "key string, type string, pattern string, required boolean")


def part_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Config-style keys from part names with one of ten suffixes chosen by size."""
    p = table(spark, sf, "part")
    suffixes = F.array(*[F.lit(x) for x in ("URL", "PORT", "SECRET", "PASSWORD", "API_KEY", "TOKEN",
                                            "CREDENTIAL", "DB_HOST", "S3_BUCKET", "DEBUG")])
    key = F.concat(F.upper(F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))), F.lit("_"),
                   F.element_at(suffixes, (F.col("p_size") % 10 + 1).cast("int")))
    return p.select("p_partkey", key.alias("key"), F.col("p_retailprice").cast("string").alias("value"),
                    "p_brand", "p_type", "p_size", "p_name")


def event_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Run-log style messages from events: run = user, seq = event_id, views are user turns."""
    ev = table(spark, sf, "events")
    return ev.select(F.col("user_id").alias("run_id"), F.col("event_id").alias("seq"),
                     F.when(F.col("event_type") == "view", "user").otherwise("assistant").alias("type"),
                     F.concat(F.col("event_type"), F.lit(" event: "), F.col("props")).alias("text"))


# Phase names standing in for order priorities.
PRIORITY_PHASE = {"1-URGENT": "discovery", "2-HIGH": "scoping", "3-MEDIUM": "planning",
                  "4-NOT SPECIFIED": "development", "5-LOW": "deploy"}


def phase_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Phase records: run = customer, phase from priority, completed = F, failed = P."""
    o = table(spark, sf, "orders")
    m = F.create_map(*[F.lit(x) for kv in PRIORITY_PHASE.items() for x in kv])
    return o.select(F.col("o_custkey").alias("run_id"), m[F.col("o_orderpriority")].alias("phase"),
                    (F.col("o_orderstatus") == "F").alias("completed"), (F.col("o_orderstatus") == "P").alias("failed"))


def run_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Run ids: base-36 order key (6 digits), a dash, status and a priority letter."""
    o = table(spark, sf, "orders")
    rid = F.concat(F.lpad(F.lower(F.conv(F.col("o_orderkey").cast("string"), 10, 36)), 6, "0"), F.lit("-"),
                   F.col("o_orderstatus"), F.lower(F.substring("o_orderpriority", 3, 1)))
    return o.select("o_orderkey", rid.alias("run_id"))


def part_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Dependency tree over parts: node = p_partkey depends on p_partkey div 2 (root 0)."""
    p = table(spark, sf, "part")
    return p.filter(F.col("p_partkey") > 0).select(
        F.lit("parts").alias("graph_id"), F.col("p_partkey").alias("node"),
        F.expr("p_partkey div 2").alias("depends_on"))


def part_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.lit("parts").alias("graph_id"), F.col("p_partkey").alias("node"))


def graph_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Spec documents per node: doc_id is the node number."""
    d = table(spark, sf, "documents")
    return d.select(F.lit("parts").alias("graph_id"), F.col("doc_id").alias("node"),
                    F.concat(F.lit("Document "), F.col("doc_id").cast("string"), F.lit(" ("), F.col("lang"), F.lit(")"))
                    .alias("title"), "text")
