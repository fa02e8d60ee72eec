"""Text and JSON function queries (FN-01..08, FN-17..20, FN-24, FN-26)."""

from __future__ import annotations

from pyspark.sql import functions as F

from runledger.functions import text as T
from runledger.plans import bindings as B
from runledger.plans import oracle as O
from runledger.plans.queries.registry import register
from runledger.plans.tables import table


@register("extract_json", f"""WITH src AS ({O.WRAPPED_EVENTS}),
{O.extract_json_ctes('src', 'text', 'event_id')}
SELECT event_id, json_text FROM fj""")
def q_extract_json(spark, sf):
    """FN-01 over model-style text wrapped around every ``events.props``."""
    w = B.wrapped_events(spark, sf)
    return w.select("event_id", T.extract_json("text").alias("json_text"))


_E2E_SQL = f"""'{{"test_name": "' || event_type || '", "status": "' ||
    CASE WHEN value >= 10 THEN 'passed' WHEN value >= 1 THEN 'failed' ELSE 'skipped' END || '"}}'"""


@register("parse_test_results", f"""WITH base AS (SELECT event_id, event_type,
    CASE WHEN event_type = 'error' THEN '[{{"test_name": "' || event_type || '", "status": '
         ELSE '```json' || {O.NL} || '[' || {_E2E_SQL} || ']' || {O.NL} || '```' END AS text FROM events),
{O.extract_json_ctes('base', 'text', 'event_id')},
p AS (SELECT event_id, json_text, json_valid(json_text) AS ok FROM fj)
SELECT event_id,
  CASE WHEN ok THEN CAST(json_array_length(json_text) AS INTEGER) END AS n_items,
  CASE WHEN NOT ok THEN 'Failed to parse JSON. Text was: ' || substring(json_text, 1, 200) || '...'
       WHEN json_extract_string(json_text, '$[0].status') NOT IN ('passed', 'failed')
       THEN 'Invalid status. Text was: ' || substring(json_text, 1, 200) || '...' END AS error
FROM p""")
def q_parse_test_results(spark, sf):
    """FN-02: typed parse of E2E results (status domain passed/failed) inside fences."""
    ev = table(spark, sf, "events")
    status = (F.when(F.col("value") >= 10, "passed").when(F.col("value") >= 1, "failed").otherwise("skipped"))
    item = F.concat(F.lit('{"test_name": "'), F.col("event_type"), F.lit('", "status": "'), status, F.lit('"}'))
    text = F.when(F.col("event_type") == "error",
                  F.concat(F.lit('[{"test_name": "'), F.col("event_type"), F.lit('", "status": '))) \
            .otherwise(F.concat(F.lit("```json\n["), item, F.lit("]\n```")))
    parsed = T.parse_typed(text, "array<struct<test_name:string,status:string>>",
                           {"status": ("passed", "failed")})
    return ev.select("event_id", parsed.alias("p")).select(
        "event_id", F.when(F.col("p.value").isNotNull(), F.size("p.value")).alias("n_items"),
        F.col("p.error").alias("error"))


@register("truncate_text", f"""SELECT doc_id, {O.truncate('text', 500)} AS short_text FROM documents""")
def q_truncate_text(spark, sf):
    """FN-03 on every document (default 500 characters with suffix)."""
    d = table(spark, sf, "documents")
    return d.select("doc_id", T.truncate_text("text", 500).alias("short_text"))


@register("truncate_text_short", f"""SELECT doc_id, {O.truncate('text', 60)} AS short_text FROM documents""")
def q_truncate_text_short(spark, sf):
    """FN-03 with a 60-character limit: the break windows reach the text start (clamped)."""
    d = table(spark, sf, "documents")
    return d.select("doc_id", T.truncate_text("text", 60).alias("short_text"))


_BLOB_SQL = f"""CASE role
  WHEN 'user' THEN '{{"type":"assistant","message":{{"content":[{{"text":' || to_json(text) || '}}]}}}}'
       || {O.NL} || '{{"type":"result","result":""}}'
  WHEN 'assistant' THEN '{{"type":"assistant","message":{{"content":[{{"text":"draft"}}]}}}}'
       || {O.NL} || '{{"type":"result","result":' || to_json(text) || '}}'
  ELSE '{{"type":"assistant","message":{{"content":[]}}}}' || {O.NL}
       || '{{"type":"result","subtype":"error_during_execution"}}' END"""


@register("summarise_jsonl", f"""WITH b AS (SELECT conv_id, turn, {_BLOB_SQL} AS blob FROM conversations),
l AS (SELECT conv_id, turn, blob, string_split({O.strip('blob')}, {O.NL}) AS lines FROM b),
f AS (SELECT conv_id, turn, blob, len(lines) AS n, list_filter(list_transform(lines, lambda x:
      CASE WHEN json_extract_string(x, '$.type') = 'result' THEN json_extract_string(x, '$.result')
           WHEN json_extract_string(x, '$.type') = 'assistant'
           THEN json_extract_string(x, '$.message.content[0].text') END), lambda y: length(y) > 0) AS found
      FROM l),
g AS (SELECT conv_id, turn, n, CASE WHEN len(found) > 0 THEN found[-1] END AS pick FROM f)
SELECT conv_id, turn, CASE WHEN pick IS NOT NULL THEN {O.truncate('pick', 500)}
  ELSE '[JSONL output with ' || n || ' messages]' || {O.q(O.SUFFIX)} END AS display_text FROM g""")
def q_summarise_jsonl(spark, sf):
    """FN-04: a two-line run log per conversation turn, summarised for display."""
    cv = table(spark, sf, "conversations")
    asst = lambda t: F.to_json(F.struct(F.lit("assistant").alias("type"),
                                        F.struct(F.array(F.struct(t.alias("text"))).alias("content")).alias("message")))
    res = lambda t: F.to_json(F.struct(F.lit("result").alias("type"), t.alias("result")))
    empty_asst = F.lit('{"type":"assistant","message":{"content":[]}}')
    err = F.lit('{"type":"result","subtype":"error_during_execution"}')
    blob = (F.when(F.col("role") == "user", F.concat(asst(F.col("text")), F.lit("\n"), res(F.lit(""))))
             .when(F.col("role") == "assistant", F.concat(asst(F.lit("draft")), F.lit("\n"), res(F.col("text"))))
             .otherwise(F.concat(empty_asst, F.lit("\n"), err)))
    return cv.select("conv_id", "turn", T.summarise_jsonl(blob).alias("display_text"))


@register("head_tail", f"""SELECT doc_id, {O.head_tail('text', 8000)} AS context FROM documents""")
def q_head_tail(spark, sf):
    """FN-05 on every document at the default 8000 characters."""
    d = table(spark, sf, "documents")
    return d.select("doc_id", T.head_tail("text", 8000).alias("context"))


@register("command_of", """SELECT conv_id, turn,
  CASE WHEN role <> 'assistant' THEN role END AS command FROM conversations""")
def q_command_of(spark, sf):
    """FN-07: slash command at the start of a prompt (assistant turns carry none)."""
    cv = table(spark, sf, "conversations")
    prompt = F.when(F.col("role") != "assistant", F.concat(F.lit("/"), F.col("role"), F.lit(" "), F.col("text"))) \
              .otherwise(F.col("text"))
    return cv.select("conv_id", "turn", T.command_of(prompt).alias("command"))


_LABEL_TEXT_SQL = """'  I think this is ' || CASE o_orderpriority WHEN '1-URGENT' THEN '/bug'
   WHEN '2-HIGH' THEN '/feature' WHEN '3-MEDIUM' THEN '/chore' WHEN '4-NOT SPECIFIED' THEN '0'
   ELSE 'unsure' END || ' (priority ' || o_orderpriority || ') '"""


@register("classify_label", f"""WITH t AS (SELECT o_orderkey, {_LABEL_TEXT_SQL} AS raw FROM orders),
m AS (SELECT o_orderkey, raw, regexp_extract({O.strip('raw')}, '(/chore|/bug|/feature|0)', 1) AS m,
      {O.strip('raw')} AS out FROM t),
c AS (SELECT o_orderkey, raw, CASE WHEN m <> '' THEN m ELSE out END AS cmd FROM m)
SELECT o_orderkey, CASE WHEN cmd IN ('/chore', '/bug', '/feature') THEN cmd END AS label,
  CASE WHEN cmd = '0' THEN 'No command selected: ' || raw
       WHEN cmd NOT IN ('/chore', '/bug', '/feature') THEN 'Invalid command selected: ' || raw END AS error
FROM c""")
def q_classify_label(spark, sf):
    """FN-08: issue class from free text built from ``o_orderpriority``."""
    o = table(spark, sf, "orders")
    pick = (F.when(F.col("o_orderpriority") == "1-URGENT", "/bug").when(F.col("o_orderpriority") == "2-HIGH", "/feature")
             .when(F.col("o_orderpriority") == "3-MEDIUM", "/chore")
             .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "0").otherwise("unsure"))
    raw = F.concat(F.lit("  I think this is "), pick, F.lit(" (priority "), F.col("o_orderpriority"), F.lit(") "))
    c = T.classify_label(raw)
    return o.select("o_orderkey", c.label.alias("label"), c.error.alias("error"))


@register("repo_path", """SELECT page_id,
  replace(replace(url, regexp_extract(url, '^(https?://[^/]+/)', 1), ''), '.git', '') AS repo FROM pages""")
def q_repo_path(spark, sf):
    """FN-17: owner/repo style path from page URLs (host prefix and ``.git`` removed)."""
    p = table(spark, sf, "pages")
    host = F.regexp_extract("url", r"^(https?://[^/]+/)", 1)
    return p.select("page_id", T.repo_path("url", host).alias("repo"))


_BRANCH_SQL = """CASE WHEN o_orderstatus = 'O' THEN '* ' ELSE '' END ||
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'remotes/origin/' ELSE '' END ||
  'feat-issue-' || o_orderkey || '-adw-' || lower(o_orderstatus) || o_custkey || '-' ||
  lower(replace(o_orderpriority, ' ', '-'))"""


@register("parse_branch", f"""WITH b AS (SELECT o_orderkey,
  replace(replace({_BRANCH_SQL}, '* ', ''), 'remotes/origin/', '') AS branch FROM orders)
SELECT o_orderkey, branch, CAST(NULLIF(regexp_extract(branch, 'issue-(\\d+)', 1), '') AS BIGINT) AS issue_number,
  NULLIF(regexp_extract(branch, '-adw-([^-]+)-', 1), '') AS run_id FROM b""")
def q_parse_branch(spark, sf):
    """FN-18: branch listing lines (current marker, remote prefix) parsed to ids."""
    o = table(spark, sf, "orders")
    raw = F.concat(F.when(F.col("o_orderstatus") == "O", "* ").otherwise(""),
                   F.when(F.col("o_orderpriority") == "1-URGENT", "remotes/origin/").otherwise(""),
                   F.lit("feat-issue-"), F.col("o_orderkey").cast("string"), F.lit("-adw-"),
                   F.lower("o_orderstatus"), F.col("o_custkey").cast("string"), F.lit("-"),
                   F.lower(F.replace(F.col("o_orderpriority"), F.lit(" "), F.lit("-"))))
    p = T.parse_branch(raw)
    return o.select("o_orderkey", p.branch.alias("branch"), p.issue_number.alias("issue_number"),
                    p.run_id.alias("run_id"))


@register("tag_message", """SELECT conv_id, turn,
  '[ADW-AGENTS] ' || concat_ws('_', CAST(conv_id AS VARCHAR), role,
     CASE WHEN role = 'assistant' THEN 's' || turn END) || ': ' || text AS tagged FROM conversations""")
def q_tag_message(spark, sf):
    """FN-19: bot-tagged comment text; the session part only for assistant turns."""
    cv = table(spark, sf, "conversations")
    sess = F.when(F.col("role") == "assistant", F.concat(F.lit("s"), F.col("turn").cast("string")))
    return cv.select("conv_id", "turn", T.tag_message(F.col("conv_id").cast("string"), "role", "text", sess)
                     .alias("tagged"))


_ERR_PARTS_SQL = """CASE WHEN event_type = 'error' THEN props END AS structured,
  CASE WHEN value > 25 THEN 'partial output ' || event_id END AS stdout,
  CASE WHEN value < 10 THEN 'stack trace ' || repeat('x', CAST(floor(value * 100) AS INT)) END AS stderr,
  CAST(floor(value) AS INT) % 3 AS exit_code"""


@register("error_text", f"""WITH e AS (SELECT event_id, {_ERR_PARTS_SQL} FROM events),
m AS (SELECT event_id, CASE
  WHEN length(structured) > 0 THEN 'Claude Code error: ' || structured
  WHEN coalesce(length(stdout) > 0, false) AND NOT coalesce(length(stderr) > 0, false) THEN 'Claude Code error: ' || stdout
  WHEN coalesce(length(stderr) > 0, false) AND NOT coalesce(length(stdout) > 0, false) THEN 'Claude Code error: ' || stderr
  WHEN coalesce(length(stdout) > 0, false) AND coalesce(length(stderr) > 0, false)
    THEN 'Claude Code error: ' || stderr || {O.NL} || 'Stdout: ' || stdout
  ELSE 'Claude Code error: Command failed with exit code ' || exit_code END AS msg FROM e)
SELECT event_id, {O.truncate('msg', 800)} AS error_text FROM m""")
def q_error_text(spark, sf):
    """FN-20: error text precedence over parts derived from each event, cut at 800."""
    ev = table(spark, sf, "events")
    structured = F.when(F.col("event_type") == "error", F.col("props"))
    stdout = F.when(F.col("value") > 25, F.concat(F.lit("partial output "), F.col("event_id").cast("string")))
    stderr = F.when(F.col("value") < 10, F.concat(F.lit("stack trace "),
                                                  F.repeat(F.lit("x"), (F.col("value") * 100).cast("int"))))
    code = F.pmod((F.col("value")).cast("int"), F.lit(3))
    return ev.select("event_id", T.error_text(structured, stdout, stderr, code).alias("error_text"))


@register("minimal_payload", """SELECT o_orderkey,
  CAST(to_json(struct_pack(number := o_orderkey, title := o_orderpriority, body := o_orderstatus)) AS VARCHAR) AS payload FROM orders""")
def q_minimal_payload(spark, sf):
    """FN-24: number, title and body as compact JSON."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").alias("number"),
                                         F.col("o_orderpriority").alias("title"), F.col("o_orderstatus").alias("body"))
    return o.select("o_orderkey", T.minimal_payload(o, ["number", "title", "body"]).alias("payload"))


@register("chunk_text", """SELECT doc_id, CAST(g.i AS INT) AS chunk_no, substring(text, CAST(g.i * 5000 + 1 AS INT), 5000) AS chunk
FROM documents, LATERAL (SELECT unnest(range(0, CAST(ceil(length(text) / 5000.0) AS BIGINT))) AS i) g""")
def q_chunk_text(spark, sf):
    """FN-26: 5000-character chunks of every document."""
    d = table(spark, sf, "documents")
    return T.chunk_text(d, "text", 5000, 0.0, keep=["doc_id"])


@register("chunk_text_overlap", """WITH s AS (SELECT doc_id, text, unnest(range(0, length(text), 410)) AS st
  FROM documents WHERE length(text) > 0)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY st) - 1 AS INT) AS chunk_no,
  substring(text, CAST(st + 1 AS INT), 512) AS chunk FROM s""")
def q_chunk_text_overlap(spark, sf):
    """FN-26: 512-character chunks with 20% overlap (step 410)."""
    d = table(spark, sf, "documents")
    return T.chunk_text(d, "text", 512, 0.2, keep=["doc_id"])


@register("budget_context", f"""SELECT doc_id, n_chars // 1000 AS distance,
  CASE WHEN n_chars // 1000 > 5 THEN {O.head_tail('text', 2000)} ELSE text END AS smart,
  {O.head_tail('text', 3000)} AS summarized, CAST(length(text) AS INTEGER) AS full_length FROM documents""")
def q_budget_context(spark, sf):
    """FN-06: the three context modes; distance stands in as thousands of characters."""
    d = table(spark, sf, "documents").withColumn("distance", F.expr("n_chars div 1000"))
    return d.select("doc_id", "distance", T.budget_text("text", "distance", "smart").alias("smart"),
                    T.budget_text("text", "distance", "summarized").alias("summarized"),
                    F.length(T.budget_text("text", "distance", "full")).alias("full_length"))


@register("ensure_bot_tag", """SELECT conv_id, turn, CASE WHEN starts_with(t, '[ADW-AGENTS]') THEN t ELSE '[ADW-AGENTS] ' || t END AS comment
  FROM (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN '[ADW-AGENTS] ' || text ELSE text END AS t FROM conversations)""")
def q_ensure_bot_tag(spark, sf):
    """FN-19: comments get the bot tag only when they do not already start with it."""
    cv = table(spark, sf, "conversations")
    t = F.when(F.col("role") == "assistant", F.concat(F.lit("[ADW-AGENTS] "), F.col("text"))).otherwise(F.col("text"))
    return cv.select("conv_id", "turn", T.ensure_tag(t).alias("comment"))


@register("capped_responses", """SELECT conv_id, turn, substring(text, 1, 2000) AS response, length(text) > 2000 AS capped
  FROM conversations WHERE role = 'assistant'""")
def q_capped_responses(spark, sf):
    """FN-26: assistant responses capped at 2000 characters, with a flag where cut."""
    cv = table(spark, sf, "conversations").filter(F.col("role") == "assistant")
    return cv.select("conv_id", "turn", T.cap_text("text", 2000).alias("response"), (F.length("text") > 2000).alias("capped"))
