"""DuckDB twins of the bindings (SQL fragments used inside ``WITH`` clauses)."""

ATTEMPT_EVENTS = """SELECT user_id, CAST(ts AS DATE) AS run_date, ts, event_id,
    event_type = 'error' AS failed, event_type, value FROM events"""

TEST_RESULTS = """SELECT user_id, CAST(ts AS DATE) AS run_date, event_id,
    event_type AS test_name, value >= 1 AS passed FROM events"""

MESSAGES = """SELECT conv_id AS run_id, turn AS seq,
    CASE WHEN role = 'assistant' THEN 'result' ELSE role END AS type, text AS result
    FROM conversations"""

REVIEW_ISSUES = """SELECT d.source || '/' || (l.doc_id // 100) AS run_id, l.doc_id AS review_issue_number,
    CASE WHEN l.toxic = 1 THEN 'blocker' WHEN l.quality = 0 THEN 'tech_debt' ELSE 'skippable' END
      AS issue_severity
    FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""


# ------------------------------------------------------------------ SQL helpers
# Generators of DuckDB expressions that repeat the Column functions rule by rule.
NL = "chr(10)"
SUFFIX = "... (truncated)"


def q(s: str) -> str:
    """SQL string literal (newlines through chr(10))."""
    parts = s.split("\n")
    lits = ["'" + p.replace("'", "''") + "'" for p in parts]
    return ("(" + f" || {NL} || ".join(lits) + ")") if len(parts) > 1 else lits[0]


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def last_pos(x: str, ch: str) -> str:
    return (f"(CASE WHEN strpos({x}, '{ch}') > 0 THEN length(regexp_extract({x}, '(?s)^(.*)\\{ch}', 1)) + 1 "
            f"ELSE 0 END)")


def truncate(x: str, max_length: int = 500, suffix: str = SUFFIX) -> str:
    cut = max(max_length - len(suffix), 0)

    def win(ch_sql: str, ch_re: str, width: int) -> str:
        start = max(cut - width, 0)
        w = f"substring({x}, {start + 1}, {cut - start})"
        return (f"(CASE WHEN strpos({w}, {ch_sql}) > 0 THEN {start} + "
                f"length(regexp_extract({w}, '(?s)^(.*){ch_re}', 1)) ELSE -1 END)")

    nl, sp = win(NL, "\\n", 50), win("' '", " ", 20)
    s = q(suffix)
    return (f"(CASE WHEN length({x}) <= {max_length} THEN {x} "
            f"WHEN {nl} > 0 THEN substring({x}, 1, {nl}) || {s} "
            f"WHEN {sp} > 0 THEN substring({x}, 1, {sp}) || {s} "
            f"ELSE substring({x}, 1, {cut}) || {s} END)")


def head_tail(x: str, max_length: int = 8000) -> str:
    half = max_length // 2
    marker = q("\n\n[... CONTEXT SUMMARIZED FOR LENGTH ...]\n\n")
    return (f"(CASE WHEN length({x}) <= {max_length} THEN {x} ELSE substring({x}, 1, {half}) || {marker} || "
            f"substring({x}, length({x}) - {half} + 1, {half}) END)")


FENCE = "'(?s)```(?:json)?\\s*\\n(.*?)\\n```'"


def extract_json_ctes(src: str, text_col: str, keep: str) -> str:
    """Two CTE bodies computing FN-01 as column ``json_text`` (body -> cut)."""
    return f"""fj_body AS (SELECT {keep}, CASE WHEN regexp_matches({text_col}, {FENCE})
        THEN {strip(f"regexp_extract({text_col}, {FENCE}, 1)")} ELSE {strip(text_col)} END AS body FROM {src}),
    fj_pos AS (SELECT *, strpos(body, '[') AS a0, {last_pos('body', ']')} AS a1,
        strpos(body, '{{') AS o0, {last_pos('body', '}')} AS o1 FROM fj_body),
    fj AS (SELECT {keep}, CASE WHEN starts_with(body, '[') OR starts_with(body, '{{') THEN body
        WHEN a0 > 0 AND (o0 = 0 OR a0 < o0) AND a1 > 0 THEN substring(body, a0, a1 - a0 + 1)
        WHEN a0 > 0 AND (o0 = 0 OR a0 < o0) THEN body
        WHEN o0 > 0 AND o1 > 0 THEN substring(body, o0, o1 - o0 + 1)
        ELSE body END AS json_text FROM fj_pos)"""


# Wrapped model output built from events (shared by FN-01, FN-02, FN-09 style queries).
WRAPPED_EVENTS = f"""SELECT event_id, event_type, CASE event_type
    WHEN 'view' THEN 'Results:' || {NL} || '```json' || {NL} || props || {NL} || '```' || {NL} || 'Done.'
    WHEN 'click' THEN '```' || {NL} || props || {NL} || '```'
    WHEN 'signup' THEN 'list: [' || props || '] end'
    WHEN 'purchase' THEN 'The answer is ' || props || ' as requested.'
    ELSE 'oops [ ' || props END AS text FROM events"""


CONFIG_LAYERS = """SELECT 'ports' AS layer, 0 AS priority, 'REGION_' || r_regionkey AS key, r_name AS value,
    CAST(r_regionkey AS BIGINT) AS seq FROM region
  UNION ALL SELECT 'local', 1, 'NATION_' || n_nationkey, CAST(n_regionkey AS VARCHAR), n_nationkey FROM nation
  UNION ALL SELECT 'base', 2, 'REGION_' || n_regionkey, n_name, n_nationkey FROM nation
  UNION ALL SELECT 'environment', 3, 'NATION_' || c_nationkey, c_name, c_custkey FROM customer"""

CONFIG_VALUES = """SELECT c_custkey AS run_id, 'API_URL' AS key, CASE WHEN c_mktsegment = 'MACHINERY'
    THEN '"https://api' || c_custkey || '.example.com"' ELSE '"ftp://files' || c_custkey || '"' END AS value_json FROM customer
  UNION ALL SELECT c_custkey, 'DB_PORT', CASE WHEN c_nationkey % 2 = 0 THEN '"' || (c_nationkey + 5000) || '"'
    ELSE '"54x' || c_nationkey || '"' END FROM customer
  UNION ALL SELECT c_custkey, 'MAX_CONN', CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT c_custkey, 'RATIO', CAST(c_acctbal AS VARCHAR) FROM customer
  UNION ALL SELECT c_custkey, 'DEBUG', CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END FROM customer
  UNION ALL SELECT c_custkey, 'ADMIN_EMAIL', CASE WHEN c_mktsegment = 'BUILDING' THEN '"admin@' || lower(c_mktsegment) || '"'
    ELSE '"ops@' || lower(c_mktsegment) || '.example.com"' END FROM customer
  UNION ALL SELECT c_custkey, 'SECRET_TOKEN', '"' || c_name || '"' FROM customer
  UNION ALL SELECT c_custkey, 'TIMEOUT', CASE WHEN c_custkey % 3 = 0 THEN '"30"' ELSE '30' END FROM customer"""

CONFIG_SCHEMA = """SELECT * FROM (VALUES ('API_URL', 'string', '^https?://', true), ('DB_PORT', 'string', '^[0-9]+$', true),
  ('MAX_CONN', 'integer', NULL, true), ('RATIO', 'number', NULL, false), ('DEBUG', 'boolean', NULL, true),
  ('ADMIN_EMAIL', 'string', '^[^@]+@[^@]+\\.[^@]+$', true), ('TIMEOUT', 'integer', NULL, false),
  ('REGION', 'string', NULL, true)) AS s(key, type, pattern, required)"""


def json_type(v: str) -> str:
    return (f"(CASE WHEN {v} IN ('true', 'false') THEN 'bool' WHEN regexp_full_match({v}, '-?[0-9]+') THEN 'int' "
            f"WHEN regexp_full_match({v}, '-?[0-9]+(\\.[0-9]+)?([eE][-+]?[0-9]+)?') THEN 'float' "
            f"WHEN starts_with({v}, '\"') THEN 'str' WHEN {v} = 'null' THEN 'NoneType' "
            f"WHEN starts_with({v}, '[') THEN 'list' WHEN starts_with({v}, '{{') THEN 'dict' END)")


def truthy(v: str) -> str:
    t = json_type(v)
    return (f"NOT (({t} = 'bool' AND {v} = 'false') OR ({t} IN ('int', 'float') AND TRY_CAST({v} AS DOUBLE) = 0) "
            f"OR ({t} = 'str' AND {v} = '\"\"') OR {t} = 'NoneType' OR {v} IN ('[]', '{{}}'))")


PART_KEYS = """SELECT p_partkey, upper(replace(p_name, ' ', '_')) || '_' ||
    ['URL', 'PORT', 'SECRET', 'PASSWORD', 'API_KEY', 'TOKEN', 'CREDENTIAL', 'DB_HOST', 'S3_BUCKET', 'DEBUG'][p_size % 10 + 1]
    AS key, CAST(p_retailprice AS VARCHAR) AS value, p_brand, p_type, p_size, p_name FROM part"""


def contains_any(x: str, words) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), '{w}')" for w in words) + ")"


EVENT_MESSAGES = """SELECT user_id AS run_id, event_id AS seq,
    CASE WHEN event_type = 'view' THEN 'user' ELSE 'assistant' END AS type,
    event_type || ' event: ' || props AS text FROM events"""

PHASE_ROWS = """SELECT o_custkey AS run_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'discovery'
    WHEN '2-HIGH' THEN 'scoping' WHEN '3-MEDIUM' THEN 'planning' WHEN '4-NOT SPECIFIED' THEN 'development'
    WHEN '5-LOW' THEN 'deploy' END AS phase, o_orderstatus = 'F' AS completed, o_orderstatus = 'P' AS failed
    FROM orders"""

B36 = "'0123456789abcdefghijklmnopqrstuvwxyz'"
RUN_IDS = f"""SELECT o_orderkey, array_to_string([substr({B36}, CAST((o_orderkey // CAST(pow(36, 5 - i) AS BIGINT)) % 36 AS INT) + 1, 1)
    FOR i IN range(6)], '') || '-' || o_orderstatus || lower(substr(o_orderpriority, 3, 1)) AS run_id FROM orders"""


def base36_bucket(x: str, n: int = 15) -> str:
    s = f"regexp_replace(substr({x}, 1, 8), '[^0-9A-Za-z]', '', 'g')"
    val = (f"CAST(list_sum([(strpos({B36}, lower(substr({s}, i, 1))) - 1) * CAST(pow(36, length({s}) - i) AS BIGINT) "
           f"FOR i IN range(1, length({s}) + 1)]) AS BIGINT)")
    return f"CAST({val} % {n} AS INT)"


PART_EDGES = "SELECT p_partkey AS node, p_partkey // 2 AS prereq FROM part WHERE p_partkey > 0"
PART_CLOSURE = f"""e AS ({PART_EDGES}),
c(node, prereq) AS (SELECT node, prereq FROM e UNION SELECT c.node, e.prereq FROM c JOIN e ON c.prereq = e.node)"""
