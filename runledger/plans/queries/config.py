"""Configuration queries (U-01, J-03, A-15, U-06, FL-04, FN-10..16, FN-25)."""

from __future__ import annotations

from pyspark.sql import functions as F

from runledger.functions import config as C
from runledger.operators import config as CFG
from runledger.plans import bindings as B
from runledger.plans import oracle as O
from runledger.plans.queries.registry import register
from runledger.plans.tables import table


@register("config_overlay", f"""WITH l AS ({O.CONFIG_LAYERS})
SELECT key, arg_max(priority, (priority, seq)) AS priority, arg_max(seq, (priority, seq)) AS seq,
  arg_max(value, (priority, seq)) AS value, arg_max(layer, (priority, seq)) AS layer FROM l GROUP BY key""")
def q_config_overlay(spark, sf):
    """U-01: five-layer style overlay, later layer and later line win."""
    return CFG.overlay(B.config_layers(spark, sf))


_SENS = {k: v for k, v in C.SENSITIVE_WORDS.items()}
_CAT_SQL = "CASE " + " ".join(f"WHEN {O.contains_any('key', ws)} THEN '{name}'" for name, ws in C.CATEGORIES) \
    + f" ELSE '{C.OTHER_CATEGORY}' END"


@register("config_key_report", f"""WITH k AS ({O.PART_KEYS})
SELECT p_partkey, key, {O.contains_any('key', _SENS['generic'])} AS sensitive,
  {O.contains_any('key', _SENS['parameter'])} AS sensitive_param,
  {O.contains_any('key', _SENS['display'])} AS sensitive_display,
  CASE WHEN {O.contains_any('key', _SENS['generic'])} THEN 'your-secret-value-here' ELSE value END AS template_value,
  CASE WHEN {O.contains_any('key', _SENS['display'])} THEN '***HIDDEN***' ELSE value END AS display_value,
  {_CAT_SQL} AS category,
  '/runs/dev/' || replace(key, '_', '/') AS param_name,
  CASE WHEN {O.contains_any('key', _SENS['parameter'])} THEN 'SecureString' ELSE 'String' END AS param_type
FROM k""")
def q_config_key_report(spark, sf):
    """FN-10, FN-11, FN-12, FN-16 and SRC-08 typing: sensitivity under the three lists, masks,
    category, parameter path and type for config keys built from part names."""
    k = B.part_keys(spark, sf)
    return k.select("p_partkey", "key",
                    C.is_sensitive("key", "generic").alias("sensitive"),
                    C.is_sensitive("key", "parameter").alias("sensitive_param"),
                    C.is_sensitive("key", "display").alias("sensitive_display"),
                    C.mask_value("key", "value", "template").alias("template_value"),
                    C.mask_value("key", "value", "display").alias("display_value"),
                    C.categorise("key").alias("category"),
                    C.key_to_path("key", "/runs/dev").alias("param_name"),
                    C.param_type("key").alias("param_type"))


_VAL_SQL = f"""WITH c AS ({O.CONFIG_VALUES}), s AS ({O.CONFIG_SCHEMA}),
j AS (SELECT c.run_id, c.key, c.value_json, s.type, s.pattern, {O.json_type('c.value_json')} AS t,
      CASE WHEN {O.json_type('c.value_json')} = 'str' THEN json_extract_string('[' || c.value_json || ']', '$[0]') END AS sv
      FROM c JOIN s ON c.key = s.key),
e AS (SELECT run_id, key, CASE
    WHEN type = 'string' AND t <> 'str' THEN key || ': Expected string, got ' || t
    WHEN type = 'integer' AND t NOT IN ('int', 'bool') THEN key || ': Expected integer, got ' || t
    WHEN type = 'number' AND t NOT IN ('int', 'float', 'bool') THEN key || ': Expected number, got ' || t
    WHEN type = 'boolean' AND t <> 'bool' THEN key || ': Expected boolean, got ' || t END AS error FROM j
  UNION ALL SELECT run_id, key, key || ': Does not match pattern ' || pattern FROM j
    WHERE pattern IS NOT NULL AND t = 'str' AND NOT regexp_matches(sv, '^(?:' || pattern || ')')),
r AS (SELECT DISTINCT c.run_id, s.key FROM (SELECT run_id FROM c UNION SELECT s_suppkey + 1000000000 FROM supplier) c, s WHERE s.required),
m AS (SELECT r.run_id, r.key, 'Missing required field: ' || r.key AS error FROM r
  WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.run_id = r.run_id AND c.key = r.key AND {O.truthy('c.value_json')}))
SELECT run_id, key, error FROM e WHERE error IS NOT NULL UNION ALL SELECT * FROM m"""


@register("config_validate", _VAL_SQL)
def q_config_validate(spark, sf):
    """J-03: required / type / pattern violations of per-customer configs; suppliers' runs
    have no config at all and miss every required key."""
    values = B.config_values(spark, sf)
    bare = table(spark, sf, "supplier").select((F.col("s_suppkey") + 1000000000).alias("run_id"))
    return CFG.validate(values, B.config_schema(spark), runs=values.select("run_id").unionByName(bare))


@register("config_infer_schema", f"""WITH c AS ({O.CONFIG_VALUES}),
v AS (SELECT key, CASE {O.json_type('value_json')} WHEN 'bool' THEN 'boolean' WHEN 'int' THEN 'integer'
      WHEN 'float' THEN 'number' ELSE 'string' END AS t,
      CASE WHEN {O.json_type('value_json')} = 'str' THEN CASE WHEN contains(lower(key), 'port') THEN '^[0-9]+$'
        WHEN contains(lower(key), 'url') THEN '^https?://' WHEN contains(lower(key), 'email') THEN '^[^@]+@[^@]+\\.[^@]+$' END
      END AS p,
      NOT {O.contains_any('key', _SENS['generic'])} AND {O.truthy('value_json')} AS req FROM c),
a AS (SELECT key, list_distinct(list(t)) AS ts, max(p) AS pattern, bool_and(req) AS required FROM v GROUP BY key),
b AS (SELECT key, CASE WHEN len(ts) = 1 THEN ts[1]
      WHEN len(list_filter(ts, lambda x: x NOT IN ('integer', 'number'))) = 0 THEN 'number' ELSE 'string' END AS type,
      pattern, required FROM a)
SELECT key, type, CASE WHEN type = 'string' THEN pattern END AS pattern,
  'Configuration value for ' || key AS description, required FROM b""")
def q_config_infer_schema(spark, sf):
    """A-15: schema inferred per key over all customer configs."""
    return CFG.infer_schema(B.config_values(spark, sf))


_SYNC_LOCAL = "SELECT 'PART_' || p_partkey AS key, p_name AS value FROM part"
_SYNC_CLOUD = ("SELECT 'PART_' || p_partkey AS key, CASE WHEN p_size > 40 THEN p_type ELSE p_name END AS value "
               "FROM part WHERE p_size > 10")


def _sync_frames(spark, sf):
    p = table(spark, sf, "part")
    local = p.select(F.concat(F.lit("PART_"), F.col("p_partkey").cast("string")).alias("key"),
                     F.col("p_name").alias("value"))
    cloud = p.filter(F.col("p_size") > 10).select(
        F.concat(F.lit("PART_"), F.col("p_partkey").cast("string")).alias("key"),
        F.when(F.col("p_size") > 40, F.col("p_type")).otherwise(F.col("p_name")).alias("value"))
    return local, cloud


for _dir, _gone in (("local_to_cloud", "untouched"), ("cloud_to_local", "delete")):
    _src, _dst = (_SYNC_LOCAL, _SYNC_CLOUD) if _dir == "local_to_cloud" else (_SYNC_CLOUD, _SYNC_LOCAL)

    def _mk(direction):
        def q(spark, sf):
            local, cloud = _sync_frames(spark, sf)
            return CFG.sync_plan(local, cloud, direction).groupBy("action").agg(F.count(F.lit(1)).alias("n_keys"))
        q.__doc__ = f"U-06: sync plan {direction}, counted per action."
        return q

    register(f"config_sync_{_dir}", f"""WITH s AS ({_src}), d AS ({_dst}),
j AS (SELECT coalesce(s.key, d.key) AS key, s.value AS sv, d.value AS dv FROM s FULL OUTER JOIN d ON s.key = d.key)
SELECT CASE WHEN sv IS NULL AND dv IS NOT NULL THEN '{_gone}' WHEN dv IS NULL THEN 'insert'
  WHEN sv = dv THEN 'same' ELSE 'update' END AS action, count(*) AS n_keys FROM j GROUP BY 1""")(_mk(_dir))


@register("config_only_keys", f"""WITH k AS ({O.PART_KEYS})
SELECT key, value FROM k WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)""")
def q_config_only_keys(spark, sf):
    """FL-04: keep the keys of parts ever ordered in quantities above 45 (semi join)."""
    k = B.part_keys(spark, sf)
    wanted = table(spark, sf, "lineitem").filter(F.col("l_quantity") > 45).select(F.col("l_partkey").alias("p_partkey"))
    return CFG.only_keys(k, wanted, "p_partkey").select("key", "value")


_FILL_SPEC = {"service": "lambda", "memory_mb": 128, "timeout_s": 30,
              "scaling": {"min": 1, "max": 10, "enabled": False}}


@register("fill_defaults", """WITH r AS (SELECT p_partkey, '{"service": "' || lower(p_type) || '"' ||
    CASE WHEN p_size > 25 THEN ', "memory_mb": ' || (p_size * 64) ELSE '' END ||
    CASE WHEN p_size % 2 = 0 THEN ', "scaling": {"max": ' || p_size || '}' ELSE '' END || '}' AS req FROM part)
SELECT p_partkey, coalesce(json_extract_string(req, '$.service'), 'lambda') AS service,
  coalesce(TRY_CAST(json_extract_string(req, '$.memory_mb') AS BIGINT), 128) AS memory_mb,
  coalesce(TRY_CAST(json_extract_string(req, '$.timeout_s') AS BIGINT), 30) AS timeout_s,
  coalesce(TRY_CAST(json_extract_string(req, '$.scaling.min') AS BIGINT), 1) AS scaling_min,
  coalesce(TRY_CAST(json_extract_string(req, '$.scaling.max') AS BIGINT), 10) AS scaling_max,
  coalesce(TRY_CAST(json_extract_string(req, '$.scaling.enabled') AS BOOLEAN), false) AS scaling_enabled FROM r""")
def q_fill_defaults(spark, sf):
    """FN-25: nested service config from sparse JSON requests built from part rows."""
    p = table(spark, sf, "part")
    req = F.concat(F.lit('{"service": "'), F.lower("p_type"), F.lit('"'),
                   F.when(F.col("p_size") > 25, F.concat(F.lit(', "memory_mb": '), (F.col("p_size") * 64).cast("string")))
                    .otherwise(F.lit("")),
                   F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(', "scaling": {"max": '), F.col("p_size").cast("string"), F.lit("}")))
                    .otherwise(F.lit("")), F.lit("}"))
    s = CFG.fill_defaults(req, _FILL_SPEC).alias("cfg")
    return p.select("p_partkey", s).select("p_partkey", F.col("cfg.service").alias("service"),
                                           F.col("cfg.memory_mb").alias("memory_mb"), F.col("cfg.timeout_s").alias("timeout_s"),
                                           F.col("cfg.scaling.min").alias("scaling_min"), F.col("cfg.scaling.max").alias("scaling_max"),
                                           F.col("cfg.scaling.enabled").alias("scaling_enabled"))


_SERVICES = ("Lambda", "RDS", "DynamoDB", "S3", "CloudFront", "Cognito", "SageMaker")
_SVC_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_tax", "l_discount")
_SVC_SQL = f"""SELECT l_orderkey AS project, {", ".join(_SVC_ORDER)},
  [{", ".join(f"'{x}'" for x in _SERVICES)}][l_linenumber] AS service,
  CASE WHEN l_returnflag = 'R' THEN 'nodejs18.x' END AS runtime,
  CASE WHEN l_quantity > 25 THEN CAST(l_quantity * 32 AS BIGINT) END AS memory,
  CASE WHEN l_discount > 0.05 THEN CAST(60 AS BIGINT) END AS timeout,
  CASE WHEN l_linestatus = 'O' THEN 'mysql' END AS engine,
  CASE WHEN l_tax > 0.06 THEN 'db.t3.small' END AS instanceClass FROM lineitem"""
_ORD = "(" + ", ".join(_SVC_ORDER) + ")"


@register("service_needs", f"""WITH s AS ({_SVC_SQL}),
a AS (SELECT project,
  max(CASE WHEN service = 'Lambda' THEN true END) AS compute_serverless,
  CASE WHEN count_if(service = 'Lambda') > 0 THEN coalesce(arg_max_null(CASE WHEN service = 'Lambda' THEN runtime END,
    CASE WHEN service = 'Lambda' THEN {_ORD} END), 'python3.11') END AS compute_runtime,
  CASE WHEN count_if(service = 'Lambda') > 0 THEN coalesce(arg_max_null(CASE WHEN service = 'Lambda' THEN memory END,
    CASE WHEN service = 'Lambda' THEN {_ORD} END), 512) END AS compute_memory,
  CASE WHEN count_if(service = 'Lambda') > 0 THEN coalesce(arg_max_null(CASE WHEN service = 'Lambda' THEN timeout END,
    CASE WHEN service = 'Lambda' THEN {_ORD} END), 30) END AS compute_timeout,
  max(CASE WHEN service = 'RDS' THEN true END) AS database_relational,
  CASE WHEN count_if(service = 'RDS') > 0 THEN coalesce(arg_max_null(CASE WHEN service = 'RDS' THEN engine END,
    CASE WHEN service = 'RDS' THEN {_ORD} END), 'postgres') END AS database_engine,
  CASE WHEN count_if(service = 'RDS') > 0 THEN coalesce(arg_max_null(CASE WHEN service = 'RDS' THEN instanceClass END,
    CASE WHEN service = 'RDS' THEN {_ORD} END), 'db.t3.micro') END AS database_instance_class,
  max(CASE WHEN service = 'DynamoDB' THEN true END) AS database_nosql,
  max(CASE WHEN service = 'S3' THEN true END) AS storage_object,
  max(CASE WHEN service = 'S3' THEN true END) AS storage_versioning,
  max(CASE WHEN service = 'CloudFront' THEN true END) AS storage_cdn,
  max(CASE WHEN service = 'Cognito' THEN true END) AS auth_user_pool FROM s GROUP BY project)
SELECT *, true AS networking_api, 'REST' AS networking_api_type FROM a""")
def q_service_needs(spark, sf):
    """FN-25 (service-to-need mapping): requirements per order (project) whose lines
    list services; the fixed mapping joins by name and pivots into flags."""
    li = table(spark, sf, "lineitem")
    svc = F.element_at(F.array(*[F.lit(x) for x in _SERVICES]), F.col("l_linenumber"))
    s = li.select(F.col("l_orderkey").alias("project"), *_SVC_ORDER, svc.alias("service"),
                  F.when(F.col("l_returnflag") == "R", F.lit("nodejs18.x")).alias("runtime"),
                  F.when(F.col("l_quantity") > 25, (F.col("l_quantity") * 32).cast("bigint")).alias("memory"),
                  F.when(F.col("l_discount") > 0.05, F.lit(60).cast("bigint")).alias("timeout"),
                  F.when(F.col("l_linestatus") == "O", F.lit("mysql")).alias("engine"),
                  F.when(F.col("l_tax") > 0.06, F.lit("db.t3.small")).alias("instanceClass"))
    return CFG.service_needs(s, ["project"], order_cols=_SVC_ORDER)
