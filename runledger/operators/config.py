"""Configuration operators: overlay (U-01), validation (J-03), schema inference (A-15),
sync plan (U-06), key filter (FL-04), default filling (FN-25)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.functions import config as C
from runledger.functions.text import fill_template
from runledger.operators.runs import latest

# Layer priorities, lowest first (later layers win).
LAYER_PRIORITY = {"ports": 0, "local": 1, "base": 2, "environment": 3, "cloud": 4}
# Validation and schema texts ({name} marks a filled-in value).
MISSING_FIELD = "Missing required field: {key}"
TYPE_ERROR = "{key}: Expected {expected}, got {got}"
PATTERN_ERROR = "{key}: Does not match pattern {pattern}"
DESCRIPTION = "Configuration value for {key}"


def overlay(layers: DataFrame, keys: Sequence[str] = ("key",), priority_col: str = "priority",
            seq_col: str = "seq") -> DataFrame:
    """U-01: later layer wins per key; inside a layer the later line wins.

    ``layers`` is the union of all layers with a priority and an in-layer sequence.
    Partial aggregation (max over a struct) keeps a hot key from landing whole in one task.
    """
    return latest(layers, list(keys), [priority_col, seq_col], ["value", "layer"])


def validate(config: DataFrame, schema: DataFrame, run_cols: Sequence[str] = ("run_id",),
             runs: DataFrame | None = None) -> DataFrame:
    """J-03: violations of config rows (run, key, value_json) against schema rows
    (key, type, pattern, required). Keys outside the schema are skipped.

    Required: the key is missing or its value is falsy (0, false, "" count as missing).
    Type: ``bool`` passes an integer or number check (Python subclass rule).
    Pattern: only for string values, anchored at the start only.
    ``runs`` lists the runs to report on, so that one without any config row misses every
    required key; without it, the runs are those of ``config``. The schema's required keys
    stay in the plan as one array; nothing is read while the plan is built.
    """
    run_cols = list(run_cols)
    config = config.withColumn("_t", C.json_type("value_json")).withColumn("_truthy", C.truthy("value_json"))
    req = schema.filter(F.col("required")).agg(F.sort_array(F.collect_set("key"))).scalar()
    t = F.col("_t")
    checked = config.join(schema, "key")
    bad_type = (((F.col("type") == "string") & (t != "str"))
                | ((F.col("type") == "integer") & ~t.isin("int", "bool"))
                | ((F.col("type") == "number") & ~t.isin("int", "float", "bool"))
                | ((F.col("type") == "boolean") & (t != "bool")))
    type_err = F.when(bad_type, fill_template(TYPE_ERROR, {"key": F.col("key"), "expected": F.col("type"), "got": t}))
    s = C.json_string_value("value_json")
    pat_err = F.when(F.col("pattern").isNotNull() & (t == "str")
                     & ~F.regexp(s, F.concat(F.lit("^(?:"), F.col("pattern"), F.lit(")"))),
                     fill_template(PATTERN_ERROR, {"key": F.col("key"), "pattern": F.col("pattern")}))
    errs = checked.select(*run_cols, "key", F.array(type_err, pat_err).alias("_e")) \
                  .select(*run_cols, "key", F.explode(F.filter("_e", lambda x: x.isNotNull())).alias("error"))
    # one shuffle per run: the set of required keys present with a truthy value
    # (bounded by the schema size); runs without any still appear with an empty set
    have = config.select(*run_cols, F.when(F.col("_truthy") & F.array_contains(req, F.col("key")), F.col("key")).alias("key"))
    if runs is not None:
        have = have.unionByName(runs.select(*run_cols, F.lit(None).cast("string").alias("key")))
    missing = (have.groupBy(*run_cols).agg(F.collect_set("key").alias("_have"))
                   .select(*run_cols, F.explode(F.array_except(req, "_have")).alias("key"))
                   .withColumn("error", fill_template(MISSING_FIELD, {"key": F.col("key")})))
    return missing.unionByName(errs)


def infer_schema(config: DataFrame, run_cols: Sequence[str] = ("run_id",)) -> DataFrame:
    """A-15: schema rows inferred from config values over all runs.

    Per value: bool -> boolean, int -> integer, float -> number, else string, with a
    pattern for string keys naming port, url or email (in that order). Per key over
    runs: one type if all agree, integer+number -> number, otherwise string; required
    when the key is not sensitive and its value is truthy in every run.
    """
    inf = C.infer_type("key", "value_json")
    per = config.select("key", inf.type.alias("t"), inf.pattern.alias("p"),
                        (~C.is_sensitive("key", "generic") & C.truthy("value_json")).alias("req"))
    agg = per.groupBy("key").agg(F.collect_set("t").alias("ts"), F.max("p").alias("pattern"),
                                 F.bool_and("req").alias("required"))
    typ = (F.when(F.size("ts") == 1, F.element_at("ts", 1))
            .when(F.size(F.array_except("ts", F.array(F.lit("integer"), F.lit("number")))) == 0, F.lit("number"))
            .otherwise(F.lit("string")))
    return agg.select("key", typ.alias("type"),
                      F.when(typ == "string", F.col("pattern")).alias("pattern"),
                      fill_template(DESCRIPTION, {"key": F.col("key")}).alias("description"),
                      "required")


def sync_plan(local: DataFrame, cloud: DataFrame, direction: str = "local_to_cloud",
              keys: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """U-06: one action per key: insert, update, same, untouched or delete.

    local_to_cloud writes local keys to the cloud (cloud-only keys untouched).
    cloud_to_local replaces the local file, so local-only keys are lost (delete).
    """
    if direction == "local_to_cloud":
        src, dst = only_keys(local, keys), cloud
    elif direction == "cloud_to_local":
        src, dst = only_keys(cloud, keys), local
    else:
        raise ValueError(f"invalid sync direction {direction}")
    j = src.select("key", F.col("value").alias("src_value")).join(
        dst.select("key", F.col("value").alias("dst_value")), "key", "full_outer")
    gone = "untouched" if direction == "local_to_cloud" else "delete"
    action = (F.when(F.col("src_value").isNull() & F.col("dst_value").isNotNull(), F.lit(gone))
               .when(F.col("dst_value").isNull(), F.lit("insert"))
               .when(F.col("src_value") == F.col("dst_value"), F.lit("same"))
               .otherwise(F.lit("update")))
    return j.select("key", action.alias("action"))


def only_keys(df: DataFrame, keys: Sequence[str] | DataFrame | None, key_col: str = "key") -> DataFrame:
    """FL-04: keep requested keys; an empty request keeps all. A DataFrame of keys is
    applied as a semi join (Catalyst broadcasts it when its size estimate is small)."""
    if keys is None:
        return df
    if isinstance(keys, DataFrame):
        return df.join(keys.select(F.col(keys.columns[0]).alias(key_col)).distinct(), key_col, "left_semi")
    keys = list(keys)
    return df if not keys else df.filter(F.col(key_col).isin(*keys))


def fill_defaults(json_col, spec: Mapping[str, object], path: str = "$") -> Column:
    """FN-25: nested struct from a sparse JSON request, each leaf defaulted.

    ``spec`` maps field -> default value (leaf) or a nested mapping. Leaves are read
    with ``get_json_object`` and cast to the default's type.
    """
    fields = []
    for name, default in spec.items():
        p = f"{path}.{name}"
        if isinstance(default, Mapping):
            fields.append(fill_defaults(json_col, default, p).alias(name))
            continue
        raw = F.get_json_object(json_col if not isinstance(json_col, str) else F.col(json_col), p)
        typ = ("boolean" if isinstance(default, bool) else "bigint" if isinstance(default, int)
               else "double" if isinstance(default, float) else "string")
        fields.append(F.coalesce(raw.try_cast(typ), F.lit(default).cast(typ)).alias(name))
    return F.struct(*fields)


# What each listed service turns on, as (service, section, flag).
SERVICE_NEEDS = (
    ("Lambda", "compute", "serverless"),
    ("RDS", "database", "relational"),
    ("DynamoDB", "database", "nosql"),
    ("S3", "storage", "objectStorage"),
    ("S3", "storage", "versioning"),
    ("CloudFront", "storage", "cdn"),
    ("Cognito", "auth", "userPool"),
)
# Defaults for the settings read from a service entry.
SERVICE_DEFAULTS = {"runtime": "python3.11", "memory": 512, "timeout": 30,
                    "engine": "postgres", "instanceClass": "db.t3.micro"}
NETWORKING_DEFAULTS = {"api": True, "apiType": "REST"}


def service_needs(services: DataFrame, project_cols: Sequence[str], service_col: str = "service",
                  order_cols: Sequence[str] = ("position",)) -> DataFrame:
    """FN-25 (service-to-need mapping): infrastructure requirements per project from its
    listed services.

    The fixed mapping is a small constant table joined by service name (broadcast by
    size) and pivoted with ``max`` per flag; a flag no service sets stays null (absent).
    Lambda's runtime/memory/timeout and RDS's engine/instanceClass come from the last
    such service in list order (later entries overwrite), defaulted when missing.
    Networking always gets its defaults.
    """
    from runledger.session import constant_table
    projects = list(project_cols)
    needs = constant_table(services.sparkSession, SERVICE_NEEDS, "service string, section string, flag string")
    flags = (services.select(*projects, F.col(service_col).alias("service")).join(needs, "service")
                     .groupBy(*projects).pivot("flag", [f for _, _, f in SERVICE_NEEDS])
                     .agg(F.max(F.lit(True))))
    order = [F.col(c) for c in order_cols]
    last = lambda svc, cols: (services.filter(F.col(service_col) == svc)
                              .groupBy(*projects).agg(F.max(F.struct(*order, *[F.col(c) for c in cols])).alias(f"_{svc}")))
    lam, rds = last("Lambda", ["runtime", "memory", "timeout"]), last("RDS", ["engine", "instanceClass"])
    d = SERVICE_DEFAULTS
    out = (services.select(*projects).distinct().join(flags, projects, "left")
                   .join(lam, projects, "left").join(rds, projects, "left"))
    has_l, has_r = F.col("_Lambda").isNotNull(), F.col("_RDS").isNotNull()
    return out.select(
        *projects,
        F.col("serverless").alias("compute_serverless"),
        F.when(has_l, F.coalesce(F.col("_Lambda.runtime"), F.lit(d["runtime"]))).alias("compute_runtime"),
        F.when(has_l, F.coalesce(F.col("_Lambda.memory"), F.lit(d["memory"]))).alias("compute_memory"),
        F.when(has_l, F.coalesce(F.col("_Lambda.timeout"), F.lit(d["timeout"]))).alias("compute_timeout"),
        F.col("relational").alias("database_relational"),
        F.when(has_r, F.coalesce(F.col("_RDS.engine"), F.lit(d["engine"]))).alias("database_engine"),
        F.when(has_r, F.coalesce(F.col("_RDS.instanceClass"), F.lit(d["instanceClass"]))).alias("database_instance_class"),
        F.col("nosql").alias("database_nosql"), F.col("objectStorage").alias("storage_object"),
        F.col("versioning").alias("storage_versioning"), F.col("cdn").alias("storage_cdn"),
        F.col("userPool").alias("auth_user_pool"),
        F.lit(NETWORKING_DEFAULTS["api"]).alias("networking_api"), F.lit(NETWORKING_DEFAULTS["apiType"]).alias("networking_api_type"))
