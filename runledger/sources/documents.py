"""Structured documents: state snapshots (SRC-09/10), issues (SRC-11/12), stacks
(SRC-14) and nested lists (SRC-15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Core fields of a run state snapshot; everything else is extended state.
STATE_CORE_SCHEMA = ("adw_id string, issue_number string, branch_name string, plan_file string, issue_class string, "
                     "worktree_path string, backend_port int, frontend_port int, model_set string, "
                     "all_adws array<string>, infrastructure_deployed boolean, infrastructure_tested boolean")
STATE_CORE = tuple(f.split()[0] for f in STATE_CORE_SCHEMA.split(", "))
USER = "struct<id: string, login: string, name: string, is_bot: boolean>"
COMMENT = f"struct<id: string, author: {USER}, body: string, createdAt: string, updatedAt: string>"
LABEL = "struct<id: string, name: string, color: string, description: string>"
ISSUE_SCHEMA = (f"number int, title string, body string, state string, author {USER}, assignees array<{USER}>, "
                f"labels array<{LABEL}>, milestone struct<id: string, number: int, title: string, description: string, "
                f"state: string>, comments array<{COMMENT}>, createdAt string, updatedAt string, closedAt string, url string")
STACK_SCHEMA = ("array<struct<stack_name: string, stack_id: string, status: string, region: string, "
                "outputs: map<string,string>, parameters: map<string,string>, deployed_at: string, error_message: string>>")


def _whole(spark: SparkSession, path: str) -> DataFrame:
    from runledger.sources.logs import whole_files
    return whole_files(spark, path)


def to_state_json(core: Column, extended: Column | None = None) -> Column:
    """SRC-10: core fields with nulls dropped (``to_json`` omits them), then extended keys
    overlaid; on a clash the extended value wins (LAST_WIN map policy)."""
    if extended is None:
        return F.to_json(core)
    core_map = F.from_json(F.to_json(core), "map<string,variant>")
    ext = F.coalesce(F.from_json(F.to_json(extended), "map<string,variant>"), F.create_map().cast("map<string,variant>"))
    # drop clashing core keys first, so no map-key dedup policy is needed
    core_only = F.map_filter(core_map, lambda k, v: ~F.array_contains(F.map_keys(ext), k))
    return F.to_json(F.map_concat(core_only, ext))


def _docs(spark: SparkSession, path: str, per_file: bool) -> DataFrame:
    """One document per file (``per_file``) or one per line (JSON Lines)."""
    if per_file:
        return _whole(spark, path)
    from runledger.sources.logs import text_lines
    return text_lines(spark, path).select("file", F.col("line").alias("value"))


def read_state(spark: SparkSession, path: str, per_file: bool = True) -> DataFrame:
    """SRC-09: one row per state document: core fields typed, the rest as an extended
    map of JSON texts. A missing file simply yields no row."""
    raw = _docs(spark, path, per_file)
    core = F.from_json("value", STATE_CORE_SCHEMA)
    allm = F.from_json("value", "map<string,variant>")
    core_keys = F.array(*[F.lit(k) for k in STATE_CORE])
    ext = F.transform_values(F.map_filter(allm, lambda k, v: ~F.array_contains(core_keys, k)), lambda k, v: F.to_json(v))
    return raw.select("file", core.alias("core"), ext.alias("extended")).select("file", "core.*", "extended")


def state_get(key: str, default=None) -> Column:
    """State lookup on ``read_state`` rows: a core field by exact name (null -> default),
    else a dotted path into extended state; a missing key or a non-object on the way
    gives the default."""
    if key in STATE_CORE:
        c = F.col(key)
    else:
        head, *rest = key.split(".")
        c = F.get_json_object(F.col("extended")[head], "$" + "".join("." + r for r in rest))
    return F.coalesce(c, F.lit(default)) if default is not None else c


def read_issues(spark: SparkSession, path: str, per_file: bool = True) -> DataFrame:
    """SRC-11: issue documents with nested author, labels, assignees and comments;
    camelCase fields renamed, timestamps parsed."""
    raw = _docs(spark, path, per_file)
    i = raw.select(F.from_json("value", ISSUE_SCHEMA).alias("i")).select("i.*")
    return (i.withColumn("created_at", utc_wallclock(F.col("createdAt")))
             .withColumn("updated_at", utc_wallclock(F.col("updatedAt")))
             .withColumn("closed_at", utc_wallclock(F.col("closedAt")))
             .withColumn("comments", F.transform("comments", lambda c: F.struct(
                 c["id"].alias("id"), c["author"].alias("author"), c["body"].alias("body"),
                 utc_wallclock(c["createdAt"]).alias("created_at"), utc_wallclock(c["updatedAt"]).alias("updated_at"))))
             .drop("createdAt", "updatedAt", "closedAt"))


def utc_wallclock(iso: Column) -> Column:
    """ISO-8601 UTC text (``...Z``) as a timestamp without time zone in UTC wall-clock
    time, so results do not depend on the session time zone; bad text gives null."""
    return F.regexp_replace(iso, "Z$", "").try_cast("timestamp_ntz")


def issue_comments(issues: DataFrame) -> DataFrame:
    """SRC-11: one row per comment (issues without comments keep one null row)."""
    return issues.select("number", F.posexplode_outer("comments").alias("pos", "c")).select(
        "number", "pos", F.col("c.id").alias("comment_id"), F.col("c.author.login").alias("author"),
        F.col("c.body").alias("body"), F.col("c.created_at").alias("created_at"))


def open_issues(issues: DataFrame, limit: int = 1000, cols: Sequence[str] = ("number", "title", "body", "labels",
                                                                             "created_at", "updated_at")) -> DataFrame:
    """SRC-12: open issues, a column subset, newest first, at most ``limit`` (the listing
    limit is the feature). Filter and columns reach the scan."""
    return (issues.filter(F.col("state") == "open").select(*cols)
                  .orderBy(F.col("created_at").desc(), F.col("number").desc()).limit(limit))


def read_stacks(spark: SparkSession, path: str, per_file: bool = True) -> DataFrame:
    """SRC-14: observed stacks, one row each; a missing status reads as ``unknown``."""
    raw = _docs(spark, path, per_file)
    return (raw.select("file", F.inline(F.from_json("value", STACK_SCHEMA)))
               .withColumn("status", F.coalesce("status", F.lit("unknown"))))


def stack_lookup(stacks: DataFrame, names: DataFrame, name_col: str = "stack_name") -> DataFrame:
    """SRC-14: outputs and status by stack name; names not listed read as ``unknown``."""
    return names.join(stacks.select(name_col, "status", "outputs"), name_col, "left") \
                .withColumn("status", F.coalesce("status", F.lit("unknown")))


def explode_list(df: DataFrame, json_col: str, path: str, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """SRC-15: a nested list inside a document as rows with their position; a document
    without the list keeps one row with nulls."""
    arr = F.from_json(F.get_json_object(F.col(json_col), path), f"array<{schema}>")
    return df.select(*keep, F.posexplode_outer(arr).alias("pos", "item")).select(*keep, "pos", "item.*")
