"""Configuration sources and sinks (SRC-04..08)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.functions import config as C
from runledger.sources.exports import read_fragments, write_fragments
from runledger.sources.logs import file_lines, whole_files
from runledger.sources.yaml_fold import parsed_lines, yaml_json


def parse_kv(lines: DataFrame, keys=("file",)) -> DataFrame:
    """Settings of numbered ``.env`` lines (keys..., line_no, line): trimmed, blanks and ``#`` lines
    dropped, split on the first ``=`` (both sides trimmed), lines without ``=`` dropped; of a repeated
    setting the later one wins."""
    lines = lines.withColumn("line", F.trim("line"))
    kv = (lines.filter(~F.col("line").startswith("#") & F.col("line").contains("="))
               .select(*keys, "line_no", F.split("line", "=", 2).alias("p"))
               .select(*keys, "line_no", F.trim(F.col("p")[0]).alias("key"), F.trim(F.col("p")[1]).alias("value")))
    last = kv.groupBy(*keys, "key").agg(F.max(F.struct("line_no", "value")).alias("_b"))
    return last.select(*keys, "key", F.col("_b.value").alias("value"), F.col("_b.line_no").alias("line_no"))


def read_kv(spark: SparkSession, path: str) -> DataFrame:
    """SRC-04: settings of every ``.env`` file under ``path``: (file, key, value, line_no).

    Spark's file index skips hidden names (leading ``.`` or ``_``), explicit paths
    included, so fleet ``.env`` files must be stored under visible names (for example
    ``<run>/dotenv``) to be read here.
    """
    return parse_kv(file_lines(spark, path))


def write_kv(df: DataFrame, path: str, group_cols=(), key_col: str = "key", value_col: str = "value",
             order_col: str | None = None) -> None:
    """SRC-05: ``key=value`` lines of every group (or of the whole table) in order, as fragments: no
    group is gathered into one value. A null key or value is left out of its line."""
    write_fragments(df, list(group_cols), [order_col or key_col], F.concat_ws("=", key_col, value_col), path)


def read_kv_export(spark: SparkSession, path: str) -> DataFrame:
    """SRC-04 on a :func:`write_kv` export: (group..., key, value, line_no)."""
    lines = read_fragments(spark, path)
    return parse_kv(lines, tuple(c for c in lines.columns if c not in ("line_no", "line")))


def read_config_docs(spark: SparkSession, path: str, fmt: str = "json", refused: str = "error") -> DataFrame:
    """SRC-06: top-level keys of structured config files as (file, key, value_json).

    JSON is parsed by Spark (as a map of JSON texts), YAML by a fold over a document's lines
    (``yaml_fold.py``) into JSON first. Empty files hold no keys. A document that cannot be read, or is
    no mapping, ends the job with its name (``refused="error"``) or is a row with a null key (``"rows"``).
    """
    if fmt not in ("json", "yaml") or refused not in ("error", "rows"):
        raise ValueError((fmt, refused))
    raw = whole_files(spark, path).filter(F.col("value").rlike(r"\S"))
    if fmt == "yaml":
        raw = raw.select("file", parsed_lines(F.col("value")).alias("lines")).select("file", yaml_json(F.col("lines")).alias("value"))
    # each top-level value as a VARIANT, printed back as exact JSON text
    docs = raw.select("file", F.from_json(F.col("value"), "map<string,variant>").alias("m"))
    if refused == "error":
        stop = F.raise_error(F.concat(F.lit(f"no readable {fmt} mapping: "), F.col("file"))).cast("map<string,variant>")
        rows = docs.select("file", F.explode(F.when(F.col("m").isNull(), stop).otherwise(F.col("m"))).alias("key", "_v"))
    else:
        known = docs.filter("m IS NOT NULL").select("file", F.explode("m").alias("key", "_v"))
        rows = known.unionByName(docs.filter("m IS NULL").select("file"), allowMissingColumns=True)
    value = F.when(F.col("key").isNotNull(), F.coalesce(F.to_json("_v"), F.lit("null")))
    return rows.select("file", "key", value.alias("value_json"))


def layered(docs: DataFrame, priority: dict, keys=("run_id", "key")) -> DataFrame:
    """SRC-06: base file then environment file: the later layer wins per key.
    ``docs`` carries a ``layer`` column naming each file's layer."""
    from runledger.operators.config import overlay
    m = F.create_map(*[x for k, v in priority.items() for x in (F.lit(k), F.lit(v))])
    return overlay(docs.select(*keys, F.col("value_json").alias("value"), "layer",
                               m[F.col("layer")].alias("priority"), F.lit(0).alias("seq")), list(keys))


def params_under(df: DataFrame, prefix: str, name_col: str = "name") -> DataFrame:
    """SRC-07: parameters under ``prefix`` (recursive): key = name without ``prefix/``
    and with ``/`` as ``_``. All rows are returned (no single-page limit)."""
    p = prefix.rstrip("/") + "/"
    return df.filter(F.col(name_col).startswith(p)).withColumn("key", C.path_to_key(F.col(name_col), prefix))


def to_params(df: DataFrame, prefix: str, existing: DataFrame | None = None, overwrite: bool = True,
              key_col: str = "key", value_col: str = "value") -> DataFrame:
    """SRC-08: parameter rows (name, value, type) to write; with ``overwrite=False`` the
    names that already exist are left out (a left anti join)."""
    out = df.select(C.key_to_path(F.col(key_col), prefix).alias("name"), F.col(value_col).cast("string").alias("value"),
                    C.param_type(F.col(key_col)).alias("type"))
    if not overwrite and existing is not None:
        out = out.join(existing.select("name"), "name", "left_anti")
    return out
