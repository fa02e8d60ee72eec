"""Configuration Column functions (FN-10..12, FN-16, FN-25) and JSON value typing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three sensitive-word lists, kept apart because they differ.
SENSITIVE_WORDS = {
    "generic": ("secret", "password", "key", "token", "credential"),
    "parameter": ("secret", "password", "key"),
    "display": ("secret", "password", "key", "token"),
}
# Mask texts.
TEMPLATE_PLACEHOLDER = "your-secret-value-here"
HIDDEN = "***HIDDEN***"
HIDDEN_HINT = "***HIDDEN*** (use --show-secrets to display)"
# Key categories, first hit wins, substring tests on the lower-cased key.
CATEGORIES = (
    ("Database Configuration", ("database", "db", "postgres", "mysql", "mongo")),
    ("API Configuration", ("api", "endpoint", "url", "host")),
    ("AWS Configuration", ("aws", "bucket", "lambda", "dynamodb", "s3")),
    ("Development Configuration", ("port", "debug", "log")),
)
OTHER_CATEGORY = "Other Configuration"
# Inferred string patterns by key word, checked in this order.
KEY_PATTERNS = (("port", "^[0-9]+$"), ("url", "^https?://"), ("email", "^[^@]+@[^@]+\\.[^@]+$"))


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _contains_any(col, words) -> Column:
    low = F.lower(_c(col))
    out = F.lit(False)
    for w in words:
        out = out | low.contains(w)
    return out


def is_sensitive(key, profile: str = "generic") -> Column:
    """FN-10: key names a secret under one of the three word lists."""
    return _contains_any(key, SENSITIVE_WORDS[profile])


def mask_value(key, value, mode: str = "display", reveal=False) -> Column:
    """FN-11: masked value. ``template``: placeholder for generic-sensitive keys;
    ``display``: ***HIDDEN***; ``lookup``: hidden with a hint unless ``reveal``."""
    v = _c(value)
    if mode == "template":
        return F.when(is_sensitive(key, "generic"), F.lit(TEMPLATE_PLACEHOLDER)).otherwise(v)
    if mode == "display":
        return F.when(is_sensitive(key, "display"), F.lit(HIDDEN)).otherwise(v)
    if mode == "lookup":
        r = F.lit(reveal) if isinstance(reveal, bool) else _c(reveal)
        return F.when(is_sensitive(key, "display") & ~r, F.lit(HIDDEN_HINT)).otherwise(v)
    raise ValueError(mode)


def categorise(key) -> Column:
    """FN-12: ordered category of a key (first hit wins)."""
    out = None
    for name, words in CATEGORIES:
        cond = _contains_any(key, words)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(OTHER_CATEGORY))


def key_to_path(key, prefix: str) -> Column:
    """FN-16: ``prefix/`` + key with ``_`` turned into ``/``."""
    return F.concat(F.lit(prefix.rstrip("/") + "/"), F.replace(_c(key), F.lit("_"), F.lit("/")))


def path_to_key(name, prefix: str) -> Column:
    """FN-16 / SRC-07: drop every ``prefix/``, then ``/`` -> ``_``."""
    p = prefix.rstrip("/") + "/"
    return F.replace(F.replace(_c(name), F.lit(p), F.lit("")), F.lit("/"), F.lit("_"))


def param_type(key) -> Column:
    """SRC-08: SecureString when the key has secret/password/key, else String."""
    return F.when(is_sensitive(key, "parameter"), F.lit("SecureString")).otherwise(F.lit("String"))


def json_type(value_json) -> Column:
    """Python type name of a JSON literal: bool, int, float, str, NoneType, list, dict."""
    v = F.regexp_replace(_c(value_json), r"^\s+|\s+$", "")
    return (F.when(v.isin("true", "false"), "bool")
             .when(v.rlike(r"^-?[0-9]+$"), "int")
             .when(v.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$"), "float")
             .when(v.startswith('"'), "str")
             .when(v == "null", "NoneType")
             .when(v.startswith("["), "list")
             .when(v.startswith("{"), "dict"))


def truthy(value_json) -> Column:
    """Python truthiness of a JSON literal: 0, 0.0, false, "", null, [] and {} are falsy."""
    v = F.regexp_replace(_c(value_json), r"^\s+|\s+$", "")
    t = json_type(v)
    num = v.try_cast("double")
    return ~((t == "bool") & (v == "false") | (t.isin("int", "float") & (num == 0))
             | ((t == "str") & (v == '""')) | (t == "NoneType") | v.isin("[]", "{}"))


def json_string_value(value_json) -> Column:
    """The decoded text of a JSON string literal (null for other types)."""
    return F.when(json_type(value_json) == "str", F.get_json_object(F.concat(F.lit("["), _c(value_json), F.lit("]")), "$[0]"))


def infer_type(key, value_json) -> Column:
    """A-15 per value: struct(type, pattern) as the source infers it."""
    t = json_type(value_json)
    typ = (F.when(t == "bool", "boolean").when(t == "int", "integer").when(t == "float", "number")
            .otherwise("string"))
    low = F.lower(_c(key))
    pat = None
    for word, p in KEY_PATTERNS:
        cond = (t == "str") & low.contains(word)
        pat = F.when(cond, F.lit(p)) if pat is None else pat.when(cond, F.lit(p))
    return F.struct(typ.alias("type"), pat.alias("pattern"))
