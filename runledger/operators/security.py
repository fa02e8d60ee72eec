"""Access rules: authorisation decisions (J-13), row-level (J-14) and column-level
security (J-15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.functions.text import fill_template
from runledger.operators.skew import enrich


# Endpoint policy (endpoint, method, required role); ``*`` is a wildcard
# path segment at the end, ALL matches any method, {id} stands for one path segment.
ENDPOINT_POLICY = (
    ("/api/v1/tasks", "GET", "user"),
    ("/api/v1/tasks", "POST", "user"),
    ("/api/v1/tasks/{id}", "PUT", "user"),
    ("/api/v1/tasks/{id}", "DELETE", "user"),
    ("/api/v1/users", "GET", "manager"),
    ("/api/v1/users", "POST", "admin"),
    ("/api/v1/users/{id}", "DELETE", "admin"),
    ("/api/v1/admin/*", "ALL", "admin"),
)


# Authorisation reasons, in the order they are checked.
LACKS_ROLE = "User lacks required role: {role}"
NOT_FOUND = "Resource not found"
ADMIN_OVERRIDE = "Admin override"
NOT_OWNER = "User does not own this resource"
AUTHORIZED = "Authorized"


def required_role(endpoint, method, policy=ENDPOINT_POLICY):
    """Required role of a request as one Column expression (the policy is configuration,
    so no join or shuffle): the path is normalised (numeric segments -> ``{id}``); exact
    (path, method) rows win, then wildcard rows by longest prefix; null when none match."""
    ep = F.col(endpoint) if isinstance(endpoint, str) else endpoint
    m = F.col(method) if isinstance(method, str) else method
    norm = F.regexp_replace(ep, r"/[0-9]+(?=/|$)", "/{id}")
    exact = [(e, mt, r) for e, mt, r in policy if not e.endswith("/*")]
    wild = sorted([(e, mt, r) for e, mt, r in policy if e.endswith("/*")], key=lambda x: -len(x[0]))
    out = None
    for e, mt, r in exact:
        cond = (norm == e) & ((m == mt) if mt != "ALL" else F.lit(True))
        out = F.when(cond, F.lit(r)) if out is None else out.when(cond, F.lit(r))
    for e, mt, r in wild:
        cond = norm.startswith(e[:-1]) & ((m == mt) if mt != "ALL" else F.lit(True))
        out = F.when(cond, F.lit(r)) if out is None else out.when(cond, F.lit(r))
    return out


def authorise(requests: DataFrame, memberships: DataFrame, resources: DataFrame, policy=ENDPOINT_POLICY,
              user_col: str = "user_id", resource_col: str = "resource_id") -> DataFrame:
    """J-13: decision and reason, checked in order: required role missing; resource not
    found; admin override; not the owner (a resource without an owner is nobody's);
    authorised. A user or resource with very many requests is dealt over salts
    (:func:`skew.enrich`)."""
    r = requests.withColumn("required_role", required_role("endpoint", "method", policy))
    # one row per user with the few roles there are, so a user's requests are joined once
    roles = memberships.groupBy(F.col("user_id").alias(user_col)).agg(F.collect_set("role").alias("_roles"))
    res = resources.select(F.col("resource_id").alias(resource_col), F.lit(True).alias("_found"), F.col("owner_id").alias("_owner"))
    j = enrich(enrich(r, roles, [user_col]), res, [resource_col])
    has = F.coalesce(F.array_contains("_roles", F.col("required_role")), F.lit(False))
    admin = F.coalesce(F.array_contains("_roles", F.lit("admin")), F.lit(False))
    role_txt = F.coalesce(F.col("required_role"), F.lit("None"))
    reason = (F.when(~has, fill_template(LACKS_ROLE, {"role": role_txt}))
               .when(F.col(resource_col).isNotNull() & F.col("_found").isNull(), F.lit(NOT_FOUND))
               .when(F.col(resource_col).isNotNull() & admin, F.lit(ADMIN_OVERRIDE))
               .when(F.col(resource_col).isNotNull() & ~F.col("_owner").eqNullSafe(F.col(user_col)),
                     F.lit(NOT_OWNER))
               .otherwise(F.lit(AUTHORIZED)))
    ok = reason.isin(ADMIN_OVERRIDE, AUTHORIZED)
    return j.select(*requests.columns, "required_role", ok.alias("authorized"), reason.alias("reason"))


def rls(df: DataFrame, owner_col: str, principal_id, role: str, teams: DataFrame | None = None) -> DataFrame:
    """J-14: rows a principal may see: admins all, managers their team's and their own,
    everyone else only their own. ``teams`` is (manager_id, member_id)."""
    if role == "admin":
        return df
    own = F.col(owner_col) == F.lit(principal_id)
    if role == "manager" and teams is not None:
        members = (teams.filter(F.col("manager_id") == F.lit(principal_id))
                        .select(F.col("member_id").alias(owner_col)).distinct().withColumn("_team", F.lit(True)))
        return df.join(members, owner_col, "left").filter(own | F.col("_team").isNotNull()).drop("_team")
    return df.filter(own)


def cls(df: DataFrame, requester_id, requester_role: str, owner_col: str,
        pii_cols: Sequence[str], hash_cols: Sequence[str]) -> DataFrame:
    """J-15: hash columns are always dropped; PII columns are null unless the requester
    owns the row or is an admin."""
    see = F.lit(requester_role == "admin") | (F.col(owner_col) == F.lit(requester_id))
    out = []
    for c in df.columns:
        if c in hash_cols:
            continue
        out.append(F.when(see, F.col(c)).alias(c) if c in pii_cols else F.col(c))
    return df.select(*out)
