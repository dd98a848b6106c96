"""Operators over identity-server data: decoded claims, signing keys, account URLs and login replies."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from rowgate.functions.claims import all_roles, claims_valid, parse_claims, realm_roles
from rowgate.functions.gates import FORBIDDEN, NO_LOGIN, OK

# Fixed value: the text in a login reply that marks pending account actions.
PENDING_ACTIONS = "resolve_required_actions"


def roles_union(df: DataFrame, claims: str, client: str | None = None, *, out: str = "roles") -> DataFrame:
    """Add the caller's roles: of the realm and, if ``client`` is given, of that client; sorted, without repeats."""
    parsed = parse_claims(F.col(claims))
    roles = all_roles(parsed, client) if client is not None else F.sort_array(F.array_distinct(realm_roles(parsed)))
    return df.withColumn(out, roles)


def require_role(df: DataFrame, roles: str, role: str, *, ok: int = OK, refused: int = FORBIDDEN) -> DataFrame:
    """Add the status of the role rule."""
    has = F.coalesce(F.array_contains(roles, role), F.lit(False))
    return df.withColumn("status", F.when(has, F.lit(ok)).otherwise(F.lit(refused)))


def location_id(df: DataFrame, url: str, fallback: Column, *, out: str = "found_id") -> DataFrame:
    """Add the id at the end of a URL. Only an empty or missing URL falls back; an empty tail stays empty."""
    value = F.col(url)
    blank = value.isNull() | (value == "")
    return df.withColumn(out, F.when(blank, fallback).otherwise(F.substring_index(value, "/", -1)))


def kid_match(
    tokens: DataFrame,
    kid: str,
    keys: DataFrame,
    key_id: str,
    columns: Mapping[str, str],
    *,
    ok: int = OK,
    miss: int = NO_LOGIN,
) -> DataFrame:
    """Match each token's key id to the key table; a miss is 401. A token without id matches a key without id.

    Key ids are unique in a key set, and the table is small, so Spark broadcasts it by its size statistics.
    """
    right = keys.select(
        F.col(key_id).alias("_kid"), F.lit(True).alias("_known"), *[F.col(c).alias(n) for c, n in columns.items()]
    )
    joined = tokens.join(right, F.col(kid).eqNullSafe(F.col("_kid")), "left")
    status = F.when(F.col("_known"), F.lit(ok)).otherwise(F.lit(miss))
    return joined.withColumn("status", status).drop("_kid", "_known")


def claims_filter(df: DataFrame, claims: str, audience: str, issuer: str, now: int | Column) -> DataFrame:
    """Rows whose claims are valid at ``now``; see ``claims_valid``."""
    now_col = now if isinstance(now, Column) else F.lit(now)
    return df.where(claims_valid(F.col(claims), audience, issuer, now_col))


def login_outcome(log: DataFrame, code: str, body: str) -> DataFrame:
    """Add the status of a login reply: 200, pending account actions (403), anything else (401).

    The error text is the description, or the error code where the description is empty or missing; a body that is
    no JSON counts as the text itself.
    """
    doc = F.try_parse_json(F.col(body))
    described = F.try_variant_get(doc, "$.error_description", "string")
    error = F.try_variant_get(doc, "$.error", "string")
    text = F.when(doc.isNull(), F.col(body)).otherwise(F.coalesce(F.nullif(described, F.lit("")), error))
    pending = F.coalesce(F.contains(text, F.lit(PENDING_ACTIONS)), F.lit(False))
    return log.withColumn(
        "status", F.when(F.col(code) == OK, F.lit(OK)).when(pending, F.lit(FORBIDDEN)).otherwise(F.lit(NO_LOGIN))
    )
