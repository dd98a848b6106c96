"""Account requests: profile updates and registration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowgate.functions.gates import (
    CREATED,
    EMPTY,
    FORBIDDEN,
    NO_LOGIN,
    NOT_FOUND,
    OK,
    SERVER_ERROR,
    Gate,
    finish,
    first_failure,
    then,
)
from rowgate.operators.keys import first_claims, first_on_all, winning_claims
from rowgate.operators.links import insert_with_lookup_value
from rowgate.operators.lookups import may_touch, owned_by_other
from rowgate.storage import cut


def update_profile(
    requests: DataFrame,
    users: DataFrame,
    seq: str,
    *,
    caller: str,
    admin: Column,
    target: str,
    new_name: Column,
    new_role: Column,
    key: str,
    name: str,
    role: str,
    owner: str,
    scope: str | None = None,
    named: DataFrame | None = None,
    gates: Sequence[Gate] = (),
) -> DataFrame:
    """(seq, target, new_name, status, reason) of each profile update.

    Order: ``gates``, no caller (401), no such user (404), neither owner nor admin (403), another role than the
    present one (403), name owned by someone else or claimed by an earlier request (400), accepted (200). A null
    name or role means 'not sent', and an empty request is accepted. ``scope`` names a column of ``users`` within
    which names must be unique; by default they are unique in the whole table. ``users`` may be cut down to the rows
    the batch targets, if ``named`` gives all users whose name it asks for.
    """
    status, reason = first_failure(gates)
    within = [scope] if scope else []
    rows = requests.select(
        seq,
        F.col(caller).alias("_caller"),
        F.coalesce(admin, F.lit(False)).alias("_admin"),
        F.col(target).alias("_target"),
        new_name.alias("_name"),
        new_role.alias("_role"),
        status,
        reason,
    )
    current = users.select(
        F.col(key).alias("_id"),
        F.col(name).alias("_old_name"),
        F.col(role).alias("_old_role"),
        F.col(owner).alias("_owner"),
        *[F.col(c).alias(f"_in_{c}") for c in within],
    )
    rows = rows.join(current, F.col("_target") == F.col("_id"), "left")
    rows = owned_by_other(
        rows, users if named is None else named, [("_name", name), *[(f"_in_{c}", c) for c in within]], own="_id", pk=key, flag="_taken"
    )
    checks = [
        Gate(F.coalesce(F.col("_caller"), F.lit("")) == "", NO_LOGIN, "no caller"),
        Gate(F.col("_id").isNull(), NOT_FOUND, "user not found"),
        Gate(~may_touch(F.col("_owner"), F.col("_caller"), F.col("_admin")), FORBIDDEN, "not the owner"),
        Gate(F.col("_role") != F.col("_old_role"), FORBIDDEN, "role may not change"),
        Gate(F.col("_taken"), EMPTY, "name in use"),
    ]
    renames = F.col("_name").isNotNull() & ~F.col("_name").eqNullSafe(F.col("_old_name"))
    scoped = [f"_in_{c}" for c in within]
    keep = [seq, "_target", F.col("_name").alias("new_name"), *scoped, renames.alias("_renames")]
    rows = cut(then(rows, keep, checks))
    claims = rows.where(F.col("status").isNull() & F.col("_renames"))
    first = first_claims(claims, ["new_name", *scoped], seq).select(seq)
    rows = rows.join(first.withColumn("_first", F.lit(True)), seq, "left")
    late = Gate(F.col("_renames") & F.col("_first").isNull(), EMPTY, "name in use")
    outs = [seq, F.col("_target").alias("target"), "new_name"]
    return finish(then(rows, [seq, "_target", "new_name"], [late]), outs, OK, "updated")


def register_users(
    requests: DataFrame,
    users: DataFrame,
    roles: DataFrame,
    seq: str,
    *,
    name: str,
    user_name: str,
    role_name: str,
    role_id: str,
    role_value: str,
    gates: Sequence[Gate] = (),
    refused: Column | None = None,
    identity: str | None = None,
) -> DataFrame:
    """(seq, user_name, role_id, status, reason) of each registration.

    Order: ``gates`` (row rules), name already known or taken by an earlier request (400), role missing from the roles
    table (500), identity known (500), created (201) with the id of role ``role_value``. An identity is known where
    ``refused`` says so, or if an earlier request of the batch made an account with that value of column ``identity``.
    Only a request that ends in an account takes its name and identity: one that fails leaves both free for the next.
    """
    status, reason = first_failure(gates)
    known = F.coalesce(refused, F.lit(False)) if refused is not None else F.lit(False)
    own = [F.col(identity).alias("_identity")] if identity else []
    rows = requests.select(seq, F.col(name).alias("user_name"), known.alias("_refused"), *own, status, reason)
    rows = cut(insert_with_lookup_value(rows, "role_id", roles, F.col(role_name) == role_value, role_id))
    fails = F.col("_refused") | F.col("role_id").isNull()
    live = rows.where(F.col("status").isNull())
    held = users.select(F.col(user_name).alias("user_name"))
    if identity:
        free = cut(live.where(~fails).join(held, "user_name", "left_anti"))
        won = cut(first_on_all(free, ["user_name", "_identity"], seq).select(seq, "user_name"))
    else:
        won = winning_claims(live.where(~fails), ["user_name"], seq, users, [user_name])
        won = cut(rows.select(seq, "user_name").join(won, seq, "left_semi"))
    late = cut(live.select(seq, "user_name").join(won.select(seq), seq, "left_anti"))
    earlier = won.select(F.col("user_name"), F.col(seq).alias("_first"))
    taken = late.join(held, "user_name", "left_semi").select(seq)
    taken = taken.unionByName(late.join(earlier, "user_name").where(F.col(seq) > F.col("_first")).select(seq)).distinct()
    rows = rows.join(won.select(seq, F.lit(True).alias("_won")), seq, "left")
    rows = rows.join(taken.withColumn("_taken", F.lit(True)), seq, "left")
    lost = F.col("_won").isNull()
    checks = [
        Gate(F.col("_taken"), EMPTY, "name in use"),
        Gate(lost & F.col("role_id").isNull(), SERVER_ERROR, "role missing"),
        Gate(lost, SERVER_ERROR, "identity known"),
    ]
    keep = [seq, "user_name", "role_id"]
    return finish(then(rows, keep, checks), keep, CREATED, "created")
