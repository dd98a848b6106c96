"""Request routes of the booking tables, each over a whole batch of requests.

A request row is ``(seq bigint, caller_sub string, claims string, target_id int, body string)``: claims and body are
JSON text, ``claims`` is null where no valid token came with the request. ``authenticate`` makes such requests from
tokens' claims and key ids, and takes ``caller_sub`` from them. Requests are judged in order of ``seq``.
``tables`` maps table names to DataFrames. Every route gives outcomes ``(seq, status, reason)`` and, where it changes
data, the new versions of the tables it touched.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from rowgate.contracts import Contract
from rowgate.functions.claims import claims_valid, is_object, parse_claims, realm_roles
from rowgate.functions.gates import (
    CREATED,
    DELETED,
    FORBIDDEN,
    INVALID,
    NO_LOGIN,
    OK,
    Gate,
    finish,
    first_failure,
    then,
)
from rowgate.operators.changes import apply_inserts, apply_patch, patch_outcome
from rowgate.operators.deletes import delete_outcome, delete_rows, restricted_roots
from rowgate.operators.identity import kid_match, login_outcome
from rowgate.operators.keys import assign_ids, insert_if_absent
from rowgate.operators.links import Parent, insert_with_lookup_value
from rowgate.operators.lookups import is_small, lookup_by_alt_key, lookup_by_key, touched_rows
from rowgate.operators.users import register_users, update_profile
from rowgate.plans.booking import (
    ADMIN_ROLE,
    ADMIN_TABLES,
    CLIENT_ROLE,
    CONTRACTS,
    LOGIN,
    NULL_PARENT_CHECKED,
    REGISTER,
)
from rowgate.sources.requests import decode_bodies
from rowgate.sources.tables import project_response
from rowgate.storage import cut
from rowgate.streaming.streams import InsertRules

SEQ = "seq"


Result = tuple[Mapping[str, DataFrame], DataFrame | None]


@dataclass(frozen=True)
class Change:
    """Outcomes of a batch, the rows it created, and new versions of the tables it changed.

    Tables and created rows are planned when they are first asked for; who wants outcomes only pays for no ids,
    cascades or patches.
    """

    outcomes: DataFrame
    result: Callable[[], Result]

    @cached_property
    def _made(self) -> Result:
        return self.result()

    @property
    def tables(self) -> Mapping[str, DataFrame]:
        return self._made[0]

    @property
    def created(self) -> DataFrame | None:
        return self._made[1]


@dataclass(frozen=True)
class TokenRules:
    """What a token must be: its audience, its issuer, the time it is judged at (epoch seconds), and the known keys.

    ``keys`` has a column ``kid``; without it the requests' key ids are not looked at.
    """

    audience: str
    issuer: str
    now: int
    keys: DataFrame | None = None


def authenticate(requests: DataFrame, rules: TokenRules) -> DataFrame:
    """Requests as the routes take them: ``claims`` only where the token is valid, ``caller_sub`` from its claims.

    With ``rules.keys`` the requests' column ``kid`` must name one of the keys. Whatever ``caller_sub`` was sent is
    replaced.
    """
    valid = claims_valid(F.col("claims"), rules.audience, rules.issuer, F.lit(rules.now))
    if rules.keys is not None:
        keys = rules.keys.select("kid").distinct()
        requests = kid_match(requests, "kid", keys, "kid", {}).withColumnRenamed("status", "_kid_status")
        valid = valid & (F.col("_kid_status") == OK)
    claims = F.when(valid, F.col("claims"))
    return requests.withColumns({"claims": claims, "caller_sub": parse_claims(claims)["sub"]}).drop("_kid_status")


def _callers(requests: DataFrame) -> DataFrame:
    """Requests with their claims read: ``logged_in`` and ``is_admin``. Claims that are no JSON object are no login."""
    roles = realm_roles(parse_claims(F.col("claims")))
    return requests.withColumns(
        {
            "logged_in": is_object(F.col("claims")),
            "is_admin": F.coalesce(F.array_contains(roles, ADMIN_ROLE), F.lit(False)),
        }
    ).drop("claims")


def _decoded(requests: DataFrame, contract: Contract, *, partial: bool = False) -> DataFrame:
    """Requests with claims and body read once and stored typed, since every later step reads some of the columns."""
    return cut(decode_bodies(_callers(requests), contract, partial=partial).drop("body"))


def _no_login() -> Gate:
    return Gate(~F.col("logged_in"), NO_LOGIN, "no valid token")


def _bad_body() -> Gate:
    return Gate(F.size("errors") > 0, INVALID, F.array_join("errors", ";"))


def _bad_target() -> Gate:
    return Gate(F.col("target_id").isNull(), INVALID, "target_id:missing")


def _role(name: str) -> list[Gate]:
    return [Gate(~F.col("is_admin"), FORBIDDEN, "admin only")] if name in ADMIN_TABLES else []


def _parents(contract: Contract, tables: Mapping[str, DataFrame], rows: DataFrame, small: bool) -> list[Parent]:
    parents = []
    for link in contract.links:
        key = CONTRACTS[link.parent].key
        table = touched_rows(tables[link.parent], rows, (link.column, key), small=small)
        null_fails = (contract.name, link.column) in NULL_PARENT_CHECKED
        parents.append(Parent(link.column, table, key, link.parent, null_fails=null_fails))
    return parents


def _outcomes(df: DataFrame) -> DataFrame:
    return df.select(SEQ, "status", "reason")


def _served(requests: DataFrame, outcomes: DataFrame, status: int) -> DataFrame:
    return requests.join(outcomes.where(F.col("status") == status).select(SEQ), SEQ, "left_semi")


# Reads


def list_rows(name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The whole table as a response shows it."""
    return project_response(tables[name], CONTRACTS[name])


def get_rows(requests: DataFrame, name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Each request's row by primary key: 401, 422, 404 or 200 with the response columns."""
    contract = CONTRACTS[name]
    shown = {c: c for c in contract.response_columns}
    gated = _callers(requests).select(SEQ, "target_id", *first_failure([_no_login(), _bad_target()], "_early", "_why"))
    wanted = touched_rows(tables[name], gated, ("target_id", contract.key))
    found = lookup_by_key(gated, wanted, ("target_id", contract.key), shown)
    passed = F.col("_early").isNull()
    return found.select(
        SEQ,
        F.coalesce("_early", "status").alias("status"),
        *[F.when(passed, F.col(c)).alias(c) for c in shown],
    )


def get_me(requests: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The caller's own user row: 401 without login or subject, 404 if unknown, else 200."""
    contract = CONTRACTS["users"]
    shown = {c: c for c in contract.response_columns}
    no_subject = Gate(F.coalesce(F.col("caller_sub"), F.lit("")) == "", NO_LOGIN, "no subject")
    gated = _callers(requests).select(SEQ, "caller_sub", *first_failure([_no_login(), no_subject], "_early", "_why"))
    wanted = touched_rows(tables["users"], gated, ("caller_sub", "keycloak_id"))
    found = lookup_by_alt_key(gated, wanted, [("caller_sub", "keycloak_id")], contract.key, shown)
    passed = F.col("_early").isNull()
    return found.select(
        SEQ,
        F.coalesce("_early", "status").alias("status"),
        *[F.when(passed, F.col(c)).alias(c) for c in shown],
    )


# Changes


def create(requests: DataFrame, name: str, tables: Mapping[str, DataFrame]) -> Change:
    """Inserts: 401, 422, 403, missing parent 404, unique key 409, else 201 with a fresh id."""
    rows = _decoded(requests, CONTRACTS[name])
    return _insert(rows, cut(_judge(rows, name, tables)), name, tables)


def _judge(rows: DataFrame, name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    contract = CONTRACTS[name]
    return apply_inserts(
        rows,
        SEQ,
        gates=[_no_login(), _bad_body(), *_role(name)],
        parents=_parents(contract, tables, rows, is_small(rows)),
        unique=contract.unique,
        table=tables[name],
    )


def create_rules(name: str, tables: Mapping[str, DataFrame]) -> InsertRules:
    """``create`` as rules for a request stream: each micro-batch sees the table as earlier ones left it."""
    contract = CONTRACTS[name]

    def outcome(batch: DataFrame, table: DataFrame) -> DataFrame:
        return _judge(_decoded(batch, contract), name, {**tables, name: table})

    def rows(accepted: DataFrame, table: DataFrame) -> DataFrame:
        return assign_ids(decode_bodies(accepted, contract), table, contract.key, SEQ).select(*contract.columns)

    return InsertRules(SEQ, outcome, rows, contract.schema)


def _insert(rows: DataFrame, outcomes: DataFrame, name: str, tables: Mapping[str, DataFrame]) -> Change:
    contract = CONTRACTS[name]

    def result() -> Result:
        created = assign_ids(_served(rows, outcomes, CREATED), tables[name], contract.key, SEQ)
        table = tables[name].unionByName(created.select(*contract.columns))
        return {name: table}, created.select(SEQ, *contract.response_columns)

    return Change(_outcomes(outcomes), result)


def update(requests: DataFrame, name: str, tables: Mapping[str, DataFrame]) -> Change:
    """Partial updates: 401, 422, 403, 404, nothing sent 400, missing parent 404, null or unique key 409, else 200."""
    contract = CONTRACTS[name]
    rows = _decoded(requests, contract, partial=True)
    names = [f.name for f in contract.body_fields]
    small = is_small(rows)
    outcomes = cut(
        patch_outcome(
            rows,
            touched_rows(tables[name], rows, ("target_id", contract.key), small=small),
            contract.key,
            "target_id",
            SEQ,
            {n: (F.col(f"has_{n}"), F.col(n)) for n in names},
            gates=[_no_login(), _bad_target(), _bad_body(), *_role(name)],
            parents=_parents(contract, tables, rows, small),
            required=[f.name for f in contract.body_fields if f.required],
            unique=contract.unique,
            held=tables[name],
        )
    )

    def result() -> Result:
        patches = rows.join(outcomes.where(F.col("status") == OK).select(SEQ, "moved"), SEQ)
        sent = {n: F.col(f"has_{n}") & F.col("moved") if n in contract.unique else F.col(f"has_{n}") for n in names}
        fields = {n: (sent[n], F.col(n)) for n in names}
        return {name: apply_patch(tables[name], contract.key, patches, "target_id", SEQ, fields)}, None

    return Change(_outcomes(outcomes), result)


def delete(requests: DataFrame, name: str, tables: Mapping[str, DataFrame]) -> Change:
    """Deletes: 401, 422, 403, 404, still referred to 409, else 204; children follow their links.

    A user row may be deleted by its owner or an admin; other tables follow the role rule.
    """
    contract = CONTRACTS[name]
    gates = [_no_login(), _bad_target(), *_role(name)]
    access: dict = {}
    if name == "users":
        gates.insert(1, Gate(F.coalesce(F.col("caller_sub"), F.lit("")) == "", NO_LOGIN, "no subject"))
        access = {"owner": "keycloak_id", "caller": "caller_sub", "admin": F.col("is_admin")}
    small = is_small(requests)
    asked = touched_rows(tables[name], requests, ("target_id", contract.key), small=small)
    # Requests that a gate refuses anyway have no children looked up.
    passed = _callers(requests).select("target_id", *first_failure(gates, "_early", "_why")).where("_early is null")
    wanted = passed.select(F.col("target_id").alias(contract.key)).distinct()
    roots = asked.join(wanted, contract.key, "left_semi").select(F.col(contract.key).alias("root"))
    restricted = restricted_roots(roots, name, tables, CONTRACTS)
    outcomes = cut(
        delete_outcome(
            _callers(requests), asked, contract.key, "target_id", SEQ, gates=gates, restricted=restricted, **access
        )
    )
    gone = outcomes.where(F.col("status") == DELETED).select(F.col("target").alias("root"))
    return Change(_outcomes(outcomes), lambda: (delete_rows(gone, name, tables, CONTRACTS), None))


def update_me(requests: DataFrame, tables: Mapping[str, DataFrame]) -> Change:
    """Profile updates of users: 401, 422, 404, 403, name taken 400, else 200."""
    contract = CONTRACTS["users"]
    users = tables["users"]
    rows = _decoded(requests, contract, partial=True)
    small = is_small(rows)
    outcomes = cut(
        update_profile(
            rows,
            touched_rows(users, rows, ("target_id", "user_id"), small=small),
            SEQ,
            caller="caller_sub",
            admin=F.col("is_admin"),
            target="target_id",
            new_name=F.col("user_name"),
            new_role=F.col("role_id"),
            key="user_id",
            name="user_name",
            role="role_id",
            owner="keycloak_id",
            named=touched_rows(users, rows, ("user_name", "user_name"), small=small),
            gates=[_no_login(), _bad_target(), _bad_body()],
        )
    )
    patches = outcomes.where((F.col("status") == OK) & F.col("new_name").isNotNull())
    fields = {"user_name": (F.lit(True), F.col("new_name"))}
    return Change(
        _outcomes(outcomes), lambda: ({"users": apply_patch(users, contract.key, patches, "target", SEQ, fields)}, None)
    )


def register(requests: DataFrame, tables: Mapping[str, DataFrame], identity: str = "identity_id") -> Change:
    """New users with the client role: 422, name in use 400, role missing 500, identity already known 500, else 201.

    Column ``identity`` holds the id the identity server gave the account, null if there is none. Accounts come out as
    if requests were served one by one: one that fails on its name or identity takes neither.
    """
    # Only what the account needs is stored; the password is checked and goes no further.
    rows = decode_bodies(requests, REGISTER).select(SEQ, "username", "errors", identity)
    held = tables["users"].select(F.col("keycloak_id").alias(identity)).where(F.col(identity).isNotNull()).distinct()
    rows = cut(rows.join(held.withColumn("_known", F.lit(True)), identity, "left"))
    judged = cut(
        register_users(
            rows,
            tables["users"],
            tables["roles"],
            SEQ,
            name="username",
            user_name="user_name",
            role_name="role_name",
            role_id="role_id",
            role_value=CLIENT_ROLE,
            gates=[_bad_body()],
            refused=F.col("_known"),
            identity=identity,
        )
    )
    accepted = judged.where(F.col("status") == CREATED).select(SEQ, "user_name", "role_id")
    users = cut(accepted.join(rows.select(SEQ, F.col(identity).alias("keycloak_id")), SEQ))
    return _insert(users, judged, "users", tables)


def login(replies: DataFrame) -> DataFrame:
    """Outcome of each login: 422 for a bad body, else by the identity server's ``reply_code`` and ``reply_body``."""
    rows = login_outcome(decode_bodies(replies, LOGIN), "reply_code", "reply_body")
    judged = rows.withColumnRenamed("status", "_late").select(
        SEQ, "_late", *first_failure([_bad_body()])
    )
    checks = [Gate(F.col("_late") == code, code, "login refused") for code in (NO_LOGIN, FORBIDDEN)]
    return finish(then(judged, [SEQ], checks), [SEQ], OK, "logged in")


def seed_users(rows: DataFrame, tables: Mapping[str, DataFrame], role: str = ADMIN_ROLE) -> DataFrame:
    """Users plus the given ``(seq, user_name, keycloak_id)`` rows, with the role's id; known identities are left."""
    users = tables["users"]
    with_role = insert_with_lookup_value(rows, "role_id", tables["roles"], F.col("role_name") == role, "role_id")
    with_ids = assign_ids(with_role, users, "user_id", SEQ)
    return insert_if_absent(users, with_ids, ["keycloak_id"], SEQ)
