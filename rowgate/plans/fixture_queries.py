"""One query per operator over the given TPC-H-like tables.

The tables stand in for the booking tables (customers for users, nations for dining tables, parts for menus, events for
requests). Every query runs over whole tables. Misses come from scaling keys, and flags from the events' values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from rowgate.contracts import Contract, Field, Link
from rowgate.functions.gates import CREATED, FORBIDDEN, INVALID, Gate
from rowgate.operators import (
    audit_change,
    Parent,
    Path,
    apply_inserts,
    apply_patch,
    assign_ids,
    check_email,
    children_pages,
    children_summary,
    claims_filter,
    coerce_types,
    constraint_audit,
    constraint_counts,
    delete_by_key,
    delete_cascade,
    delete_detach,
    delete_outcome,
    delete_restrict,
    duplicate_keys,
    fill_defaults,
    fk_check,
    fk_orphans,
    insert_if_absent,
    insert_with_lookup_value,
    kid_match,
    location_id,
    login_outcome,
    lookup_by_alt_key,
    lookup_by_key,
    navigate_to_many,
    navigate_to_one,
    owner_or_admin,
    patch_outcome,
    register_users,
    require_role,
    roles_union,
    taken_by_other,
    touched_rows,
    unique_conflict,
    update_profile,
    validate_rows,
)
from rowgate.sources import append_accepted, decode_bodies, project_response, publish_version, read_version, scan_typed
from rowgate.storage import cut, fresh_dir
from rowgate.streaming import InsertRules, drain, stream_apply, stream_compact, stream_fk_check

col = F.col

# The given tables as contracts: fixed schemas, and the rules the audit counts.
CUSTOMER = Contract(
    "customer",
    "c_custkey",
    (
        Field("c_name", "string"),
        Field("c_nationkey", "int", ge=0, le=20),
        Field("c_acctbal", "double", gt=0),
        Field("c_mktsegment", "string", max_length=8, hidden=True),
    ),
    key_type="bigint",
)
ORDERS = Contract(
    "orders",
    "o_orderkey",
    (Field("o_custkey", "bigint"), Field("o_orderpriority", "string")),
    key_type="bigint",
    links=(Link("o_custkey", "customer"),),
)
PART = Contract("part", "p_partkey", (), key_type="bigint", unique=("p_brand", "p_name"))
LINEITEM = Contract(
    "lineitem",
    "l_orderkey",
    (Field("l_quantity", "double", gt=1),),
    key_type="bigint",
    unique=("l_orderkey", "l_linenumber"),
    links=(Link("menu_id", "part"),),
)
EVENTS = Contract(
    "events",
    "event_id",
    (
        Field("ts", "timestamp_ntz"),
        Field("user_id", "bigint"),
        Field("event_type", "string"),
        Field("value", "double"),
        Field("props", "string"),
    ),
    key_type="bigint",
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _floor(value: Column, kind: str) -> Column:
    return F.floor(value).cast(kind)


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _customer_name(number: Column) -> Column:
    return F.concat(F.lit("Customer#"), F.lpad(number.cast("string"), 9, "0"))


# Scans, projections, sinks


def q_scan_typed(spark: SparkSession, sf: str) -> DataFrame:
    orders = scan_typed(spark, f"{sf}/orders.parquet", ORDERS)
    return orders.select(
        col("o_orderkey").alias("order_id"), col("o_custkey").alias("client_id"), col("o_orderpriority").alias("order_type")
    )


def q_project_response(spark: SparkSession, sf: str) -> DataFrame:
    return project_response(scan_typed(spark, f"{sf}/customer.parquet", CUSTOMER), CUSTOMER)


def q_append_accepted(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "accepted")
    append_accepted(q_apply_inserts(spark, sf), path)
    return spark.read.schema("req_id bigint, status int").parquet(path)


def q_decode_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Menu bodies written as JSON text: prices as text or number, fields left out, null or of the wrong kind."""
    menu = Contract(
        "menus",
        "menu_id",
        (
            Field("dish_name", "string", min_length=1, max_length=6),
            Field("price", "decimal(10,2)", gt=0),
            Field("restaurant_id", "int", gt=0),
        ),
    )
    value, user = col("value").cast("string"), col("user_id").cast("string")
    price = F.when(col("event_type") == "view", _text('"price":"', value, '",')).otherwise(_text('"price":', value, ","))
    dish = (
        F.when(col("value") < 10, F.lit('"dish_name":null'))
        .when(col("value") < 20, F.lit('"dish_name":7'))
        .when(col("value") < 30, F.lit('"other":1'))
        .otherwise(_text('"dish_name":"', col("event_type"), '"'))
    )
    shop = F.when(col("event_type") == "click", _text('"restaurant_id":', user, ".5,")).otherwise(
        _text('"restaurant_id":"', user, '",')
    )
    requests = _table(spark, sf, "events").select(
        col("event_id").alias("req_id"), F.concat(F.lit("{"), price, shop, dish, F.lit("}")).alias("body")
    )
    decoded = decode_bodies(requests, menu)
    return decoded.select(
        "req_id",
        "dish_name",
        "price",
        "restaurant_id",
        col("has_dish_name").cast("int").alias("sent_name"),
        F.array_join(F.sort_array("errors"), ";").alias("errors"),
    )


# Filters, predicates, lookups


def q_lookup_by_key(spark: SparkSession, sf: str) -> DataFrame:
    requests = _table(spark, sf, "events").select(col("event_id").alias("req_id"), (col("user_id") * 20).alias("key"))
    return lookup_by_key(requests, _table(spark, sf, "customer"), ("key", "c_custkey"), {"c_name": "user_name"})


def q_lookup_touched(spark: SparkSession, sf: str) -> DataFrame:
    """The same lookup for a batch far smaller than the table: the table is first cut down to the rows asked for."""
    requests = _table(spark, sf, "supplier").select(
        col("s_suppkey").alias("req_id"), (col("s_suppkey") * 300).alias("key")
    )
    lines = touched_rows(_table(spark, sf, "orders"), requests, ("key", "o_orderkey"))
    return lookup_by_key(requests, lines, ("key", "o_orderkey"), {"o_custkey": "client_id"})


def q_lookup_by_alt_key(spark: SparkSession, sf: str) -> DataFrame:
    part = _table(spark, sf, "part")
    wanted = F.when(col("p_size") > 40, F.concat("p_name", F.lit(" deluxe"))).otherwise(col("p_name"))
    requests = part.select(col("p_partkey").alias("req_id"), wanted.alias("name"))
    return lookup_by_alt_key(requests, part, [("name", "p_name")], "p_partkey", {"p_partkey": "first_id"})


def q_taken_by_other(spark: SparkSession, sf: str) -> DataFrame:
    part = _table(spark, sf, "part").select("p_partkey", "p_brand", "p_name")
    return taken_by_other(part, ["p_brand", "p_name"], "p_partkey").select(col("p_partkey").alias("id"))


def q_owner_or_admin(spark: SparkSession, sf: str) -> DataFrame:
    requests = _table(spark, sf, "events")
    caller = _floor(col("value"), "bigint")
    checked = owner_or_admin(requests, col("user_id"), caller, col("event_type") == "purchase")
    return checked.select(col("event_id").alias("req_id"), "status")


# Contracts


def q_validate_rows(spark: SparkSession, sf: str) -> DataFrame:
    names = {"c_acctbal": "price", "c_mktsegment": "name", "c_nationkey": "status"}
    rules = [CUSTOMER.field(n) for n in names]
    checked = validate_rows(_table(spark, sf, "customer"), rules, names=names)
    return checked.select(col("c_custkey").alias("id"), F.array_join("errors", ";").alias("errors"))


def q_coerce_types(spark: SparkSession, sf: str) -> DataFrame:
    n = col("l_linenumber")
    tail = F.when(n == 2, F.lit("000001")).when(n == 3, F.lit("e1")).otherwise(F.lit(""))
    zone = F.when(n == 3, F.lit(" Europe/Madrid")).otherwise(F.lit("+02:00"))
    raw = _table(spark, sf, "lineitem").select(
        col("l_orderkey").alias("order_id"),
        col("l_partkey").alias("menu_id"),
        col("l_linenumber").alias("n"),
        # Text as it would stand in a request: '23.0', '68423.46', a local time with its offset. Some lines have what
        # does not convert: a tiny fraction, an exponent, a zone by name, a month without a day.
        F.concat(col("l_quantity").cast("string"), tail).alias("quantity"),
        col("l_tax").cast("string").alias("portions"),
        col("l_extendedprice").cast("string").alias("price"),
        F.when(n == 4, F.date_format("l_shipdate", "yyyy-MM"))
        .otherwise(F.concat(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"), zone))
        .alias("at"),
    )
    typed = coerce_types(
        raw,
        [
            Field("quantity", "int"),
            Field("portions", "int"),
            Field("price", "decimal(10,2)"),
            Field("at", "timestamp_ntz"),
        ],
    )
    return typed.withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss"))


def q_check_email(spark: SparkSession, sf: str) -> DataFrame:
    mark = F.when(col("c_nationkey") < 8, F.lit("")).otherwise(F.lit("@"))
    tail = (
        F.when(col("c_mktsegment") == "BUILDING", F.lit(""))
        .when(col("c_mktsegment") == "MACHINERY", F.lit(" .com"))
        .otherwise(F.lit(".com"))
    )
    requests = _table(spark, sf, "customer").select(
        col("c_custkey").alias("req_id"), F.concat(F.replace(F.lower("c_name"), F.lit("#"), mark), tail).alias("email")
    )
    return check_email(requests, "email")


def q_fill_defaults(spark: SparkSession, sf: str) -> DataFrame:
    given = F.when(col("value") < 30, F.lit(None)).when(col("value") < 60, F.lit(0)).otherwise(F.lit(2))
    rows = _table(spark, sf, "events").select(col("event_id").alias("id"), given.cast("int").alias("table_status"))
    return fill_defaults(rows, [Field("table_status", "int", default=1)])


# Joins and references


def _fk_requests(events: DataFrame) -> DataFrame:
    return events.select(
        col("event_id").alias("req_id"),
        (col("user_id") * 15).alias("client_id"),
        F.when(col("event_type") != "view", _floor(col("value"), "int")).alias("table_id"),
    )


def _fk_parents(spark: SparkSession, sf: str, salts: int = 1) -> list[Parent]:
    return [
        Parent("table_id", _table(spark, sf, "nation"), "n_nationkey", "table", salts=salts),
        Parent("client_id", _table(spark, sf, "customer"), "c_custkey", "client", salts=salts),
    ]


def q_fk_check(spark: SparkSession, sf: str) -> DataFrame:
    requests = _fk_requests(_table(spark, sf, "events"))
    return fk_check(requests, _fk_parents(spark, sf), "req_id").select("req_id", "fk")


def q_fk_orphans(spark: SparkSession, sf: str) -> DataFrame:
    child = _table(spark, sf, "orders").select(
        col("o_orderkey").alias("order_id"), (col("o_custkey") + 100).alias("client_id")
    )
    return fk_orphans(child, "client_id", _table(spark, sf, "customer"), "c_custkey").select("order_id", "client_id")


def q_navigate_to_one(spark: SparkSession, sf: str) -> DataFrame:
    items = _table(spark, sf, "lineitem").select(
        col("l_orderkey").alias("order_id"), "l_partkey", col("l_linenumber").alias("n"), col("l_quantity").alias("quantity")
    )
    paths = [
        Path("order_id", _table(spark, sf, "orders"), "o_orderkey", {"o_custkey": "client_id"}),
        Path("l_partkey", _table(spark, sf, "part"), "p_partkey", {"p_name": "dish_name"}),
    ]
    return navigate_to_one(items, paths).select("order_id", "n", "dish_name", "client_id", "quantity")


def q_navigate_to_many(spark: SparkSession, sf: str) -> DataFrame:
    orders = _table(spark, sf, "orders").select(col("o_orderkey").alias("order_id"))
    items = _table(spark, sf, "lineitem")
    return navigate_to_many(
        orders, "order_id", items, "l_orderkey", {"l_linenumber": "n", "l_partkey": "menu_id", "l_quantity": "quantity"}
    )


def q_children_summary(spark: SparkSession, sf: str) -> DataFrame:
    orders = _table(spark, sf, "orders").select(col("o_orderkey").alias("order_id"))
    measures = [
        F.count("*").alias("n_items"),
        F.min("l_partkey").alias("first_menu"),
        F.max("l_partkey").alias("last_menu"),
    ]
    summary = children_summary(orders, "order_id", _table(spark, sf, "lineitem"), "l_orderkey", measures)
    return summary.withColumn("n_items", F.coalesce("n_items", F.lit(0).cast("bigint")))


def q_insert_with_lookup_value(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "customer").select(col("c_custkey").alias("user_id"), col("c_name").alias("user_name"))
    return insert_with_lookup_value(
        rows, "role_id", _table(spark, sf, "region"), col("r_name") == "ASIA", "r_regionkey"
    )


# Unique keys and identifiers


def q_unique_conflict(spark: SparkSession, sf: str) -> DataFrame:
    requests = _table(spark, sf, "events").select(
        col("event_id").alias("req_id"), (col("user_id") * 10).alias("client"), _floor(col("value"), "int").alias("number")
    )
    held = _table(spark, sf, "customer")
    checked = unique_conflict(requests, ["client", "number"], "req_id", held, ["c_custkey", "c_nationkey"])
    return checked.select("req_id", "status")


def q_duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    items = _table(spark, sf, "lineitem").select(col("l_orderkey").alias("order_id"), col("l_linenumber").alias("n"))
    return duplicate_keys(items, ["order_id", "n"])


def q_insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    users = _table(spark, sf, "customer").select(col("c_custkey").alias("user_id"), col("c_name").alias("user_name"))
    rows = _table(spark, sf, "events").select(
        "event_id", (col("user_id") * 20).alias("user_id"), F.concat(F.lit("guest "), "event_type").alias("user_name")
    )
    return insert_if_absent(users, rows, ["user_id"], "event_id")


def q_assign_ids(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "events").select(col("event_id").alias("req_id"))
    return assign_ids(rows, _table(spark, sf, "orders"), "o_orderkey", "req_id", out="order_id")


# Change sets


def _booking_requests(events: DataFrame) -> DataFrame:
    return events.select(
        col("event_id").alias("req_id"),
        "event_type",
        "value",
        (col("user_id") * 15).alias("client_id"),
        _floor(col("value") / 3, "int").alias("table_id"),
    )


def _bookings(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "customer").select(
        col("c_custkey").alias("client_id"), col("c_nationkey").alias("table_id")
    )


def _booking_outcome(spark: SparkSession, sf: str, requests: DataFrame, table: DataFrame) -> DataFrame:
    return apply_inserts(
        requests,
        "req_id",
        gates=[
            Gate(~(col("value") > 5), INVALID, "value:gt"),
            Gate(col("event_type") == "error", FORBIDDEN, "role"),
        ],
        parents=_fk_parents(spark, sf),
        unique=["client_id", "table_id"],
        table=table,
    )


def q_apply_inserts(spark: SparkSession, sf: str) -> DataFrame:
    """All gates in one plan: value rule, role, two parents, unique key with first-wins among survivors."""
    requests = _booking_requests(_table(spark, sf, "events"))
    return _booking_outcome(spark, sf, requests, _bookings(spark, sf)).select("req_id", "status")


def q_apply_patch(spark: SparkSession, sf: str) -> DataFrame:
    patches = _table(spark, sf, "events").withColumn("target", col("user_id") * 7)
    users = _table(spark, sf, "customer").select(
        col("c_custkey").alias("id"), col("c_mktsegment").alias("seg"), col("c_acctbal").alias("bal")
    )
    fields = {
        "seg": (col("event_type").isin("click", "view"), F.when(col("value") >= 20, col("event_type"))),
        "bal": (col("value") > 50, col("value")),
    }
    return apply_patch(users, "id", patches, "target", "event_id", fields)


def q_patch_outcome(spark: SparkSession, sf: str) -> DataFrame:
    patches = _table(spark, sf, "events").select(
        col("event_id").alias("req_id"), (col("user_id") * 20).alias("target"), "event_type", "value"
    )
    fields = {
        "c_name": (col("event_type").isin("click", "purchase"), _customer_name(_floor(col("value"), "bigint") * 20)),
        "c_nationkey": (col("event_type") == "signup", _floor(col("value") / 3, "int")),
        "c_mktsegment": ((col("value") < 2) | (col("value") > 100), F.when(col("value") >= 2, F.lit("BUILDING"))),
    }
    outcome = patch_outcome(
        patches,
        _table(spark, sf, "customer"),
        "c_custkey",
        "target",
        "req_id",
        fields,
        gates=[Gate(col("event_type") == "error", FORBIDDEN, "role")],
        parents=[Parent("c_nationkey", _table(spark, sf, "nation"), "n_nationkey", "nation")],
        required=["c_mktsegment"],
        unique=["c_name"],
    )
    return outcome.select("req_id", "status")


def q_delete_by_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = _table(spark, sf, "orders").select(col("o_orderkey").alias("order_id"), col("o_custkey").alias("client_id"))
    keys = _table(spark, sf, "events").select((col("event_id") * 2).alias("key"))
    return delete_by_key(orders, "order_id", keys, "key")


def q_delete_outcome(spark: SparkSession, sf: str) -> DataFrame:
    requests = _table(spark, sf, "events").select(
        col("event_id").alias("req_id"), (col("user_id") * 20).alias("target"), "event_type"
    )
    users = _table(spark, sf, "customer")
    # Scaled, so that two thirds of the customers are not needed.
    refs = _table(spark, sf, "orders").select((col("o_custkey") * 3).alias("o_custkey"))
    needed = delete_restrict(users.select("c_custkey"), "c_custkey", [(refs, "o_custkey")])
    restricted = needed.where("restricted").select(col("c_custkey").alias("root"))
    outcome = delete_outcome(
        requests,
        users,
        "c_custkey",
        "target",
        "req_id",
        gates=[Gate(col("event_type") == "error", FORBIDDEN, "role")],
        restricted=restricted,
    )
    return outcome.select("req_id", "status")


def q_delete_cascade(spark: SparkSession, sf: str) -> DataFrame:
    doomed = _table(spark, sf, "supplier").where(col("s_acctbal") < 0)
    items = _table(spark, sf, "lineitem").select(
        col("l_orderkey").alias("order_id"), col("l_linenumber").alias("n"), col("l_partkey").alias("menu_id"), col("l_suppkey").alias("s")
    )
    return delete_cascade(items, "s", doomed, "s_suppkey")


def q_delete_restrict(spark: SparkSession, sf: str) -> DataFrame:
    orders = _table(spark, sf, "orders").select(col("o_orderkey").alias("order_id"))
    checked = delete_restrict(orders, "order_id", [(_table(spark, sf, "lineitem"), "l_orderkey")])
    outcome = F.when(col("restricted"), F.lit("restricted")).otherwise(F.lit("deleted"))
    return checked.select("order_id", outcome.alias("outcome"))


def q_delete_detach(spark: SparkSession, sf: str) -> DataFrame:
    gone = _table(spark, sf, "customer").where(col("c_mktsegment") == "BUILDING")
    orders = _table(spark, sf, "orders").select(col("o_orderkey").alias("order_id"), col("o_custkey").alias("table_id"))
    return delete_detach(orders, "table_id", gone, "c_custkey")


def q_update_profile(spark: SparkSession, sf: str) -> DataFrame:
    part = _table(spark, sf, "part").withColumn("owner", col("p_partkey").cast("string"))
    requests = part.select(
        col("p_partkey").alias("req_id"),
        (col("p_partkey") + F.when(col("p_type") == "MEDIUM", 1).otherwise(0)).alias("target"),
        F.when(col("p_type") != "ECONOMY", col("owner")).alias("caller"),
        col("p_brand").alias("brand"),
        F.when(col("p_size") < 25, F.lit("red widget")).when(col("p_size") < 40, F.concat("p_name", F.lit(" xl"))).alias("name"),
        F.when(col("p_size") > 45, col("p_size") + 1).alias("role"),
    )
    outcome = update_profile(
        requests,
        part,
        "req_id",
        caller="caller",
        admin=col("brand") == "Brand#1",
        target="target",
        new_name=col("name"),
        new_role=col("role"),
        key="p_partkey",
        name="p_name",
        role="p_size",
        owner="owner",
        scope="p_brand",
    )
    return outcome.select("req_id", "status")


def q_children_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with their orders by date, eight to a page, shown as text."""
    pages = children_pages(
        _table(spark, sf, "customer").select("c_custkey"),
        "c_custkey",
        _table(spark, sf, "orders"),
        "o_custkey",
        ["o_orderdate", "o_orderkey"],
        {"o_orderkey": "id", "o_orderstatus": "status"},
        size=8,
    )
    shown = F.transform("children", lambda c: F.concat(c["id"].cast("string"), F.lit(":"), c["status"]))
    return pages.select("c_custkey", "page", F.array_join(shown, ",").alias("children"))


def q_register_users(spark: SparkSession, sf: str) -> DataFrame:
    requests = _table(spark, sf, "events").select(
        col("event_id").alias("req_id"), _customer_name(col("user_id") * 20).alias("name"), "value"
    )
    outcome = register_users(
        requests,
        _table(spark, sf, "customer"),
        _table(spark, sf, "region"),
        "req_id",
        name="name",
        user_name="c_name",
        role_name="r_name",
        role_id="r_regionkey",
        role_value="EUROPE",
        gates=[Gate(col("value") < 2, INVALID, "password:min_length")],
    )
    role = F.when(col("status") == CREATED, col("role_id"))
    return outcome.select("req_id", "status", "user_name", role.alias("role_id"))


# Identity data


def _claims(events: DataFrame) -> DataFrame:
    granted = F.when(col("value") > 10, F.lit("admin")).otherwise(F.lit("view"))
    return events.select(
        col("event_id").alias("req_id"),
        _text(
            '{"realm_access":{"roles":["', col("event_type"), '"]},"resource_access":{"app":{"roles":["view","', granted, '"]}}}'
        ).alias("claims"),
    )


def q_roles_union(spark: SparkSession, sf: str) -> DataFrame:
    rows = roles_union(_claims(_table(spark, sf, "events")), "claims", "app")
    return rows.select("req_id", F.array_join("roles", ",").alias("roles"))


def q_require_role(spark: SparkSession, sf: str) -> DataFrame:
    rows = roles_union(_claims(_table(spark, sf, "events")), "claims", "app")
    return require_role(rows, "roles", "admin").select("req_id", "status")


def q_location_id(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages").select(
        "page_id", F.when(F.contains("url", F.lit("?")), F.lit("")).otherwise(col("url")).alias("url")
    )
    named = lookup_by_key(pages, _table(spark, sf, "customer"), ("page_id", "c_custkey"), {"c_name": "found_name"})
    return location_id(named, "url", col("found_name")).select("page_id", "found_id")


def q_kid_match(spark: SparkSession, sf: str) -> DataFrame:
    tokens = _table(spark, sf, "events").select(
        col("event_id").alias("req_id"),
        F.when(col("event_type") != "view", _floor(col("value") / 2, "int")).alias("kid"),
    )
    keys = _table(spark, sf, "nation")
    return kid_match(tokens, "kid", keys, "n_nationkey", {"n_name": "key_name"}).select("req_id", "key_name", "status")


def q_claims_filter(spark: SparkSession, sf: str) -> DataFrame:
    aud = F.when(col("value") > 50, _text('["account","', col("event_type"), '"]')).otherwise(
        _text('"', col("event_type"), '"')
    )
    realm = F.when(col("user_id") < 50, F.lit("realm-1")).otherwise(F.lit("realm-2"))
    # A fraction is cut off; an expiry that is no number is invalid.
    exp = F.when(col("value") > 80, F.lit('"x"')).otherwise(
        F.concat(col("event_id").cast("string"), F.when(col("value") < 30, F.lit(".5")).otherwise(F.lit("")))
    )
    rows = _table(spark, sf, "events").select(
        col("event_id").alias("req_id"),
        _text('{"aud":', aud, ',"iss":"', realm, '","exp":', exp, "}").alias("claims"),
    )
    return claims_filter(rows, "claims", "click", "realm-1", 50).select("req_id")


def q_login_outcome(spark: SparkSession, sf: str) -> DataFrame:
    described = F.when(
        col("event_type") == "view", F.lit("Account is not fully set up: resolve_required_actions")
    ).when(col("event_type") == "error", F.lit(""))
    log = _table(spark, sf, "events").select(
        col("event_id").alias("req_id"),
        F.when(col("event_type") == "click", 200).otherwise(401).alias("code"),
        F.to_json(F.struct(described.alias("error_description"), F.lit("invalid_grant").alias("error"))).alias("body"),
    )
    return login_outcome(log, "code", "body").select("req_id", "status")


# Audit


_AUDITED = [CUSTOMER, ORDERS, PART, LINEITEM, EVENTS]


def _audited(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    tables = {n: _table(spark, sf, n) for n in ("customer", "orders", "part", "lineitem", "events")}
    tables["lineitem"] = tables["lineitem"].withColumn("menu_id", col("l_partkey") + 100)
    tables["events"] = tables["events"].withColumn("event_id", F.when(col("value") >= 5, col("event_id")))
    return tables


def q_constraint_audit(spark: SparkSession, sf: str) -> DataFrame:
    return constraint_audit(_audited(spark, sf), _AUDITED)


def q_audit_change(spark: SparkSession, sf: str) -> DataFrame:
    """The audit is carried over two change sets made from the events: customers go and parts come, then orders go and lines come."""
    tables = _audited(spark, sf)
    events = _table(spark, sf, "events")
    brand = [col("event_type").alias("p_brand"), _text("Part#", col("user_id").cast("string")).alias("p_name")]
    parts = events.select(col("event_id").alias("p_partkey"), *brand)
    lines = events.select(
        (col("event_id") * 2).alias("l_orderkey"),
        F.lit(1).alias("l_linenumber"),
        col("value").alias("l_quantity"),
        col("user_id").alias("menu_id"),
    )
    gone = events.select(col("user_id").alias("c_custkey"))
    closed = events.select((col("event_id") * 2).alias("o_orderkey"))
    sets = [
        ({"customer": tables["customer"].join(gone, "c_custkey", "left_semi")}, {"part": parts}),
        ({"orders": tables["orders"].join(closed, "o_orderkey", "left_semi")}, {"lineitem": lines}),
    ]
    audit = cut(constraint_audit(tables, _AUDITED))
    counts = cut(constraint_counts(tables, _AUDITED))
    for removed, added in sets:
        change = constraint_counts(added, _AUDITED).unionByName(constraint_counts(removed, _AUDITED, sign=-1))
        change = cut(change)
        audit = cut(audit_change(audit, counts, change))
        counts = counts.unionByName(change)
    return audit


# Streams


def _events_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(EVENTS.schema).parquet(path)


def q_stream_fk_check(spark: SparkSession, sf: str) -> DataFrame:
    """Events arrive as files of a folder; the reference check runs on the stream and appends to a sink."""
    root = fresh_dir(spark, "fk-stream")
    _table(spark, sf, "events").repartitionByRange("event_id").write.parquet(f"{root}/in")
    requests = _fk_requests(_events_stream(spark, f"{root}/in"))
    checked = stream_fk_check(requests, _fk_parents(spark, sf, salts=4), "req_id").select("req_id", "fk")
    writer = checked.writeStream.format("parquet").outputMode("append").option("path", f"{root}/out")
    drain(writer.option("checkpointLocation", f"{root}/progress"))
    return spark.read.schema("req_id bigint, fk string").parquet(f"{root}/out")


def q_publish_version(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of a table are published; the later one, without some rows, is read."""
    root = fresh_dir(spark, "versions")
    orders = scan_typed(spark, f"{sf}/orders.parquet", ORDERS)
    keys = _table(spark, sf, "events").select((col("event_id") * 2).alias("key"))
    publish_version(orders, root, 0)
    publish_version(delete_by_key(orders, "o_orderkey", keys, "key"), root, 1)
    return read_version(spark, root, ORDERS).select("o_orderkey", "o_custkey")


def q_stream_apply(spark: SparkSession, sf: str) -> DataFrame:
    return _stream_apply(spark, sf, compact=False)


def q_stream_compact(spark: SparkSession, sf: str) -> DataFrame:
    """The same with a new base after each lot."""
    return _stream_apply(spark, sf, compact=True)


def _stream_apply(spark: SparkSession, sf: str, compact: bool) -> DataFrame:
    """Events arrive in three lots, each applied to the table as the earlier lots left it."""
    root = fresh_dir(spark, "apply-stream")
    events = scan_typed(spark, f"{sf}/events.parquet", EVENTS)
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    lot = F.least(F.floor((col("event_id") - low) * 3 / (high - low + 1)), F.lit(2))
    table_schema = T.StructType.fromDDL("client_id bigint, table_id int")
    rules = InsertRules(
        seq="req_id",
        outcome=lambda batch, table: _booking_outcome(spark, sf, batch, table),
        rows=lambda accepted, table: accepted.select("client_id", "table_id"),
        schema=table_schema,
    )
    for number in range(3):
        events.where(lot == number).write.mode("append").parquet(f"{root}/in")
        requests = _booking_requests(_events_stream(spark, f"{root}/in"))
        drain(stream_apply(requests, lambda: _bookings(spark, sf), root, rules))
        if compact:
            stream_compact(spark, lambda: _bookings(spark, sf), root, table_schema, number)
    return spark.read.schema("req_id bigint, status int").parquet(f"{root}/outcomes").select("req_id", "status")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_typed": q_scan_typed,
        "project_response": q_project_response,
        "append_accepted": q_append_accepted,
        "decode_bodies": q_decode_bodies,
        "lookup_by_key": q_lookup_by_key,
        "lookup_touched": q_lookup_touched,
        "lookup_by_alt_key": q_lookup_by_alt_key,
        "taken_by_other": q_taken_by_other,
        "owner_or_admin": q_owner_or_admin,
        "validate_rows": q_validate_rows,
        "coerce_types": q_coerce_types,
        "check_email": q_check_email,
        "fill_defaults": q_fill_defaults,
        "fk_check": q_fk_check,
        "fk_orphans": q_fk_orphans,
        "navigate_to_one": q_navigate_to_one,
        "navigate_to_many": q_navigate_to_many,
        "children_summary": q_children_summary,
        "insert_with_lookup_value": q_insert_with_lookup_value,
        "unique_conflict": q_unique_conflict,
        "duplicate_keys": q_duplicate_keys,
        "insert_if_absent": q_insert_if_absent,
        "assign_ids": q_assign_ids,
        "apply_inserts": q_apply_inserts,
        "apply_patch": q_apply_patch,
        "patch_outcome": q_patch_outcome,
        "delete_by_key": q_delete_by_key,
        "delete_outcome": q_delete_outcome,
        "delete_cascade": q_delete_cascade,
        "delete_restrict": q_delete_restrict,
        "delete_detach": q_delete_detach,
        "update_profile": q_update_profile,
        "register_users": q_register_users,
        "children_pages": q_children_pages,
        "roles_union": q_roles_union,
        "require_role": q_require_role,
        "location_id": q_location_id,
        "kid_match": q_kid_match,
        "claims_filter": q_claims_filter,
        "login_outcome": q_login_outcome,
        "constraint_audit": q_constraint_audit,
        "audit_change": q_audit_change,
        "stream_fk_check": q_stream_fk_check,
        "stream_apply": q_stream_apply,
        "stream_compact": q_stream_compact,
        "publish_version": q_publish_version,
    }
