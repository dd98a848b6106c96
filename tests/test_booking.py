"""Hand-made cases over the booking tables: gate order, nulls, conversions, conflicts and deletes."""

import json
from datetime import datetime
from decimal import Decimal

import pytest

from rowgate.plans import routes
from rowgate.plans.booking import CONTRACTS
from rowgate.storage import cut

REQUEST = "seq bigint, caller_sub string, claims string, target_id int, body string"
ADMIN = json.dumps({"sub": "k1", "realm_access": {"roles": ["admin"]}})
USER = json.dumps({"sub": "k2", "realm_access": {"roles": ["client"]}})


@pytest.fixture(scope="module")
def saved_tables(spark):
    rows = {
        "roles": [(1, "admin"), (2, "client")],
        "users": [(1, "root", "k1", 1), (2, "ana", "k2", 2), (3, "bob", None, 2), (4, "cy", None, 2)],
        "restaurants": [(1, "uno", 1, 1), (2, "dos", 1, 1), (3, "tres", 1, 1)],
        "menus": [
            (1, "soup", Decimal("3.50"), 1),
            (2, "rice", Decimal("4.00"), 1),
            (3, "soup", Decimal("2.00"), 2),
            (4, "cake", Decimal("2.00"), 3),
        ],
        "tables": [(1, 1, 1, 1), (2, 2, 1, 1), (3, 1, 1, 2), (4, 1, 1, 3)],
        "orders": [(1, 1, 2, "here", 1), (2, 4, 2, "here", 2), (3, None, 2, "away", 2)],
        "order_items": [(1, 1, 1, 2, Decimal("3.50"))],
        "reservations": [(1, 2, 2, datetime(2025, 3, 1, 20, 0), 0)],
    }
    return {n: cut(spark.createDataFrame(r, CONTRACTS[n].schema).coalesce(1)) for n, r in rows.items()}


@pytest.fixture
def tables(saved_tables):
    return dict(saved_tables)


def batch(spark, *rows):
    """Rows of (claims, target, body); the sequence number is the position."""
    data = []
    for i, (claims, target, body) in enumerate(rows, 1):
        sub = json.loads(claims).get("sub") if claims else None
        data.append((i, sub, claims, target, body if body is None or isinstance(body, str) else json.dumps(body)))
    return spark.createDataFrame(data, REQUEST).coalesce(1)


def statuses(df):
    return [r.status for r in df.orderBy("seq").collect()]


def rows_of(df, key):
    return {r[key]: r for r in df.collect()}


def menu(name="stew", price=5, shop=1):
    return {"dish_name": name, "price": price, "restaurant_id": shop}


def test_create_gate_order_and_first_wins_among_survivors(spark, tables):
    reqs = batch(
        spark,
        (USER, None, menu()),  # role, although the same key follows
        (ADMIN, None, menu()),
        (ADMIN, None, menu()),  # the key is taken now
        (ADMIN, None, menu("soup")),  # held by the table
        (ADMIN, None, menu("soup", 5, 3)),
        (ADMIN, None, menu(shop=9)),
        (USER, None, menu(price=-1)),  # rules come before the role
        (None, None, menu(price=-1)),  # login comes before rules
        (ADMIN, None, "no json"),
        (ADMIN, None, "[1]"),
        (ADMIN, None, None),
    )
    change = routes.create(reqs, "menus", tables)
    assert statuses(change.outcomes) == [403, 201, 409, 409, 201, 404, 422, 401, 422, 422, 422]
    got = rows_of(change.tables["menus"], "menu_id")
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    assert (got[5].dish_name, got[5].restaurant_id) == ("stew", 1)
    assert (got[6].dish_name, got[6].restaurant_id) == ("soup", 3)
    assert sorted(change.created.columns) == ["dish_name", "menu_id", "price", "restaurant_id", "seq"]


@pytest.mark.parametrize(
    ("price", "status", "stored"),
    [
        ("NaN", 422, None),
        (0.001, 201, Decimal("0.00")),
        (2.675, 201, Decimal("2.68")),
        (100000000, 422, None),
        ("7.5", 201, Decimal("7.50")),
        (True, 201, Decimal("1.00")),
        (False, 422, None),
        ([1], 422, None),
        (0, 422, None),
        (None, 422, None),
    ],
)
def test_prices(spark, tables, price, status, stored):
    change = routes.create(batch(spark, (ADMIN, None, menu(price=price))), "menus", tables)
    assert statuses(change.outcomes) == [status]
    if stored is not None:
        assert rows_of(change.tables["menus"], "menu_id")[5].price == stored


def test_lenient_integers_and_strict_texts(spark, tables):
    def table(number):
        return {"table_number": number, "table_status": 0, "restaurant_id": 1}

    reqs = batch(
        spark,
        (ADMIN, None, table("5")),
        (ADMIN, None, table(6.0)),
        (ADMIN, None, table(5.5)),
        (ADMIN, None, table(2**31)),
        (ADMIN, None, {"table_number": 9, "table_status": 3, "restaurant_id": 1}),
        (ADMIN, None, {"table_number": 9, "restaurant_id": 1}),
    )
    change = routes.create(reqs, "tables", tables)
    assert statuses(change.outcomes) == [201, 201, 422, 422, 422, 422]
    assert {5, 6} <= {r.table_number for r in change.tables["tables"].collect()}
    reqs = batch(spark, (ADMIN, None, menu(7)), (ADMIN, None, menu("")), (ADMIN, None, menu("é" * 64)), (ADMIN, None, menu("x" * 65)))
    assert statuses(routes.create(reqs, "menus", tables).outcomes) == [422, 422, 201, 422]


def test_order_parents(spark, tables):
    def order(table, client, shop=1):
        return {"table_id": table, "client_id": client, "order_type": "here", "restaurant_id": shop}

    reqs = batch(
        spark,
        (USER, None, order(None, 2)),
        (USER, None, {"client_id": 2, "order_type": "here", "restaurant_id": 1}),
        (USER, None, order(99, 99)),
        (USER, None, order(1, 99)),
        (USER, None, order(1, 2, 99)),
        (USER, None, order(0, 2)),
        (USER, None, order(1, 2)),
    )
    change = routes.create(reqs, "orders", tables)
    assert statuses(change.outcomes) == [201, 201, 404, 404, 404, 422, 201]
    reasons = [r.reason for r in change.outcomes.orderBy("seq").collect()]
    assert reasons[2:5] == ["tables not found", "users not found", "restaurants not found"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_reservation_times_are_utc(spark, tables, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        def booking(at):
            return {"table_id": 1, "client_id": 2, "reservation_date": at, "reservation_status": 0}

        reqs = batch(
            spark,
            (USER, None, booking("2025-03-01T20:00:00+02:00")),
            (USER, None, booking("2025-03-01T20:00:00Z")),
            (USER, None, booking("2025-03-01T20:00:00")),
            (USER, None, booking(1740852000)),
            (USER, None, booking("soon")),
            # Clock times that New York skips or repeats.
            (USER, None, booking("2025-03-09T02:30:00Z")),
            (USER, None, booking("2025-11-02T01:30:00-05:00")),
            (USER, None, booking("2025-03-09T02:30:00")),
        )
        change = routes.create(reqs, "reservations", tables)
        assert statuses(change.outcomes) == [201, 201, 201, 201, 422, 201, 201, 201]
        got = rows_of(change.tables["reservations"], "reservation_id")
        times = [got[i].reservation_date.strftime("%d %H:%M") for i in range(2, 9)]
        assert times == ["01 18:00", "01 20:00", "01 20:00", "01 18:00", "09 02:30", "02 06:30", "09 02:30"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_update_outcomes(spark, tables):
    reqs = batch(
        spark,
        (USER, 1, {"price": 9}),
        (ADMIN, 99, {"price": 9}),
        (ADMIN, 1, {}),
        (ADMIN, 1, {"other": 1}),
        (ADMIN, 1, {"price": None}),
        (ADMIN, 1, {"price": 9}),
        (ADMIN, 2, {"dish_name": "soup"}),  # held by menu 1
        (ADMIN, 2, {"dish_name": "stew"}),
        (ADMIN, 1, {"dish_name": "stew"}),  # taken earlier in the batch
        (ADMIN, 3, {"restaurant_id": 99}),
        (ADMIN, 3, {"price": -1}),
        (ADMIN, 4, "oops"),
        (ADMIN, None, {"price": 9}),
    )
    change = routes.update(reqs, "menus", tables)
    assert statuses(change.outcomes) == [403, 404, 400, 400, 409, 200, 409, 200, 409, 404, 422, 422, 422]
    got = rows_of(change.tables["menus"], "menu_id")
    assert (got[1].dish_name, got[1].price) == ("soup", Decimal("9.00"))
    assert (got[2].dish_name, got[2].price) == ("stew", Decimal("4.00"))
    assert len(got) == 4


def test_update_last_sent_value_wins_and_keys_never_repeat(spark, tables):
    reqs = batch(
        spark,
        (ADMIN, 1, {"price": 7, "dish_name": "pie", "restaurant_id": 2}),
        (ADMIN, 1, {"price": 8, "dish_name": "soup"}),  # sends its present name: no move, must not undo the first
        (ADMIN, 2, {"dish_name": "cod"}),
        (ADMIN, 2, {"dish_name": "ham"}),  # a row moves once per batch
    )
    change = routes.update(reqs, "menus", tables)
    assert statuses(change.outcomes) == [200, 200, 200, 409]
    got = rows_of(change.tables["menus"], "menu_id")
    assert (got[1].dish_name, got[1].restaurant_id, got[1].price) == ("pie", 2, Decimal("8.00"))
    assert got[2].dish_name == "cod"
    keys = [(r.restaurant_id, r.dish_name) for r in got.values()]
    assert len(keys) == len(set(keys))


def test_update_table_with_null_parent_is_not_found(spark, tables):
    reqs = batch(spark, (ADMIN, 1, {"restaurant_id": None}), (ADMIN, 1, {"table_number": None}))
    assert statuses(routes.update(reqs, "tables", tables).outcomes) == [404, 409]
    assert statuses(routes.update(batch(spark, (ADMIN, 1, {"restaurant_id": None})), "menus", tables).outcomes) == [409]


def test_update_restaurant_without_unique_key(spark, tables):
    reqs = batch(spark, (ADMIN, 1, {"restaurant_name": "one"}), (ADMIN, 1, {"admin_id": 77}), (ADMIN, 2, {"admin_id": None}))
    change = routes.update(reqs, "restaurants", tables)
    assert statuses(change.outcomes) == [200, 404, 409]
    assert rows_of(change.tables["restaurants"], "restaurant_id")[1].restaurant_name == "one"


def test_delete_restaurant_cascades_or_is_restricted(spark, tables):
    reqs = batch(spark, (ADMIN, 1, None), (USER, 3, None), (ADMIN, 3, None), (ADMIN, 3, None), (ADMIN, 9, None), (ADMIN, 2, None))
    change = routes.delete(reqs, "restaurants", tables)
    # 1 has menus with order items, 2 has orders; 3 goes with its menu and its table.
    assert statuses(change.outcomes) == [409, 403, 204, 404, 404, 409]
    assert sorted(rows_of(change.tables["restaurants"], "restaurant_id")) == [1, 2]
    assert sorted(rows_of(change.tables["menus"], "menu_id")) == [1, 2, 3]
    assert sorted(rows_of(change.tables["tables"], "table_id")) == [1, 2, 3]
    orders = rows_of(change.tables["orders"], "order_id")
    assert [orders[i].table_id for i in (1, 2, 3)] == [1, None, None]


def test_delete_table_detaches_orders(spark, tables):
    change = routes.delete(batch(spark, (ADMIN, 1, None), (ADMIN, 2, None)), "tables", tables)
    assert statuses(change.outcomes) == [204, 409]
    assert sorted(rows_of(change.tables["tables"], "table_id")) == [2, 3, 4]
    orders = rows_of(change.tables["orders"], "order_id")
    assert [orders[i].table_id for i in (1, 2, 3)] == [None, 4, None]


def test_delete_reservation_needs_no_role(spark, tables):
    change = routes.delete(batch(spark, (USER, 1, None), (USER, 5, None), (None, 1, None)), "reservations", tables)
    assert statuses(change.outcomes) == [204, 404, 401]
    assert change.tables["reservations"].count() == 0


def test_delete_user_by_owner_or_admin(spark, tables):
    reqs = batch(spark, (USER, 1, None), (USER, 3, None), (USER, 2, None), (ADMIN, 3, None), (ADMIN, 77, None))
    change = routes.delete(reqs, "users", tables)
    # User 2 has orders and reservations; user 3 has no owner, so only the admin may delete it.
    assert statuses(change.outcomes) == [403, 403, 409, 204, 404]
    assert sorted(rows_of(change.tables["users"], "user_id")) == [1, 2, 4]


def test_profile_updates(spark, tables):
    no_sub = json.dumps({"realm_access": {"roles": ["admin"]}})
    reqs = batch(
        spark,
        (no_sub, 2, {"user_name": "x"}),
        (USER, 99, {"user_name": "x"}),
        (USER, 3, {"user_name": "x"}),
        (USER, 2, {"role_id": 1}),
        (USER, 2, {"user_name": "bob"}),
        (USER, 2, {}),
        (USER, 2, {"role_id": 2}),
        (USER, 2, {"user_name": None}),
        (USER, 2, {"user_name": "ana"}),
        (USER, 2, {"user_name": "eve"}),
        (ADMIN, 3, {"user_name": "eve"}),
        (ADMIN, 4, {"user_name": "dan"}),
        (USER, 2, {"user_name": ""}),
    )
    change = routes.update_me(reqs, tables)
    assert statuses(change.outcomes) == [401, 404, 403, 403, 400, 200, 200, 200, 200, 200, 400, 200, 422]
    got = rows_of(change.tables["users"], "user_id")
    assert [got[i].user_name for i in (1, 2, 3, 4)] == ["root", "eve", "bob", "dan"]


def test_register(spark, tables):
    def body(name, email="a@b.co", password="12345678"):
        return json.dumps({"username": name, "email": email, "password": password})

    data = [
        (1, body("ana"), "k9"),
        (2, body("dora"), "k10"),
        (3, body("dora"), "k11"),
        (4, body("x"), None),
        (5, body("fay", email="a@b"), None),
        (6, body("fay", password="123"), None),
        (7, body("fay"), None),
        (8, body("gil"), "k1"),
        (9, body("hal"), "k12"),
        (10, body("ida"), "k12"),
    ]
    reqs = spark.createDataFrame(data, "seq bigint, body string, identity_id string")
    change = routes.register(reqs, tables)
    assert statuses(change.outcomes) == [400, 201, 400, 422, 422, 422, 201, 500, 201, 500]
    got = rows_of(change.tables["users"], "user_id")
    assert (got[5].user_name, got[5].keycloak_id, got[5].role_id) == ("dora", "k10", 2)
    assert (got[6].user_name, got[6].keycloak_id, got[6].role_id) == ("fay", None, 2)
    assert (got[7].user_name, got[7].keycloak_id) == ("hal", "k12") and len(got) == 7
    tables["roles"] = tables["roles"].where("role_name = 'admin'")
    assert statuses(routes.register(reqs, tables).outcomes) == [400, 500, 500, 422, 422, 422, 500, 500, 500, 500]


def test_names_stay_free_when_a_registration_fails(spark, tables):
    body = json.dumps({"username": "new", "email": "a@b.co", "password": "12345678"})
    reqs = spark.createDataFrame(
        [(1, body, "k1"), (2, body, "k20"), (3, body, "k1"), (4, body, "k21")], "seq bigint, body string, identity_id string"
    )
    change = routes.register(reqs, tables)
    assert statuses(change.outcomes) == [500, 201, 400, 400]


def test_tokens_are_checked_before_a_route(spark, tables):
    def claims(**parts):
        return json.dumps({"sub": "k1", "aud": "me", "iss": "realm", "exp": 100} | parts)

    tokens = [
        (1, claims(), "key"),
        (2, claims(exp=99), "key"),
        (3, claims(iss="other"), "key"),
        (4, claims(aud="you"), "key"),
        (5, claims(), "unknown"),
        (6, "not json", "key"),
        (7, "[]", "key"),
        (8, None, "key"),
        (9, claims(), None),
    ]
    rows = spark.createDataFrame([(s, "someone else", c, k, 1, None) for s, c, k in tokens], "seq bigint, caller_sub string, claims string, kid string, target_id int, body string")
    rules = routes.TokenRules("me", "realm", 100, spark.createDataFrame([("key",)], "kid string"))
    checked = routes.authenticate(rows, rules)
    assert [r.status for r in routes.get_rows(checked, "users", tables).orderBy("seq").collect()] == [200] + [401] * 8
    assert [r.caller_sub for r in checked.orderBy("seq").collect()] == ["k1"] + [None] * 8


def test_reads(spark, tables):
    assert routes.list_rows("users", tables).columns == ["user_id", "user_name", "role_id"]
    reqs = batch(spark, (USER, 1, None), (USER, 99, None), (None, 1, None), (USER, 1, None))
    got = routes.get_rows(reqs, "menus", tables).orderBy("seq").collect()
    assert [(r.status, r.dish_name) for r in got] == [(200, "soup"), (404, None), (401, None), (200, "soup")]
    stranger = json.dumps({"sub": "nobody"})
    got = routes.get_me(batch(spark, (USER, None, None), (stranger, None, None), (json.dumps({}), None, None)), tables)
    assert [(r.status, r.user_name) for r in got.orderBy("seq").collect()] == [(200, "ana"), (404, None), (401, None)]


def test_login(spark):
    body = json.dumps({"username": "ana", "password": "x"})
    data = [
        (1, body, 200, "{}"),
        (2, body, 401, json.dumps({"error": "invalid_grant", "error_description": "resolve_required_actions"})),
        (3, body, 400, json.dumps({"error": "resolve_required_actions", "error_description": ""})),
        (4, body, 401, json.dumps({"error": "invalid_grant"})),
        (5, body, 502, "resolve_required_actions as plain text"),
        (6, body, 500, None),
        (7, "{}", 200, "{}"),
    ]
    replies = spark.createDataFrame(data, "seq bigint, body string, reply_code int, reply_body string")
    assert statuses(routes.login(replies)) == [200, 403, 403, 401, 403, 401, 422]


def test_seed_users(spark, tables):
    rows = spark.createDataFrame([(1, "boss", "k1"), (2, "new", "k7"), (3, "again", "k7")], "seq bigint, user_name string, keycloak_id string")
    got = [r for r in routes.seed_users(rows, tables).collect() if r.user_id > 4]
    assert [(r.user_name, r.keycloak_id, r.role_id) for r in got] == [("new", "k7", 1)]
