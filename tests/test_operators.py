"""Operators on small random tables against brute force in plain Python, and edge cases the given tables lack."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowgate.contracts import CASCADE, Contract, Field, Link
from rowgate.functions.gates import Gate
from rowgate.functions.rules import valid_email
from rowgate.operators import (
    Parent,
    Path,
    apply_inserts,
    apply_patch,
    assign_ids,
    children_pages,
    claims_filter,
    coerce_types,
    constraint_audit,
    delete_detach,
    delete_outcome,
    delete_rows,
    duplicate_keys,
    fill_defaults,
    first_on_all,
    fk_check,
    fk_orphans,
    insert_if_absent,
    insert_with_lookup_value,
    kid_match,
    location_id,
    lookup_by_alt_key,
    lookup_by_key,
    navigate_to_many,
    navigate_to_one,
    owner_or_admin,
    roles_union,
    taken_by_other,
    touched_rows,
    unique_conflict,
    validate_rows,
)
from rowgate.operators.lookups import owned_by_other
from rowgate.sources import append_accepted, publish_version, read_version, scan_typed
from rowgate.storage import cut, fresh_dir


def values(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def status_by(df, seq="seq"):
    return {r[seq]: r.status for r in df.collect()}


@pytest.fixture(params=range(3))
def rng(request):
    return random.Random(request.param)


def maybe(rng, low, high):
    """A small number; a third of the draws hit one hot value, some are null."""
    draw = rng.random()
    if draw < 0.1:
        return None
    return low if draw < 0.43 else rng.randint(low, high)


def test_inserts_match_one_at_a_time_processing(spark, rng):
    parents = sorted(rng.sample(range(12), 8))
    held = {(rng.randint(0, 11), rng.randint(0, 5)) for _ in range(10)}
    reqs = [(i, maybe(rng, 0, 11), maybe(rng, 0, 5), rng.random() < 0.2) for i in range(120)]
    expected, taken = {}, set(held)
    for seq, a, b, bad in reqs:
        if bad:
            expected[seq] = 422
        elif a is not None and a not in parents:
            expected[seq] = 404
        elif a is not None and b is not None and (a, b) in taken:
            expected[seq] = 409
        else:
            expected[seq] = 201
            taken.add((a, b))
    df = spark.createDataFrame(reqs, "seq long, a int, b int, bad boolean").repartition(4)
    table = spark.createDataFrame(sorted(held), "a int, b int")
    parent = Parent("a", spark.createDataFrame([(p,) for p in parents], "id int"), "id", "parent")
    outcome = apply_inserts(df, "seq", gates=[Gate(F.col("bad"), 422, "bad")], parents=[parent], unique=["a", "b"], table=table)
    assert status_by(outcome) == expected
    good = df.where(~F.col("bad") & (F.col("a").isNull() | F.col("a").isin(parents)))
    assert status_by(unique_conflict(good, ["a", "b"], "seq", table)) == {k: v for k, v in expected.items() if v in (201, 409)}


def test_patch_keeps_last_sent_value(spark, rng):
    table = {i: [i * 10, f"n{i}"] for i in range(10)}
    patches = [
        (seq, rng.choice([0, 0, 0, *range(12)]), rng.random() < 0.5, maybe(rng, 1, 99), rng.random() < 0.5, rng.choice([None, "x", "y"]))
        for seq in range(80)
    ]
    expected = {k: list(v) for k, v in table.items()}
    for _, target, has_a, a, has_b, b in patches:
        if target in expected:
            if has_a:
                expected[target][0] = a
            if has_b:
                expected[target][1] = b
    df = spark.createDataFrame(patches, "seq long, target int, has_a boolean, a int, has_b boolean, b string")
    base = spark.createDataFrame([(k, *v) for k, v in table.items()], "id int, a int, b string")
    fields = {"a": (F.col("has_a"), F.col("a")), "b": (F.col("has_b"), F.col("b"))}
    got = apply_patch(base, "id", df.repartition(4), "target", "seq", fields)
    assert got.dtypes == base.dtypes
    assert {r.id: [r.a, r.b] for r in got.collect()} == expected


def test_deletes_match_one_at_a_time_processing(spark, rng):
    rows = {i: rng.choice(["o1", "o2", None]) for i in range(10)}
    blocked = set(rng.sample(range(10), 3))
    reqs = [(s, rng.choice([1, 1, *range(13)]), rng.choice(["o1", "o2"]), rng.random() < 0.3) for s in range(60)]
    expected, left = {}, dict(rows)
    for seq, target, caller, admin in reqs:
        if target not in left:
            expected[seq] = 404
        elif left[target] != caller and not admin:
            expected[seq] = 403
        elif target in blocked:
            expected[seq] = 409
        else:
            expected[seq] = 204
            del left[target]
    df = spark.createDataFrame(reqs, "seq long, target int, caller string, admin boolean")
    got = status_by(
        delete_outcome(
            df,
            spark.createDataFrame(list(rows.items()), "id int, owner string"),
            "id",
            "target",
            "seq",
            restricted=spark.createDataFrame([(b,) for b in blocked], "root int"),
            owner="owner",
            caller="caller",
            admin=F.col("admin"),
        )
    )
    assert got == expected


def test_taken_by_other_matches_pairs(spark, rng):
    rows = [(i, maybe(rng, 0, 9), maybe(rng, 0, 3)) for i in range(60)]
    expected = [
        (i,)
        for i, a, b in rows
        if a is not None and b is not None and any((x, y) == (a, b) and j != i for j, x, y in rows)
    ]
    df = spark.createDataFrame(rows, "id int, a int, b int")
    assert values(taken_by_other(df, ["a", "b"], "id"), "id") == sorted(expected, key=repr)
    asked = [(s, maybe(rng, 0, 9), rng.choice([None, *range(60)])) for s in range(60)]
    expected = {s: a is not None and any(x == a and j != own for j, x, _ in rows) for s, a, own in asked}
    reqs = spark.createDataFrame(asked, "seq int, want int, own int")
    got = owned_by_other(reqs, df, [("want", "a")], own="own", pk="id")
    assert {r.seq: r.taken for r in got.collect()} == expected


def test_lookups(spark, rng):
    rows = [(i, maybe(rng, 0, 9)) for i in range(40)]
    asked = [(s, maybe(rng, 0, 45)) for s in range(50)]
    table = spark.createDataFrame(rows, "id int, alt int")
    reqs = spark.createDataFrame(asked, "seq int, key int")
    by_id = dict(rows)
    got = lookup_by_key(reqs, touched_rows(table, reqs, ("key", "id")), ("key", "id"), {"alt": "found"})
    assert values(got, "seq", "found", "status") == sorted(
        [(s, by_id.get(k), 200 if k in by_id else 404) for s, k in asked], key=repr
    )
    first = {}
    for i, alt in rows:
        if alt is not None:
            first.setdefault(alt, i)
    got = lookup_by_alt_key(reqs, table, [("key", "alt")], "id", {"id": "found"})
    assert values(got, "seq", "found", "status") == sorted(
        [(s, first.get(k), 200 if k in first else 404) for s, k in asked], key=repr
    )


def test_touched_rows_of_any_type_and_size(spark, monkeypatch):
    table = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, name string")
    reqs = spark.createDataFrame([(2**40 + 1, "b"), (1, "x" * 5000), (1, None), (None, "zz")], "id long, name string")
    assert values(touched_rows(table, reqs, ("id", "id")), "id") == [(1,)]
    assert values(touched_rows(table, reqs, ("name", "name")), "id") == [(2,)]
    monkeypatch.setattr("rowgate.operators.lookups.BROADCAST_ROWS", 3)
    assert touched_rows(table, reqs, ("id", "id")).count() == 3
    assert touched_rows(table, reqs.where("id = 1"), ("id", "id")).count() == 1


def test_reference_check_skips_nulls_and_never_multiplies(spark):
    reqs = spark.createDataFrame([(1, None, 1), (2, 9, 9), (3, 1, 9), (4, 1, 1)], "seq int, a int, b int")
    once = spark.createDataFrame([(1,)], "id int")
    twice = once.union(once)
    for salts in (1, 5):
        parents = [
            Parent("a", twice, "id", "first", unique=False, salts=salts),
            Parent("b", once, "id", "second", salts=salts),
        ]
        assert values(fk_check(reqs, parents, "seq"), "seq", "fk") == [(1, "ok"), (2, "first"), (3, "second"), (4, "ok")]
    strict = [Parent("a", once, "id", "first", null_fails=True)]
    assert values(fk_check(reqs, strict, "seq"), "seq", "fk") == [(1, "first"), (2, "first"), (3, "ok"), (4, "ok")]
    assert values(fk_orphans(reqs, "a", once, "id"), "seq") == [(2,)]


def test_navigation(spark):
    parent = spark.createDataFrame([(1, "p"), (2, "q")], "id int, name string")
    child = spark.createDataFrame([(10, 1), (11, 1), (12, None), (13, 5)], "cid int, ref int")
    many = navigate_to_many(parent, "id", child, "ref", {"cid": "child"})
    assert values(many, "id", "name", "child") == [(1, "p", 10), (1, "p", 11), (2, "q", None)]
    path = Path("ref", parent, "id", {"name": "parent_name"}, optional=True)
    assert values(navigate_to_one(child, [path]), "cid", "parent_name") == [(10, "p"), (11, "p"), (12, None), (13, None)]
    inner = Path("ref", parent, "id", {"name": "parent_name"})
    assert values(navigate_to_one(child, [inner]), "cid") == [(10,), (11,)]


def test_insert_with_lookup_value(spark):
    roles = spark.createDataFrame([(3, "a"), (2, "a"), (1, "b")], "id int, name string")
    rows = spark.createDataFrame([(1,), (2,)], "x int")
    assert values(insert_with_lookup_value(rows, "r", roles, F.col("name") == "a", "id"), "x", "r") == [(1, 2), (2, 2)]
    assert values(insert_with_lookup_value(rows, "r", roles, F.col("name") == "z", "id"), "r") == [(None,), (None,)]


def test_null_keys_do_not_conflict(spark):
    users = spark.createDataFrame([(1, None), (2, None), (3, "k")], "id int, ext string")
    assert duplicate_keys(users, ["ext"]).count() == 0
    new = spark.createDataFrame([(1, 4, None), (2, 5, "k"), (3, 6, "m"), (4, 7, "m"), (5, 8, None)], "seq int, id int, ext string")
    assert values(insert_if_absent(users, new, ["ext"], "seq"), "id") == [(1,), (2,), (3,), (4,), (6,), (8,)]


def test_ids_are_dense_in_order_and_checked(spark):
    rows = spark.range(0, 5000, numPartitions=7).select((F.col("id") * F.col("id") - 100).alias("seq"))
    table = spark.createDataFrame([(41,), (17,)], "id int")
    got = assign_ids(rows.repartition(5), table, "id", "seq").orderBy("seq").collect()
    assert [r.id for r in got] == list(range(42, 5042))
    empty = table.where("id < 0")
    assert values(assign_ids(rows.where("seq < 0"), empty, "id", "seq"), "id") == sorted([(i,) for i in range(1, 11)], key=repr)
    full = spark.createDataFrame([(2**31 - 2,)], "id int")
    with pytest.raises(Exception, match="exceeds 2147483647"):
        assign_ids(rows, full, "id", "seq").collect()


def test_rules_and_conversion(spark):
    df = spark.createDataFrame(
        [(1, 5.0, "ok"), (2, float("nan"), ""), (3, 0.0, "toolong"), (4, None, None)], "id int, price double, name string"
    )
    rules = [Field("price", "double", gt=0), Field("name", "string", required=False, min_length=1, max_length=4)]
    got = {r.id: r.errors for r in validate_rows(df, rules).collect()}
    assert got == {1: [], 2: ["price:gt", "name:min_length"], 3: ["price:gt", "name:max_length"], 4: ["price:missing"]}
    raw = spark.createDataFrame([("5", "2.675"), ("5.0", "0.001"), ("5.5", "100000000"), ("x", None)], "n string, p string")
    typed = coerce_types(raw, [Field("n", "int"), Field("p", "decimal(10,2)")])
    assert [(r.n, r.p) for r in typed.collect()] == [(5, Decimal("2.68")), (5, Decimal("0.00")), (None, None), (None, None)]
    flagged = spark.createDataFrame([(None, False), (None, True), (3, True)], "s int, has_s boolean")
    assert [r.s for r in fill_defaults(flagged, [Field("s", "int", default=1)]).collect()] == [1, None, 3]


def test_email_pattern(spark):
    good = ["a@b.co", "a.b+c@d-e.org", "ü@b.de"]
    bad = ["a@b", "@b.co", "a@b.", "a b@c.de", "a@b@c.de", "a@b .co", "", None, "a@b.co\n"]
    df = spark.createDataFrame([(x,) for x in good + bad], "e string").select(valid_email(F.col("e")).alias("ok"))
    assert [r.ok for r in df.collect()] == [True] * len(good) + [False] * len(bad)


def test_owner_rule_with_null_owner(spark):
    df = spark.createDataFrame([(1, None, "a", False), (2, None, "a", True), (3, "a", "a", None), (4, "b", "a", False)], "seq int, o string, c string, adm boolean")
    assert status_by(owner_or_admin(df, F.col("o"), F.col("c"), F.col("adm"))) == {1: 403, 2: 200, 3: 200, 4: 403}


def test_identity_rows(spark):
    claims = [
        '{"realm_access":{"roles":["b","a"]}}',
        '{"resource_access":{"app":{"roles":["c"]},"other":{"roles":["z"]}}}',
        '{"realm_access":{"roles":["a"]},"resource_access":{"app":{"roles":["a","d"]}}}',
        "{}",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(claims)), "seq int, claims string")
    assert [r.roles for r in roles_union(df, "claims", "app").orderBy("seq").collect()] == [["a", "b"], ["c"], ["a", "d"], [], []]
    assert [r.roles for r in roles_union(df, "claims").orderBy("seq").collect()] == [["a", "b"], [], ["a"], [], []]
    tokens = [
        '{"aud":"me","iss":"r","exp":9}',
        '{"aud":["x","me"],"iss":"r"}',
        '{"aud":["x"],"iss":"r"}',
        '{"aud":"me","iss":"q"}',
        '{"aud":"me","iss":"r","exp":5}',
        '{"iss":"r"}',
        '{"aud":"me","iss":"r","exp":4.9}',
        '{"aud":"me","iss":"r","exp":5.5}',
        '{"aud":"me","iss":"r","exp":"x"}',
        "not json",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(tokens)), "seq int, claims string")
    assert values(claims_filter(df, "claims", "me", "r", 5), "seq") == [(0,), (1,), (4,), (5,), (7,)]
    keys = spark.createDataFrame([("k1", "one"), (None, "anon")], "kid string, name string")
    df = spark.createDataFrame([(1, "k1"), (2, "zz"), (3, None)], "seq int, kid string")
    got = kid_match(df, "kid", keys, "kid", {"name": "name"})
    assert values(got, "seq", "name", "status") == [(1, "one", 200), (2, None, 401), (3, "anon", 200)]
    urls = spark.createDataFrame([(1, "http://h/u/42"), (2, "http://h/u/"), (3, ""), (4, None), (5, "plain")], "seq int, url string")
    got = location_id(urls, "url", F.lit("looked up"))
    assert [r.found_id for r in got.orderBy("seq").collect()] == ["42", "", "looked up", "looked up", "plain"]


def test_audit_counts_every_kind_of_fault(spark):
    a = Contract("a", "id", (Field("v", "int", gt=0), Field("s", "string", max_length=2)), unique=("v",))
    b = Contract("b", "id", (), links=(Link("ref", "a"),))
    tables = {
        "a": spark.createDataFrame([(1, 1, "x"), (1, 1, "xxx"), (2, -1, None), (3, None, "y")], "id int, v int, s string"),
        "b": spark.createDataFrame([(1, 1), (2, 7), (3, None), (None, 1), (None, 1)], "id int, ref int"),
    }
    got = {(r.table_name, r.rule): r.violations for r in constraint_audit(tables, [a, b]).collect()}
    assert got == {
        ("a", "pk"): 1,
        ("a", "id:missing"): 0,
        ("a", "unique:v"): 1,
        ("a", "v:missing"): 1,
        ("a", "v:gt"): 1,
        ("a", "s:missing"): 1,
        ("a", "s:max_length"): 1,
        ("b", "pk"): 0,
        ("b", "id:missing"): 2,
        ("b", "fk:ref"): 1,
    }


def test_cascade_cycle_is_refused(spark):
    a = Contract("a", "id", (), links=(Link("ref", "b", CASCADE),))
    b = Contract("b", "id", (), links=(Link("ref", "a", CASCADE),))
    rows = spark.createDataFrame([(1, 1)], "id int, ref int")
    roots = spark.createDataFrame([(1,)], "root int")
    with pytest.raises(ValueError, match="cycle"):
        delete_rows(roots, "a", {"a": rows, "b": rows}, {"a": a, "b": b})


def test_detach_keeps_other_rows(spark):
    child = spark.createDataFrame([(1, 1), (2, 2), (3, None)], "id int, ref int")
    gone = spark.createDataFrame([(1,), (9,)], "id int")
    assert values(delete_detach(child, "ref", gone, "id"), "id", "ref") == [(1, None), (2, 2), (3, None)]


def test_versions_and_appends(spark):
    contract = Contract("t", "id", (Field("v", "string"),))
    root = fresh_dir(spark, "test-versions")
    publish_version(spark.createDataFrame([(1, "a")], contract.schema), root, 1)
    # A version that was written but never listed does not count.
    spark.createDataFrame([(9, "z")], contract.schema).write.parquet(f"{root}/data/v=3")
    assert values(read_version(spark, root, contract), "id", "v") == [(1, "a")]
    publish_version(spark.createDataFrame([(2, "b")], contract.schema), root, 2)
    assert values(read_version(spark, root, contract), "id", "v") == [(2, "b")]
    assert values(read_version(spark, root, contract, 1), "id", "v") == [(1, "a")]
    out = fresh_dir(spark, "test-append")
    outcomes = spark.createDataFrame([(1, 201), (2, 409)], "seq int, status int")
    append_accepted(outcomes, out, batch=0)
    append_accepted(outcomes, out, batch=0)
    append_accepted(outcomes, out, batch=1)
    assert values(spark.read.parquet(out), "seq", "batch") == [(1, 0), (1, 1)]


def test_typed_scans_of_other_formats(spark):
    contract = Contract("t", "id", (Field("p", "decimal(10,2)"), Field("at", "timestamp_ntz")))
    rows = [(1, Decimal("2.50"), datetime(2025, 3, 1, 20, 0)), (2, None, None)]
    df = spark.createDataFrame(rows, contract.schema).withColumn("extra", F.lit("x"))
    for fmt in ("parquet", "json", "orc"):
        path = fresh_dir(spark, f"test-{fmt}")
        df.write.format(fmt).save(path)
        got = scan_typed(spark, path, contract, fmt)
        assert got.columns == contract.columns
        assert values(got, "id", "p", "at") == rows


def test_cut_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, Decimal("1.50"), None)], "a int, b decimal(10,2), c string")
    kept = cut(df)
    assert kept.dtypes == df.dtypes and kept.collect() == df.collect()


@pytest.mark.parametrize("seed", range(3))
def test_first_on_all_equals_one_by_one(spark, seed):
    pick = random.Random(seed)
    rows = []
    for seq in range(200):
        name = pick.choice([None, "hot", "hot", *(f"n{i}" for i in range(30))])
        rows.append((seq, name, pick.choice([None, None, *range(25)]), pick.choice([None, *range(40)])))
    # A chain in which every other request fails on the key that the one before it took.
    rows += [(1000 + i, f"c{i // 2}", 100 + (i + 1) // 2, None) for i in range(9)]
    names, second, third, want = set(), set(), set(), []
    for seq, *keys in rows:
        taken = [k is not None and k in held for k, held in zip(keys, (names, second, third))]
        if not any(taken):
            want.append(seq)
            for k, held in zip(keys, (names, second, third)):
                held.add(k)
    pick.shuffle(rows)
    got = first_on_all(spark.createDataFrame(rows, "seq long, a string, b int, c int"), ["a", "b", "c"], "seq")
    assert sorted(r.seq for r in got.collect()) == want
    assert first_on_all(got.where("seq < 0"), ["a"], "seq").collect() == []


def test_children_pages(spark):
    pick = random.Random(3)
    rows = [(i, pick.choice([1, 1, 2, 3, 9, None]), pick.randrange(5)) for i in range(300)]
    child = spark.createDataFrame(rows, "id int, owner int, rank int")
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "none"), (None, "null")], "key int, name string")
    got = children_pages(parent, "key", child.repartition(7), "owner", ["rank", "id"], {"id": "child", "rank": "rank"}, size=16)
    want = {}
    for key, name in [(1, "a"), (2, "b"), (3, "c"), (4, "none"), (None, "null")]:
        mine = sorted((r, i) for i, owner, r in rows if owner == key and key is not None)
        for page in range(max(1, -(-len(mine) // 16))):
            want[key, name, page] = [(i, r) for r, i in mine[page * 16 : page * 16 + 16]]
    assert {(r.key, r.name, r.page): [tuple(c) for c in r.children] for r in got.collect()} == want
    assert len(want) > 8
