"""A key that holds a third of all requests: joins split it, and results stay whole."""

import pytest
from pyspark.sql import functions as F

from rowgate.operators import (
    Parent,
    apply_inserts,
    delete_cascade,
    delete_outcome,
    fk_check,
    lookup_by_alt_key,
    lookup_by_key,
    navigate_to_many,
    unique_conflict,
)
from rowgate.operators.keys import winning_claims
from rowgate.storage import fresh_dir

ROWS = 300_000
KEYS = 20_000

# Small limits, so that local data is large enough to be shuffled and split.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
}


@pytest.fixture(scope="module")
def data(spark):
    root = fresh_dir(spark, "test-skew")
    spread = F.pmod(F.xxhash64("id"), F.lit(KEYS)).cast("int")
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(spread)
    spark.range(0, ROWS, 1, 16).select(F.col("id").alias("seq"), key.alias("k"), (spread % 5).alias("m")).write.parquet(f"{root}/req")
    spark.range(1, KEYS).select(F.col("id").cast("int").alias("id"), (F.col("id") / 2).cast("int").alias("alt")).write.parquet(f"{root}/par")
    before = {name: spark.conf.get(name) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield spark.read.parquet(f"{root}/req"), spark.read.parquet(f"{root}/par")
    for name, value in before.items():
        spark.conf.set(name, value)


def final_plan(df, capsys):
    # All columns are read, so that the shuffled rows have their full size.
    total = df.agg(F.count("*"), F.bit_xor(F.xxhash64(*df.columns)))
    rows = total.collect()[0][0]
    capsys.readouterr()
    total.explain()
    return rows, capsys.readouterr().out.split("Initial Plan")[0]


@pytest.mark.parametrize("name", ["lookup", "alt", "reference", "cascade", "children"])
def test_hot_key_is_split(data, capsys, name):
    req, par = data
    df = {
        "lookup": lambda: lookup_by_key(req, par, ("k", "id"), {"alt": "found"}),
        "alt": lambda: lookup_by_alt_key(req, par, [("k", "alt")], "id", {"id": "found"}),
        "reference": lambda: fk_check(req, [Parent("k", par, "id", "p")], "seq"),
        "cascade": lambda: delete_cascade(req, "k", par.where("id > 10"), "id"),
        "children": lambda: navigate_to_many(par, "id", req, "k", {"seq": "s"}),
    }[name]()
    rows, plan = final_plan(df, capsys)
    assert "skew=true" in plan
    if name in ("lookup", "alt", "reference"):
        assert rows == ROWS


def test_first_wins_on_a_hot_unique_key(data):
    req, par = data
    held = par.where("id % 2 = 0").select(F.col("id").alias("k"), F.lit(0).alias("m"))
    parents = [Parent("k", par, "id", "p")]
    outcome = apply_inserts(req, "seq", parents=parents, unique=["k", "m"], table=held)
    by_status = {r.status: r["count"] for r in outcome.groupBy("status").count().collect()}
    keys = req.where("k <> 0").select("k", "m").distinct().where("not (k % 2 = 0 and m = 0)").count()
    missing = req.where("k = 0").count()
    assert by_status == {201: keys, 404: missing, 409: ROWS - keys - missing}
    alone = unique_conflict(req.where("k <> 0"), ["k", "m"], "seq", held)
    assert alone.where("status = 201").count() == keys


def test_delete_with_blocked_rows_is_split(data, capsys):
    req, par = data
    blocked = par.where("id % 5 = 0").select(F.col("id").alias("root"))
    outcome = delete_outcome(req, par, "id", "k", "seq", restricted=blocked)
    by_status = {r.status: r["count"] for r in outcome.groupBy("status").count().collect()}
    keys = req.where("k <> 0").select("k").distinct()
    needed = req.where("k <> 0 and k % 5 = 0").count()
    assert by_status == {204: keys.where("k % 5 <> 0").count(), 409: needed, 404: ROWS - needed - keys.where("k % 5 <> 0").count()}


def test_key_that_is_hot_in_the_table_can_be_split(data, capsys):
    """Only keys are shuffled here, which compress too well to count as skewed, so the shape of the join is checked:
    nothing but a sort stands between it and the shuffle of either side."""
    req, par = data
    new = par.select(F.col("id").alias("k"), F.col("id").cast("long").alias("seq"))
    winners = winning_claims(new, ["k"], "seq", req)
    rows, plan = final_plan(winners, capsys)
    assert rows == new.join(req, "k", "left_anti").count()
    join = plan[plan.index("SortMergeJoin [k#") :].splitlines()[1:]
    sides = [line for line in join if "Sort [k#" in line or "HashAggregate" in line or "Exchange hashpartitioning(k#" in line]
    assert not any("HashAggregate" in line for line in sides[:2])


def test_two_parents_by_one_column_are_split(data, capsys):
    req, par = data
    two = [Parent("k", par, "id", "p"), Parent("k", par.where("id > 3"), "id", "q")]
    rows, plan = final_plan(fk_check(req, two, "seq"), capsys)
    assert rows == ROWS and "skew=true" in plan
