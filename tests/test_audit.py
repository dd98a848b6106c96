"""The audit carried over a change set, against an audit of the changed tables."""

from pyspark.sql import functions as F

from rowgate.contracts import Contract, Field, Link
from rowgate.operators import audit_change, constraint_audit, constraint_counts

PARENT = Contract("parent", "id", (Field("name", "string"),), unique=("name",))
CHILD = Contract("child", "id", (Field("up", "int", gt=0),), links=(Link("up", "parent"),))
BOTH = [PARENT, CHILD]


def test_audit_change_meets_keys_without_a_sort(spark):
    parents = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, None), (None, "c")], "id int, name string")
    children = spark.createDataFrame([(1, 1), (2, 1), (3, 9), (3, 0), (4, None), (None, 2)], "id int, up int")
    more = spark.createDataFrame([(9, "b"), (2, "b"), (None, "a")], "id int, name string")
    fewer = parents.where("id = 1 or id = 3")
    born = spark.createDataFrame([(1, 1), (5, 77), (6, 77), (None, -1)], "id int, up int")
    before = {"parent": parents, "child": children}
    after = {"parent": parents.where("id is null or id = 2").unionByName(more), "child": children.unionByName(born)}
    change = constraint_counts({"parent": more, "child": born}, BOTH).unionByName(constraint_counts({"parent": fewer}, BOTH, sign=-1))
    counts = constraint_counts(before, BOTH)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = audit_change(constraint_audit(before, BOTH), counts, change)
        plan = audit_change(constraint_audit(before, BOTH), counts, change)._jdf.queryExecution().executedPlan().toString()
        got = {(r.table_name, r.rule): r.violations for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {(r.table_name, r.rule): r.violations for r in constraint_audit(after, BOTH).collect()}
    assert "SortMergeJoin" in plan and "key#" in plan
    assert not [line for line in plan.splitlines() if "Join [" in line and "key#" in line]


def test_audit_change_keeps_rules_that_nothing_touches(spark):
    parents = spark.createDataFrame([(1, "a"), (1, "a")], "id int, name string")
    children = spark.createDataFrame([(1, 5)], "id int, up int")
    tables = {"parent": parents, "child": children}
    audit, counts = constraint_audit(tables, BOTH), constraint_counts(tables, BOTH)
    none = counts.where(F.lit(False))
    assert sorted(audit_change(audit, counts, none).collect()) == sorted(audit.collect())
