"""Constraint audit: how many rows or keys of each table break each declared constraint."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rowgate.contracts import Contract
from rowgate.operators.checks import row_rules
from rowgate.operators.keys import duplicate_keys
from rowgate.operators.links import fk_orphans

_GROUP = ["table_name", "rule", "key"]


def _counted(table: str, rule: str, rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "violations"
    )


def _row_rules(table: DataFrame, contract: Contract) -> DataFrame:
    """All row rules of a table in one scan: one conditional count each, then one row per rule."""
    rules = [(f"{contract.key}:missing", F.col(contract.key).isNull()), *row_rules(table, contract.fields)]
    counts = table.agg(*[F.count(F.when(broken, 1)).alias(f"_r{i}") for i, (_, broken) in enumerate(rules)])
    lines = F.array(
        *[F.struct(F.lit(label).alias("rule"), F.col(f"_r{i}").alias("violations")) for i, (label, _) in enumerate(rules)]
    )
    return counts.select(F.lit(contract.name).alias("table_name"), F.inline(lines))


def constraint_audit(tables: Mapping[str, DataFrame], contracts: Iterable[Contract]) -> DataFrame:
    """One row per table and rule: primary key (repeated, missing), unique key, references, and every field's rules."""
    contracts = {c.name: c for c in contracts}
    parts = []
    for name, contract in contracts.items():
        table = tables[name]
        parts.append(_counted(name, "pk", duplicate_keys(table, [contract.key])))
        if contract.unique:
            parts.append(_counted(name, f"unique:{','.join(contract.unique)}", duplicate_keys(table, contract.unique)))
        for link in contract.links:
            parent = contracts[link.parent]
            orphans = fk_orphans(table, link.column, tables[link.parent], parent.key)
            parts.append(_counted(name, f"fk:{link.column}", orphans))
        parts.append(_row_rules(table, contract))
    return reduce(DataFrame.unionByName, parts)


def constraint_counts(tables: Mapping[str, DataFrame], contracts: Iterable[Contract], sign: int = 1) -> DataFrame:
    """What an audit needs to know of rows, as counts that add up: ``(table_name, rule, key, held, used)``.

    ``held`` counts the rows that hold a key, ``used`` those that refer to it; for a field's rule, whose key is empty,
    ``held`` counts the rows that break it. Rows with a null in a key count for none. ``tables`` may have some of the
    contracts' tables, as a change set has; with ``sign`` -1 its rows are taken away. Counts are combined before the
    shuffle, so a hot key is one row per partition.
    """
    parts = []

    def add(table: str, rule: str, rows: DataFrame, columns: Iterable[str], held: int, used: int) -> None:
        key = F.array(*[F.col(c).cast("string") for c in columns])
        some = rows.dropna(subset=list(columns)).groupBy(key.alias("key")).agg(F.count("*").alias("n"))
        parts.append(
            some.select(
                F.lit(table).alias("table_name"),
                F.lit(rule).alias("rule"),
                "key",
                (F.col("n") * held * sign).alias("held"),
                (F.col("n") * used * sign).alias("used"),
            )
        )

    contracts = {c.name: c for c in contracts}
    for name, contract in contracts.items():
        for link in contract.links:
            if link.parent in tables:
                add(name, f"fk:{link.column}", tables[link.parent], [contracts[link.parent].key], 1, 0)
        if name not in tables:
            continue
        table = tables[name]
        add(name, "pk", table, [contract.key], 1, 0)
        if contract.unique:
            add(name, f"unique:{','.join(contract.unique)}", table, contract.unique, 1, 0)
        for link in contract.links:
            add(name, f"fk:{link.column}", table, [link.column], 0, 1)
        parts.append(
            _row_rules(table, contract).select(
                "table_name",
                "rule",
                F.array().cast("array<string>").alias("key"),
                (F.col("violations") * sign).alias("held"),
                F.lit(0).cast("long").alias("used"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def audit_change(audit: DataFrame, counts: DataFrame, change: DataFrame) -> DataFrame:
    """The audit after a change set, from the audit before it, without reading the tables again.

    ``counts`` are the ``constraint_counts`` of the tables before, ``change`` those of the added rows and, with sign -1,
    of the removed ones. Only keys that the change touches are judged, before and after it. The counts of the tables
    after are ``counts.unionByName(change)``: they may be stored as they come, one part per change set, and summed by
    key now and then.

    Counts of the rules that the change has meet it in one aggregation, which needs no sort by key as a join would;
    ``counts`` are read once, ``change`` twice.
    """
    # One row per rule.
    rules = F.broadcast(change.select("table_name", "rule").distinct())
    before = counts.join(rules, ["table_name", "rule"], "left_semi").select(*_GROUP, "held", "used", F.lit(0).alias("changes"))
    after = change.select(*_GROUP, "held", "used", F.lit(1).alias("changes"))

    def total(column: str, new: int) -> Column:
        return F.sum(F.when(F.col("changes") == new, F.col(column)).otherwise(0))

    both = before.unionByName(after).groupBy(_GROUP)
    both = both.agg(
        *[total(c, 0).alias(c) for c in ("held", "used")],
        *[total(c, 1).alias(f"{c}_more") for c in ("held", "used")],
        F.max("changes").alias("changes"),
    ).where("changes = 1")

    def broken(held, used):
        by_key = F.when(F.col("rule").startswith("fk:"), F.when(held <= 0, used).otherwise(0))
        return by_key.when(F.size("key") > 0, (held > 1).cast("long")).otherwise(held)

    held, used = F.col("held"), F.col("used")
    more = broken(held + F.col("held_more"), used + F.col("used_more")) - broken(held, used)
    more = both.groupBy("table_name", "rule").agg(F.sum(more).alias("more"))
    now = F.col("violations") + F.coalesce("more", F.lit(0))
    return audit.join(more, ["table_name", "rule"], "left").select("table_name", "rule", now.cast("long").alias("violations"))
