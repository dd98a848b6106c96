"""References between tables: check them, list broken ones, follow them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from rowgate.functions.gates import NOT_FOUND
from rowgate.operators.keys import assign_ids
from rowgate.storage import cut


@dataclass(frozen=True)
class Parent:
    """A reference to probe: request ``column`` must exist as ``key`` of ``table``.

    ``key`` is a primary key, so the probe cannot multiply requests and the table needs no de-duplication before the
    join; set ``unique=False`` for a key that may repeat. A null reference is skipped unless ``null_fails``.
    ``salts`` above 1 spreads each key over that many tasks by copying the parent side that often. It is for plans
    without adaptive execution (streams) with hot keys; batch plans split hot keys at run time.
    """

    column: str
    table: DataFrame
    key: str
    label: str
    status: int = NOT_FOUND
    null_fails: bool = False
    unique: bool = True
    salts: int = 1


def probe_parents(requests: DataFrame, parents: Sequence[Parent], seq: str) -> tuple[DataFrame, list[Column]]:
    """Join every parent and return 'reference is missing' columns in the given order."""
    missing: list[Column] = []
    probed: set[str] = set()
    for i, p in enumerate(parents):
        if p.column in probed and not requests.isStreaming:
            # Two joins in a row on one column would share partitions, so that neither could be split.
            requests = cut(requests)
        probed.add(p.column)
        found = f"_parent{i}"
        keys = p.table.select(F.col(p.key).alias(found))
        if not p.unique:
            keys = keys.distinct()
        condition = F.col(p.column) == F.col(found)
        if p.salts > 1:
            salt, copy = f"_salt{i}", f"_copy{i}"
            requests = requests.withColumn(salt, F.pmod(F.xxhash64(seq), F.lit(p.salts)).cast("int"))
            keys = keys.withColumn(copy, F.explode(F.sequence(F.lit(0), F.lit(p.salts - 1))))
            requests = requests.join(keys, condition & (F.col(salt) == F.col(copy)), "left").drop(salt, copy)
        else:
            requests = requests.join(keys, condition, "left")
        absent = F.col(found).isNull()
        missing.append(absent if p.null_fails else absent & F.col(p.column).isNotNull())
    return requests, missing


def fk_check(requests: DataFrame, parents: Sequence[Parent], seq: str, *, out: str = "fk") -> DataFrame:
    """Add the label of the first missing parent, in the given order, or 'ok'. Works on batches and on streams."""
    columns = requests.columns
    joined, missing = probe_parents(requests, parents, seq)
    first = F.coalesce(*[F.when(m, F.lit(p.label)) for m, p in zip(missing, parents)], F.lit("ok"))
    return joined.select(*columns, first.alias(out))


def fk_orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose parent is missing. A null reference is no orphan."""
    keys = parent.select(F.col(key).alias(column))
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


@dataclass(frozen=True)
class Path:
    """A to-one step: ``column`` of the rows so far leads to ``key`` of ``table``; ``columns`` maps what to bring."""

    column: str
    table: DataFrame
    key: str
    columns: Mapping[str, str] = field(default_factory=dict)
    optional: bool = False


def navigate_to_one(child: DataFrame, paths: Sequence[Path]) -> DataFrame:
    """Follow declared paths from child to parent, one equi-join per step; optional references keep their row."""
    for i, p in enumerate(paths):
        key = f"_to{i}"
        right = p.table.select(F.col(p.key).alias(key), *[F.col(c).alias(n) for c, n in p.columns.items()])
        child = child.join(right, F.col(p.column) == F.col(key), "left" if p.optional else "inner").drop(key)
    return child


def navigate_to_many(
    parent: DataFrame, key: str, child: DataFrame, column: str, columns: Mapping[str, str]
) -> DataFrame:
    """One row per parent and child; parents without children stay once, with nulls.

    The result is flat rather than one array per parent, since a single parent may hold any share of the children.
    An inner join plus an anti join is used instead of a left join, as only the former can split a hot parent.
    """
    rows = child.select(F.col(column).alias(key), *[F.col(c).alias(n) for c, n in columns.items()])
    childless = parent.join(child.select(F.col(column).alias(key)).distinct(), key, "left_anti")
    return parent.join(rows, key).unionByName(childless, allowMissingColumns=True)


def children_pages(
    parent: DataFrame,
    key: str,
    child: DataFrame,
    column: str,
    order: Sequence[str],
    columns: Mapping[str, str],
    *,
    size: int = 1000,
    page: str = "page",
    out: str = "children",
) -> DataFrame:
    """Each parent with its children as arrays of structs, at most ``size`` in each: (parent, page from 0, children).

    Children come by ``order``, which with ``column`` must tell them apart, as a primary key in it does; ``columns`` maps
    child columns to names in the structs. A parent without children has one page with an empty array, and children
    without a parent are in none.

    No task holds all children of a parent: they are sorted by ranges, one parent over many tasks if need be, and a
    child's rank is its place in the whole order less its parent's first. Pages are then gathered by (parent, page).
    """
    rows = child.where(F.col(column).isNotNull())
    none = parent.select(F.lit(0).cast("bigint").alias("_place")).where(F.lit(False))
    unique = [column, *order]
    placed = cut(assign_ids(rows.select(*unique), none, "_place", unique))
    first = cut(placed.groupBy(column).agg(F.min("_place").alias("_first")))
    rank = F.col("_place") - F.col("_first")
    ranked = placed.join(first, column).select(*unique, rank.alias("_rank"))
    shown = F.struct("_rank", F.struct(*[F.col(c).alias(n) for c, n in columns.items()]).alias("_row"))
    wide = rows.select(*dict.fromkeys([*unique, *columns])).join(ranked, unique)
    wide = wide.select(F.col(column).alias("_parent"), F.floor(F.col("_rank") / size).cast("int").alias("_page"), shown.alias("_one"))
    pages = wide.groupBy("_parent", "_page").agg(F.array_sort(F.collect_list("_one"))["_row"].alias("_rows"))
    joined = parent.join(cut(pages), F.col(key) == F.col("_parent"), "left")
    return joined.select(
        *parent.columns,
        F.coalesce("_page", F.lit(0)).alias(page),
        F.coalesce("_rows", F.array().cast(pages.schema["_rows"].dataType)).alias(out),
    )


def children_summary(
    parent: DataFrame, key: str, child: DataFrame, column: str, measures: Sequence[Column]
) -> DataFrame:
    """Aggregates over the children of each parent, combined map-side before the join; no parent is lost."""
    summary = child.groupBy(F.col(column).alias(key)).agg(*measures)
    return parent.join(summary, key, "left")


def insert_with_lookup_value(
    rows: DataFrame, column: str, table: DataFrame, where: Column, value: str
) -> DataFrame:
    """Add a column read from another table by a scalar subquery: the lowest match, null if there is none."""
    return rows.withColumn(column, table.where(where).agg(F.min(value)).scalar())
