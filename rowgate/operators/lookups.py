"""Batched lookups and row-level access.

Joins here keep the requests on the left and an unaggregated table on the right, so a key that many requests share is
split by adaptive skew handling. Which side is broadcast is left to Spark's size statistics.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowgate.functions.gates import FORBIDDEN, NOT_FOUND, OK, all_present

# At most this many key hashes are broadcast, which is some tens of megabytes.
BROADCAST_ROWS = 1_000_000


def lookup_by_key(
    requests: DataFrame,
    table: DataFrame,
    on: tuple[str, str],
    columns: Mapping[str, str],
    *,
    hit: int = OK,
    miss: int = NOT_FOUND,
) -> DataFrame:
    """Fetch rows by primary key; requests that miss stay, with the miss status.

    ``on`` is (request column, primary key of the table), ``columns`` maps table columns to result names.
    """
    left_key, key = on
    right = table.select(F.col(key).alias("_key"), *[F.col(c).alias(n) for c, n in columns.items()])
    joined = requests.join(right, F.col(left_key) == F.col("_key"), "left")
    status = F.when(F.col("_key").isNull(), F.lit(miss)).otherwise(F.lit(hit))
    return joined.withColumn("status", status).drop("_key")


def first_rows(table: DataFrame, cols: Sequence[str], pk: str) -> DataFrame:
    """The row with the lowest primary key for each value of ``cols``; null values are left out.

    The narrow minimum is combined map-side; whole rows are then picked by primary key, which cannot be skewed.
    """
    firsts = table.where(all_present(cols)).groupBy(*cols).agg(F.min(pk).alias(pk)).select(pk)
    return table.join(firsts, pk, "left_semi")


def lookup_by_alt_key(
    requests: DataFrame,
    table: DataFrame,
    on: Sequence[tuple[str, str]],
    pk: str,
    columns: Mapping[str, str],
    *,
    hit: int = OK,
    miss: int = NOT_FOUND,
) -> DataFrame:
    """Fetch the first row (lowest primary key) by columns that need not be unique."""
    firsts = first_rows(table, [t for _, t in on], pk)
    keys = [F.col(t).alias(f"_alt{i}") for i, (_, t) in enumerate(on)]
    right = firsts.select(*keys, *[F.col(c).alias(n) for c, n in columns.items()])
    condition = [F.col(r) == F.col(f"_alt{i}") for i, (r, _) in enumerate(on)]
    joined = requests.join(right, condition, "left")
    status = F.when(F.col("_alt0").isNull(), F.lit(miss)).otherwise(F.lit(hit))
    return joined.withColumn("status", status).drop(*[f"_alt{i}" for i in range(len(on))])


def is_small(requests: DataFrame) -> bool:
    """Size check for ``touched_rows``: are there few enough requests to broadcast one key column of theirs?"""
    return requests.count() <= BROADCAST_ROWS


def touched_rows(table: DataFrame, requests: DataFrame, on: tuple[str, str], *, small: bool | None = None) -> DataFrame:
    """The table rows that may matter to a batch of requests, for lookups in tables far larger than the batch.

    A batch within the size limit has the hashes of its keys broadcast, eight bytes each however long a key is, so the
    table is filtered where it is read and is never shuffled. Equal hashes may let a few other rows through, which the
    exact lookup that follows drops. For a larger batch the table is returned as it is, and the lookup joins it in
    full. ``small`` passes on a size check that was already made.
    """
    left_key, key = on
    if not (is_small(requests) if small is None else small):
        return table
    kind = next(f.dataType for f in table.schema if f.name == key)
    # Hashes depend on the type; a value the table's type cannot hold becomes null and matches nothing.
    wanted = F.col(left_key).try_cast(kind)
    hashes = requests.where(wanted.isNotNull()).select(F.xxhash64(wanted).alias("_hash")).distinct()
    keyed = table.where(F.col(key).isNotNull())
    return keyed.join(F.broadcast(hashes), F.xxhash64(key) == F.col("_hash"), "left_semi")


def taken_by_other(df: DataFrame, cols: Sequence[str], pk: str) -> DataFrame:
    """Rows whose ``cols`` value is also held by a row with another primary key. Null values are never taken.

    Values held by one row only are found by a combined min/max, and those single rows are removed by primary key, so
    no group of equal values is ever gathered or paired.
    """
    keyed = df.where(all_present(cols))
    spans = keyed.groupBy(*cols).agg(F.min(pk).alias(pk), F.max(pk).alias("_last"))
    return keyed.join(spans.where(F.col(pk) == F.col("_last")).select(pk), pk, "left_anti")


def owned_by_other(
    requests: DataFrame, table: DataFrame, on: Sequence[tuple[str, str]], own: str, pk: str, flag: str = "taken"
) -> DataFrame:
    """Add ``flag``: does a row other than the request's ``own`` one hold the wanted value?

    One row per value carries its lowest and highest owner, which is enough to tell whether another owner exists.
    """
    cols = [t for _, t in on]
    spans = table.where(all_present(cols)).groupBy(*cols).agg(F.min(pk).alias(pk), F.max(pk).alias("_hi"))
    owners = table.select(pk, *cols).join(spans.select(pk, "_hi"), pk)
    right = owners.select(
        F.col(pk).alias("_lo"), "_hi", *[F.col(c).alias(f"_own{i}") for i, c in enumerate(cols)]
    )
    condition = [F.col(r) == F.col(f"_own{i}") for i, (r, _) in enumerate(on)]
    joined = requests.join(right, condition, "left")
    other = (F.col("_lo") != F.col(own)) | (F.col("_hi") != F.col(own)) | F.col(own).isNull()
    taken = F.col("_lo").isNotNull() & F.coalesce(other, F.lit(False))
    return joined.withColumn(flag, taken).drop("_lo", "_hi", *[f"_own{i}" for i in range(len(cols))])


def may_touch(owner: Column, caller: Column, admin: Column) -> Column:
    """Owner or admin. A row without owner belongs to nobody."""
    return F.coalesce(owner == caller, F.lit(False)) | F.coalesce(admin, F.lit(False))


def owner_or_admin(
    requests: DataFrame, owner: Column, caller: Column, admin: Column, *, ok: int = OK, refused: int = FORBIDDEN
) -> DataFrame:
    """Add the status of the access rule: pass for the row's owner and for admins, else refused."""
    return requests.withColumn("status", F.when(may_touch(owner, caller, admin), F.lit(ok)).otherwise(F.lit(refused)))
