"""Unique keys and identifiers.

'First wins' is settled by a map-side combined minimum per key. The winners are then matched to requests by sequence
number, which is unique, so a key that a third of the batch asks for never meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from rowgate.functions.gates import CONFLICT, CREATED, all_present
from rowgate.storage import cut

_LIMITS = {"int": 2**31 - 1, "bigint": 2**63 - 1}
# monotonically_increasing_id puts the partition number above this bit.
_PARTITION_BITS = 33


def first_claims(requests: DataFrame, cols: Sequence[str], seq: str) -> DataFrame:
    """(cols, seq) of the first request for each key. Requests with a null in the key claim nothing."""
    return requests.where(all_present(cols)).groupBy(*cols).agg(F.min(seq).alias(seq))


def winning_claims(
    requests: DataFrame, cols: Sequence[str], seq: str, table: DataFrame, table_cols: Sequence[str] | None = None
) -> DataFrame:
    """Sequence numbers of requests that are first for a key which the table does not hold yet.

    The first claims are written before the join: they come out of an aggregation by the join key, whose partitions
    could not be split where a key is hot in the table.

    The inner join lets Spark broadcast whichever of batch and table is small; a huge table is not shuffled for a
    small batch.
    """
    first = cut(first_claims(requests, cols, seq))
    held = table.select(*[F.col(t).alias(c) for c, t in zip(cols, table_cols or cols)])
    taken = first.join(held, list(cols)).select(seq)
    return first.select(seq).join(taken, seq, "left_anti")


def first_on_all(requests: DataFrame, cols: Sequence[str], seq: str) -> DataFrame:
    """(seq, cols) of the requests that find each of their keys free when they are served in order.

    Every column is a unique key of its own; a null claims nothing. A request takes its keys only if all are free, so
    one that fails on one key leaves the others to the next. Requests are settled in rounds: those that are first on all
    their keys are served, then they and all that share a key with them are done. There are as many rounds as the longest
    chain in which each request waits for the one before; firsts are minima combined before the shuffle, and are matched
    by sequence number.
    """
    open_ = cut(requests.select(seq, *cols))
    served = []
    while not served or open_.limit(1).count():
        leads = open_
        for i, name in enumerate(cols):
            first = open_.where(F.col(name).isNotNull()).groupBy(name).agg(F.min(seq).alias(seq))
            leads = leads.join(first.select(seq, F.lit(True).alias(f"_first{i}")), seq, "left")
            leads = leads.where(F.col(name).isNull() | F.col(f"_first{i}"))
        won = cut(leads.select(seq, *cols))
        served.append(won)
        left = open_.join(won.select(seq), seq, "left_anti")
        for name in cols:
            left = cut(left.join(won.select(name), name, "left_anti"))
        open_ = left
    return reduce(DataFrame.unionByName, served)


def unique_conflict(
    requests: DataFrame,
    cols: Sequence[str],
    seq: str,
    table: DataFrame,
    table_cols: Sequence[str] | None = None,
    *,
    ok: int = CREATED,
    conflict: int = CONFLICT,
) -> DataFrame:
    """Add the status of the unique rule: conflict if the table or an earlier request has the key."""
    winners = winning_claims(requests, cols, seq, table, table_cols).withColumn("_won", F.lit(True))
    free = F.col("_won") | ~all_present(cols)
    status = F.when(free, F.lit(ok)).otherwise(F.lit(conflict))
    return requests.join(winners, seq, "left").withColumn("status", status).drop("_won")


def duplicate_keys(df: DataFrame, cols: Sequence[str], *, out: str = "copies") -> DataFrame:
    """Key values held by more than one row. Values with a null part do not conflict."""
    return df.where(all_present(cols)).groupBy(*cols).agg(F.count("*").alias(out)).where(F.col(out) > 1)


def insert_if_absent(table: DataFrame, rows: DataFrame, cols: Sequence[str], seq: str) -> DataFrame:
    """The table plus the first new row of each key it lacks. Rows with a null in the key never conflict."""
    winners = winning_claims(rows, cols, seq, table)
    new = rows.where(all_present(cols)).join(winners, seq, "left_semi")
    free = rows.where(~all_present(cols))
    columns = table.columns
    return table.unionByName(new.select(*columns)).unionByName(free.select(*columns))


def assign_ids(
    rows: DataFrame, table: DataFrame, key: str, seq: str | Sequence[str], *, out: str | None = None, above: int = 0
) -> DataFrame:
    """Add fresh dense identifiers above the table's highest one, and above ``above``, in order of ``seq``,
    which may be several columns.

    ``above`` is the highest identifier ever given; without it the one of a deleted last row is given again.

    The sequence numbers alone are sorted once across the cluster and kept in reliable storage, so that positions stay
    the same whoever reads them. Partition offsets come from one count per sorted partition: that list has as many
    rows as there are partitions, which bounds both the running sum and the broadcast.
    """
    out = out or key
    kind = next(f.dataType for f in table.schema if f.name == key)
    limit = _LIMITS["int" if isinstance(kind, T.IntegerType) else "bigint"]

    seq = [seq] if isinstance(seq, str) else list(seq)
    placed = cut(rows.select(*seq).sort(*seq).withColumn("_at", F.monotonically_increasing_id())).select(
        *seq,
        F.shiftrightunsigned("_at", _PARTITION_BITS).alias("_part"),
        F.col("_at").bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1)).alias("_row"),
    )
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    top = F.greatest(table.agg(F.max(F.col(key).cast("bigint"))).scalar(), F.lit(above).cast("bigint"))
    offsets = counts.select("_part", (top + F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_before"))

    fresh = F.col("_before") + F.col("_row") + 1
    checked = F.when(fresh > limit, F.raise_error(F.lit(f"{out} exceeds {limit}"))).otherwise(fresh)
    ids = placed.join(F.broadcast(offsets), "_part").select(*seq, checked.cast(kind).alias(out))
    return rows.join(ids, seq)
