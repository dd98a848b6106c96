"""Outcome gates: the first failing gate decides a request's outcome."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# The outcome codes of the request rules.
OK = 200
CREATED = 201
DELETED = 204
EMPTY = 400
NO_LOGIN = 401
FORBIDDEN = 403
NOT_FOUND = 404
CONFLICT = 409
INVALID = 422
SERVER_ERROR = 500


@dataclass(frozen=True)
class Gate:
    """``fails`` is true for rows that must stop here with ``status``."""

    fails: Column
    status: int
    reason: str | Column


def first_failure(gates: Sequence[Gate], status: str = "status", reason: str = "reason") -> list[Column]:
    """Status and reason of the first failing gate, null for rows that pass them all."""
    if not gates:
        return [F.lit(None).cast("int").alias(status), F.lit(None).cast("string").alias(reason)]
    hits = [(F.coalesce(g.fails, F.lit(False)), g) for g in gates]
    return [
        F.coalesce(*[F.when(hit, F.lit(g.status)) for hit, g in hits]).alias(status),
        F.coalesce(*[F.when(hit, F.lit(g.reason)) for hit, g in hits]).alias(reason),
    ]


def then(rows: DataFrame, keep: Sequence[str | Column], gates: Sequence[Gate]) -> DataFrame:
    """Apply further gates to rows whose ``status`` is still null."""
    late_status, late_reason = first_failure(gates, "_s", "_r")
    decided = F.col("status").isNotNull()
    return rows.select(
        *keep,
        F.when(decided, F.col("status")).otherwise(late_status).alias("status"),
        F.when(decided, F.col("reason")).otherwise(late_reason).alias("reason"),
    )


def finish(rows: DataFrame, keep: Sequence[str | Column], status: int, reason: str) -> DataFrame:
    """Rows that no gate stopped get the final status."""
    return rows.select(
        *keep, F.coalesce("status", F.lit(status)).alias("status"), F.coalesce("reason", F.lit(reason)).alias("reason")
    )


def all_present(columns: Sequence[str]) -> Column:
    """True where none of the columns is null."""
    result = F.col(columns[0]).isNotNull()
    for name in columns[1:]:
        result = result & F.col(name).isNotNull()
    return result
