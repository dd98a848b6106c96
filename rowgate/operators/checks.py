"""Contract checks on whole tables: validate, convert, fill. All are narrow maps without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rowgate.contracts import Field
from rowgate.functions.convert import convert
from rowgate.functions.gates import CREATED, INVALID
from rowgate.functions.rules import field_rules, label_broken, valid_email

_FLOATING = {"double", "float"}


def row_rules(df: DataFrame, fields: Sequence[Field], names: dict[str, str] | None = None):
    """(label, condition) of every rule of ``fields``. ``names`` maps a column to the name shown in labels."""
    kinds = dict(df.dtypes)
    shown = names or {}
    for f in fields:
        for rule, broken in field_rules(f, F.col(f.name), floating=kinds[f.name] in _FLOATING).items():
            yield f"{shown.get(f.name, f.name)}:{rule}", broken


def validate_rows(
    df: DataFrame, fields: Sequence[Field], *, out: str = "errors", names: dict[str, str] | None = None
) -> DataFrame:
    """Add the labels of all broken rules of each row; clean rows get an empty array."""
    return df.withColumn(out, label_broken(row_rules(df, fields, names)))


def coerce_types(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Convert raw columns to contract types. What does not convert becomes null for the rules to report."""
    return df.withColumns({f.name: convert(F.col(f.name), f.type) for f in fields})


def check_email(df: DataFrame, column: str, *, ok: int = CREATED, invalid: int = INVALID) -> DataFrame:
    """Add the status of the email format rule."""
    return df.withColumn("status", F.when(valid_email(F.col(column)), F.lit(ok)).otherwise(F.lit(invalid)))


def fill_defaults(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Give absent values their column default.

    Where a ``has_<field>`` flag exists only unsent fields are filled, so an explicit null stays null.
    """
    filled = {}
    for f in fields:
        if f.default is None:
            continue
        default = F.lit(f.default).cast(f.type)
        flag = f"has_{f.name}"
        if flag in df.columns:
            filled[f.name] = F.when(F.col(flag), F.col(f.name)).otherwise(default)
        else:
            filled[f.name] = F.coalesce(F.col(f.name), default)
    return df.withColumns(filled)
