"""Typed scans and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowgate.contracts import Contract
from rowgate.functions.gates import CREATED


def scan_typed(spark: SparkSession, path: str, contract: Contract, fmt: str = "parquet") -> DataFrame:
    """Read a whole table against its fixed schema; only contract columns reach the scan."""
    return spark.read.schema(contract.schema).format(fmt).load(path).select(*contract.columns)


def project_response(df: DataFrame, contract: Contract) -> DataFrame:
    """Keep only the columns a response shows."""
    return df.select(*contract.response_columns)


def append_accepted(
    outcomes: DataFrame, path: str, *, accepted: int | Column = CREATED, batch: int | None = None
) -> None:
    """Write the accepted rows. With ``batch`` the rows replace that batch's folder, so a retry writes them once."""
    keep = accepted if isinstance(accepted, Column) else F.col("status") == accepted
    rows = outcomes.where(keep)
    if batch is None:
        rows.write.mode("append").parquet(path)
    else:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def publish_version(df: DataFrame, root: str, version: int) -> None:
    """Write a whole new table version, then make it the current one by a single small append.

    Readers see either the old version or the complete new one: a version counts only once it is listed.
    """
    df.write.mode("overwrite").parquet(f"{root}/data/v={version}")
    listed = df.sparkSession.range(version, version + 1).select(F.col("id").alias("version"))
    listed.coalesce(1).write.mode("append").parquet(f"{root}/published")


def read_version(spark: SparkSession, root: str, contract: Contract, version: int | None = None) -> DataFrame:
    """Read a published version, by default the latest."""
    if version is None:
        listed = spark.read.schema("version bigint").parquet(f"{root}/published")
        version = listed.agg(F.max("version")).first()[0]
    return scan_typed(spark, f"{root}/data/v={version}", contract)
