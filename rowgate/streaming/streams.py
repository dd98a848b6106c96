"""Structured Streaming forms of the reference check and of inserts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from rowgate.functions.gates import CREATED
from rowgate.operators.links import Parent, fk_check
from rowgate.storage import scope


def stream_fk_check(stream: DataFrame, parents: Sequence[Parent], seq: str, *, out: str = "fk") -> DataFrame:
    """The reference check on an unbounded stream: stream-static left joins, append mode, no state.

    Streaming plans have no adaptive skew handling; give hot references ``salts`` in their ``Parent``.
    """
    return fk_check(stream, parents, seq, out=out)


@dataclass(frozen=True)
class InsertRules:
    """How a micro-batch is judged and stored.

    ``outcome`` gets (batch, current table) and returns (seq, status, ...); ``rows`` gets (accepted requests, current
    table) and returns the new table rows; ``schema`` is the schema of those rows.
    """

    seq: str
    outcome: Callable[[DataFrame, DataFrame], DataFrame]
    rows: Callable[[DataFrame, DataFrame], DataFrame]
    schema: T.StructType
    accepted: int = CREATED


#: A table, or a function that reads it as it stands now.
Table = DataFrame | Callable[[], DataFrame]


def _compacted(spark: SparkSession, root: str, batch_id: int) -> int:
    """The last batch below ``batch_id`` up to which a written base holds all rows, or -1."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/base")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return -1
    done = [-1]
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/base/{name}/_SUCCESS")):
            done.append(int(name.removeprefix("upto=")))
    return max(n for n in done if n < batch_id)


def _current(spark: SparkSession, base: Table, root: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """The table before a batch: the newest base below it plus what later batches, before this one, added."""
    last = _compacted(spark, root, batch_id)
    if last >= 0:
        table = spark.read.schema(schema).parquet(f"{root}/base/upto={last}")
    else:
        table = base() if callable(base) else base
    if batch_id == last + 1:
        return table
    stored = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    added = spark.read.schema(stored).parquet(f"{root}/rows")
    return table.unionByName(added.where((F.col("batch") > last) & (F.col("batch") < batch_id)).drop("batch"))


def stream_compact(spark: SparkSession, base: Table, root: str, schema: T.StructType, batch_id: int) -> str:
    """Write the table as it stands after ``batch_id`` as a new base, which later batches start from.

    Batches up to that one can still be replayed, as they go on from the bases before. Run it between batches, every
    so many of them: a batch then reads one base and at most so many small folders, however long the stream runs.
    """
    path = f"{root}/base/upto={batch_id}"
    _current(spark, base, root, schema, batch_id + 1).write.mode("overwrite").parquet(path)
    return path


def apply_batch(base: Table, root: str, rules: InsertRules) -> Callable[[DataFrame, int], None]:
    """The handler of one micro-batch, to be called with the batch and its number.

    ``base`` may be a function: it is then called for each batch, so that a table which others replace is read anew.
    Outcomes go to ``root/outcomes/batch=N`` and accepted rows to ``root/rows/batch=N``. Both are overwritten as a
    whole and a batch reads only lower numbers, so a batch that is replayed after a failure gives the same state.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scope(spark):  # what the rules write on their way goes when the batch is stored
            table = _current(spark, base, root, rules.schema, batch_id)
            decided = f"{root}/outcomes/batch={batch_id}"
            rules.outcome(batch, table).write.mode("overwrite").parquet(decided)
            accepted = spark.read.parquet(decided).where(F.col("status") == rules.accepted).select(rules.seq)
            rows = rules.rows(batch.join(accepted, rules.seq, "left_semi"), table)
            rows.write.mode("overwrite").parquet(f"{root}/rows/batch={batch_id}")

    return handle


def stream_apply(stream: DataFrame, base: Table, root: str, rules: InsertRules) -> DataStreamWriter:
    """Apply each micro-batch of inserts to the table as the batches before it left it; see ``apply_batch``."""
    handle = apply_batch(base, root, rules)
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{root}/progress")


def drain(writer: DataStreamWriter) -> None:
    """Process everything that has arrived, then stop."""
    writer.trigger(availableNow=True).start().awaitTermination()
