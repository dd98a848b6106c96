"""Where jobs may put intermediate data.

A cluster names a shared folder in ``spark.checkpoint.dir``. It is read from the session; only where it is unset in
local mode, where driver and executors are one process, a temporary folder is made and used instead.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_open_scope: ContextVar[list[str] | None] = ContextVar("rowgate_scope", default=None)


def checked_dir(master: str, root: str | None) -> str | None:
    """``root`` if jobs of this master can share it, null where local mode may make one of its own, else an error."""
    if root:
        if root.startswith("file:") and not master.startswith("local"):
            raise ValueError(f"{_CONF} is {root}, which executors on other machines cannot see")
        return root
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"set {_CONF} to a folder that the driver and all executors share")
    return None


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session."""
    root = checked_dir(spark.sparkContext.master, spark.conf.get(_CONF, None))
    if not root:
        root = tempfile.mkdtemp(prefix="rowgate-")
        spark.conf.set(_CONF, root)
    return root


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier job has used."""
    return f"{shared_dir(spark).rstrip('/')}/rowgate/{name}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that its path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Remove what ``cut`` writes inside when the block ends. Results must be stored before, as they may read it."""
    paths: list[str] = []
    token = _open_scope.set(paths)
    try:
        yield
    finally:
        _open_scope.reset(token)
        for path in paths:
            remove_dir(spark, path)


def keep(path: str) -> None:
    """Have the open scope, if there is one, remove this folder too."""
    paths = _open_scope.get()
    if paths is not None:
        paths.append(path)


def cut(df: DataFrame) -> DataFrame:
    """Run ``df`` once, write its rows to the shared folder and read them back.

    Meant for narrow intermediate rows that several results read. The written table survives lost executors and gives
    Spark true sizes. It also drops the partitioning of the joins before it: otherwise an aggregation over a wider key
    would reuse the join's partitions, with a hot join key and all its rows in one task.
    """
    path = fresh_dir(df.sparkSession, "cut")
    df.write.parquet(path)
    keep(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
