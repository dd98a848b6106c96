"""Compare fixture queries with their SQL oracle, as bags of rows."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events pages".split()
TYPES = {
    "tinyint": "int",
    "smallint": "int",
    "integer": "int",
    "varchar": "string",
    "timestamp": "timestamp_ntz",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def compare(spark_df, con, sql: str) -> tuple[int, int, list[str]]:
    """Rows on each side and a list of differences, empty when both results are the same bag."""
    cols = sorted(spark_df.columns)
    want = con.sql(sql)
    faults = []
    if cols != sorted(want.columns):
        return 0, 0, [f"columns {cols} against {sorted(want.columns)}"]
    kinds = {c: str(t).lower().replace(" ", "") for c, t in zip(want.columns, want.types)}
    for name, kind in spark_df.dtypes:
        other = TYPES.get(kinds[name], kinds[name])
        if kind != other:
            faults.append(f"type of {name}: {kind} against {other}")
    got_rows = Counter(tuple(r) for r in spark_df.select(*cols).collect())
    listed = ", ".join(f'"{c}"' for c in cols)
    want_rows = Counter(con.sql(f"select {listed} from ({sql})").fetchall())
    if got_rows != want_rows:
        faults.append(f"only spark {list((got_rows - want_rows).items())[:3]}")
        faults.append(f"only oracle {list((want_rows - got_rows).items())[:3]}")
    return sum(got_rows.values()), sum(want_rows.values()), faults
