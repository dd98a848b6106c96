"""Streams: replayed batches, and order across batches."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.operators import Parent, apply_inserts
from rowgate.plans import routes
from rowgate.plans.booking import CONTRACTS
from rowgate.storage import fresh_dir
from rowgate.streaming import InsertRules, apply_batch, drain, stream_apply, stream_compact, stream_fk_check

ROWS = T.StructType([T.StructField("k", T.IntegerType())])
RULES = InsertRules(
    seq="seq",
    outcome=lambda batch, table: apply_inserts(batch, "seq", unique=["k"], table=table),
    rows=lambda accepted, table: accepted.select("k"),
    schema=ROWS,
)


def outcomes(spark, root):
    log = spark.read.parquet(f"{root}/outcomes").select("seq", "status").collect()
    assert len({r.seq for r in log}) == len(log)
    return {r.seq: r.status for r in log}


def test_replayed_batch_gives_the_same_state(spark):
    root = fresh_dir(spark, "test-replay")
    base = spark.createDataFrame([(1,)], ROWS)
    handle = apply_batch(base, root, RULES)
    first = spark.createDataFrame([(1, 1), (2, 2), (3, 2)], "seq long, k int")
    second = spark.createDataFrame([(4, 2), (5, 3), (6, None), (7, 3)], "seq long, k int")
    handle(first, 0)
    handle(second, 1)
    once = outcomes(spark, root)
    assert once == {1: 409, 2: 201, 3: 409, 4: 409, 5: 201, 6: 201, 7: 409}
    handle(second, 1)
    handle(first, 0)
    handle(second, 1)
    assert outcomes(spark, root) == once
    stored = [r.k for r in spark.read.parquet(f"{root}/rows").collect()]
    assert sorted(stored, key=repr) == [2, 3, None]


def test_compaction_keeps_each_row_once(spark):
    root = fresh_dir(spark, "test-compact")
    base = spark.createDataFrame([(1,)], ROWS)
    handle = apply_batch(lambda: base, root, RULES)
    lots = [[(1, 1), (2, 2)], [(3, 2), (4, 3)], [(5, 3), (6, 4)], [(7, 1), (8, 5)]]
    for number, lot in enumerate(lots):
        handle(spark.createDataFrame(lot, "seq long, k int"), number)
        if number == 1:
            path = stream_compact(spark, base, root, ROWS, number)
            assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    once = outcomes(spark, root)
    assert once == {1: 409, 2: 201, 3: 409, 4: 201, 5: 409, 6: 201, 7: 409, 8: 201}
    handle(spark.createDataFrame(lots[1], "seq long, k int"), 1)
    assert outcomes(spark, root) == once
    last = stream_compact(spark, base, root, ROWS, 3)
    assert sorted(r.k for r in spark.read.parquet(last).collect()) == [1, 2, 3, 4, 5]


def test_a_base_that_is_replaced_is_read_anew(spark):
    root = fresh_dir(spark, "test-anew")
    tables = [spark.createDataFrame([(1,)], ROWS), spark.createDataFrame([(1,), (9,)], ROWS)]
    handle = apply_batch(lambda: tables[0], root, RULES)
    handle(spark.createDataFrame([(1, 1)], "seq long, k int"), 0)
    tables.pop(0)
    handle(spark.createDataFrame([(2, 9)], "seq long, k int"), 1)
    assert outcomes(spark, root) == {1: 409, 2: 409}


def test_batches_see_what_earlier_batches_added(spark):
    root = fresh_dir(spark, "test-stream")
    base = spark.createDataFrame([(100,)], ROWS)
    for lot in ([(1, 5), (2, 100)], [(3, 5), (4, 6)], [(5, 6), (6, 7)]):
        spark.createDataFrame(lot, "seq long, k int").write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema("seq long, k int").parquet(f"{root}/in")
        drain(stream_apply(stream, base, root, RULES))
    assert outcomes(spark, root) == {1: 201, 2: 409, 3: 409, 4: 201, 5: 409, 6: 201}


def test_stream_reference_check_with_salted_parent(spark):
    root = fresh_dir(spark, "test-fk")
    rows = spark.range(1000).select(F.col("id").alias("seq"), F.when(F.col("id") > 300, 1).otherwise(F.col("id") - 298).cast("int").alias("ref"))
    rows.write.parquet(f"{root}/in")
    parents = spark.createDataFrame([(1,), (2,)], "id int")
    stream = spark.readStream.schema("seq long, ref int").parquet(f"{root}/in")
    checked = stream_fk_check(stream, [Parent("ref", parents, "id", "parent", salts=8)], "seq")
    drain(checked.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/progress"))
    got = spark.read.parquet(f"{root}/out").groupBy("fk").count().collect()
    assert {r.fk: r["count"] for r in got} == {"ok": 701, "parent": 299}


def test_stream_of_create_requests(spark):
    root = fresh_dir(spark, "test-create")
    rows = {"restaurants": [(1, "uno", 1, 1)], "tables": [(4, 1, 1, 1)]}
    tables = {n: spark.createDataFrame(r, CONTRACTS[n].schema) for n, r in rows.items()}
    claims = json.dumps({"sub": "k", "realm_access": {"roles": ["admin"]}})
    request = "seq bigint, caller_sub string, claims string, target_id int, body string"
    for lot in ([(1, 1), (2, 2)], [(3, 2), (4, 3), (5, 3)]):
        data = [(s, "k", claims, None, json.dumps({"table_number": n, "table_status": 1, "restaurant_id": 1})) for s, n in lot]
        spark.createDataFrame(data, request).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(request).parquet(f"{root}/in")
        drain(stream_apply(stream, tables["tables"], root, routes.create_rules("tables", tables)))
    assert outcomes(spark, root) == {1: 409, 2: 201, 3: 409, 4: 201, 5: 409}
    added = spark.read.parquet(f"{root}/rows").collect()
    assert sorted((r.table_id, r.table_number) for r in added) == [(5, 2), (6, 3)]
