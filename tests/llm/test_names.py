"""Operators that keep all columns keep those whose names look like their own helpers'."""

from pyspark.sql import functions as F

from rowgate.llm import chunks, simhash

HELPERS = ["_key", "_doc", "_pieces", "_version", "_kept", "key", "cut_id", "cut_version", "pieces", "version", "kept_id", "kept_version", "VERSION_", "bits", "label"]
TEXT = "A passage that is long enough to be cut into several pieces, and that comes again word for word in another document. "


def test_extra_columns_stay(spark):
    rows = [(1, TEXT + "One."), (2, TEXT + "Two and something else."), (3, "short"), (3, "short"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in HELPERS})
    for out, more in ((chunks.deduplicate(docs), ["n_bytes", "n_removed", "spans"]), (simhash.representatives(docs), [])):
        assert out.columns == docs.columns + more
        for row in out.collect():
            for name in HELPERS:
                assert row[name] == (None if row.doc_id is None else f"{name}{row.doc_id}")
    assert sorted(str(r.doc_id) for r in simhash.representatives(docs).collect()) == ["1", "2", "3", "None"]
    assert [r.n_removed > 60 for r in chunks.deduplicate(docs).orderBy("doc_id", "text").collect()] == [False, False, True, False, False]
