"""The pipeline's stages against brute-force versions, one by one and all together."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rowgate.llm import chunks, quality, tiling

from . import helpers

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"file://{tmp_path_factory.mktemp('stages')}/{k}"
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_columns(stages):
    assert all(s.columns == list(corpus_pipeline.COLUMNS) for s in stages[:-1])


def test_quality_stage(spark, stages):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    scores = {r.doc_id: r.score for r in quality.assess(docs, labels).collect()}
    assert {r.doc_id for r in stages[0].collect()} == {i for i, s in scores.items() if s >= 0.5}


def test_near_duplicate_stage(stages):
    rows = sorted(stages[0].collect(), key=lambda r: r.doc_id)
    bits = np.array([helpers.fingerprint(r.text) for r in rows], np.uint64)
    label = helpers.components(len(rows), lambda a, b: np.bitwise_count(bits[a:b, None] ^ bits[None, :]) <= 3)
    assert {tuple(r) for r in stages[1].collect()} == {tuple(rows[i]) for i in set(label.tolist())}


def test_substring_stage(stages):
    before = {r.doc_id: r for r in stages[1].collect()}
    after = {r.doc_id: r for r in stages[2].collect()}
    assert before.keys() == after.keys()
    seen, spans = {}, {}
    for i in sorted(before):
        data = np.frombuffer(before[i].text.encode(), np.uint8)
        cuts = chunks.cuts(data, np.array([0, len(data)]), 5, 16, 1024).tolist()
        runs = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            first = seen.setdefault(data[a:b].tobytes(), (i, a))
            if first != (i, a):
                runs = [*runs[:-1], (runs[-1][0], b)] if runs and runs[-1][1] == a else [*runs, (a, b)]
        spans[i] = [r for r in runs if r[1] - r[0] >= 64]
    for i, r in after.items():
        data = bytearray(before[i].text.encode())
        for a, b in reversed(spans[i]):
            del data[a:b]
        assert r.text == data.decode() and r.n_chars == len(r.text)


def test_benchmark_stage(spark, stages):
    found = tiling.contaminated(stages[2], spark.read.parquet(f"{SMALL}/benchmark.parquet"))
    bad = {r.doc_id for r in found.collect()}
    assert {tuple(r) for r in stages[3].collect()} == {tuple(r) for r in stages[2].collect() if r.doc_id not in bad}


def test_pieces_stage_and_run(spark, stages):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    expected = sorted((r.doc_id, r.text, library.encode(r.text)) for r in stages[3].collect())
    assert sorted((r.doc_id, r.text, r.ids) for r in stages[4].collect()) == expected
    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted((r.doc_id, r.text, r.ids) for r in whole.collect()) == expected


def test_stages_take_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (None, "", "en", "a", 0), (None, "word " * 50, None, "b", 250), (1, "word " * 50, None, "b", 250)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() <= 4
        assert stage(spark, docs.where(F.lit(False)), SMALL).count() == 0
