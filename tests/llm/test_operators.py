"""Operators on Spark: against brute force, and on nulls, empty and long texts, repeated rows and clashing columns."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rowgate.llm import chunks, exact, pages, pieces, pq, quality, queries, simhash, tiling, token_files, toxicity
from rowgate.llm.graph import components

from . import helpers

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def base(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def odd(spark, base):
    """Nulls, empty, repeated and long texts, repeated and missing ids, and columns named like helpers."""
    rows = base + [
        (5001, None),
        (5002, ""),
        (None, base[3][1]),
        (None, None),
        (7, base[7][1]),
        (8, "different " * 60),
        (5003, "a" * 1000),
        (5004, "ab" * 400),
        (5005, base[10][1] * 3),
        (5006, base[11][1][:230]),
        (5007, "x" + base[11][1][:199]),
        (5008, "Wort für Wort " * 20000),
        (5009, " \t\n"),
        (-1, "one two"),
    ]
    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in ("bits", "version", "place", "spans", "part", "u", "node")})


def test_components(spark):
    random.seed(1)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, i) for i in range(6000, 6200)]
    found = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    label = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in range(len(label)):
        before = dict(label)
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
        if before == label:
            break
    assert found == label
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_simhash(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = simhash.near_duplicates(odd).collect()
    bits = np.array([helpers.fingerprint(t) for _, t in rows], np.uint64)
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(i), f"{int(b):016x}") for (i, _), b in zip(rows, bits, strict=True))
    label = helpers.components(len(rows), lambda a, b: np.bitwise_count(bits[a:b, None] ^ bits[None, :]) <= 3)
    least = {}
    for (i, _), c in zip(rows, label, strict=True):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    expected = sorted((str(i), str(least.get(c))) for (i, _), c in zip(rows, label, strict=True))
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == expected
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    kept = simhash.representatives(odd)
    assert kept.columns == odd.columns and kept.count() == len(set(label))


def test_one_group_of_near_copies(spark):
    random.seed(4)
    words = [f"w{i}" for i in range(600)]
    rows = []
    for i in range(300):
        other = list(words)
        other[random.randrange(600)] = f"new{i}"
        rows.append((i, " ".join(other)))
    got = simhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    bits = np.array([int(r.fingerprint, 16) for r in got], np.uint64)
    ids = np.array([r.doc_id for r in got])
    label = helpers.components(len(bits), lambda a, b: np.bitwise_count(bits[a:b, None] ^ bits[None, :]) <= 3)
    assert [r.component_id for r in got] == [ids[label == c].min() for c in label]


def test_fingerprints_go_to_four_shards_however_many_there_are(spark, monkeypatch):
    rng = np.random.default_rng(9)
    points = rng.integers(0, 1 << 63, 1500, dtype=np.uint64)
    near = [p ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for k in (1, 3, 4) for p in points[:200]]
    points = np.unique(np.append(points, np.array(near, np.uint64)))
    prints = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "bits long")
    dealt, deal = [], type(prints).mapInArrow
    monkeypatch.setattr(type(prints), "mapInArrow", lambda *given: dealt.append(deal(*given)) or dealt[-1])
    place = {int(p): i for i, p in enumerate(points.view(np.int64))}
    edges = [(place[r.u], place[r.v]) for r in simhash.links(prints, per_shard=8).collect()]
    assert dealt[0].count() == 4 * len(points) and dealt[0].select("shard").distinct().count() > 400
    label = list(range(len(points)))
    while any(label[u] != label[v] for u, v in edges):
        for u, v in edges:
            label[u] = label[v] = min(label[u], label[v])
    assert label == helpers.components(len(points), lambda a, b: np.bitwise_count(points[a:b, None] ^ points[None, :]) <= 3).tolist()


@pytest.mark.parametrize("limits", [{}, {"group_rows": 2, "shard_rows": 20}])
def test_exact_removal(spark, odd, limits, monkeypatch):
    whole = exact.spans
    monkeypatch.setattr(exact, "spans", lambda docs, length: whole(docs, length, **limits))
    some = odd.where("doc_id is null or doc_id <> 5008")
    got = exact.removals(some).collect()
    expected = helpers.removals([(r.doc_id, r.text) for r in some.collect()], 200)
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, expected))
    assert exact.removals(odd.limit(0)).count() == 0


def test_chunks(spark, odd, base):
    out = chunks.deduplicate(odd).collect()
    given = {(r.doc_id, r.text) for r in odd.collect()}
    assert len(out) == odd.count() and {r.doc_id for r in out} == {i for i, _ in given}
    for r in out:
        sources = [t or "" for i, t in given if i == r.doc_id and len((t or "").encode()) == r.n_bytes]
        data = [s.encode() for s in sources]
        kept = [bytes(np.delete(np.frombuffer(d, np.uint8), np.concatenate([np.arange(0), *(np.arange(a, b) for a, b in r.spans)]).astype(int))) for d in data]
        assert (r.text or "").encode() in kept
    random.seed(3)
    words = [w for _, t in base for w in (t or "").split()]
    pick = lambda n: " ".join(random.sample(words, n))
    passages = [pick(55) for _ in range(40)]
    rows = [(2 * k + j, f"{pick(60)} {p} {pick(60)}") for k, p in enumerate(passages) for j in range(2)]
    rows += [(1000 + k, pick(200)) for k in range(60)]
    removed = {r.doc_id: r.n_removed for r in chunks.deduplicate(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(removed[2 * k + 1] > 0.4 * len(p.encode()) for k, p in enumerate(passages))
    assert not any(n for i, n in removed.items() if i >= 1000 or i % 2 == 0)
    assert chunks.deduplicate(odd.limit(0)).count() == 0


def test_token_files(spark, odd, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        definition = file.read()
    more = spark.createDataFrame([(1, "a\n b \n\n c  d <|endoftext|> it's"), (2, " x "), (3, "　你好 世界")], DOCS)
    docs = odd.select("doc_id", "text").unionByName(more).repartition(5)
    path = f"file://{tmp_path}/tokens"
    token_files.write(docs.withColumn("part", F.lit("x")), path, definition)
    got = token_files.digests(spark, path).orderBy("start").collect()
    expected, at = {}, 0
    for r in docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        expected.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in got:
        assert r.start == at
        at += r.n_tokens
        expected[r.doc_id].remove((r.n_tokens, r.ids_crc32))
    assert not any(expected.values())
    ids = [r.doc_id for r in got if r.doc_id is not None]
    assert ids == sorted(ids) and [r.doc_id for r in got][: len(got) - len(ids)] == [None] * (len(got) - len(ids))
    assert sorted(r.doc_id for r in token_files.find(spark, path, [7, 8]).collect()) == sorted(i for i in ids if i in (7, 8))
    plan = token_files.find(spark, path, [7])._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in plan or "In(doc_id" in plan
    token_files.write(docs.limit(0), f"{path}-none", definition)
    assert token_files.digests(spark, f"{path}-none").count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(60, 16))
    near = [c + rng.normal(size=16) * 0.06 for c in centre for _ in range(6)]
    vectors = [*near, *rng.normal(size=(300, 16)), *near[:20], *(3 * v for v in near[:5])]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    good = len(rows)
    rows += [(9001, None), (9002, [0.0] * 16), (9003, [float("nan")] * 16), (9004, [1.0, None]), (9005, []), (9006, [1.0, 0.0]), (9007, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"blob": F.lit(1), "node": F.lit(2)})
    x = np.array([r[1] for r in rows[:good]], "f4").astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= 0.95
    np.fill_diagonal(close, False)
    label = helpers.components(good, lambda a, b: close[a:b] | (np.arange(a, b)[:, None] == np.arange(good)[None, :]))
    expected = {i: (int(close[i].sum()), int(label[i]), bool(label[i] == i)) for i in range(good)}
    expected |= {i: (0, i, True) for i in range(9001, 9006)} | {9006: (1, 9006, True), 9007: (1, 9006, False)}
    for options in ({}, {"per_list": 40, "chunk": 15}, {"per_list": 60, "margin": 1.0}):
        got = {r[0]: tuple(r[1:]) for r in pq.near_duplicates(df, **options).collect()}
        assert got == expected
    assert pq.near_duplicates(df.limit(0)).count() == 0


def test_embedding_recall(spark):
    """The default number of probes, on a whole table, against brute force."""
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = table.select("vec_id", "embedding").collect()
    x = np.array([r.embedding for r in rows], "f4").astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    right = (x @ x.T >= 0.95).sum(1) - 1
    got = {r.vec_id: r.n_links for r in pq.near_duplicates(table, per_list=20).collect()}
    assert sum(got[r.vec_id] for r in rows) >= 0.99 * right.sum()
    assert all(got[r.vec_id] <= n for r, n in zip(rows, right, strict=True))


def test_tiling(spark, odd):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    item = benchmark.orderBy("item_id").first()
    words = item.text.split()
    n = len(words) // 2
    mixed = " ".join(["some words"] + words[n:] + ["and more"] + words[:n]).upper()
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(7001, mixed), (7002, " ".join(words[:n])), (7001, mixed)], DOCS))
    found = tiling.contaminated(docs, benchmark).collect()
    assert [r.item_id for r in found if r.doc_id == 7001] == [item.item_id] * 2 and not [r for r in found if r.doc_id == 7002]
    more = benchmark.unionByName(spark.createDataFrame([(None, None), (-5, ""), (-6, "two words")], "item_id long, text string"))
    assert sorted(map(str, tiling.contaminated(docs, more).collect())) == sorted(map(str, found))
    clean = tiling.clean(odd.unionByName(odd.limit(0)), benchmark)
    bad = {r.doc_id for r in found}
    assert clean.columns == odd.columns and not bad & {r.doc_id for r in clean.collect()}
    assert clean.count() == odd.where(~F.coalesce(F.col("doc_id"), F.lit(-9)).isin(*bad)).count()
    assert tiling.contaminated(docs, benchmark.limit(0)).count() == 0
    assert tiling.clean(docs.limit(0), benchmark).count() == 0


def test_tiling_in_blocks(spark, odd, monkeypatch):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    whole = sorted(map(str, tiling.contaminated(odd, benchmark).collect()))
    long = spark.createDataFrame([(k, f"filler{k} " * 30000) for k in range(12)], "item_id long, text string")
    parts = tiling.contaminated(odd, benchmark.unionByName(long), block_mb=1)
    assert sorted(str(r) for r in parts.collect() if r.coverage and str(r) in whole) == whole


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_classifiers_on_odd_rows(spark, operator):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x loser"), (3, "zz  top"), (3, "zz  top"), (4, "...")], DOCS)
    docs = docs.withColumns({"score": F.lit("x"), "toxic": F.lit(7), "_doc": F.lit(1)})
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (None, 1, 1), (3, None, None), (3, 1, 0)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0), labels.where("quality = 1")):
        rows = operator.assess(docs, given).collect()
        assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert operator.assess(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("query, label, fold, least", [(queries.op7_nbsvm, "quality", (3, 1), 0.96), (queries.op5_kneser_ney, "toxic", (5, 0), 0.9)])
def test_held_out_accuracy(spark, query, label, fold, least):
    where = "/root/testdata/sf0.1"
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{where}/labels.parquet").collect()}
    rows = query(spark, where).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % fold[0] == fold[1]) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > least


def test_pages(spark):
    table = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html")
    more = spark.createDataFrame([(None, None, None), (1, "u", ""), (1, "u", "<article><p>" + "word " * 100000)], table.schema)
    docs = table.unionByName(more).withColumn("text", F.lit(1))
    got = pages.extract(docs).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got) == sorted((str(r.page_id), pages.main_text(r.html), len(pages.main_text(r.html))) for r in docs.collect())
    assert pages.extract(docs.limit(0)).count() == 0


def test_pieces(spark, odd):
    import sentencepiece

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model = file.read()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    docs = odd.withColumns({"ids": F.lit("x"), "n_pieces": F.lit("y")})
    got = pieces.tokenise(docs, model).collect()
    expected = sorted((str(r.doc_id), r.text or "", library.encode(r.text or "")) for r in docs.collect())
    assert sorted((str(r.doc_id), r.text, r.ids) for r in got) == expected
    assert all(r.same_text for r in pieces.digests(docs, model).collect())
    assert pieces.digests(docs.limit(0), model).count() == pieces.tokenise(docs.limit(0), model).count() == 0
