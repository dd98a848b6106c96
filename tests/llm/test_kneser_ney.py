"""Scores of the toxicity models against plain dictionaries of counts."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from rowgate.llm import toxicity

ORDER, DISCOUNT = 6, 0.75


def word_ratios(rows, labels):
    counts = {k: collections.Counter() for k in (0, 1, None)}
    for i, words in rows:
        for w in set(words):
            line = "\0" * (ORDER - 1) + w + " "
            for at in range(len(w) + 1):
                counts[None][line[at : at + ORDER]] += 1
                if i in labels:
                    counts[labels[i]][line[at : at + ORDER]] += 1

    def levels(table):
        seen, mass = collections.Counter(), collections.Counter()
        for g, n in table.items():
            seen[g[:-1]] += n
            mass[g[:-1]] += min(n, DISCOUNT)
        return table, seen, mass

    def chance(level, g, back):
        table, seen, mass = level
        return (max(table[g] - DISCOUNT, 0) + mass[g[:-1]] * back) / seen[g[:-1]] if seen[g[:-1]] else back

    shared, longer = {}, set(counts[None])
    for order in range(ORDER - 1, 0, -1):
        table = collections.Counter(g[-order:] for g in longer)
        shared[order], longer = levels(table), set(table)
    own = {k: levels(counts[k]) for k in (0, 1)}

    def ratio(w):
        line, total = "\0" * (ORDER - 1) + w + " ", 0.0
        for at in range(len(w) + 1):
            g, back = line[at : at + ORDER], 1 / 256
            for order in range(1, ORDER):
                back = chance(shared[order], g[-order:], back)
            total += math.log(chance(own[1], g, back)) - math.log(chance(own[0], g, back))
        return total / (len(w) + 1)

    return {w: ratio(w) for w in {w for _, words in rows for w in words}}


@pytest.mark.parametrize("per_block", [1 << 20, 3000])
def test_every_gram_has_counts_of_its_own(spark, per_block):
    random.seed(8)
    pick = lambda: "".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(random.randint(4, 10)))
    rows = [(i, [pick() for _ in range(30)] + random.choices(["fool", "idiot", "and", "the"], k=2)) for i in range(300)]
    labels = {i: int("fool" in words or "idiot" in words) for i, words in rows if i % 2}
    docs = spark.createDataFrame([(i, " ".join(words)) for i, words in rows], "doc_id long, text string")
    given = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.assess(docs, given, per_block=per_block).collect()}
    held = {r.doc_id for r in toxicity.assess(docs, given).where("held_out").collect()}
    by_word = word_ratios(rows, {i: y for i, y in labels.items() if i not in held})
    right = np.array([np.mean(sorted((by_word[w] for w in set(words)), reverse=True)[:3]) for _, words in rows])
    score = np.array([got[i] for i, _ in rows])
    logit = np.log(score / (1 - score))
    slope, offset = np.polyfit(right, logit, 1)
    assert slope > 0 and np.abs(slope * right + offset - logit).max() < 1e-6 * np.ptp(logit)


def test_each_block_of_words_asks_once_for_an_ngram(spark):
    random.seed(9)
    given = sorted({"".join(random.choices(["la", "tion", "ment", "é", "er", "s"], k=random.randint(1, 7))) for _ in range(3000)})
    words = spark.createDataFrame([(w, 1, 1) for w in given], "word string, ordinary long, toxic long")
    counts = toxicity._count(words).select("gram", (F.col("ordinary") / 7).alias("ratio"))
    table = {r.gram: r.ratio for r in counts.collect()}
    data = [w.encode() for w in given]
    off = np.cumsum([0, *map(len, data)])
    flat = np.frombuffer(b"".join(data), np.uint8)
    gram, owner = toxicity.grams(flat, off[:-1], off[1:])
    want = collections.defaultdict(list)
    for g, w in zip(gram.tolist(), owner.tolist()):
        want[w].append(table[g])
    hashes = toxicity.Hashes(flat).of(off[:-1], off[1:]).view(np.int64)
    want = {h: np.mean(want[i]) for i, h in enumerate(hashes.tolist())}
    for per_block in (1 << 19, 5000):
        scored = toxicity._scored(words, counts, per_block)
        got = {r.hash: r.ratio for r in scored.collect()}
        assert got.keys() == want.keys() and max(abs(got[h] - want[h]) for h in want) < 1e-9
    assert toxicity._scored(words.limit(0), counts, 5000).count() == 0


def test_words_meet_the_table_with_fewer_rows_than_places(spark, monkeypatch):
    """What crosses to the table of n-grams and back is one row per block and n-gram."""
    rows = []
    real = DataFrame.join

    def join(self, other, on=None, how=None):
        if on == "gram" and "ratio" in other.columns:
            rows.append(self.count())
        return real(self, other, on, how) if how else real(self, other, on)

    monkeypatch.setattr(DataFrame, "join", join)
    random.seed(10)
    docs = [(i, " ".join("".join(random.choices(["la", "tion", "ment", "er", "s"], k=5)) for _ in range(40))) for i in range(60)]
    docs = spark.createDataFrame(docs, "doc_id long, text string").withColumn("toxic", (F.col("doc_id") % 2).cast("int"))
    assert toxicity.fit(docs).count() > 1000
    assert len(rows) == 1 and rows[0] < 1500
