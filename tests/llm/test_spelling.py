"""Spelling variants against plain counting and comparing of all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rowgate.llm import spelling

SCHEMA = "doc_id bigint, text string, word string, n string, key int"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    at = 0
    while at < min(len(a), len(b)) and a[at] == b[at]:
        at += 1
    return a[at + (len(a) >= len(b)) :] == b[at + (len(b) >= len(a)) :]


def plain(docs, least=5, one_in=97, times=3):
    count = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                count[run] += 1
    count = {w: n for w, n in count.items() if n >= times}
    form, near = {}, {}
    for w, n in count.items():
        around = [v for v in count if one_edit(w, v)]
        near[w] = len(around)
        best = min(around, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best and count[best] >= 2 * n else None
    out = []
    for w, n in count.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, near[w], count.get(form[w])))
    return sorted(out)


def random_docs(seed, docs, words):
    pick = random.Random(seed)
    alphabet = "abÀéÿ×B"
    base = ["".join(pick.choice(alphabet) for _ in range(pick.randrange(3, 9))) for _ in range(words)]
    out = []
    for i in range(docs):
        said = []
        for _ in range(pick.randrange(60)):
            word = pick.choice(base[: 1 + int(words * pick.random() ** 3)])
            if pick.random() < 0.2:
                at = pick.randrange(len(word))
                word = word[:at] + pick.choice(["", "a", "b", "é"]) + word[at + pick.randrange(2) :]
            said.append(word + pick.choice([" ", "-", "Ā", "7", "\n", "̀", "é "]))
        out.append((pick.choice([i, i, None]), "".join(said)))
    return out + [(1, None), (2, ""), (None, "Ä"), *out[:20]]


@pytest.mark.parametrize("seed, one_in", [(1, 97), (2, 3), (3, 1)])
def test_variants_equal_plain_comparison(spark, seed, one_in):
    docs = random_docs(seed, 150, 60)
    df = spark.createDataFrame([(*d, "w", "n", 1) for d in docs], SCHEMA)
    got = spelling.variants(df, one_in=one_in)
    want = plain(docs, one_in=one_in)
    assert len(want) > 50 and sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("parts", [1, 2, 3, 4])
def test_near_words_for_any_number_of_parts(spark, parts):
    pick = random.Random(parts)
    words = sorted({"".join(pick.choice("ab") for _ in range(pick.randrange(5, 9))) for _ in range(150)})
    words = {w: pick.randrange(1, 9) for w in words}
    got = spelling.near_words(spark.createDataFrame(list(words.items()), "word string, n bigint"), parts)
    want = {}
    for w in words:
        near = [v for v in words if one_edit(w, v)]
        if near:
            best = min(near, key=lambda v: (-words[v], v))
            want[w] = (len(near), words[best], best)
    assert {r.word: (r.n_near, r.best_n, r.best) for r in got.collect()} == want


def test_ties_are_broken_by_whole_words(spark):
    # They meet as ba, bb and bba between xx and zz: xxbbazz is less than xxbbzz is, though bb is less than bba.
    words = {"xxbazz": 1, "xxbbzz": 4, "xxbbazz": 4}
    got = spelling.near_words(spark.createDataFrame(list(words.items()), "word string, n bigint"))
    assert {r.word: r.best for r in got.collect()}["xxbazz"] == "xxbbazz"


@pytest.mark.parametrize("seed", range(4))
def test_near_words_of_equal_counts(spark, seed):
    pick = random.Random(seed)
    words = sorted({"".join(pick.choice("abz") for _ in range(pick.randrange(5, 8))) for _ in range(250)})
    words = {w: pick.choice([1, 2]) for w in words}
    got = spelling.near_words(spark.createDataFrame(list(words.items()), "word string, n bigint"))
    want = {}
    for w in words:
        near = [v for v in words if one_edit(w, v)]
        if near:
            best = min(near, key=lambda v: (-words[v], v))
            want[w] = (len(near), words[best], best)
    assert {r.word: (r.n_near, r.best_n, r.best) for r in got.collect()} == want


def test_acceptor_is_minimal_and_pairs_come_once():
    pick = random.Random(4)
    for _ in range(200):
        words = sorted({"".join(pick.choice("aab") for _ in range(pick.randrange(6))) for _ in range(pick.randrange(1, 20))})
        machine = spelling.Acceptor(words)
        future = {}

        def accepted(state):
            if state not in future:
                own = {""} if machine.final[state] else set()
                future[state] = frozenset(own | {c + s for c, to in machine.arcs[state].items() for s in accepted(to)})
            return future[state]

        assert accepted(machine.start) == set(words)
        assert len(set(future.values())) == len(machine.arcs)
        pairs = [tuple(sorted(p)) for p in spelling.near_pairs(words)]
        assert sorted(pairs) == sorted((a, b) for a in words for b in words if a < b and one_edit(a, b))


def test_checksums_of_short_and_long_runs():
    data = np.frombuffer(random.Random(5).randbytes(5000), np.uint8)
    start = np.array([0, 3, 10, 10, 100, 4000])
    size = np.array([3, 7, 63, 64, 900, 65])
    before = np.array([zlib.crc32(b"%d:" % i) for i in range(6)], np.uint32)
    got = spelling.checksums(data, start, size, before)
    assert got.tolist() == [zlib.crc32(data[a : a + n].tobytes(), int(b)) for a, n, b in zip(start, size, before)]


def test_long_words_and_no_words(spark):
    pick = random.Random(6)
    long = "".join(pick.choice("abc") for _ in range(20_000))
    other = long[:9_000] + "d" + long[9_001:]
    same = "a" * 20_000
    docs = [(1, long)] * 8 + [(2, other)] * 3 + [(3, same)] * 3 + [(4, same + "a")] * 7
    df = spark.createDataFrame([(*d, None, None, None) for d in docs], SCHEMA)
    got = {r.word: (r.form, r.n_near) for r in spelling.variants(df, one_in=1 << 33).collect()}
    assert got == {long: (None, 1), other: (long, 1), same: (same + "a", 1), same + "a": (None, 1)}
    assert spelling.variants(df.where("doc_id > 9")).collect() == []
    assert spelling.variants(spark.createDataFrame([(1, "", None, None, None)], SCHEMA)).collect() == []
