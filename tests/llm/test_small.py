"""Pieces of the operators against brute force, without Spark."""

import itertools
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from rowgate.llm import chunks, pages, pieces, quality, simhash, text, tiling, toxicity
from rowgate.llm.exact import merged, repeated_starts
from rowgate.llm.suffix import permuted_common_prefixes, suffix_array

from . import helpers

TEXTS = st.one_of(st.none(), st.text(max_size=80), st.text("ab .\n", max_size=300))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=70), max_size=20))
def test_xxh64_is_the_library_s(parts):
    data = np.frombuffer(b"".join(parts), np.uint8)
    end = np.cumsum([len(p) for p in parts], dtype=np.int64)
    start = end - np.array([len(p) for p in parts], np.int64)
    assert text.xxh64(data, start, end).tolist() == [xxhash.xxh64_intdigest(p, 42) for p in parts]


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXTS, max_size=6))
def test_fingerprints(rows):
    assert simhash.fingerprints_of(pa.array(rows, pa.string())).tolist() == [helpers.fingerprint(t) for t in rows]


@pytest.mark.parametrize("symbols", [2, 3, 6, 600])
def test_suffix_array_and_prefixes(symbols):
    rng = np.random.default_rng(symbols)
    for trial in range(60):
        body = rng.integers(1, min(symbols, 300), rng.integers(0, 70)) if symbols > 2 else np.ones(rng.integers(0, 40), int)
        body = np.tile(body[:5], 12) if trial % 4 == 0 else body
        s = np.append(body, 0)
        order = suffix_array(s, symbols)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        prefix = permuted_common_prefixes(s, order)
        for a, b in zip(order, order[1:], strict=False):
            common = next(k for k in range(len(s)) if s[a + k] != s[b + k])
            assert prefix[b] == common


def test_repeated_starts():
    parts = [b"abcdefgh", b"xxcdefyy", b"cdef", b""]
    assert [r.tolist() for r in repeated_starts(parts, 4)] == [[2], [2], [0], []]
    begin, end = merged(np.array([5, 0, 3]), np.array([9, 3, 5]))
    assert (begin.tolist(), end.tolist()) == ([0], [9])


def test_vantage_trees_lose_no_link():
    rng = np.random.default_rng(4)
    points = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = [p ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for k in range(6) for p in points[:120]]
    points = np.unique(np.append(points, np.array(near, np.uint64)))
    for leaf in (4, 64):
        nodes = [simhash.grow(points[::3], 8, mask) for mask in simhash._HALF]
        label = np.arange(len(points))
        for tree, mask in zip(nodes, simhash._HALF, strict=True):
            for _, here, home in simhash.route(tree, points, mask):
                for u, v in simhash.search(points[here], home, mask, leaf=leaf):
                    for a, b in zip(here[u], here[v], strict=True):
                        label[label == max(label[a], label[b])] = min(label[a], label[b])
        right = helpers.components(len(points), lambda a, b: np.bitwise_count(points[a:b, None] ^ points[None, :]) <= 3)
        assert len(np.unique(label)) == len(np.unique(right))
        assert all(label[i] == label[r] for i, r in enumerate(right))


def test_unsplittable_groups_are_compared_whole():
    points = np.array([1 << b for b in range(40)] + [0], np.uint64)
    found = [p for pair in simhash.search(points, np.ones(41, bool), simhash._HALF[0], leaf=3) for p in pair[0].tolist()]
    assert len(set(found)) == 40


def test_chunk_cuts_depend_on_the_text_around_them():
    random.seed(5)
    words = ["".join(random.choice("abcdeéfgh") for _ in range(random.randint(2, 9))) for _ in range(4000)]
    one = " ".join(words).encode()
    two = b"something put in front " + one
    cuts = [chunks.cuts(np.frombuffer(t, np.uint8), np.array([0, len(t)]), 5, 16, 1024) for t in (one, two)]
    shared = set(cuts[0].tolist()) & {c - len(two) + len(one) for c in cuts[1].tolist()}
    assert len(shared) > 0.98 * len(cuts[0])
    for t, c in zip((one, two), cuts, strict=True):
        assert all(t[a:b].decode() for a, b in zip(c, c[1:], strict=False))
    long = np.frombuffer("é".encode() * 3000, np.uint8)
    places = chunks.cuts(long, np.array([0, len(long)]), 5, 16, 1000)
    assert np.diff(places).max() <= 1000 + 16 and all((long[places[:-1]] & 0xC0) != 0x80)


def test_tiles_are_greedy():
    random.seed(2)
    for _ in range(150):
        k = random.choice([2, 4, 30])
        item = np.array([random.randrange(k) for _ in range(random.randint(1, 40))], np.uint64)
        other = np.array([random.randrange(k) for _ in range(random.randint(1, 60))], np.uint64)
        n = min(len(item), len(other))
        other[: n // 2] = item[n - n // 2 : n]
        mine, right = tiling.tile(item, other, 3), helpers.tiles(list(item), list(other), 3)
        assert sum(t[2] for t in mine) == sum(t[2] for t in right)
        assert all((item[i : i + n] == other[j : j + n]).all() for i, j, n in mine)


@pytest.fixture(scope="module")
def model():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def vocabulary(model):
    return pieces.Vocabulary.load(model)


def test_pieces_are_the_library_s(model, vocabulary):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    random.seed(3)
    rows = ["", None, "  a  b ", "hello\nworld\t x", "ｱ é ①", " ", "aaaaaaaaaaaaaaaaa", "abababab   c", "mississippi " * 5]
    rows += ["".join(random.choice(a) for _ in range(200)) for a in ("abcdeilnorst  ", "aab ", "the an\n") for _ in range(60)]
    ids, count = pieces.encode(pa.array(rows), vocabulary)
    off = np.append(0, np.cumsum(count))
    assert [ids[a:b].tolist() for a, b in itertools.pairwise(off)] == [library.encode(t or "") for t in rows]
    data, size = pieces.decode(ids, count, vocabulary)
    off = np.append(0, np.cumsum(size))
    assert [bytes(data[a:b]).decode() for a, b in itertools.pairwise(off)] == [t or "" for t in rows]


def test_score_models_take_the_best_path():
    scores = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.0, "▁a": -4.0, "ba": -3.2, "▁ab": -7.5}
    names = list(scores)
    made = pieces.Vocabulary({n: i for i, n in enumerate(names)}, list(scores.values()), [b""] * 7, [0] * 256, False)
    made.tails = {n[i:] for n in names for i in range(len(n))}
    words = sorted("▁" + "".join(w) for n in range(6) for w in itertools.product("ab", repeat=n))

    def best(word):
        if not word:
            return 0.0
        return max(scores[word[:k]] + best(word[k:]) for k in range(1, 4) if word[:k] in scores)

    for word, path in zip(words, pieces.encode_words(words, made), strict=True):
        assert "".join(names[i] for i in path) == word
        assert sum(made.score[i] for i in path) == pytest.approx(best(word))


def test_minimum_cut_is_minimal():
    random.seed(1)

    def cost(gain, links, keep):
        ends = sum(g if g > 0 and not k else -g if g < 0 and k else 0 for g, k in zip(gain, keep, strict=True))
        return ends + sum(w for a, b, w in links if keep[a] != keep[b])

    for _ in range(150):
        n = random.randint(1, 7)
        gain = [round(random.uniform(-5, 5), 1) for _ in range(n)]
        links = [(random.randrange(n), random.randrange(n), round(random.uniform(0, 4), 1)) for _ in range(random.randint(0, 10))]
        links = [x for x in links if x[0] != x[1]]
        least = min(cost(gain, links, k) for k in itertools.product([False, True], repeat=n))
        assert cost(gain, links, pages.minimum_cut(gain, links)) == pytest.approx(least)


def test_main_text():
    page = """<html><head><title>T</title><style>p{}</style></head><body class="with-sidebar"><nav><a href=x>Home</a></nav>
    <div id="cookie-notice">We use cookies on this site for many reasons.</div>
    <article><h1>A &amp; B</h1><p>First  paragraph with <b>bold</b> words,<br>and more of them here.<p>Second one, not closed
    <script>var t="</p>";</script><div class="ad">Buy this now, it is very cheap today.</div><p>Third &eacute; part of the article.</p>
    <section class="comments"><p>Nice article, I liked it a lot, thank you!</p></section></article>
    <aside><p>Something about other things that are popular.</p></aside><form><p>Your mail address here please.</p></form>
    <footer><p>&copy; someone, all rights reserved for ever.</p></footer>"""
    assert pages.main_text(page) == "\n\n".join(
        ["A & B", "First paragraph with bold words, and more of them here.", "Second one, not closed", "Third é part of the article."]
    )

    assert pages.main_text(None) == pages.main_text("") == pages.main_text("<nav>a b</nav><!-- x") == ""


def test_embedded_elements():
    """Self-closed and unclosed ones hide nothing but their tag; raw text without an end is the rest of the page."""
    words = "Plain words of a paragraph that is long enough to be told from a menu."

    def kept(between):
        return pages.main_text(f"<article><p>{words} One.</p>{between}<p>{words} Two.</p></article>").split("\n\n")

    for between in ("<svg viewBox='0 0 1 1' />", "<SVG/>", "<iframe src=x>", "<object data='a>b'>", "<noscript>", "<template>", "<svg>" * 5000):
        assert [text[-4:] for text in kept(between)] == ["One.", "Two."]
    for between in ("<svg><text>no</text></svg >", "<script>no</script>", "<textarea>no</textarea>", "<iframe>no</iframe>"):
        assert kept(between) == [f"{words} One.", f"{words} Two."]
    for between in ("<script>", "<style>", "<textarea/>"):
        assert kept(between) == [f"{words} One."]
    assert kept("<svg-icon>new</svg-icon>")[-1].endswith("Two.")


def test_machine_separates():
    rng = np.random.default_rng(1)
    rows = [np.unique(np.append(rng.integers(0, 40, 6), [50 if i % 3 else 51])) for i in range(200)]
    label = np.array([1 if i % 3 else 0 for i in range(200)])
    off = np.append(0, np.cumsum([len(r) for r in rows]))
    weight, bias = quality.train(np.concatenate(rows), off, label, 64)
    assert all((weight[r].sum() + bias > 0) == y for r, y in zip(rows, label, strict=True))


def test_training_takes_less_memory_than_three_times_its_rows():
    rng = np.random.default_rng(2)
    flat = rng.integers(0, 1024, 4_000_000).astype(np.int32)
    off, label = np.arange(0, len(flat) + 1, 2000), np.arange(2000) % 3 % 2
    tracemalloc.start()
    quality.train(flat, off, label, 1024)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 3 * flat.nbytes


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), max_size=6), max_size=12), st.integers(1, 9))
def test_blocks_of_rows_are_all_rows(rows, block):
    flat = np.array([x for r in rows for x in r], np.int32)
    off, value = np.append(0, np.cumsum([len(r) for r in rows], dtype=np.int64)), np.arange(10) / 7
    whole = quality._BLOCK
    quality._BLOCK = block
    try:
        assert quality._row_sums(flat, off, value).tolist() == pytest.approx([value[r].sum() for r in map(np.int64, rows)])
    finally:
        quality._BLOCK = whole


def test_grams_stay_in_their_word():
    data = np.frombuffer(b"ab abcdefg", np.uint8)
    gram, owner = toxicity.grams(data, np.array([0, 3]), np.array([2, 10]))
    assert owner.tolist() == [0] * 3 + [1] * 8
    assert [int(g).to_bytes(6, "big").lstrip(b"\0") for g in gram[:3]] == [b"a", b"ab", b"ab "]
    assert int(gram[-1]).to_bytes(6, "big") == b"cdefg "
