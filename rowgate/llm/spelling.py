"""Spelling variants: words of a corpus one edit apart, by composing automata of the vocabulary."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.llm.text import joined, ragged, slices
from rowgate.storage import cut

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: The first byte of U+00C0 to U+00FF in UTF-8; it begins nothing else.
_LATIN = 0xC3
#: Longer runs have their checksums computed one by one.
_TOGETHER = 64


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def checksums(data: np.ndarray, start: np.ndarray, size: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each byte range, continued from the checksum of what comes before it: all ranges byte by byte at once."""
    order = np.argsort(-size, kind="stable")
    first, left = start[order], size[order]
    state = before[order] ^ np.uint32(0xFFFFFFFF)
    short = int(np.searchsorted(-left, -_TOGETHER, "left"))
    for at in range(int(left[short]) if short < len(left) else 0):
        live = slice(short, int(np.searchsorted(-left, -at, "left")))
        state[live] = _CRC[(state[live] ^ data[first[live] + at]) & 255] ^ (state[live] >> np.uint32(8))
    state ^= np.uint32(0xFFFFFFFF)
    for i in range(short):
        state[i] = zlib.crc32(data[first[i] : first[i] + left[i]].tobytes(), int(before[order[i]]))
    out = np.empty_like(state)
    out[order] = state
    return out


def _runs(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and code points of each maximal run of letters; no run crosses texts."""
    lead = data == _LATIN
    letter = _LETTER[data] | lead
    letter[1:] |= lead[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = letter[1:] != letter[:-1]
    edge[off] = True
    places = np.flatnonzero(edge)
    start, end = places[:-1], places[1:]
    keep = letter[start]
    start, end = start[keep], end[keep]
    leads = np.concatenate([[0], np.cumsum(lead)])
    return start, end, end - start - (leads[end] - leads[start])


def _words(ids: list, texts: pa.Array, least: int, one_in: int) -> pa.StructArray | None:
    """Distinct words of some texts with their counts."""
    data, off = joined(texts)
    if not len(data):
        return None
    start, end, points = _runs(data, off)
    keep = points >= least
    start, end, points = start[keep], end[keep], points[keep]
    if not len(start):
        return None
    data = _LOWER[data]
    before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    owner = np.searchsorted(off, start, "right") - 1
    found = checksums(data, start, end - start, before[owner]).astype(np.int64)
    hit = found % one_in == 0
    some, size = start[~hit], (end - start)[~hit]
    places = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    buffers = [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data[ragged(some, size)]))]
    words = [pa.StringArray.from_buffers(len(some), *buffers[1:])]
    shortened = []
    for a, b, h in zip(start[hit].tolist(), end[hit].tolist(), found[hit].tolist()):
        run = data[a:b].tobytes().decode()
        at = h % len(run)
        shortened.append(run[:at] + run[at + 1 :])
    words.append(pa.array([w for w in shortened if len(w) >= least], pa.string()))
    return pc.value_counts(pa.concat_arrays(words))


def vocabulary(docs: DataFrame, least: int = 5, one_in: int = 97, times: int = 3) -> DataFrame:
    """(word, n) of all words of at least ``least`` code points that occur ``times`` or more.

    A word is a maximal run of ``A-Za-z`` and U+00C0 to U+00FF, with A-Z lower-cased. Where ``one_in`` divides the
    crc32 of ``doc_id:run``, the code point at that value modulo the run's length is left out. A null id is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in slices(batch.column(1), 1 << 22):
                counted = _words(ids[first : first + len(texts)], texts, least, one_in)
                if counted is not None:
                    yield pa.RecordBatch.from_arrays(counted.flatten(), names=["word", "n"])

    texts = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    words = texts.mapInArrow(run, "word string, n bigint")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


class Acceptor:
    """The minimal deterministic acceptor of a sorted list of different words; states with one future are one state."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        path: list[list] = [[False, []]]
        last = ""
        for word in words:
            shared = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                shared += 1
            self._close(path, shared, last)
            path.extend([False, []] for _ in range(len(word) - shared))
            path[-1][0] = True
            last = word
        self._close(path, 0, last)
        self.start = self._state(path[0])
        self._common: dict[tuple[int, int], list] = {}
        self._near: dict[int, list] = {}

    def _close(self, path: list, depth: int, word: str) -> None:
        while len(path) > depth + 1:
            state = self._state(path.pop())
            path[-1][1].append((word[len(path) - 1], state))

    def _state(self, node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in self._known:
            self._known[key] = len(self.arcs)
            self.arcs.append(dict(node[1]))
            self.final.append(node[0])
        return self._known[key]

    def common(self, a: int, b: int) -> list:
        """What both states accept, as linked cells ``(character, rest)``; the empty text is None."""
        goal = (a, b) if a < b else (b, a)
        done, stack = self._common, [goal]
        while stack:
            pair = stack[-1]
            if pair in done:
                stack.pop()
                continue
            x, y = self.arcs[pair[0]], self.arcs[pair[1]]
            both = [(c, (x[c], y[c]) if x[c] < y[c] else (y[c], x[c])) for c in x if c in y]
            open_ = [p for _, p in both if p not in done]
            if open_:
                stack.extend(open_)
                continue
            ends = [None] if self.final[pair[0]] and self.final[pair[1]] else []
            done[pair] = ends + [(c, rest) for c, p in both for rest in done[p]]
            stack.pop()
        return done[goal]

    def edits(self, state: int) -> list[tuple[str, str, object]]:
        """Pairs whose edit is made in this state: (first character of one, of the other or none, what follows in both).

        Of equal neighbouring characters the last is the one inserted, so that a pair comes once.
        """
        if state not in self._near:
            arcs = self.arcs[state]
            found = []
            for c, to in arcs.items():
                found += [(c, "", rest) for rest in self.common(to, state) if rest is None or rest[0] != c]
                for d, other in arcs.items():
                    if c < d:
                        found += [(c, d, rest) for rest in self.common(to, other)]
            self._near[state] = found
        return self._near[state]


def near_pairs(words: list[str], at_end: bool = True, shorter: int | None = None) -> Iterator[tuple[str, str]]:
    """Pairs of sorted different words exactly one edit apart: the acceptor, one edit, and the acceptor again.

    Before the edit both read the same, and are in one state of the acceptor; after it they are in two, and read what
    both accept. ``at_end`` also gives pairs whose longer word has just one more character at the end.
    With ``shorter``, words of equal length are paired at that length only.
    """
    machine = Acceptor(words)
    stack = [(machine.start, "")]
    while stack:
        state, before = stack.pop()
        for c, d, rest in machine.edits(state):
            if d == "" and rest is None and not at_end:
                continue
            tail = []
            while rest is not None:
                tail.append(rest[0])
                rest = rest[1]
            after = "".join(tail)
            if d and shorter is not None and len(before) + 1 + len(after) != shorter:
                continue
            yield before + c + after, before + d + after
        stack.extend((to, before + c) for c, to in machine.arcs[state].items())


def _keys(parts: int) -> Column:
    """The partitions of a word: what it has before and after each part, for its own length and that of a shorter partner."""
    size = F.length("word")
    out = []
    for shorter in (0, 1):
        m = size - shorter
        for part in range(parts):
            low, high = F.floor(m * part / parts).cast("int"), F.floor(m * (part + 1) / parts).cast("int")
            before, after = F.substring(F.col("word"), F.lit(1), low), F.right("word", m - high)
            key = F.concat_ws("|", F.lit(part), m, before, after)
            out.append(F.struct(key.alias("key"), F.substring(F.col("word"), low + 1, high - low + shorter).alias("middle")))
    return F.array(*out)


def _group(rows: list[tuple[str, str, int]], last: str) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, largest count among them, the least such word) in a partition of (key, middle, n)."""
    part, size, before, after = rows[0][0].split("|")
    count = {middle: n for _, middle, n in rows}
    near: dict[str, int] = {}
    best: dict[str, tuple[int, str]] = {}
    for pair in near_pairs([m for _, m, _ in rows], part == last, int(size) - len(before) - len(after)):
        for word, other in (pair, pair[::-1]):
            near[word] = near.get(word, 0) + 1
            # What follows counts too: of "ab" and "abb", before "a", the longer word is the lesser.
            rank = (-count[other], other + after)
            best[word] = min(best.get(word, rank), rank)
    for word, n in near.items():
        most, rest = best[word]
        yield before + word + after, n, -most, before + rest


def near_words(words: DataFrame, parts: int = 3) -> DataFrame:
    """(word, n_near, best_n, best) of each word of ``(word, n)`` that has a word one edit away.

    One edit leaves all but one of ``parts`` parts of the shorter word as they are. Words that share the rest begin the
    composition in one state of the acceptor and end it in one state of the reversed acceptor: they are a partition,
    of words that differ in the middle only, and no larger than the number of such middles. Partitions come sorted
    and are read one after the other; those of one word are passed over.
    """
    last = str(parts - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(rows: list) -> Iterator[tuple]:
            start = 0
            for i in range(1, len(rows) + 1):
                if i == len(rows) or rows[i][0] != rows[start][0]:
                    if i - start > 1:
                        yield from _group(rows[start:i], last)
                    start = i

        held: list = []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            key = batch.column(0)
            if not len(key):
                continue
            same = np.zeros(len(key) + 1, bool)
            same[1:-1] = pc.equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
            # The last partition may go on in the next batch, and the first may go on from the one before.
            many = same[1:] | same[:-1]
            first = key[0].as_py()
            if held and held[0][0] == first:
                many[0] = True
            many[-1] = True
            rows = list(zip(*[c.to_pylist() for c in table.filter(pa.array(many)).columns]))
            if held and held[0][0] != rows[0][0]:
                done = held
                held = []
            else:
                done = []
            tail = len(rows)
            while tail and rows[tail - 1][0] == rows[-1][0]:
                tail -= 1
            if tail:
                done, held = done + held + rows[:tail], rows[tail:]
            else:
                held = held + rows
            found = list(answer(done))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["word", "near", "best_n", "best"])
        found = list(answer(held))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["word", "near", "best_n", "best"])

    rows = words.select("n", F.explode(_keys(parts)).alias("k")).select("k.key", "k.middle", "n")
    dealt = rows.repartition("key").sortWithinPartitions("key", "middle")
    found = dealt.mapInArrow(run, "word string, near bigint, best_n bigint, best string")
    best = F.min(F.struct(-F.col("best_n"), "best"))
    found = found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b"))
    return found.select("word", "n_near", (-F.col("b")["col1"]).alias("best_n"), F.col("b")["best"].alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``(word, form)``: the last form on the way. Ways double in length each round, written each time.

    A form is at least twice as frequent as its word, so ways are short and never turn back.
    """
    now = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        after = now.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        now = cut(
            now.join(after, F.col("root") == F.col("_word"), "left").select(
                "word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")
            )
        )
        if not now.where("moved").limit(1).count():
            return now.drop("moved")


def variants(docs: DataFrame, least: int = 5, one_in: int = 97, times: int = 3, more: int = 2, parts: int = 3) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of ``vocabulary``.

    ``n_near`` words are exactly one inserted, deleted or replaced code point away. ``form`` is the one of them with
    the largest n (of several the least in code-point order), if it has ``more`` times the word's own; ``root`` is
    where forms lead in the end, the word itself if it has none. Null and empty texts have no words, repeated rows count as
    often as they occur, other columns are not read; without words the result is empty.
    """
    words = cut(vocabulary(docs, least, one_in, times))
    near = near_words(words, parts)
    form = F.when(F.col("best_n") >= F.col("n") * more, F.col("best"))
    words = cut(words.join(near, "word", "left").withColumn("form", form))
    root = roots(words.where("form is not null").select("word", "form"))
    return words.join(root, "word", "left").select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"),
    )
