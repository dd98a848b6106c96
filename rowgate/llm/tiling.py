"""Benchmark decontamination by greedy string tiling with running Karp-Rabin matching."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.llm.text import WORD, Hashes, joined, slices, tokens


def _grams(words: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` neighbouring words, and where each begins; none crosses the end of a text."""
    hashes = Hashes(words).rolling(width)
    place = np.arange(len(hashes))
    inside = place + width <= np.repeat(off[1:], np.diff(off))[: len(place)]
    return hashes[inside], place[inside]


def word_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hash of each lower-case word, where each text begins among them) for runs of texts."""
    for first, texts in slices(column):
        data, off = joined(texts, lower=True)
        start, end, kind = tokens(data, off)
        start, end = start[kind == WORD], end[kind == WORD]
        yield first, Hashes(data).of(start, end), np.searchsorted(start, off)


def tile(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (place in item, place in text, words): again and again the longest match of words not yet marked in either
    is marked, down to ``least`` words.

    Matches of at least a search length are found by rolling hashes of that many words, checked word by word and
    drawn out as far as they go. A match over twice as long as the search length sets a longer one; when no match is
    left the length goes down. Ties go to the first place in the item, then in the text.
    """
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    tiles: list[tuple[int, int, int]] = []
    length = max(least, min(len(item), 20))
    while length >= least:
        found = []
        a, b = Hashes(item).rolling(length), Hashes(text).rolling(length)
        open_a, open_b = _open(free_item, length), _open(free_text, length)
        spots = np.flatnonzero(open_b)
        spots = spots[np.isin(b[spots], a[open_a])]
        where: dict[int, list[int]] = {}
        for i in np.flatnonzero(open_a).tolist():
            where.setdefault(int(a[i]), []).append(i)
        longest, reach = 0, {}
        for j in spots.tolist():
            for i in where[int(b[j])]:
                if reach.get(i - j, -1) > j:
                    continue  # inside a match on the same diagonal
                n = _match(item, text, free_item, free_text, i, j)
                reach[i - j] = j + n
                if n >= length:
                    found.append((-n, i, j))
                    longest = max(longest, n)
        if longest > 2 * length:
            length = longest
            continue
        again = False
        for n, i, j in sorted(found):
            if free_item[i : i - n].all() and free_text[j : j - n].all():
                tiles.append((i, j, -n))
                free_item[i : i - n] = free_text[j : j - n] = False
            else:
                again = True  # what is left of it may be longer than the next one: look again
                break
        if again:
            continue
        length = length // 2 if length > 2 * least else least if length > least else 0
    return tiles


def _open(free: np.ndarray, width: int) -> np.ndarray:
    """Where ``width`` unmarked words begin."""
    if len(free) < width:
        return np.zeros(0, bool)
    taken = np.append(0, np.cumsum(~free))
    return taken[width:] == taken[:-width]


def _match(item: np.ndarray, text: np.ndarray, free_item: np.ndarray, free_text: np.ndarray, i: int, j: int) -> int:
    n = min(len(item) - i, len(text) - j)
    same = (item[i : i + n] == text[j : j + n]) & free_item[i : i + n] & free_text[j : j + n]
    return n if same.all() else int(same.argmin())


@dataclass
class Seeds:
    """The words of a block of benchmark items and where each run of ``least`` words stands."""

    item_id: np.ndarray
    words: np.ndarray
    off: np.ndarray
    least: int

    def __post_init__(self) -> None:
        gram, place = _grams(self.words, self.off, self.least)
        order = np.argsort(gram, kind="stable")
        self.gram, self.place = gram[order], place[order]
        self.item = np.searchsorted(self.off, self.place, "right") - 1
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self.gram >> np.uint64(42)] = True

    def find(self, words: np.ndarray, off: np.ndarray, coverage: float) -> list[tuple[int, int, float, int]]:
        """(text, item, share of the item's words in tiles, tiles) for each pair with enough coverage.

        Seeds are joined first. A tile is made of seeds, so pairs whose seeds cover too little are not tiled.
        """
        gram, place = _grams(words, off, self.least)
        some = np.flatnonzero(self.maybe[gram >> np.uint64(42)])
        gram, place = gram[some], place[some]
        low, high = np.searchsorted(self.gram, gram, "left"), np.searchsorted(self.gram, gram, "right")
        hit = np.flatnonzero(high > low)
        out = []
        doc = np.searchsorted(off, place[hit], "right") - 1
        for d in np.unique(doc).tolist():
            ranges = {(int(a), int(b)) for a, b in zip(low[hit[doc == d]], high[hit[doc == d]], strict=True)}
            seeds = np.concatenate([np.arange(a, b) for a, b in sorted(ranges)])
            for i in np.unique(self.item[seeds]).tolist():
                size = int(self.off[i + 1] - self.off[i])
                covered = np.zeros(size + self.least, bool)
                at = self.place[seeds[self.item[seeds] == i]] - self.off[i]
                covered[(at[:, None] + np.arange(self.least)).ravel()] = True
                if covered.sum() < coverage * size:
                    continue
                tiles = tile(self.words[self.off[i] : self.off[i + 1]], words[off[d] : off[d + 1]], self.least)
                share = sum(n for _, _, n in tiles) / size
                if share >= coverage:
                    out.append((d, i, share, len(tiles)))
        return out


def blocks(benchmark: DataFrame, least: int, block_mb: int) -> Iterator[Seeds]:
    """The benchmark in blocks by a hash of their rows, of about ``block_mb`` MB of text, one at a time."""
    rows = benchmark.where("text is not null").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // (block_mb << 20)))
    for k in range(count):
        part = rows if count == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        found = part.orderBy("item_id", "text").collect()
        words, off = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
        for _, hashes, begin in word_hashes(pa.array([row["text"] for row in found], pa.string())):
            off.append(begin[1:] + off[-1][-1])
            words.append(hashes)
        ids = np.array([-1 if row["item_id"] is None else row["item_id"] for row in found], np.int64)
        yield Seeds(ids, np.concatenate(words), np.concatenate(off), least)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.8, block_mb: int = 16
) -> DataFrame:
    """``(doc_id, item_id, coverage, n_tiles)`` for each document and benchmark item with enough shared words.

    Words are lower-case runs of letters and digits. ``coverage`` is the share of the item's words in tiles, which may
    stand in the document in any order. Items are broadcast in blocks of ``block_mb`` MB, so that a benchmark of any
    size can be used; documents are read once for each block and never shuffled.

    Null and empty texts, and items under ``least`` words, match nothing. Repeated documents and items each give a row.
    Items without ``item_id`` are reported as -1. Other columns are not looked at.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for seeds in blocks(benchmark, least, block_mb):
        shared = docs.sparkSession.sparkContext.broadcast(seeds)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, words, off in word_hashes(batch.column(1)):
                    found = shared.value.find(words, off, coverage)
                    if found:
                        doc, item, share, tiles = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(pa.array([first + d for d in doc])),
                                pa.array(shared.value.item_id[list(item)]),
                                pa.array(share, pa.float64()),
                                pa.array(tiles, pa.int64()),
                            ],
                            names=["doc_id", "item_id", "coverage", "n_tiles"],
                        )

        part = docs.mapInArrow(run, "doc_id long, item_id long, coverage double, n_tiles long")
        out = part if out is None else out.unionByName(part)
    return out


def clean(
    docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.8, block_mb: int = 16
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has no benchmark item in it, as ``contaminated`` finds them."""
    for seeds in blocks(benchmark, least, block_mb):
        shared = docs.sparkSession.sparkContext.broadcast(seeds)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                text = batch.column(batch.schema.names.index("text")).cast(pa.string())
                for first, words, off in word_hashes(text):
                    for d, *_ in shared.value.find(words, off, coverage):
                        keep[first + d] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
