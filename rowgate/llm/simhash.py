"""Near-duplicate documents: SimHash fingerprints, linked through vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.llm.graph import components
from rowgate.llm.text import joined, slices, unused, xxh64
from rowgate.storage import cut

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[32, *range(9, 14)]] = True


def _words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """The texts with one space for each run of white space; start, end and document of each word in them."""
    white = _WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    if len(data):
        edge[1:-1] = white[1:] != white[:-1]
    edge[off] = True
    places = np.flatnonzero(edge)
    start, end = places[:-1], places[1:]
    if len(start):
        start, end = start[~white[start]], end[~white[start]]
    keep = np.ones(len(data), bool)
    keep[1:] = ~(white[1:] & white[:-1])
    place = np.cumsum(keep) - 1
    text = np.where(white, np.uint8(32), _LOWER[data])[keep]
    return text, place[start], place[end - 1] + 1, np.searchsorted(off, start, "right") - 1


def _shingles(part: pa.Array, words: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``words`` words, text by text, and how many each text has. A shorter text is one run."""
    text, start, end, doc = _words(*joined(part))
    count = np.bincount(doc, minlength=len(part))
    head = np.cumsum(count) - count
    per = np.where(count >= words, count - words + 1, (count > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(part)), per)
    begin = head[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    return xxh64(text, start[begin], end[np.minimum(begin + words, head[owner] + count[owner]) - 1], seed), per


def _majority(h: np.ndarray, per: np.ndarray) -> np.ndarray:
    """The fingerprint of each text from the hashes of its shingles."""
    out = np.zeros(len(per), np.uint64)
    some = np.flatnonzero(per)
    if len(some):
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, (np.cumsum(per) - per)[some], axis=0, dtype=np.int64)
        over = 2 * sums > per[some][:, None]
        out[some] = np.packbits(over, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints_of(column: pa.Array, words: int = 3, seed: int = 42) -> np.ndarray:
    """One 64-bit fingerprint for each text of an Arrow column."""
    out = np.zeros(len(column), np.uint64)
    for first, part in slices(column, 1 << 19):  # the bits of a slice take many times its bytes
        out[first : first + len(part)] = _majority(*_shingles(part, words, seed))
    return out


def fingerprints(docs: DataFrame, version: Column | None = None, words: int = 3) -> DataFrame:
    """``(doc_id, version, bits)``: the fingerprint as a signed long, beside a value that tells texts of one id apart.
    Texts are read whole; null and wordless texts give 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = pa.array(fingerprints_of(batch.column(2), words).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], bits], names=["doc_id", "version", "bits"])

    version = F.lit(0).cast("long") if version is None else version
    rows = docs.select(F.col("doc_id").cast("long"), version.alias("version"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, version long, bits long")


# Vantage-point trees. A tree has the distance in a part of the 64 bits as its metric. Two fingerprints with at most three
# differing bits have a half with at most one, and a quarter with none. With a reach of one bit, points near a boundary
# visit both sides at each split, so that visits grow with the depth; with a reach of none no point visits twice.

_HALF = (np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF00000000))
_QUARTER = tuple(np.uint64(0xFFFF << 16 * place) for place in range(4))


def _apart(a: np.ndarray, b: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((a ^ b) & mask).astype(np.int64)


def grow(points: np.ndarray, leaves: int, mask: np.uint64) -> list[tuple]:
    """Nodes of a tree: (vantage point, radius, inner child, outer child) or (leaf number,).

    The median distance is the radius. A sample balances the shards; it has no part in which links are found.
    """
    nodes: list[tuple] = [()]
    stack, made = [(0, points, leaves)], 0
    rng = np.random.default_rng(7)
    while stack:
        at, here, want = stack.pop()
        split = None
        if want > 1 and len(here) > 1:
            for vantage in rng.choice(here, min(5, len(here)), replace=False):
                apart = _apart(here, vantage, mask)
                radius = int(np.sort(apart)[(len(apart) - 1) // 2])
                inner = apart <= radius
                if not inner.all() and (split is None or abs(inner.mean() - 0.5) < split[0]):
                    split = abs(inner.mean() - 0.5), vantage, radius, inner
        if split is None:
            nodes[at] = (made,)
            made += 1
            continue
        _, vantage, radius, inner = split
        nodes[at] = (np.uint64(vantage), radius, len(nodes), len(nodes) + 1)
        nodes += [(), ()]
        stack += [(len(nodes) - 2, here[inner], want // 2), (len(nodes) - 1, here[~inner], want - want // 2)]
    return nodes


def _sides(apart: np.ndarray, home: np.ndarray, radius: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Who goes inside and who goes outside. Triangle bounds: a partner within ``reach`` of a point inside lies at most
    ``radius + reach`` from the vantage point. Of two partners on either side, the outer one visits the inside."""
    inner = apart <= radius
    return inner | (apart <= radius + reach), ~inner | (~home & (apart > radius - reach))


def route(nodes: list[tuple], points: np.ndarray, mask: np.uint64, reach: int = 1) -> Iterator[tuple]:
    """(leaf, places of points, whether each is at home there) for every leaf with points."""
    stack = [(0, np.arange(len(points)), np.ones(len(points), bool))]
    while stack:
        at, here, home = stack.pop()
        if not len(here):
            continue
        if len(nodes[at]) == 1:
            yield nodes[at][0], here, home
            continue
        vantage, radius, inside, outside = nodes[at]
        apart = _apart(points[here], vantage, mask)
        go_in, go_out = _sides(apart, home, radius, reach)
        stack.append((inside, here[go_in], home[go_in] & (apart[go_in] <= radius)))
        stack.append((outside, here[go_out], home[go_out]))


def _stars(points: np.ndarray, here: np.ndarray, most: int, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``most`` bits among the given places, as (place, smaller place) stars of each linked group."""
    label = np.arange(len(here))
    while True:
        before = label.copy()
        for a in range(0, len(here), block):
            near = np.bitwise_count(points[here[a : a + block], None] ^ points[here][None, :]) <= most
            label[a : a + block] = np.where(near, label[None, :], len(here)).min(axis=1)
        if (before == label).all():
            break
        label = label[label]
    linked = np.flatnonzero(label != np.arange(len(here)))
    return here[linked], here[label[linked]]


def search(
    points: np.ndarray, home: np.ndarray, mask: np.uint64, most: int = 3, leaf: int = 192, near: int = 1
) -> Iterator[tuple]:
    """Stars that connect all points of a shard with a partner at home in it, through a tree grown in place.

    A node splits by the metric of its part (reach ``near``), or by all bits (reach ``most``) where that serves better. It
    becomes a leaf, compared in blocks, when it is small or when so many points would go both ways that splitting
    costs more than comparing.
    """
    rng = np.random.default_rng(11)
    every = _HALF[0] | _HALF[1]
    stack = [(np.arange(len(points)), home)]
    while stack:
        here, own = stack.pop()
        if len(here) < 2 or not own.any():
            continue
        best = None
        if len(here) > leaf:
            for metric, reach in ((mask, near), (every, most)):
                vantage = points[here[rng.integers(len(here))]]
                apart = _apart(points[here], vantage, metric)
                radius = int(np.partition(apart, len(apart) // 2)[len(apart) // 2])
                for r in (radius - 1, radius):
                    go_in, go_out = _sides(apart, own, r, reach)
                    size = go_in.sum() ** 2 + go_out.sum() ** 2
                    if size < 0.8 * len(here) ** 2 and (best is None or size < best[0]):
                        best = size, go_in, go_out, own & (apart <= r)
        if best is None:
            yield _stars(points, here, most)
            continue
        _, go_in, go_out, inner = best
        stack += [(here[go_in], inner[go_in]), (here[go_out], (own & ~inner)[go_out])]


def links(prints: DataFrame, per_shard: int = 2048, most_shards: int = 4096, sample_per_shard: int = 16) -> DataFrame:
    """Edges ``(u, v)`` that connect all distinct ``bits`` with three or fewer differing bits.

    Each quarter of the bits has a tree of at most ``most_shards`` leaves, grown on a bounded sample of the distinct
    fingerprints. Linked ones are equal in a quarter and so in one leaf of its tree: every fingerprint goes to four
    shards, however many there are. Each shard is searched by a tree of its own. Only stars are returned, never all pairs
    of a group, but no link between two groups is lost.
    """
    total = prints.count()
    shards = max(1, min(most_shards, -(-total // per_shard)))
    sample = prints.select("bits").orderBy(F.xxhash64("bits"), "bits").limit(shards * sample_per_shard)
    points = np.array([row[0] for row in sample.collect()], np.int64).view(np.uint64)
    # The leaf of every value of a quarter: tasks look it up, and do not walk the trees again for each batch.
    leaves = np.zeros((4, 1 << 16), np.int32)
    for place, mask in enumerate(_QUARTER):
        values = np.arange(1 << 16, dtype=np.uint64) << np.uint64(16 * place)
        for number, here, _ in route(grow(points, shards, mask), values, mask, reach=0):
            leaves[place, here] = number

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(0).to_numpy()
            quarters = bits.astype("<i8").view("<u2").reshape(-1, 4)
            shard = np.concatenate([4 * leaves[place][quarters[:, place]].astype(np.int64) + place for place in range(4)])
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(np.tile(bits, 4))], names=["shard", "bits"])

    def join(shard: pd.DataFrame) -> pd.DataFrame:
        bits = shard["bits"].to_numpy()
        mask = _QUARTER[int(shard["shard"].iloc[0]) % 4]
        found = list(search(bits.view(np.uint64), np.ones(len(bits), bool), mask, near=0))
        u, v = (np.concatenate([np.zeros(0, np.int64), *side]) for side in (zip(*found, strict=True) if found else ((), ())))
        return pd.DataFrame({"u": bits[u], "v": bits[v]}).drop_duplicates()

    dealt = prints.select("bits").mapInArrow(deal, "shard long, bits long")
    return dealt.groupBy("shard").applyInPandas(join, "u long, v long")


def _groups(prints: DataFrame) -> DataFrame:
    """``(bits, label, component_id)``: for each distinct fingerprint its group and the smallest id in it."""
    distinct = cut(prints.groupBy("bits").agg(F.min("doc_id").alias("first")))
    groups = components(links(distinct)).toDF("bits", "component")
    labels = cut(distinct.join(groups, "bits", "left").select("bits", "first", F.coalesce("component", "bits").alias("label")))
    least = cut(labels.groupBy("label").agg(F.min("first").alias("component_id")))
    return cut(labels.join(least, "label").select("bits", "label", "component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``: the group of each document of ``docs``.

    Two documents link when their SimHash fingerprints over 3-word shingles differ in three bits or fewer;
    ``component_id`` is the smallest ``doc_id`` that links reach. Null, empty and wordless texts have fingerprint zero
    and link like any other. Rows may repeat; each row gives a row. A row without ``doc_id`` is linked, but never names
    a group: a group of such rows alone has a null ``component_id``. Other columns are not looked at.
    """
    prints = cut(fingerprints(docs))
    return prints.join(_groups(prints), "bits").select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id"
    )


def representatives(docs: DataFrame, words: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, that stay when one document of each group of near-duplicates stays.

    Groups are those of ``near_duplicates`` over shingles of ``words`` words. The document with the group's smallest
    id stays; of several texts under that id, or in a group without any id, the one with the smallest fingerprint and
    then text hash. Of equal rows one stays.
    """
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    version = unused(docs.columns, "version")
    named = docs.withColumn(version, key)
    prints = cut(fingerprints(docs, key, words))
    first = prints.join(_groups(prints), "bits").where("component_id is null or doc_id = component_id")
    first = first.groupBy("label").agg(F.min(F.struct("doc_id", "bits", "version")).alias("first"))
    kept = cut(first.select(F.col("first.doc_id").alias("kept_id"), F.col("first.version").alias("kept_version")))
    same = named["doc_id"].cast("long").eqNullSafe(kept["kept_id"]) & (named[version] == kept["kept_version"])
    return named.join(kept, same, "left_semi").dropDuplicates(["doc_id", version]).drop(version)
