"""Exact substring deduplication: bytes covered by a repeated string of fixed length, found by suffix arrays.

Every string of ``length`` bytes has one anchor: the place inside it whose following bytes hash lowest, the first on a
tie. Equal strings have equal anchors, so the strings around one anchor hash, and no others, have to be compared. The
neighbouring strings of a text with the same anchor make one context, which is dealt twice: strings with at least half
of their other bytes before the anchor, and the others. All strings of such a part hold the bytes of that half beside the
anchor too, so parts that share a string also share this longer core, and the hash of the core is the key they meet under.
A core seen once has nothing repeated. Parts that are equal as a whole repeat all their strings. What is left, different
parts around one core, goes to shards, each with a suffix array of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.llm.chunks import keyed
from rowgate.llm.suffix import permuted_common_prefixes, suffix_array
from rowgate.llm.text import Hashes, joined, ragged, slices
from rowgate.storage import cut

_BLOCK = 1 << 22
_PLACE = np.uint64((1 << 23) - 1)


def contexts(data: np.ndarray, off: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Begin, end, anchor place and core hash of each part of a context of the texts."""
    half = (length - gram) // 2
    out: list[list[np.ndarray]] = [[], [], [], []]
    last = off[1:] - length
    doc_of = np.repeat(np.arange(len(off) - 1), np.diff(off))
    for base in range(0, max(len(data) - length + 1, 0), _BLOCK):
        part = data[base : base + _BLOCK + length - 1]
        hashes = Hashes(part)
        grams = hashes.rolling(gram)
        low = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        # The least of length - gram + 1 neighbours, from powers of two.
        width = 1
        while 2 * width <= length - gram + 1:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        rest = length - gram + 1 - width
        low = np.minimum(low[: len(low) - rest], low[rest:])
        anchor = (low & _PLACE).astype(np.int64)
        place = np.arange(base, base + len(anchor))
        doc = doc_of[base : base + len(anchor)]
        inside = place <= last[doc]
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(anchor))
        begin, end = begin[inside[begin]], end[inside[begin]]
        at = anchor[begin]
        # Strings that begin half or more before the anchor hold the bytes from there to the anchor's end.
        far = np.minimum(end, at - half + 1)
        near = np.maximum(begin, at - half + 1)
        for first, stop, low_end, high_end in ((begin, far, at - half, at + gram), (near, end, at, at + length - half + 1)):
            some = first < stop
            core = hashes.of(low_end[some], high_end[some])
            for column, values in zip(out, (base + first[some], base + stop[some] - 1 + length, base + at[some], core), strict=True):
                column.append(values)
    kinds = (np.int64, np.int64, np.int64, np.uint64)
    return tuple(np.concatenate([np.zeros(0, k), *c]) for c, k in zip(out, kinds, strict=True))


def _cores(keys: DataFrame, length: int, gram: int) -> DataFrame:
    """The core hash of every part, to be counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                core = contexts(*joined(texts), length, gram)[3]
                yield pa.RecordBatch.from_arrays([pa.array(core.view(np.int64))], names=["anchor"])

    return keys.select("text").mapInArrow(run, "anchor long")


def _contexts(keys: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for first, texts in slices(batch.column(2)):
                data, off = joined(texts)
                begin, end, anchor, hashes = contexts(data, off, length, gram)
                if not len(begin):
                    continue
                view = memoryview(np.ascontiguousarray(data))
                value = [
                    digest(view[a:b], c)
                    for a, b, c in zip(begin.tolist(), end.tolist(), (anchor - begin).tolist(), strict=True)
                ]
                owner = np.searchsorted(off, begin, "right") - 1
                row = pa.array(first + owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes.view(np.int64)),
                        pa.array(np.array(value, np.uint64).view(np.int64)),
                        batch.column(0).take(row),
                        batch.column(1).take(row),
                        pa.array((begin - off[owner]).astype(np.int32)),
                        pa.array((end - begin).astype(np.int32)),
                    ],
                    names=["anchor", "context", "doc_id", "version", "place", "size"],
                )

    return keys.mapInArrow(run, "anchor long, context long, doc_id long, version long, place int, size int")


def repeated_starts(parts: list[bytes], length: int) -> list[np.ndarray]:
    """For each part, where a string of ``length`` bytes begins that also begins elsewhere in these parts."""
    size = np.array([len(p) for p in parts], np.int64)
    text = np.zeros(int(size.sum()) + len(parts) + 1, np.int64)
    begin = np.cumsum(size + 1) - size - 1
    text[ragged(begin, size)] = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64) + 2
    text[begin + size] = 1
    order = suffix_array(text, 258)
    prefix = permuted_common_prefixes(text, order)
    longest = prefix.copy()
    longest[order[:-1]] = np.maximum(longest[order[:-1]], prefix[order[1:]])
    return [np.flatnonzero(np.minimum(longest[b : b + n], n - np.arange(n)) >= length) for b, n in zip(begin.tolist(), size.tolist(), strict=True)]


def _spread(places: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive numbers as (first, last)."""
    if not len(places):
        return []
    stop = np.flatnonzero(np.diff(places) != 1)
    return list(zip(places[np.append(0, stop + 1)].tolist(), places[np.append(stop, len(places) - 1)].tolist(), strict=True))


def _shard(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    rows = rows.drop_duplicates(["anchor", "context"])
    parts = rows["bytes"].tolist()
    out = []
    for (anchor, context, salted), part, found in zip(
        rows[["anchor", "context", "salted"]].itertuples(index=False, name=None), parts, repeated_starts(parts, length), strict=True
    ):
        out += [(anchor, context, a, b, None) for a, b in _spread(found)]
        if salted:
            # The group goes on in other shards: every string is also looked for there.
            out += [(anchor, context, a, a, hashlib.blake2b(part[a : a + length], digest_size=16).digest()) for a in range(len(part) - length + 1)]
    return pd.DataFrame(out, columns=["anchor", "context", "first", "last", "string"])


def spans(docs: DataFrame, length: int = 200, gram: int = 32, shard_rows: int = 1024, group_rows: int = 2048) -> DataFrame:
    """``(doc_id, version, spans)``: the repeated ranges of each document, as bytes, unsorted and overlapping.

    ``group_rows`` is the most parts of one core that go to one shard; larger groups are salted over several
    shards and their strings compared across shards by digest.
    """
    keys = keyed(docs)
    every = _contexts(keys, length, gram)
    again = _cores(keys, length, gram).groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    seen = cut(every.join(cut(again), "anchor"))
    where = F.struct("doc_id", "version", "place", "size")
    kinds = cut(seen.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(where).alias("one")))
    groups = cut(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    whole = kinds.where("n > 1").select(
        "anchor", "context", F.lit(0).alias("first"), (F.col("one.size") - length).alias("last")
    )
    mixed = cut(
        kinds.join(groups, "anchor").select(
            "anchor",
            "context",
            "kinds",
            F.col("one.doc_id").alias("doc_id"),
            F.col("one.version").alias("version"),
            F.col("one.place").alias("place"),
            F.col("one.size").alias("size"),
        )
    )
    shards = max(1, -(-mixed.count() // shard_rows))
    wanted = mixed.groupBy("doc_id", "version").agg(
        F.collect_list(F.struct("anchor", "context", "kinds", "place", "size")).alias("wanted")
    )
    wanted = wanted.select(F.col("doc_id").alias("_doc"), F.col("version").alias("_version"), "wanted")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("version") == F.col("_version"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = (batch.column(0)[i].as_py() or "").encode()
                ask = batch.column(1)[i].values
                anchor, context, kinds, place, size = (ask.field(k).to_numpy(zero_copy_only=False) for k in range(5))
                salt = np.where(kinds > group_rows, context % -(-kinds // group_rows), 0)
                hashed = (anchor ^ (salt * -7046029254386353131)).astype(np.int64)
                parts = [data[a : a + n] for a, n in zip(place.tolist(), size.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.mod(hashed, shards)),
                        pa.array(anchor),
                        pa.array(context),
                        pa.array(kinds > group_rows),
                        pa.array(parts, pa.binary()),
                    ],
                    names=["shard", "anchor", "context", "salted", "bytes"],
                )

    parts = keys.join(wanted, same).select("text", "wanted")
    parts = parts.mapInArrow(fetch, "shard long, anchor long, context long, salted boolean, bytes binary")
    found = cut(
        parts.groupBy("shard").applyInPandas(
            lambda rows: _shard(rows, length), "anchor long, context long, first int, last int, string binary"
        )
    )
    strings = found.where("string is not null")
    twice = cut(strings.groupBy("string").agg(F.count("*").alias("n")).where("n > 1").select("string"))
    across = strings.join(twice, "string")
    ranges = found.where("string is null").unionByName(across)
    ranges = cut(whole.unionByName(ranges.select("anchor", "context", "first", "last")))
    out = seen.join(ranges, ["anchor", "context"]).select(
        "doc_id",
        "version",
        F.struct(
            (F.col("place") + F.col("first")).alias("begin"), (F.col("place") + F.col("last") + length).alias("end")
        ).alias("span"),
    )
    return cut(out).groupBy("doc_id", "version").agg(F.collect_set("span").alias("spans"))


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges as maximal runs; ranges that touch are one run."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.append(True, begin[1:] > end[:-1])
    return begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def removals(docs: DataFrame, length: int = 200) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)`` for each row of ``docs``.

    A byte is removed when a string of ``length`` bytes that covers it also begins elsewhere, in this text or another;
    strings lie within one text and are judged on the input. ``spans`` has the removed runs as (begin, end) bytes.

    Null texts are empty; texts under ``length`` bytes keep everything. Rows may repeat: two rows with the same text
    repeat each other's strings, with the same or no ``doc_id`` too. Other columns are not looked at.
    """
    keys = keyed(docs)
    found = spans(docs, length).select(F.col("doc_id").alias("_doc"), F.col("version").alias("_version"), "spans")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("version") == F.col("_version"))
    rows = keys.join(found, same, "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, runs, kept, where = [], [], [], [], []
            for i in range(batch.num_rows):
                data = (batch.column(1)[i].as_py() or "").encode()
                begin = end = np.zeros(0, np.int64)
                if batch.column(2)[i].is_valid:
                    listed = batch.column(2)[i].values
                    begin, end = merged(*(listed.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(2)))
                rest, at = hashlib.sha256(), 0
                for a, b in zip(begin.tolist(), end.tolist(), strict=True):
                    rest.update(data[at:a])
                    at = b
                rest.update(data[at:])
                size.append(len(data))
                removed.append(int((end - begin).sum()))
                runs.append(len(begin))
                kept.append(rest.hexdigest())
                where.append([{"begin": a, "end": b} for a, b in zip(begin.tolist(), end.tolist(), strict=True)])
            spans_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(size, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(runs, pa.int64()),
                    pa.array(kept, pa.string()),
                    pa.array(where, spans_type),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    return rows.mapInArrow(
        run,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "spans array<struct<begin: long, end: long>>",
    )
