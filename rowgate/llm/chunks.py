"""Repeated passages: content-defined chunks, cut by a gear hash and deduplicated by digest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.llm.text import SPACE, KIND, joined, mix, slices, unused
from rowgate.storage import cut

#: The gear: a 16-bit value for each byte, from a rule. Shifted by one bit a byte, a value is gone after 16 bytes.
GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: sum of GEAR[b] << age over the last 16 bytes, in doubling steps."""
    h = GEAR[data]
    for width in (1, 2, 4, 8):
        older = np.zeros_like(h)
        older[width:] = h[:-width]
        h = h + (older << np.uint16(width))
    return h


def cuts(data: np.ndarray, off: np.ndarray, bits: int, least: int, most: int) -> np.ndarray:
    """Where chunks begin, with the end of the last one.

    A chunk may end after a byte whose hash has ``bits`` leading zeros, moved to the next start of a word (to the next
    character where no word starts within 32 bytes), so cuts depend on the text around them alone. Cuts closer than
    ``least`` bytes to the one before are left out, and pieces over ``most`` bytes are cut evenly, between characters.
    """
    found = np.flatnonzero(gear(data) >> np.uint16(16 - bits) == 0) + 1
    text = np.searchsorted(off, found, "left") - 1
    # The first 15 hashes of a text hold bytes of the one before it.
    full = found - off[text] >= 16
    found, stop = found[full], off[text[full] + 1]
    letter = np.flatnonzero((data & 0xC0) != 0x80)
    letter = np.append(letter, len(data))
    word = np.flatnonzero((KIND[data[1:]] != SPACE) & (KIND[data[:-1]] == SPACE)) + 1
    word = np.append(word, len(data))
    to_word = word[np.searchsorted(word, found)]
    to_letter = letter[np.searchsorted(letter, found)]
    found = np.minimum(np.where(to_word - found <= 32, to_word, to_letter), stop)
    wide = np.unique(np.concatenate([off, found]))
    gap = np.diff(wide)
    long = np.flatnonzero(gap > most)
    if len(long):
        more = [np.arange(a + most, b, most) for a, b in zip(wide[long], wide[long + 1], strict=True)]
        wide = np.unique(np.append(wide, letter[np.searchsorted(letter, np.concatenate(more))]))
    forced = np.zeros(len(wide), bool)
    forced[np.searchsorted(wide, off)] = True
    out, last = [], -least
    for place, edge in zip(wide.tolist(), forced.tolist(), strict=True):
        if edge or place - last >= least:
            out.append(place)
            last = place
    return np.array(out, np.int64)


def keyed(docs: DataFrame) -> DataFrame:
    """Documents with the key ``(doc_id, version)``: rows with equal id and text are one document."""
    return docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("version"), F.col("text").cast("string")
    )


def chunks(docs: DataFrame, bits: int, least: int, most: int) -> DataFrame:
    """``(digest, doc_id, version, place, size)`` of every chunk of every text; places and sizes are in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for first, texts in slices(batch.column(2)):
                data, off = joined(texts)
                if not len(data):
                    continue
                edge = cuts(data, off, bits, least, most)
                start, end = edge[:-1], edge[1:]
                owner = np.searchsorted(off, start, "right") - 1
                view = memoryview(np.ascontiguousarray(data))
                value = [digest(view[a:b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)]
                row = pa.array(first + owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array(value, np.uint64).view(np.int64)),
                        batch.column(0).take(row),
                        batch.column(1).take(row),
                        pa.array((start - off[owner]).astype(np.int32)),
                        pa.array((end - start).astype(np.int32)),
                    ],
                    names=["digest", "doc_id", "version", "place", "size"],
                )

    return keyed(docs).mapInArrow(run, "digest long, doc_id long, version long, place int, size int")


def repeats(docs: DataFrame, bits: int = 5, least: int = 16, most: int = 1024) -> DataFrame:
    """``(doc_id, version, pieces)``: the chunks of each document that occur before, in order of (doc_id, version, place).

    Per digest the first place is a minimum, combined before the shuffle, so a chunk in a third of all documents makes
    one row for each task. Its other places are found by a join with the written minima, which can be split.
    """
    every = chunks(docs, bits, least, most)
    where = F.struct("doc_id", "version", "place")
    firsts = every.groupBy("digest").agg(F.min(where).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = cut(firsts.select("digest", "first"))
    again = every.join(firsts, "digest").where(~where.eqNullSafe(F.col("first")))
    again = cut(again.select("doc_id", "version", "place", "size"))
    return again.groupBy("doc_id", "version").agg(F.array_sort(F.collect_set(F.struct("place", "size"))).alias("pieces"))


def _runs(pieces: np.ndarray, least: int) -> list[tuple[int, int]]:
    runs: list[list[int]] = []
    for place, size in pieces:
        if runs and place == runs[-1][1]:
            runs[-1][1] = place + size
        else:
            runs.append([place, place + size])
    return [(a, b) for a, b in runs if b - a >= least]


def deduplicate(docs: DataFrame, least_run: int = 64, bits: int = 5) -> DataFrame:
    """All columns of ``docs`` with repeated passages cut out of ``text``, and ``n_bytes``, ``n_removed``, ``spans``.

    Texts are cut into chunks of about 50 bytes. A chunk that also stands in a document with a smaller id, or earlier
    in the same one, is repeated; runs of neighbouring repeated chunks of ``least_run`` bytes or more are removed, so
    the first copy of a passage stays. An insertion changes the chunks around it only. ``spans`` lists the removed
    ``(begin, end)`` bytes of the original.

    Rows with equal ``doc_id`` and text are one document and are treated alike. Null texts stay null, with nothing to
    remove, and empty ones stay empty; a document repeated as a whole becomes empty. Rows without ``doc_id`` count as
    the first. Columns called ``n_bytes``, ``n_removed`` or ``spans`` are replaced; all others are kept.
    """
    dropped = [c for c in docs.columns if c in ("n_bytes", "n_removed", "spans")]
    docs = docs.drop(*dropped)
    key, doc, of, cuts_ = (unused(docs.columns, n) for n in ("key", "cut_id", "cut_version", "pieces"))
    found = repeats(docs, bits).toDF(doc, of, cuts_)
    version = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.withColumn(key, version)
    rows = rows.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (F.col(key) == F.col(of)), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts, pieces = batch.column(names.index("text")), batch.column(names.index(cuts_))
            text, size, removed, spans = [], [], [], []
            for i in range(batch.num_rows):
                value = texts[i].as_py()
                data = (value or "").encode()
                gone = []
                if pieces[i].is_valid:
                    listed = pieces[i].values
                    gone = _runs(zip(listed.field(0).to_pylist(), listed.field(1).to_pylist(), strict=True), least_run)
                kept, at = [], 0
                for a, b in gone:
                    kept.append(data[at:a])
                    at = b
                text.append(b"".join([*kept, data[at:]]).decode() if gone else value)
                size.append(len(data))
                removed.append(sum(b - a for a, b in gone))
                spans.append([{"begin": a, "end": b} for a, b in gone])
            out = dict(zip(names, batch.columns, strict=True))
            out |= {"text": pa.array(text, pa.string()), "n_bytes": pa.array(size, pa.int64()), "n_removed": pa.array(removed, pa.int64())}
            out["spans"] = pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))
            order = [*columns, "n_bytes", "n_removed", "spans"]
            yield pa.RecordBatch.from_arrays([out[c] for c in order], names=order)

    columns = docs.columns
    given = ", ".join(f"`{f.name}` {'string' if f.name == 'text' else f.dataType.simpleString()}" for f in docs.schema)
    schema = f"{given}, n_bytes long, n_removed long, spans array<struct<begin: long, end: long>>"
    return rows.select(*(f"`{c}`" for c in columns), cuts_).mapInArrow(run, schema)
