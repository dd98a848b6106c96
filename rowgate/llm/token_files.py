"""Token ids in ORC files: written in document order, read by stripe, found by document id."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.llm.text import ragged, slices

#: Appended to every document.
END = 0

FILE_SCHEMA = "doc_id long, part int, part_start long, n_tokens int, ids array<int>"


@lru_cache(maxsize=4)
def _tokenizer(definition: str, literal: bool):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.encode_special_tokens = literal
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    names = tokenizer.get_vocab()
    spaced = np.zeros(max(names.values()) + 1, bool)
    for name, number in names.items():
        spaced[number] = name.startswith("Ġ")
    return tokenizer, spaced, [] if literal else added


def _encode_parts(tokenizer, spaced: np.ndarray, parts: list[str], block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each part after a space. Many parts go through the library as one text: a byte-level tokenizer starts a
    new token at every single space, so the token that begins with a space begins a part."""
    texts = [" " + " ".join(parts[i : i + block]) for i in range(0, len(parts), block)]
    ids = [np.array(e.ids, np.int32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    flat = np.concatenate([np.zeros(0, np.int32), *ids])
    start = np.flatnonzero(spaced[flat])
    if len(start) != len(parts):
        raise ValueError("the tokenizer does not begin a token at each single space")
    return flat, np.diff(np.append(start, len(flat)))


def _encode_whole(tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    ids = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    flat = np.concatenate([np.zeros(0, np.int32), *(np.array(x, np.int32) for x in ids)])
    return flat, np.array([len(x) for x in ids], np.int64)


def encode(column: pa.Array, definition: str, literal: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts with END after each text, and the number of ids of each text.

    Texts are cut at single spaces, and each distinct part goes through the tokenizer once. A text with white space
    next to a space, or at either end, goes through it as a whole. Unless ``literal``, the content of an added token
    (such as <|endoftext|>) is that token, as in the library's own defaults, and a text with one goes through whole too.
    """
    tokenizer, spaced, added = _tokenizer(definition, literal)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    lists = pc.split_pattern(column, " ")
    off = lists.offsets.to_numpy()
    values = lists.values.slice(off[0], off[-1] - off[0]).dictionary_encode()
    off = off - off[0]
    code = values.indices.to_numpy().astype(np.int64)
    parts = values.dictionary.to_pylist()
    odd = np.array([not part or part[0].isspace() or part[-1].isspace() for part in parts], bool)
    whole = np.logical_or.reduceat(odd[code], off[:-1]) if len(column) else np.zeros(0, bool)
    for content in added:
        whole = whole | pc.match_substring(column, content).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(column)), np.diff(off))
    later = np.ones(len(code), bool)
    later[off[:-1]] = False
    plain = later & ~whole[owner]
    used = np.unique(code[plain])
    part_ids, part_len = _encode_parts(tokenizer, spaced, [parts[i] for i in used.tolist()])
    lone = np.flatnonzero(whole)
    heads = np.flatnonzero(~whole)
    lone_ids, lone_len = _encode_whole(tokenizer, column.take(pa.array(lone)).to_pylist())
    head_ids, head_len = _encode_whole(tokenizer, [parts[i] for i in code[off[:-1]][heads].tolist()])
    # Entries: the distinct parts, whole texts, first parts, END. Each text is a run of entries.
    flat = np.concatenate([part_ids, lone_ids, head_ids, np.array([END], np.int32)])
    length = np.concatenate([part_len, lone_len, head_len, [1]]).astype(np.int64)
    start = np.cumsum(length) - length
    entry = np.full(len(parts), -1, np.int64)
    entry[used] = np.arange(len(used))
    first = np.zeros(len(column), np.int64)
    first[lone] = len(used) + np.arange(len(lone))
    first[heads] = len(used) + len(lone) + np.arange(len(heads))
    rank = np.concatenate([np.arange(len(column)) * 3, owner[plain] * 3 + 1, np.arange(len(column)) * 3 + 2])
    run = np.concatenate([first, entry[code[plain]], np.full(len(column), len(length) - 1)])
    order = np.argsort(rank, kind="stable")
    run, rank = run[order], rank[order]
    count = np.bincount(rank // 3, weights=length[run], minlength=len(column)).astype(np.int64)
    return flat[ragged(start[run], length[run])], count


def write(docs: DataFrame, path: str, definition: str, stripe_mb: int = 64, literal: bool = True) -> None:
    """Encode every text and write ``FILE_SCHEMA`` rows to ORC files at ``path``, in ascending order of ``doc_id``.

    ``definition`` is the tokenizer's JSON; with ``literal`` added tokens in a text are spelled out, without they are
    the tokens that a plainly loaded tokenizer gives, as ``op3_token_files`` has them. Texts are dealt by ranges of ``doc_id`` (a repeated id also by its text),
    so file k holds smaller ids than file k + 1, and each is sorted. Ids are integers, so ORC stores them with its
    run-length encoding. Row indexes and Bloom filters on ``doc_id`` let readers skip stripes and row groups. Null
    texts are empty and give END alone; rows without ``doc_id`` come first; repeated rows are all kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            for first, texts in slices(batch.column(2), 1 << 24):
                ids, count = encode(texts, definition, literal)
                end = np.cumsum(count)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, end).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        batch.column(1).slice(first, len(texts)),
                        pa.array(before + end - count),
                        pa.array(count.astype(np.int32)),
                        lists,
                    ],
                    names=["doc_id", "part", "part_start", "n_tokens", "ids"],
                )
                before += int(end[-1])

    keys = ["doc_id", F.xxhash64("text")]
    dealt = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    dealt = dealt.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = dealt.select("doc_id", F.spark_partition_id().alias("part"), "text").mapInArrow(run, FILE_SCHEMA)
    writer = rows.write.option("orc.compress", "zstd").option("orc.stripe.size", stripe_mb << 20)
    writer = writer.option("orc.row.index.stride", 1000).option("orc.create.index", "true")
    writer.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files. Spark splits large files, so stripes are read in parallel."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def find(spark: SparkSession, path: str, doc_ids: Iterable[int]) -> DataFrame:
    """The rows of some documents; file, stripe and row-group statistics and Bloom filters prune the rest."""
    return read(spark, path).where(F.col("doc_id").isin([int(i) for i in doc_ids]))


def starts(spark: SparkSession, path: str) -> DataFrame:
    """``(part, before)``: the ids in all earlier files. One row for each written partition."""
    totals = read(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    before = np.cumsum([0] + [row["n"] for row in totals])
    return spark.createDataFrame([(row["part"], int(b)) for row, b in zip(totals, before, strict=False)], "part int, before long")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of the files' documents; ``start`` counts all ids before a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            off = lists.offsets.to_numpy()
            ids = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
            crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.diff(off).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["doc_id", "part", "part_start", "n_tokens", "ids_crc32"],
            )

    rows = read(spark, path).select("doc_id", "part", "part_start", "ids")
    rows = rows.mapInArrow(run, "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long")
    # The offsets have one row for each written partition, which bounds what is broadcast.
    return rows.join(F.broadcast(starts(spark, path)), "part").select(
        "doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"
    )
