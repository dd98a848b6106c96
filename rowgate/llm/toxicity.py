"""Toxicity: class-conditional Kneser-Ney models of the bytes in words, backing off to counts that the classes share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.llm.quality import crc_fold, logistic
from rowgate.llm.text import WORD, Hashes, joined, ragged, slices, tokens
from rowgate.storage import cut

#: Bytes in an n-gram of the highest order: the byte itself and those before it in its word, zeros before the word.
ORDER = 6
DISCOUNT = 0.75
#: About so many n-grams of words meet the table at a time: tens of megabytes in a task.
GRAMS = 1 << 19
_END = 0x20


def _words(column: pa.Array) -> Iterator[tuple]:
    """For runs of texts: first row, texts, bytes, hashes, starts and ends of the distinct words, and, for each word of
    each text once, its text and its number."""
    for first, texts in slices(column):
        data, off = joined(texts, lower=True)
        start, end, kind = tokens(data, off)
        start, end = start[kind == WORD], end[kind == WORD]
        value, one, number = np.unique(Hashes(data).of(start, end), return_index=True, return_inverse=True)
        doc = np.searchsorted(off, start, "right") - 1
        pair = np.unique(doc * len(value) + number) if len(value) else np.zeros(0, np.int64)
        width = max(len(value), 1)
        yield first, texts, data, value.view(np.int64), start[one], end[one], pair // width, pair % width


def grams(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram of highest order at each byte of each word and at its end, as one number, and the word of each."""
    size = end - start
    begin = np.cumsum(size + ORDER) - size - 1
    flat = np.zeros(int((size + ORDER).sum()), np.int64)
    flat[ragged(begin, size)] = data[ragged(start, size)]
    flat[begin + size] = _END
    gram = flat.copy()
    for back in range(1, ORDER):
        gram[back:] |= flat[:-back] << (8 * back)
    return gram[ragged(begin, size + 1)], np.repeat(np.arange(len(size)), size + 1)


def _vocabulary(docs: DataFrame) -> DataFrame:
    """``(word, ordinary, toxic)``: every word and in how many texts of each kind it is. Each word counts once in a
    text, so that what a text repeats does not outweigh other texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).fill_null(-1).to_numpy()
            for first, texts, data, _, start, end, doc, word in _words(batch.column(0)):
                kind = label[first : first + len(texts)][doc]
                per_word = [pa.array(np.bincount(word[kind == k], minlength=len(start))) for k in (0, 1)]
                off = np.append(0, np.cumsum(end - start)).astype(np.int32)
                flat = np.ascontiguousarray(data[ragged(start, end - start)])
                names = pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(off), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([names, *per_word], names=["word", "ordinary", "toxic"])

    rows = docs.mapInArrow(run, "word string, ordinary long, toxic long")
    return rows.groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def _count(words: DataFrame) -> DataFrame:
    """``(gram, ordinary, toxic)``: the counts of all n-grams of the highest order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = joined(batch.column(0))
            gram, owner = grams(data, off[:-1], off[1:])
            value, number = np.unique(gram, return_inverse=True)
            sums = [np.bincount(number, batch.column(k).to_numpy()[owner], len(value)).astype(np.int64) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array(value), *map(pa.array, sums)], names=["gram", "ordinary", "toxic"])

    rows = words.mapInArrow(run, "gram long, ordinary long, toxic long")
    return rows.groupBy("gram").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def _scored(words: DataFrame, table: DataFrame, per_block: int) -> DataFrame:
    """``(hash, ratio)`` of every word: the mean ratio in ``table`` of its n-grams of the highest order.

    Words are dealt by hash to blocks of about ``per_block`` n-grams. A block asks the table once for each n-gram, not
    once for each place of it, and sums the answers by word.
    """
    size = words.agg(F.sum(F.octet_length("word") + 1)).head()[0] or 1
    block = F.pmod(F.xxhash64("word"), F.lit(-(-size // per_block))).alias("block")
    words = words.select(block, "word")

    def of(rows: pa.Table) -> tuple[np.ndarray, ...]:
        data, off = joined(rows.column("word").combine_chunks())
        return data, off, *grams(data, off[:-1], off[1:])

    def asked(rows: pa.Table) -> pa.Table:
        gram = np.unique(of(rows)[2])
        return pa.table({"block": np.full(len(gram), rows.column("block")[0].as_py()), "gram": gram})

    def scored(rows: pa.Table, found: pa.Table) -> pa.Table:
        data, off, gram, owner = of(rows)
        found = found.sort_by("gram")
        ratio = found.column("ratio").to_numpy()[np.searchsorted(found.column("gram").to_numpy(), gram)]
        value = Hashes(data).of(off[:-1], off[1:]).view(np.int64)
        mean = np.bincount(owner, ratio, len(value)) / np.bincount(owner, minlength=len(value))
        return pa.table({"hash": value, "ratio": mean})

    found = words.groupBy("block").applyInArrow(asked, "block long, gram long").join(table, "gram")
    found = found.select("block", "gram", "ratio").groupBy("block")
    return words.groupBy("block").cogroup(found).applyInArrow(scored, "hash long, ratio double")


def _kept(count: str) -> F.Column:
    return F.greatest(F.col(count) - DISCOUNT, F.lit(0.0))


def _mass(count: str) -> F.Column:
    return F.sum(F.least(F.col(count), F.lit(DISCOUNT)))


def _tail(order: int) -> F.Column:
    return F.col("gram").bitwiseAND(F.lit((1 << 8 * order) - 1))


def _chances(counts: DataFrame) -> DataFrame:
    """``(tail, chance)`` of every n-gram of the order below the highest, by how many different bytes precede it, backed
    off to lower orders in the same way."""
    longer, seen = {}, counts.select("gram")
    for order in range(ORDER - 1, 0, -1):
        seen = longer[order] = cut(seen.select(_tail(order).alias("gram")).groupBy("gram").agg(F.count("*").alias("n")))
    chance = None
    for order in range(1, ORDER):
        rows = longer[order].withColumn("context", F.shiftright("gram", 8))
        rows = rows.join(rows.groupBy("context").agg(F.sum("n").alias("seen"), _mass("n").alias("mass")), "context")
        if chance is None:
            rows = rows.withColumn("before", F.lit(1 / 256))
        else:
            rows = rows.withColumn("tail", _tail(order - 1)).join(chance.withColumnRenamed("chance", "before"), "tail")
        found = (_kept("n") + F.col("mass") * F.col("before")) / F.col("seen")
        chance = cut(rows.select(F.col("gram").alias("tail"), found.alias("chance")))
    return chance


def fit(docs: DataFrame) -> DataFrame:
    """``(hash, ratio)`` of every word of ``docs``: toxic minus ordinary log-likelihood, divided by its bytes and end.

    Class counts of the highest order come from texts whose ``toxic`` is not null, and backoff counts, of how many
    different bytes precede an n-gram, from all. Every n-gram has its own counts, in tables that grow with the corpus.
    """
    words = cut(_vocabulary(docs.select("text", "toxic")))
    counts = cut(_count(words))
    rows = counts.withColumn("context", F.shiftright("gram", 8)).withColumn("tail", _tail(ORDER - 1))
    sums = []
    for kind in ("ordinary", "toxic"):
        sums += [F.sum(kind).alias(f"{kind}_n"), _mass(kind).alias(f"{kind}_mass")]
    rows = rows.join(cut(rows.groupBy("context").agg(*sums)), "context").join(_chances(counts), "tail")
    logs = []
    for kind in ("toxic", "ordinary"):
        found = (_kept(kind) + F.col(f"{kind}_mass") * F.col("chance")) / F.col(f"{kind}_n")
        logs.append(F.log(F.when(F.col(f"{kind}_n") > 0, found).otherwise(F.col("chance"))))
    table = cut(rows.select("gram", (logs[0] - logs[1]).alias("ratio")))
    return cut(_scored(words, table, GRAMS))


def dealt(table: DataFrame, per_block: int) -> list[Broadcast]:
    """Hashes in order and ratios, in as many blocks as the table needs: a task holds one at a time."""
    blocks = -(-table.count() // per_block)
    out = []
    for block in range(blocks):
        part = table.where(F.pmod(F.xxhash64("hash"), F.lit(blocks)) == block).toArrow().sort_by("hash")
        columns = part["hash"].to_numpy(), part["ratio"].to_numpy()
        out.append(table.sparkSession.sparkContext.broadcast(columns))
    return out


def ratios(column: pa.Array, blocks: list[Broadcast], words: int = 3) -> np.ndarray:
    """For each text the mean ratio of its ``words`` most toxic distinct words; 0 for a text without words."""
    out = np.zeros(len(column))
    parts = [(first, value, doc, word, np.zeros(len(value))) for first, _, _, value, _, _, doc, word in _words(column)]
    for block in blocks:
        known, found = block.value
        if len(known):
            for _, value, _, _, ratio in parts:
                at = np.minimum(np.searchsorted(known, value), len(known) - 1)
                hit = known[at] == value
                ratio[hit] = found[at[hit]]
        del known, found
        if len(blocks) > 1:
            block.__dict__.pop("_value", None)  # read again from the executor's disk when next needed
    for first, _, doc, word, by_word in parts:
        if len(doc):
            ratio = by_word[word]
            order = np.lexsort((-ratio, doc))
            doc, ratio = doc[order], ratio[order]
            some, lead, count = np.unique(doc, return_index=True, return_counts=True)
            rank = np.arange(len(doc)) - np.repeat(lead, count)
            top = rank < words
            sums = np.bincount(doc[top], ratio[top], int(some[-1]) + 1)[some]
            out[first + some] = sums / np.minimum(count, words)
    return out


def _beside(docs: DataFrame, labels: DataFrame, how: str, most: int) -> DataFrame:
    """``docs`` with their labels. At most ``most`` labels are broadcast; more of them are joined by a shuffle."""
    if labels.count() <= most:
        labels = F.broadcast(labels)
    return docs.join(labels, docs["doc_id"] == labels["doc"], how).select("doc_id", "text", "toxic")


def curve(docs: DataFrame, labels: DataFrame, model: list[Broadcast], rows: int) -> tuple[float, float]:
    """Slope and offset of the logistic curve that fits the ratios of at most ``rows`` documents with labels."""
    sample = labels.orderBy(F.xxhash64("doc"), "doc").limit(rows)
    known = _beside(docs, sample, "inner", rows)
    found = _ratios(known, model).select("toxic", "ratio").toPandas()
    if found["toxic"].nunique() < 2:
        return 0.0, float(np.log((found["toxic"].sum() + 1) / ((found["toxic"] == 0).sum() + 1)))
    found = found.sort_values(["ratio", "toxic"])
    return logistic(found["ratio"].to_numpy(), found["toxic"].to_numpy().astype(float))


def _ratios(docs: DataFrame, model: list[Broadcast]) -> DataFrame:
    """All columns of ``docs`` but ``text``, and ``ratio``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index("text")
            ratio = pa.array(ratios(batch.column(at), model))
            rest = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in rest), ratio], names=[*(batch.schema.names[i] for i in rest), "ratio"]
            )

    given = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name != "text")
    return docs.mapInArrow(run, f"{given}ratio double")


def assess(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    held: int = 0,
    curve_rows: int = 20000,
    near_labels: int = 1_000_000,
    per_block: int = 1 << 20,
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each row of ``docs``.

    Two Kneser-Ney models, of toxic and of ordinary documents, give each byte of a word its likelihood after the bytes
    before it in the word. They differ in the counts of the highest order only; rare expressions fall back on counts
    that both share, taken over all of ``docs``, labelled or not. A word's ratio is the difference of its two
    log-likelihoods, divided by its length, and a text's is the mean over its three most toxic words. A logistic curve, fitted on at most
    ``curve_rows`` labelled documents, turns ratios into scores; everything else is learned from all rows. Ratios of
    words are broadcast in blocks of ``per_block``, however many there are.

    Labels of the fold ``held`` are never read; of several labels of one document the highest counts. Null, empty and
    wordless texts have ratio 0. Rows without ``doc_id`` are scored like any other, have no label and are not held
    out. Without labels of both kinds all scores are equal.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    learn = labels.where("doc_id is not null and toxic is not null").where(crc_fold(F.col("doc_id"), folds) != held)
    learn = learn.groupBy(F.col("doc_id").cast("long").alias("doc")).agg(F.max("toxic").cast("int").alias("toxic"))
    learn = cut(learn)
    model = dealt(fit(_beside(docs, learn, "left", near_labels)), per_block)
    slope, offset = curve(docs, learn, model, curve_rows)
    score = 1 / (1 + F.exp(-(F.lit(slope) * F.col("ratio") + F.lit(offset))))
    out = F.coalesce(crc_fold(F.col("doc_id"), folds) == held, F.lit(False))
    scored = _ratios(docs, model).select("doc_id", out.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
