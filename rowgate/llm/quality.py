"""Document quality: n-gram indicators scaled by Naive Bayes log-count ratios, under a linear support vector machine."""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.llm.text import Hashes, joined, mix, slices, tokens

#: Hashed n-grams; the size of the model.
BITS = 20
COST = 1.0
#: N-grams of the training rows that are worked on at once.
_BLOCK = 1 << 20
_AGAIN = np.uint64(1)


def indicators(column: pa.Array, bits: int = BITS, limit: int = 1 << 19) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, row of each indicator, its number) for runs of texts; each n-gram of a text once, rows ascending.

    Tokens are lower-case words and runs of other signs; n-grams are tokens, pairs of neighbours, and a mark of its own
    where a token repeats the one before.
    """
    for first, texts in slices(column, limit):
        data, off = joined(texts, lower=True)
        start, end, _ = tokens(data, off)
        single = Hashes(data).of(start, end)
        doc = np.searchsorted(off, start, "right") - 1
        within = doc[1:] == doc[:-1]
        left, right = single[:-1][within], single[1:][within]
        pair = np.where(left == right, mix(_AGAIN + np.zeros_like(left)), mix(left * np.uint64(3) + right))
        number = np.concatenate([single, pair]) >> np.uint64(64 - bits)
        row = np.concatenate([doc, doc[1:][within]]).astype(np.uint64)
        both = np.unique((row << np.uint64(bits)) | number)
        yield first, (both >> np.uint64(bits)).astype(np.int64), (both & np.uint64((1 << bits) - 1)).astype(np.int64)


def _blocks(off: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows, first and last plus one, of at most ``_BLOCK`` n-grams, or of one row that has more."""
    start = 0
    while start < len(off) - 1:
        stop = max(start + 1, int(np.searchsorted(off, off[start] + _BLOCK, "right")) - 1)
        yield start, stop
        start = stop


def log_ratios(flat: np.ndarray, off: np.ndarray, good: np.ndarray, bad: np.ndarray, size: int, prior: float = 1.0) -> np.ndarray:
    """log of each indicator's smoothed share among the rows marked ``good`` over that among the rows marked ``bad``."""
    counts = []
    for chosen in (good, bad):
        count = np.zeros(size)
        for a, b in _blocks(off):
            count += np.bincount(flat[off[a] : off[b]][np.repeat(chosen[a:b], np.diff(off[a : b + 1]))], minlength=size)
        counts.append(count + prior)
    good, bad = counts
    seen = (good + bad) > 2 * prior
    return np.where(seen, np.log(good / good.sum()) - np.log(bad / bad.sum()), 0.0)


def _row_sums(flat: np.ndarray, off: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The sum over each row of the values of its n-grams."""
    sums = [np.zeros(0)]
    for a, b in _blocks(off):
        row = np.repeat(np.arange(b - a), np.diff(off[a : b + 1]))
        sums.append(np.bincount(row, value[flat[off[a] : off[b]]], b - a))
    return np.concatenate(sums)


def dual_descent(
    rows: Sequence[np.ndarray], label: np.ndarray, scale: np.ndarray, cost: float, rounds: int = 12
) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss machine with cost ``cost`` a row, one dual variable at a time.

    The values of a row are looked up at each visit, as keeping those of all rows takes more memory than the rows do.
    """
    weight, bias = np.zeros(len(scale)), 0.0
    alpha = np.zeros(len(label))
    square = np.array([(x := scale[at]) @ x for at in rows]) + 1.0
    rng = np.random.default_rng(5)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(label)):
            at, y = rows[i], label[i]
            x = scale[at]
            slope = y * (weight[at] @ x + bias) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), cost)
            step = (new - alpha[i]) * y
            if step:
                weight[at] += step * x
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step) * square[i] ** 0.5)
        if moved < 1e-3:
            break
    return weight, bias


def logistic(margin: np.ndarray, label: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and offset that turn margins into the likelihood of label 1, by Newton steps with a small ridge."""
    weight = np.ones(len(margin)) if weight is None else weight
    x = np.stack([margin, np.ones(len(margin))], 1)
    beta = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (label - p)) - 1e-3 * beta
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def train(flat: np.ndarray, off: np.ndarray, quality: np.ndarray, size: int = 1 << BITS) -> tuple[np.ndarray, float]:
    """One weight for each indicator and a bias; sigmoid(sum of weights + bias) is the likelihood of good quality.

    A fifth of the rows is kept from the machine and fits the slope that turns its margins into likelihoods.
    """
    label = np.where(quality > 0, 1.0, -1.0)
    check = np.arange(len(label)) % 5 == 4
    if len(np.unique(label[~check])) < 2 or len(np.unique(label[check])) < 2:
        share = (np.sum(label > 0) + 1) / (len(label) + 2)
        return np.zeros(size), float(np.log(share / (1 - share)))
    ratio = log_ratios(flat, off, ~check & (label > 0), ~check & (label <= 0), size)
    norm = np.sqrt(_row_sums(flat, off, ratio**2))
    keep = np.flatnonzero(~check & (norm > 0))
    rows = [flat[off[i] : off[i + 1]] for i in keep.tolist()]
    scale = ratio / np.median(norm[keep])
    weight, bias = dual_descent(rows, label[keep], scale, COST)
    value = weight * ratio / np.median(norm[keep])
    margin = _row_sums(flat, off, value) + bias
    slope, offset = logistic(margin[check], (label[check] > 0).astype(float))
    return slope * value, slope * bias + offset


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of an id written as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def fit(docs: DataFrame, labels: DataFrame, rows: int = 12000) -> tuple[np.ndarray, float]:
    """Weights and bias, fitted on at most ``rows`` documents with a label, taken in the order of a hash of their id.

    ``rows`` bounds what is sent to one task and what comes back; labels without a document don't count, and of several
    labels of one document the highest does.
    """
    sample = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("_labelled"))
        .agg(F.max("quality").cast("int").alias("_quality"))
        .orderBy(F.xxhash64("_labelled"), "_labelled")
        .limit(rows)
    )
    # The limit bounds what is broadcast.
    known = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").cast("string").alias("_text"))
    known = known.join(F.broadcast(sample), F.col("_doc") == F.col("_labelled"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                found = [(row + at, number.astype(np.int32)) for at, row, number in indicators(texts)]
                row, number = (np.concatenate(x) for x in zip(*found, strict=True))
                part = batch.slice(first, int(row[-1]) + 1 if len(row) else 0)
                count = np.bincount(row, minlength=part.num_rows)
                off = pa.array(np.append(0, np.cumsum(count)).astype(np.int32))
                lists = pa.ListArray.from_arrays(off, pa.array(number))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), lists], names=["doc", "quality", "seen"])

    def learn(found: pa.Table) -> pa.Table:
        doc = found.column("doc").to_numpy()
        _, first = np.unique(doc, return_index=True)
        order = first[mix(doc[first].view(np.uint64)).argsort(kind="stable")]
        rows = []
        for part in found.column("seen").chunks:
            off, number = part.offsets.to_numpy(), part.values.to_numpy()
            rows += [number[a:b] for a, b in zip(off[:-1], off[1:], strict=True)]
        rows = [rows[i] for i in order.tolist()]
        off = np.append(0, np.cumsum([len(r) for r in rows]))
        weight, bias = train(np.concatenate(rows), off, found.column("quality").to_numpy()[order])
        file = io.BytesIO()
        np.save(file, np.append(weight, bias).astype(np.float32))
        return pa.table({"model": pa.array([file.getvalue()], pa.binary())})

    seen = known.select("_doc", "_text", "_quality").mapInArrow(read, "doc long, quality int, seen array<int>")
    found = seen.groupBy(F.lit(0).alias("all")).applyInArrow(learn, "model binary").collect()
    if not found:
        return np.zeros(1 << BITS, np.float32), 0.0
    model = np.load(io.BytesIO(found[0]["model"]))
    return model[:-1], float(model[-1])


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """All columns of ``docs`` and ``score``: the likelihood that a text is of good quality.

    Null and empty texts have no indicator and get the score that the bias alone gives. A column ``score`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, bias = shared.value
        for batch in batches:
            names = batch.schema.names
            margin = np.full(batch.num_rows, bias, np.float64)
            for first, row, number in indicators(batch.column(names.index("text")).cast(pa.string())):
                if len(row):
                    sums = np.bincount(row, weight[number])
                    margin[first : first + len(sums)] += sums
            chance = pa.array(1 / (1 + np.exp(-np.clip(margin, -500, 500))))
            yield pa.RecordBatch.from_arrays([*batch.columns, chance], names=[*names, "score"])

    given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{given}, score double")


def assess(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, rows: int = 12000) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each row of ``docs``; learned from the labels outside one fold.

    Rows without ``doc_id`` are scored like any other and are not held out. Without usable labels every score is 0.5.
    """
    learn = labels.where(crc_fold(F.col("doc_id"), folds) != held)
    scored = score(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), fit(docs, learn, rows))
    out = F.coalesce(crc_fold(F.col("doc_id"), folds) == held, F.lit(False))
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
