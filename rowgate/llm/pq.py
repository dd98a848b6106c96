"""Near-duplicate embeddings: inverted lists with product-quantised residuals and an exact cosine at the end."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.llm.graph import components
from rowgate.storage import cut

_SLACK = 1e-4


def _lloyd(points: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centres = points[rng.choice(len(points), k, replace=False)].copy()
    for _ in range(rounds):
        nearest = np.concatenate(
            [_squares(points[i : i + 4096], centres).argmin(1) for i in range(0, len(points), 4096)]
        )
        order = np.argsort(nearest, kind="stable")
        some, first = np.unique(nearest[order], return_index=True)
        size = np.diff(np.append(first, len(order)))[:, None]
        centres[some] = np.add.reduceat(points[order], first, axis=0) / size
    return centres


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, not below zero."""
    d = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]
    return np.maximum(d, 0)


def _margins(centres: np.ndarray, rest: np.ndarray, home: np.ndarray) -> np.ndarray:
    """How much of a step may go along the line between two centres: four times the usual part, at most all of it.

    The usual part is the root of the residuals' share of variance along that line: of all residuals, or of those in
    either list, whichever is most. Where residuals have no special direction it is 1 / sqrt(dim).
    """
    spread = rest.T @ rest
    total = max(float(np.trace(spread)), 1e-300)
    share = np.zeros((len(centres),) * 2, np.float32)
    for i in range(len(centres)):
        line = centres - centres[i]
        line /= np.maximum(np.sqrt((line**2).sum(1)), 1e-300)[:, None]
        own = rest[home == i]
        here = ((own @ line.T) ** 2).sum(0) / max(float((own**2).sum()), 1e-300)
        share[i] = np.maximum(((line @ spread) * line).sum(1) / total, here)
    return np.minimum(1, 4 * np.sqrt(np.maximum(share, share.T)))


@dataclass
class Index:
    """Centres of the lists and the codewords of each subspace. Its size depends on its settings, not on the table."""

    centres: np.ndarray
    spaces: list[np.ndarray]
    books: list[np.ndarray]
    reach: float
    margins: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int, subspaces: int, codes: int, reach: float, margin: float | None) -> Index:
        """Fit on unit vectors."""
        rng = np.random.default_rng(3)
        centres = _lloyd(sample, min(lists, len(sample)), 8, rng)
        home = _squares(sample, centres).argmin(1)
        rest = sample - centres[home]
        spaces = np.array_split(np.arange(sample.shape[1]), min(subspaces, sample.shape[1]))
        books = [_lloyd(rest[:, s], min(codes, len(rest)), 6, rng) for s in spaces]
        margins = np.full((len(centres),) * 2, margin, np.float32) if margin is not None else _margins(centres, rest, home)
        return cls(centres, spaces, books, reach, margins)

    def probes(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's own list, and which lists with smaller numbers may hold a partner of it.

        A partner within ``reach`` that lies in list j is nearer to centre j than to this vector's centre, so the
        plane half way between the two centres is at most ``reach`` away. Lists farther than that cannot matter, and
        lists whose plane is farther than ``reach`` times the margin of the two lists are not probed.
        """
        squares = _squares(unit, self.centres)
        home = squares.argmin(1)
        gap = np.sqrt(_squares(self.centres, self.centres))[home]
        ahead = squares - squares[np.arange(len(unit)), home][:, None]
        visit = ahead <= 2 * gap * (self.margins[home] * self.reach + _SLACK) + _SLACK
        visit &= np.arange(len(self.centres))[None, :] < home[:, None]
        return home, visit

    def encode(self, unit: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One code for each subspace of the residual, and the distance between a vector and what its codes stand for."""
        rest = unit - self.centres[home]
        codes = np.zeros((len(unit), len(self.spaces)), np.uint8)
        wrong = np.zeros(len(unit))
        for m, (space, book) in enumerate(zip(self.spaces, self.books, strict=True)):
            codes[:, m] = _squares(rest[:, space], book).argmin(1)
            wrong += ((rest[:, space] - book[codes[:, m]]) ** 2).sum(1)
        return codes, np.sqrt(wrong)

    def tables(self, unit: np.ndarray, number: int) -> list[np.ndarray]:
        """For each subspace: squared distance of each codeword (rows) to each vector (columns), in one list."""
        rest = unit - self.centres[number]
        return [_squares(book, rest[:, space]).astype(np.float32) for space, book in zip(self.spaces, self.books, strict=True)]


def _vectors(blobs: pa.Array | pd.Series, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and unit vectors, in double precision."""
    raw = np.frombuffer(b"".join(blobs), "<f4").reshape(-1, dim).astype(np.float64)
    return raw, raw / np.sqrt((raw**2).sum(1))[:, None]


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, blob)``: the bytes of each vector; null where it is null, empty, zero or has a null or non-finite part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = []
            for row in batch.column(1):
                values = row.as_py() if row.is_valid else None
                blob = None
                if values and None not in values:
                    x = np.array(values, "<f4")
                    if np.isfinite(x).all() and x.any():
                        blob = x.tobytes()
                blobs.append(blob)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], names=["vec_id", "blob"])

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>")).mapInArrow(
        run, "vec_id long, blob binary"
    )


def _links_of(
    distinct: DataFrame, dim: int, least: float, per_list: int, chunk: int, sample: int, margin: float | None
) -> DataFrame:
    """``(node, links, root)`` parts for vectors of one length: links found in a task, and a node of the same group."""
    spark = distinct.sparkSession
    total = distinct.count()
    rows = distinct.select("blob").orderBy(F.xxhash64("blob"), "blob").limit(sample).collect()
    unit = _vectors([row["blob"] for row in rows], dim)[1]
    lists = max(1, min(total // per_list, len(rows) // 8, 4096))
    index = Index.fit(unit, lists, 8, 256, float(np.sqrt(2 - 2 * least)), margin)
    shared = spark.sparkContext.broadcast(index)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((len(shared.value.centres), 2), np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                home, visit = shared.value.probes(_vectors(batch.column(0).slice(i, 1024).to_pylist(), dim)[1])
                count[:, 0] += np.bincount(home, minlength=len(count))
                count[:, 1] += visit.sum(0)
        number = np.arange(len(count))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (number, *count.T)], names=["list", "homes", "visits"])

    counts = distinct.select("blob").mapInArrow(sizes, "list long, homes long, visits long")
    counts = counts.groupBy("list").agg(F.sum("homes").alias("homes"), F.sum("visits").alias("visits")).collect()
    # Homes and visitors of a list come in chunks. Task (list, a, b) compares home chunk a with home chunk b >= a, or
    # with the visitors' chunk b - homes. A list of usual size is one task, of whatever kind its rows are.
    split = np.ones((lists, 2), np.int64)
    for row in counts:
        split[row["list"]] = -(-row["homes"] // chunk), -(-row["visits"] // chunk)
    split = np.maximum(split, (1, 0))
    base = np.cumsum(split[:, 0] * split.sum(1)) - split[:, 0] * split.sum(1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                node, weight = part.column(0).to_numpy(), part.column(1).to_numpy()
                unit = _vectors(part.column(2).to_pylist(), dim)[1]
                home, visit = shared.value.probes(unit)
                codes, wrong = shared.value.encode(unit, home)
                at, to = np.nonzero(visit)
                who, where = np.concatenate([np.arange(len(node)), at]), np.concatenate([home, to])
                own = np.arange(len(who)) < len(node)
                homes, visits = split[where].T
                mine = (node[who] * 2654435761 >> 7) % np.where(own, homes, np.maximum(visits, 1))
                task, seat, row = [], [], []
                for other in range(int((homes + visits).max())):
                    # A home row of chunk a meets every chunk; a visitor's row meets every home chunk.
                    use = np.flatnonzero(other < np.where(own, homes + visits, homes))
                    mate = np.full(len(use), other)
                    a = np.where(own[use], np.where(mate < homes[use], np.minimum(mine[use], mate), mine[use]), mate)
                    b = np.where(own[use], np.where(mate < homes[use], np.maximum(mine[use], mate), mate), homes[use] + mine[use])
                    task.append(base[where[use]] + a * (homes + visits)[use] + b)
                    seat.append(np.where(a == b, 2, np.where(own[use] & (mine[use] == a), 0, 1)))
                    row.append(use)
                task, seat, row = (np.concatenate(x) for x in (task, seat, row))
                who, where = who[row], where[row]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(task),
                        pa.array(where),
                        pa.array(seat.astype(np.int32)),
                        pa.array(node[who]),
                        pa.array(weight[who]),
                        part.column(2).take(pa.array(who)),
                        pa.array([c.tobytes() for c in codes[who]], pa.binary()),
                        pa.array(wrong[who]),
                    ],
                    names=["task", "list", "seat", "node", "weight", "blob", "codes", "wrong"],
                )

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        index = shared.value
        rows = rows.sort_values("node", kind="stable").reset_index(drop=True)
        raw, unit = _vectors(rows["blob"], dim)
        norm = np.sqrt((raw**2).sum(1))
        seat = rows["seat"].to_numpy()
        alone = bool((seat == 2).all())
        base, seek = np.flatnonzero(seat != 1), np.flatnonzero(seat != 0)
        if not len(base) or not len(seek):
            return pd.DataFrame({"node": [], "links": [], "root": []}, dtype=np.int64)
        codes = np.frombuffer(b"".join(rows["codes"].to_numpy()[base]), np.uint8).reshape(len(base), -1)
        far = (index.reach + _SLACK + rows["wrong"].to_numpy()[base]) ** 2
        number = int(rows["list"].iloc[0])
        weight = rows["weight"].to_numpy()
        links, label = np.zeros(len(rows), np.int64), np.arange(len(rows))
        for i in range(0, len(seek), 256):
            here = seek[i : i + 256]
            near = np.zeros((len(base), len(here)), np.float32)
            for m, table in enumerate(index.tables(unit[here], number)):
                near += table[codes[:, m]]
            near = near <= far[:, None]
            found = np.flatnonzero(near.any(1))
            if not len(found):
                continue
            dots = raw[base[found]] @ raw[here].T
            hit = near[found] & (dots >= least * norm[base[found]][:, None] * norm[here][None, :])
            hit &= base[found][:, None] != here[None, :]
            links[here] += weight[base[found]] @ hit
            if not alone:
                links[base[found]] += hit @ weight[here]
            for column in np.flatnonzero(hit.any(0)):
                group = np.unique(label[np.append(base[found[hit[:, column]]], here[column])])
                if len(group) > 1:
                    label[np.isin(label, group)] = group[0]
        linked = np.flatnonzero(links)
        node = rows["node"].to_numpy()
        return pd.DataFrame({"node": node[linked], "links": links[linked], "root": node[label[linked]]})

    dealt = distinct.select("node", "weight", "blob").mapInArrow(
        deal,
        "task long, list long, seat int, node long, weight long, blob binary, codes binary, wrong double",
    )
    return dealt.groupBy("task").applyInPandas(compare, "node long, links long, root long")


def near_duplicates(
    vectors: DataFrame,
    least: float = 0.95,
    per_list: int = 512,
    chunk: int = 8192,
    sample: int = 16384,
    margin: float | None = None,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row of ``vectors``.

    Two rows link when the cosine of their vectors, in double precision, is at least ``least``. The index is fitted on
    at most ``sample`` distinct vectors and holds all of them. Coded distances are used less each code's known error,
    and every pair that is left gets its exact cosine, so within the probed lists no link is lost. Lists are probed
    ``margin`` times as far as a partner can lie: 1 is exact. By default each pair of lists has its own margin, four times
    the usual part of a step along the line between their centres, as far as the sample shows it. Equal vectors are one node with a weight. Long lists are dealt to several tasks in chunks.

    A vector that is null, empty, zero, or has a null or non-finite part links with nothing, and neither do vectors of
    different lengths. Each row gives a row, repeated or not. A row without ``vec_id`` counts as a link of others, but
    names no group and is never kept. Other columns are not looked at.
    """
    rows = cut(usable(vectors))
    distinct = rows.where("blob is not null").groupBy("blob")
    distinct = distinct.agg(F.min("vec_id").alias("first"), F.count("*").alias("weight"))
    distinct = cut(distinct.withColumn("node", F.monotonically_increasing_id()))
    sizes = [row[0] for row in distinct.select(F.octet_length("blob").alias("n")).distinct().orderBy("n").collect()]
    parts = None
    for size in sizes:
        found = _links_of(distinct.where(F.octet_length("blob") == size), size // 4, least, per_list, chunk, sample, margin)
        parts = found if parts is None else parts.unionByName(found)
    if parts is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    parts = cut(parts)
    groups = components(parts.select(F.col("node").alias("u"), F.col("root").alias("v")))
    links = parts.groupBy("node").agg(F.sum("links").alias("links"))
    labels = cut(
        distinct.select("node", "blob", "first", "weight")
        .join(links, "node", "left")
        .join(groups, "node", "left")
        .select(
            "blob",
            "first",
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("label"),
        )
    )
    least_id = cut(labels.groupBy("label").agg(F.min("first").alias("group_id")))
    named = cut(labels.join(least_id, "label").select("blob", "n_links", "group_id"))
    out = rows.join(named, "blob", "left")
    component = F.when(F.col("blob").isNull(), F.col("vec_id")).otherwise(F.col("group_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
