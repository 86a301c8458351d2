"""Approximate nearest neighbours by largest cosine with an inverted multi-index.

The two halves of the unit vectors have a codebook each, fitted by k-means on a bounded sample
(``SAMPLE`` vectors with the smallest hash of their id). A pair of centroids is a cell; all vectors
are stored by cell. A query walks the cells by the sum of its two halves' distances, nearest
first, with a heap, until the cells hold ``share`` of all vectors. Its entries there are reranked
by exact cosine on the original vectors in double precision.

Queries are taken in blocks of ``BLOCK``; a block and the cells that each query visits (one bit
per cell) are broadcast, and one pass over the stored cells keeps the best ``k`` per query and
task. So a cell of any size is spread over many tasks, and tasks send ``k`` rows per query.

``share`` is 0.5: neighbours in the given tables are nearly random vectors, of which half must be
seen for a recall above 0.9 (measured in the tests). Vectors null, zero, with null or non-finite
components, or of another length than most of the sample take no part. A candidate is any
row with another id than the query's; repeated rows are candidates of their own. A null id is
neither query nor candidate. Ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.session import staged

CENTROIDS = 32
SAMPLE = 20_000
ROUNDS = 12
SHARE = 0.5
BLOCK = 2048


@dataclass(frozen=True)
class Books:
    """Centroids of the first and the second half of a unit vector."""

    first: np.ndarray
    second: np.ndarray
    size: int

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.size // 2
        return _distances(unit[:, :half], self.first), _distances(unit[:, half:], self.second)

    def cells(self, unit: np.ndarray) -> np.ndarray:
        a, b = self.distances(unit)
        return a.argmin(1) * len(self.second) + b.argmin(1)


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return (x**2).sum(1)[:, None] - 2 * x @ centers.T + (centers**2).sum(1)


def _kmeans(x: np.ndarray, k: int) -> np.ndarray:
    x = np.unique(x, axis=0)
    k = min(k, len(x))
    centers = x[np.random.default_rng(0).choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        near = _distances(x, centers).argmin(1)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=k)
        centers = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centers)
    return centers


def _rows(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all of one length, as a matrix of doubles."""
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(1, keepdims=True) if x.size else 1.0  # squares of tiny or huge values stay finite
    x = x / scale
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def usable(vector: str | Column) -> Column:
    """Not null, not zero, all components finite."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def fit_books(vectors: DataFrame, vector: str = "embedding", sample: int = SAMPLE, centroids: int = CENTROIDS) -> Books | None:
    """Codebooks from at most ``sample`` vectors; None without any."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").select(vector).limit(sample).collect()
    lengths = [len(r[0]) for r in rows]
    if not rows:
        return None
    size = max(sorted(set(lengths)), key=lengths.count)
    unit = _unit(np.array([r[0] for r in rows if len(r[0]) == size], np.float64))
    half = size // 2
    return Books(_kmeans(unit[:, :half], centroids), _kmeans(unit[:, half:], centroids), size)


def walk(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, enough: float) -> np.ndarray:
    """Which cells to visit: pairs of centroids by summed distance until they hold ``enough`` rows."""
    order_a, order_b = np.argsort(a), np.argsort(b)
    visit, held = np.zeros(len(a) * len(b), bool), 0
    heap = [(a[order_a[0]] + b[order_b[0]], 0, 0)]
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = order_a[i] * len(b) + order_b[j]
        visit[cell] = True
        held += sizes[cell]
        # every pair is pushed once: down a column always, to the next column from the top row only
        if i + 1 < len(a):
            heapq.heappush(heap, (a[order_a[i + 1]] + b[order_b[j]], i + 1, j))
        if i == 0 and j + 1 < len(b):
            heapq.heappush(heap, (a[order_a[0]] + b[order_b[j + 1]], 0, j + 1))
    return visit


def _best(query: np.ndarray, ids: np.ndarray, unit: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest rows; every score is summed in the same order, so equal vectors tie exactly."""
    near = unit @ query
    near[ids == own] = -np.inf
    if len(near) > k:
        least = np.partition(near, len(near) - k)[len(near) - k]
        keep = np.flatnonzero(near >= least - 1e-9)
    else:
        keep = np.arange(len(near))
    keep = keep[ids[keep] != own]
    score = (unit[keep] * query).sum(1)
    order = np.lexsort((ids[keep], -score))[:k]
    return ids[keep][order], score[order]


def _search(shared, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, queries, visits = shared.value
        found: dict[int, list[tuple[float, int]]] = {}
        for batch in batches:
            cell = batch.column(0).to_numpy()
            ids, unit = batch.column(1).to_numpy(), _unit(_rows(batch.column(2)))
            cuts = np.flatnonzero(np.diff(cell, prepend=-1, append=-1))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                for q in np.flatnonzero(visits[:, cell[a] >> 3] >> (cell[a] & 7) & 1):
                    some, score = _best(queries[q], ids[a:b], unit[a:b], own[q], k)
                    mine = found.setdefault(int(q), [])
                    mine += zip((-score).tolist(), some.tolist(), strict=True)
                    if len(mine) > 64 * k:
                        found[int(q)] = heapq.nsmallest(k, mine)
        rows = [(int(own[q]), i, -s) for q, mine in found.items() for s, i in heapq.nsmallest(k, mine)]
        columns = list(zip(*rows, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
            ["query_id", "vec_id", "score"],
        )

    return search


def nearest(
    vectors: DataFrame, queries: Column, k: int = 5, vector: str = "embedding", share: float = SHARE, block: int = BLOCK
) -> DataFrame:
    """Per row of ``vectors`` for which ``queries`` holds: query_id, rank, vec_id, score of its ``k`` nearest."""
    spark = vectors.sparkSession
    sound = vectors.filter(F.col("vec_id").isNotNull() & usable(vector))
    books = fit_books(sound, vector)
    empty = "query_id long, rank int, vec_id long, score double"
    if books is None:
        return spark.createDataFrame([], empty)
    shared_books = spark.sparkContext.broadcast(books)

    @F.arrow_udf("int")
    def cell_of(column: pa.Array) -> pa.Array:
        return pa.array(shared_books.value.cells(_unit(_rows(column))), pa.int32()) if len(column) else pa.array([], pa.int32())

    sized = sound.filter(F.size(vector) == books.size).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    celled = sized.select(cell_of("v").alias("cell"), "vec_id", "v")
    # by cell and id: a large cell is cut into several parts
    stored = staged(celled.repartitionByRange("cell", F.xxhash64("vec_id")).sortWithinPartitions("cell", "vec_id"), "cells")
    sizes = np.zeros(len(books.first) * len(books.second), np.int64)
    for r in stored.groupBy("cell").count().collect():  # one row per cell
        sizes[r["cell"]] = r["count"]

    asked = staged(stored.filter(queries).select("vec_id", "v").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30))), "queries")
    blocks = max(1, -(-asked.count() // block))
    parts = []
    for i in range(blocks):
        rows = asked.filter(F.col("block") % blocks == i).select("vec_id", "v").collect()
        if not rows:
            continue
        unit = _unit(np.array([r["v"] for r in rows], np.float64))
        a, b = books.distances(unit)
        own = np.array([r["vec_id"] for r in rows], np.int64)
        # rows of one id are in one block: besides them, at least k rows are visited
        copies = dict(zip(*np.unique(own, return_counts=True)))
        enough = [max(share * sizes.sum(), k + copies[i]) for i in own]
        visits = np.stack([walk(x, y, sizes, n) for x, y, n in zip(a, b, enough, strict=True)])
        data = spark.sparkContext.broadcast((own, unit, np.packbits(visits, axis=1, bitorder="little")))
        parts.append(stored.select("cell", "vec_id", "v").mapInArrow(_search(data, k), "query_id long, vec_id long, score double"))
    if not parts:
        return spark.createDataFrame([], empty)
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_query(embeddings: DataFrame) -> DataFrame:
    return nearest(embeddings, F.col("vec_id") % 50 == 0)
