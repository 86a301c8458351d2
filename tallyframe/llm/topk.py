"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

The vectors are packed into blocks as they are scanned. A block holds, per dimension, its rows
sorted by their value there. A query walks the lists of all dimensions at the same depth, from the
end that its own component favours, scores the rows it meets for the first time, and stops when no
row deeper in the lists can beat its kth result: the sum over the dimensions of query component times
list value at the depth reached bounds the score of every row not met yet. Each block gives a query's
``k`` best of the block, exactly, and the best of these are the result.

Queries are packed into blocks too and sent to every block of vectors, a stated set against all rows; no
block of vectors travels more than once. Memory of a task: one block of vectors and one of queries.

Scores are whole numbers. Where products could leave the range in which doubles are exact, the
block counts in Python's whole numbers; a score beyond a long counts as the nearest long, and then ties.

Rows without id, null vectors and those with a null or non-finite component take no part. A missing
component of a shorter vector counts as 0. A query meets every row of another id; of a query id that
stands in several rows, every row is asked for by itself, so it returns as many results of each rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.session import staged

#: Components per packed block of vectors and of queries: 4,096 and 256 rows of 64.
BLOCK_VALUES, QUERY_VALUES = 1 << 18, 1 << 14
#: Depth of the first step down the lists; each further step is twice as long.
FIRST_STEP = 16
#: Packed rows per Arrow batch.
BATCH_ROWS = 16

EXACT = float(1 << 53)
LONGS = (-(1 << 63), (1 << 63) - 1)
PACKED = "ids binary, cells binary, width int, orders binary"
FOUND = "query_row string, query_id long, vec_id long, score long"
EMPTY = "query_id long, rank int, vec_id long, score long"


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists without nulls as rows of whole doubles ``floor(256 * x)``, shorter ones filled with 0."""
    offsets = column.offsets.to_numpy()
    sizes = np.diff(offsets)
    values = np.floor(256.0 * column.values.to_numpy(zero_copy_only=False).astype(np.float64)[offsets[0] : offsets[-1]])
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    rows = np.zeros((len(sizes), width))
    rows[np.arange(width) < sizes[:, None]] = values
    return rows


def _widened(cells: np.ndarray, width: int) -> np.ndarray:
    return cells if cells.shape[1] == width else np.pad(cells, ((0, 0), (0, width - cells.shape[1])))


def _pack(values: int, lists: bool):
    """Rows of (vec_id, vector) as packed rows of at most ``values`` components, or one vector; with sorted lists if wanted."""

    def packed(ids: np.ndarray, cells: np.ndarray) -> pa.RecordBatch:
        orders = np.argsort(cells, axis=0, kind="stable").T.astype(np.int32) if lists else np.zeros(0, np.int32)
        columns = [ids.tobytes(), np.ascontiguousarray(cells).tobytes(), cells.shape[1], orders.tobytes()]
        kinds = [pa.binary(), pa.binary(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(columns, kinds)], ["ids", "cells", "width", "orders"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, cells = np.zeros(0, np.int64), np.zeros((0, 0))
        for batch in batches:
            more_ids, more = batch.column(0).to_numpy(), _matrix(batch.column(1))
            width = max(cells.shape[1], more.shape[1])
            ids, cells = np.concatenate([ids, more_ids]), np.concatenate([_widened(cells, width), _widened(more, width)])
            rows = max(1, values // max(width, 1))
            while len(ids) >= rows:
                yield packed(ids[:rows], cells[:rows])
                ids, cells = ids[rows:], cells[rows:]
        if len(ids):
            yield packed(ids, cells)

    return pack


_nearest_long = np.frompyfunc(lambda score: min(max(score, LONGS[0]), LONGS[1]), 1, 1)


def _long(score: np.ndarray):
    """Whole numbers of any size as the nearest longs; doubles are exact here and far from the limits."""
    return _nearest_long(score) if score.dtype == object else score


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Where the ``k`` best are, best first, ties to the smaller id."""
    if score.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-score[i], ids[i]))[:k], np.int64)
    keep = np.arange(len(ids))
    if len(ids) > k:
        keep = np.flatnonzero(score >= np.partition(score, len(ids) - k)[len(ids) - k])
    return keep[np.lexsort((ids[keep], -score[keep]))[:k]]


def top_of_block(
    query: np.ndarray, own: int, ids: np.ndarray, cells: np.ndarray, orders: np.ndarray, k: int
) -> list[tuple[int, int]]:
    """The ``k`` best (score, id) of a block by the threshold algorithm, best first, ties to the smaller id.

    ``orders`` has one row of row numbers per dimension, by rising value.
    """
    used = np.flatnonzero(query != 0)
    rising = query[used] > 0
    size, others = len(ids), ids != own
    seen = np.zeros(size, bool)
    best_score, best_id = np.zeros(0, cells.dtype), np.zeros(0, np.int64)
    start, step = 0, FIRST_STEP
    while start < size:
        if len(used):
            end = min(start + step, size)
            # a favoured dimension is walked from its largest value down, another one from its smallest up
            falling = orders[used, size - end : size - start][:, ::-1]
            met = np.where(rising[:, None], falling, orders[used, start:end])
            last = met[:, -1]
            fresh = met.ravel()
            fresh = np.unique(fresh[~seen[fresh]])
        else:
            end, fresh = size, np.arange(size)
        seen[fresh] = True
        fresh = fresh[others[fresh]]
        best_score = np.concatenate([best_score, _long(cells[fresh] @ query)])
        best_id = np.concatenate([best_id, ids[fresh]])
        keep = _best(best_score, best_id, k)
        best_score, best_id = best_score[keep], best_id[keep]
        start, step = end, step * 2
        # a row below the bound comes after the kth result, one that equals it may have a smaller id
        if len(best_id) == k and len(used) and best_score[-1] > _long(np.asarray((query[used] * cells[last, used]).sum(), cells.dtype)):
            break
        if seen.all():
            break
    return [(int(s), int(i)) for s, i in zip(best_score, best_id)]


def _search(k: int):
    """Packed rows sorted by place, vectors before queries: the best of each query per block of the place."""

    def unpack(row: int, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = np.frombuffer(batch.column("ids")[row].as_py(), np.int64)
        cells = np.frombuffer(batch.column("cells")[row].as_py(), np.float64).reshape(len(ids), batch.column("width")[row].as_py())
        return ids, cells, np.frombuffer(batch.column("orders")[row].as_py(), np.int32).reshape(-1, len(ids))

    def meet(block, name: str, ids: np.ndarray, cells: np.ndarray) -> Iterator[tuple[str, int, int, int]]:
        vec_ids, vectors, orders = block
        width = min(vectors.shape[1], cells.shape[1])
        vectors, queries, orders = vectors[:, :width], cells[:, :width], orders[:width]
        if np.abs(vectors).max(initial=0) * np.abs(queries).max(initial=0) * max(width, 1) >= EXACT:
            whole = np.frompyfunc(int, 1, 1)
            vectors, queries = whole(vectors), whole(queries)
        for i, own in enumerate(ids.tolist()):
            for score, vec_id in top_of_block(queries[i], own, vec_ids, vectors, orders, k):
                yield f"{name}/{i}", own, vec_id, score

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, []
        for batch in batches:
            found: list[tuple[str, int, int, int]] = []
            for row in range(batch.num_rows):
                here = batch.column("place")[row].as_py()
                if here != place:
                    place, held = here, []
                if batch.column("asks")[row].as_py():
                    ids, cells, _ = unpack(row, batch)
                    for block in held:
                        found += meet(block, batch.column("name")[row].as_py(), ids, cells)
                else:
                    held.append(unpack(row, batch))
            columns = list(zip(*found)) or [()] * 4
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], ["query_row", "query_id", "vec_id", "score"]
            )

    return search


def top_products(vectors: DataFrame, queries: Column, k: int = 5, vector: str = "embedding") -> DataFrame:
    """Per row of ``vectors`` for which ``queries`` holds: query_id, rank, vec_id, score of its ``k`` highest products."""
    spark = vectors.sparkSession
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = vectors.filter(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & finite)
    rows = [F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")]
    numbered = F.concat_ws("/", F.spark_partition_id(), F.monotonically_increasing_id()).alias("name")

    blocks = staged(sound.select(*rows).mapInArrow(_pack(BLOCK_VALUES, True), PACKED).select("*", numbered), "lists")
    asked = staged(sound.filter(queries).select(*rows).mapInArrow(_pack(QUERY_VALUES, False), PACKED).select("*", numbered), "asked")
    places = blocks.count()
    if not places or asked.isEmpty():
        return spark.createDataFrame([], EMPTY)
    # a few blocks may share a place; each place receives every block of queries
    dealt = blocks.withColumns({"place": F.pmod(F.xxhash64("name"), F.lit(places)), "asks": F.lit(False)})
    sent = asked.withColumns({"place": F.explode(F.sequence(F.lit(0), F.lit(places - 1)).cast("array<long>")), "asks": F.lit(True)})
    # only places that hold a block
    met = dealt.unionByName(sent).repartition(places, "place").sortWithinPartitions("place", "asks")
    with small_batches(spark):
        found = staged(met.mapInArrow(_search(k), FOUND), "products")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_row").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def products_query(embeddings: DataFrame) -> DataFrame:
    return top_products(embeddings, F.col("vec_id") % 50 == 0)


PRODUCTS_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM met)
SELECT query_id, CAST(r AS INT) AS rank, vec_id, score FROM ranked WHERE r <= 5"""
