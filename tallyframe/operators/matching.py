"""The k rows with the highest inner product for each asked row, over factors, without scoring every pair.

Asked rows of near direction share a cell. The products of all unit vectors in a cell with a row lie between two bounds, so a row whose upper
bound is below the k-th greatest lower bound is no answer in that cell; the few other rows meet its asked rows at once. This is most
of the work where cells are narrow, as for factors of low rank. A cell with more than ``block_rows`` such rows is left to rounds:

No product exceeds the product of the two lengths. So the rows to find are cut into blocks by falling length, and the search
goes through them in rounds of one, two, four ... blocks: an asked row takes part in a round only while its k-th product is not
above its own length times the greatest length still to come. The rows that stop early are most of them where lengths differ, as
the factors of items with many and with few ratings do; where all lengths are equal, every pair is scored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.ordering import row_position
from tallyframe.session import discard, keep, scratch, staged

#: Rows of a block of the rows to find, and about as many asked rows that meet it at once.
BLOCK_ROWS, PACK_ROWS = 4096, 512
#: Copies of a block over which the packs of asked rows are dealt.
SALTS = 8
#: Room for rounding in the bounds, as a part of them: of lengths, and of angles to cells, where a root is taken of what rounding leaves.
SLACK, ROOM = 1e-9, 1e-7
#: Most cells are two to this power; so many asked rows steer where they are cut.
DEEPEST, STEERING = 10, 16_384
#: Lengths and bounds below this, or lengths above its inverse, are left to rounds: products could lose digits.
TINY = 1e-100
#: Rows whose bounds in all cells are computed at once.
AT_ONCE = 2048


def length(vector: str | Column) -> Column:
    squares = F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x)
    return F.sqrt(squares)


def _usable(factors: DataFrame) -> DataFrame:
    """(id, features as doubles, length) of the rows that have an id and finite numbers only."""
    doubles = factors.select("id", F.col("features").cast("array<double>").alias("features")).withColumn("length", length("features"))
    return doubles.filter(F.col("id").isNotNull() & F.col("length").isNotNull() & (F.col("length") < float("inf")))


def _blocks(factors: DataFrame, block_rows: int) -> DataFrame:
    """One row per block: its number, the greatest length in it and its rows."""
    ordered = _usable(factors).withColumn("falling", -F.col("length"))
    placed = row_position(ordered, ["falling", "id"], factors.count())
    block = F.floor((F.col("position") - 1) / block_rows).cast("int").alias("block")
    rows = F.collect_list(F.struct("id", "features")).alias("rows")
    return staged(placed.groupBy(block).agg(F.max("length").alias("top"), rows), "blocks")


def _matrix(rows: pa.StructArray) -> np.ndarray:
    return rows.field("features").flatten().to_numpy().reshape(len(rows), -1)


def _best(products: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest products, the smaller id first among equals."""
    some = np.arange(len(products))
    if len(products) > k:
        some = np.flatnonzero(products >= np.partition(products, len(products) - k)[len(products) - k])
    return some[np.lexsort((ids[some], -products[some]))[:k]]


def _meet(k: int):
    def meet(batches):
        for batch in batches:
            for packed, found in zip(batch.column("pack_rows"), batch.column("rows"), strict=True):
                asked, rows = packed.values, found.values
                left, right = _matrix(asked), _matrix(rows)
                products = np.zeros((len(left), len(right)))
                for j in range(left.shape[1]):  # every product is summed in this order, so equal rows have equal products
                    products += np.multiply.outer(left[:, j], right[:, j])
                ids, least = rows.field("id").to_numpy(), asked.field("least").to_numpy(zero_copy_only=False)
                at = [_best(p, ids, k) for p in products]
                at = [i[p[i] >= low] for i, p, low in zip(at, products, least, strict=True)]
                row = np.repeat(np.arange(len(at)), [len(i) for i in at])
                hit = np.concatenate(at)
                place = [np.arange(1, len(i) + 1, dtype=np.int32) for i in at]
                yield pa.RecordBatch.from_arrays(
                    [asked.field("id").take(pa.array(row)), pa.array(ids[hit]), pa.array(products[row, hit]), pa.array(np.concatenate(place))],
                    ["id", "found", "score", "rank"],
                )

    return meet


def _cuts(directions: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """A tree of cuts, its nodes numbered as in a heap: the dimension of each, and the greatest value that goes left."""
    dims, cuts = np.zeros(2**depth - 1, int), np.zeros(2**depth - 1)
    parts = {0: directions}
    for node in range(len(dims)):
        part = parts.pop(node)
        if len(part):
            dims[node] = np.argmax(np.ptp(part, axis=0))
            cuts[node] = np.median(part[:, dims[node]])
        left = part[:, dims[node]] <= cuts[node]
        parts[2 * node + 1], parts[2 * node + 2] = part[left], part[~left]
    return dims, cuts


def _celled(dims: np.ndarray, cuts: np.ndarray, depth: int):
    """Rows (id, features, length, direction) to (id, features, length, direction, cell)."""

    def cell(batches):
        for batch in batches:
            if batch.num_rows:
                direction = _vectors(batch.column("direction"))
                node = np.zeros(len(direction), int)
                for _ in range(depth):
                    node = 2 * node + 1 + (direction[np.arange(len(node)), dims[node]] > cuts[node])
                cells = (node - (2**depth - 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], [*batch.schema.names, "cell"])

    return cell


def _vectors(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


@dataclass(frozen=True)
class _Cones:
    """Cells of unit vectors: number, a unit vector, and cosine and sine of the greatest angle to it in the cell."""

    cells: np.ndarray
    axis: np.ndarray
    cos: np.ndarray
    sin: np.ndarray

    @classmethod
    def of(cls, rows: list) -> _Cones:
        """From the box (low, high) of each cell: a unit vector is no farther from the line to its middle than the box's half diagonal."""
        low, high = (np.array([r[c] for r in rows]) for c in ("low", "high"))
        middle, sin = (low + high) / 2, np.sqrt((((high - low) / 2) ** 2).sum(axis=1)) + SLACK
        wide = sin >= 1  # of these nothing is known but the length: no axis, and a right angle
        length = np.sqrt((middle * middle).sum(axis=1))
        axis = np.where(wide[:, None], 0.0, middle / np.where(wide, 1.0, length)[:, None])
        sin = np.where(wide, 1.0, sin)
        return cls(np.array([r["cell"] for r in rows], np.int32), axis, np.sqrt(1 - sin * sin), sin)

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row of ``x`` and cell what no product with a unit vector of the cell is below, or above."""
        size = np.sqrt((x * x).sum(axis=1))[:, None]
        along = (x / np.where(size > 0, size, 1.0)) @ self.axis.T
        across = np.sqrt(np.maximum(1 - along * along, 0.0)) * self.sin
        turned = along * self.cos
        low = np.where(along < -self.cos, -1.0, turned - across)
        high = np.where(along > self.cos, 1.0, turned + across)
        return (low - ROOM) * size, (high + ROOM) * size

    def lower(self, k: int):
        """The ``k`` greatest lower bounds per cell of a part of the rows: cell, low."""

        def lowest(batches):
            best = np.full((0, len(self.cells)), -np.inf)
            for batch in batches:
                x = _vectors(batch.column("features"))
                for at in range(0, len(x), AT_ONCE):
                    best = np.concatenate([best, self.bounds(x[at : at + AT_ONCE])[0]])
                    if len(best) > k:
                        best = np.partition(best, len(best) - k, axis=0)[-k:]
            if len(best):
                yield pa.RecordBatch.from_arrays([pa.array(np.tile(self.cells, len(best))), pa.array(best.ravel())], ["cell", "low"])

        return lowest

    def above(self, floor: np.ndarray, count: bool):
        """The rows (id, features) whose upper bound reaches the floor of a cell, or per cell how many they are."""

        def reach(batches):
            total = np.zeros(len(self.cells), np.int64)
            for batch in batches:
                x = _vectors(batch.column("features"))
                for at in range(0, len(x), AT_ONCE):
                    hits = self.bounds(x[at : at + AT_ONCE])[1] >= floor
                    if count:
                        total += hits.sum(axis=0)
                    elif hits.any():
                        row, cell = np.nonzero(hits)
                        place = pa.array(row + at)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(self.cells[cell]), batch.column("id").take(place), batch.column("features").take(place)], ["cell", "id", "features"]
                        )
            if count:
                yield pa.RecordBatch.from_arrays([pa.array(self.cells), pa.array(total)], ["cell", "n"])

        return reach

    def those(self, kept: np.ndarray) -> _Cones:
        return _Cones(self.cells[kept], self.axis[kept], self.cos[kept], self.sin[kept])


def _in_cells(questions: DataFrame) -> DataFrame:
    """The asked rows (id, features, length) with the cell of their direction, null where the length is too small or great."""
    sound = questions.filter((F.col("length") > TINY) & (F.col("length") < 1 / TINY))
    directed = sound.withColumn("direction", F.transform("features", lambda x: x / F.col("length")))
    depth = max(0, min(DEEPEST, (questions.count() // PACK_ROWS).bit_length() - 1))
    steering = [r["direction"] for r in directed.orderBy(F.xxhash64("id")).limit(STEERING).select("direction").collect()]
    kind = questions.schema["id"].dataType.simpleString()
    schema = f"id {kind}, features array<double>, length double, direction array<double>, cell int"
    dims, cuts = _cuts(np.array(steering).reshape(len(steering), -1) if steering else np.zeros((0, 1)), depth)
    celled = directed.mapInArrow(_celled(dims, cuts, depth), schema)
    others = questions.filter(~((F.col("length") > TINY) & (F.col("length") < 1 / TINY)))
    return celled.unionByName(others.withColumns({"direction": F.lit(None).cast("array<double>"), "cell": F.lit(None).cast("int")}))


def _by_cells(questions: DataFrame, factors: DataFrame, k: int, most: int, schema: str) -> tuple[DataFrame | None, list[int]]:
    """What the cells find that have ``most`` rows above their floor at the most, and which cells these are."""
    first = questions.filter(F.col("cell").isNotNull()).select(F.size("direction")).first()
    if first is None:
        return None, []
    place = [F.get("direction", F.lit(j)) for j in range(first[0])]
    ends = [F.array(*map(F.min, place)).alias("low"), F.array(*map(F.max, place)).alias("high")]
    known = questions.filter(F.col("cell").isNotNull()).groupBy("cell").agg(*ends, F.count("*").alias("n")).collect()
    cones = _Cones.of(known)
    rows = _usable(factors).select("id", "features")
    lows = rows.mapInArrow(cones.lower(k), "cell int, low double").groupBy("cell").agg(F.slice(F.sort_array(F.collect_list("low"), False), 1, k).alias("low"))
    lows = {r["cell"]: r["low"] for r in lows.collect()}
    floor = np.array([lows[c][-1] if len(lows.get(c, ())) == k else -np.inf for c in cones.cells])
    counts = {r["cell"]: r["n"] for r in rows.mapInArrow(cones.above(floor, True), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    kept = np.array([0 < counts.get(c, 0) <= most and abs(f) > TINY for c, f in zip(cones.cells, floor, strict=True)])
    if not kept.any():
        return None, []
    done = cones.cells[kept].tolist()
    kind = factors.schema["id"].dataType.simpleString()
    reached = rows.mapInArrow(cones.those(kept).above(floor[kept], False), f"cell int, id {kind}, features array<double>")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    copies = reached.groupBy("cell").agg(F.collect_list(F.struct("id", "features")).alias("rows")).select("cell", "rows", salts)
    packs = questions.sparkSession.createDataFrame([(r["cell"], 1 + r["n"] // PACK_ROWS) for r in known], "cell int, packs long")
    asked = questions.filter(F.col("cell").isin(done)).join(F.broadcast(packs), "cell").withColumn("pack", F.pmod(F.xxhash64("id"), F.col("packs")))
    row = F.struct("id", "features", F.lit(float("-inf")).alias("least"))
    packs = asked.groupBy("cell", "pack").agg(F.collect_list(row).alias("pack_rows")).withColumn("salt", F.pmod("pack", F.lit(SALTS)))
    met = packs.join(copies.hint("merge"), ["cell", "salt"])
    return staged(met.select("pack_rows", "rows").mapInArrow(_meet(k), schema + ", rank int"), "best"), done


def top_products(asked: DataFrame, factors: DataFrame, k: int = 10, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """id, rank, found, score: for each row of ``asked`` the ``k`` rows of ``factors`` with the highest inner product.

    Both have whole-number ids (id, unique) and vectors (features) of one size; rows with a null or without finite length take no
    part. Of equal products the smaller id comes first. ``asked`` and ``factors`` are stored tables: they are read more than once.
    """
    with scratch() as written:
        packs = max(1, asked.count() // PACK_ROWS)
        celled = _in_cells(_usable(asked))
        questions = staged(celled.withColumn("pack", F.pmod(F.xxhash64("id"), F.lit(packs)).cast("int")), "asked")
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        kinds = {"id": asked.schema["id"].dataType.simpleString(), "found": factors.schema["id"].dataType.simpleString()}
        schema = ", ".join(f"{c} {kind}" for c, kind in kinds.items()) + ", score double"
        ranked = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "found"))
        best = asked.sparkSession.createDataFrame([], schema + ", rank int")
        in_cells, done = _by_cells(questions, factors, k, block_rows, schema)
        if in_cells is not None:
            keep(written, in_cells)
            questions = questions.filter(F.col("cell").isNull() | ~F.col("cell").isin(done))
        blocks = None if questions.isEmpty() else _blocks(factors, block_rows)
        many, low, size = blocks.count() if blocks else 0, 0, 1
        while low < many:
            top = blocks.filter(F.col("block") == low).select("top").first()["top"]
            full = best.filter(F.col("rank") == k).select("id", F.col("score").alias("kth"))
            open_ = F.col("kth").isNull() | (F.col("kth") <= F.col("length") * top * (1 + SLACK))
            active = questions.join(full, "id", "left").filter(open_)
            row = F.struct("id", "features", F.coalesce("kth", F.lit(float("-inf"))).alias("least"))
            packed = staged(active.groupBy("pack").agg(F.collect_list(row).alias("pack_rows")), "packs")
            if packed.isEmpty():
                break
            high = min(low + size, many)
            sent = packed.select("pack_rows", F.pmod("pack", F.lit(SALTS)).alias("salt"), F.explode(F.sequence(F.lit(low), F.lit(high - 1))).alias("block"))
            copies = blocks.filter(F.col("block").between(low, high - 1)).select("block", "rows", salts)
            # merged, as the copies of a round, small in their file, would be built in the driver for a broadcast
            met = sent.join(copies.hint("merge"), ["block", "salt"])
            found = met.select("pack_rows", "rows").mapInArrow(_meet(k), schema + ", rank int").drop("rank")
            both = best.drop("rank").unionByName(found).withColumn("rank", ranked).filter(F.col("rank") <= k)
            before, best = best, staged(both.select("id", "found", "score", "rank"), "best")
            for over in (packed, before) if low else (packed,):
                discard(keep(written, over))
            low, size = high, size * 2
        if low:
            keep(written, best)
    found = [x.select("id", "rank", "found", "score") for x in (in_cells, best if low or in_cells is None else None) if x is not None]
    return reduce(DataFrame.unionByName, found)
