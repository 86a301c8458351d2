"""k-means over numeric column pairs: best of several starts, elbow table, report.

All starts, numbers of clusters and column pairs advance together, one job per iteration: each task
assigns its points for every run at once and sums them per run and center, so only these sums reach the
driver. Points are distinct and weighted by their number of rows, and lie in blocks of near ones: a block that is all nearer
to one center than to the others adds its sums without a look at its points. A start takes the points whose keyed hashes come first,
so it is the same under every partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.relational import extents

POINTS_PER_TASK, BLOCK_POINTS = 500_000, 128
BLOCK_NAMES = ["pair", "mx", "my", "hx", "hy", "n", "ox", "oy", "squares", "xs", "ys", "ws"]
BLOCKS = "pair int, " + ", ".join(f"{c} double" for c in BLOCK_NAMES[1:9]) + ", " + ", ".join(f"{c} array<double>" for c in BLOCK_NAMES[9:])
SUMS = "run int, center int, n double, x double, y double, cost double"


def column_pairs(columns: Sequence[str]) -> list[tuple[str, str]]:
    return list(combinations(columns, 2))


@dataclass(frozen=True)
class Clusters:
    """One finished run: centers, rows per center, the sum of squared distances, iterations."""

    centers: tuple[tuple[float, float], ...]
    sizes: tuple[int, ...]
    cost: float
    iterations: int


@dataclass(frozen=True)
class Points:
    """Weighted points of column pairs (pair, x, y, key, weight), the same packed in blocks, and per pair the mean variance of its columns."""

    frame: DataFrame
    blocks: DataFrame
    pairs: tuple[tuple[str, str], ...]
    variances: tuple[float, ...]


def _spans(counts: np.ndarray) -> np.ndarray:
    """0 to n - 1 for every n of ``counts``."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _pack(size: int):
    """Points (pair, x, y, weight) to blocks of up to ``size`` near points: strips by x, in a strip runs by y."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, *columns = (batch.column(i).to_numpy() for i in range(4))
            for pair in np.unique(pairs):
                x, y, w = (c[pairs == pair] for c in columns)
                strip = max(size, int(np.sqrt(len(x) * size)))
                order = np.lexsort((y, x))
                order = order[np.lexsort((x[order], y[order], np.arange(len(x)) // strip))]
                x, y, w = x[order], y[order], w[order]
                starts = np.arange(0, len(x), size)
                ends = np.append(starts, len(x)).astype(np.int32)
                # the middle of the box, half its sides, and sums of weight, offsets from the middle and their squares
                low, high = ([f.reduceat(c, starts) for c in (x, y)] for f in (np.minimum, np.maximum))
                (mx, my), half = [(a + b) / 2 for a, b in zip(low, high)], [(b - a) / 2 for a, b in zip(low, high)]
                dx, dy = x - np.repeat(mx, np.diff(np.append(starts, len(x)))), y - np.repeat(my, np.diff(np.append(starts, len(x))))
                sums = [np.add.reduceat(c, starts) for c in (w, w * dx, w * dy, w * (dx * dx + dy * dy))]
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(c)) for c in (x, y, w)]
                numbers = [pa.array(c) for c in (np.full(len(starts), pair, np.int32), mx, my, *half, *sums)]
                yield pa.RecordBatch.from_arrays([*numbers, *lists], BLOCK_NAMES)

    return pack


@contextmanager
def weighted_points(df: DataFrame, pairs: Sequence[tuple[str, str]], keys: Mapping[str, str] | None = None) -> Iterator[Points]:
    """The distinct points of every pair with their number of rows, counted in one pass and held while in use.

    Rows with a null in a pair are no points of it. ``keys`` may name, per column, one whose text stands for the value
    in the choice of starting points.
    """
    named = keys or {}
    each = [
        F.struct(
            F.lit(i).alias("pair"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"),
            F.concat_ws("|", *[F.col(named.get(c, c)).cast("string") for c in (x, y)]).alias("key"),
        )
        for i, (x, y) in enumerate(pairs)
    ]
    points = df.select(F.explode(F.array(*each)).alias("p")).select("p.*").dropna()
    weight = F.col("weight")
    counted = points.groupBy("pair", "x", "y", "key").agg(F.count("*").cast("double").alias("weight")).persist()
    held = None
    try:
        means = {c: F.sum(weight * F.col(c)) / F.sum(weight) for c in ("x", "y")}
        squares = {c: F.sum(weight * F.col(c) * F.col(c)) / F.sum(weight) for c in ("x", "y")}
        spread = sum((squares[c] - means[c] * means[c] for c in means), F.lit(0.0)) / 2
        known = {r["pair"]: r for r in counted.groupBy("pair").agg(spread.alias("variance"), F.count("*").alias("n")).collect()}
        total = sum(r["n"] for r in known.values())
        near = counted.select("pair", "x", "y", "weight").repartitionByRange(max(1, -(-total // POINTS_PER_TASK)), "pair", "x", "y")
        held = near.sortWithinPartitions("pair", "x", "y").mapInArrow(_pack(BLOCK_POINTS), BLOCKS).persist()
        held.count()
        variances = tuple(known[i]["variance"] if i in known else 0.0 for i in range(len(pairs)))
        yield Points(counted, held, tuple(pairs), variances)
    finally:
        counted.unpersist()
        if held is not None:
            held.unpersist()


def _seeds(points: Points, most: int, starts: int) -> dict[tuple[int, int], list[tuple[float, float]]]:
    """Per pair and start the ``most`` points whose hashes with the start come first."""
    hashed = points.frame.select(
        "pair", "x", "y", "key", F.explode(F.sequence(F.lit(0), F.lit(starts - 1))).alias("start")
    ).withColumn("hash", F.md5(F.concat_ws("|", "key", F.col("start").cast("string"))))
    place = F.row_number().over(Window.partitionBy("pair", "start").orderBy("hash", "key"))
    sizes = {r["pair"]: r["n"] for r in points.frame.groupBy("pair").agg(F.count("*").alias("n")).collect()}
    found: dict[tuple[int, int], list[tuple[float, float]]] = {}
    # only hashes that begin below a bound are sorted; it rises until every start has its points
    left, expected = sizes, 20 * most + 100
    while left:
        bounds = {pair: f"{min(16**8 - 1, 16**8 * expected // n):08x}" if expected < n else "g" for pair, n in left.items()}
        bound = F.coalesce(*[F.when(F.col("pair") == pair, low) for pair, low in bounds.items()])
        chosen = hashed.filter(F.col("hash") < bound).withColumn("place", place).filter(F.col("place") <= most).orderBy("pair", "start", "place")
        rows: dict[tuple[int, int], list[tuple[float, float]]] = {}
        for r in chosen.collect():  # pairs times starts times clusters
            rows.setdefault((r["pair"], r["start"]), []).append((r["x"], r["y"]))
        full = {p for p in left if all(len(rows.get((p, s), [])) >= min(most, sizes[p]) for s in range(starts))}
        found.update({at: chosen for at, chosen in rows.items() if at[0] in full})
        left, expected = {p: n for p, n in left.items() if p not in full}, expected * 16
    return found


def _owners(middle: np.ndarray, half: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Per block and run the center that is nearest to every point in the block's box, or -1.

    The lead of one center over another is linear, so it is least in a corner of the box.
    """
    away = middle[:, None, None, :] - centers[None]
    distance = (away * away).sum(axis=3)
    near = distance.argmin(axis=2)
    least = np.take_along_axis(distance, near[:, :, None], axis=2)
    own = np.take_along_axis(centers[None], near[:, :, None, None], axis=2)
    apart = np.abs(centers[None] - own)
    lead = distance - least - 2 * (apart * half[:, None, None, :]).sum(axis=3)
    # what rounding may hide counts as no lead; a center leads itself by nothing
    sure = lead > 1e-9 * (1.0 + distance)
    np.put_along_axis(sure, near[:, :, None], True, axis=2)
    return np.where(sure.all(axis=2), near, -1)


def _assigned_sums(runs: Mapping[int, tuple[int, np.ndarray]]):
    """Blocks to sums per run and center; ``runs`` has per number its pair and centers.

    A block whose box is all nearest to one center counts as a whole, only the points of the others are looked at.
    """
    groups: dict[tuple[int, int], list[int]] = {}
    for run, (pair, centers) in runs.items():
        groups.setdefault((pair, len(centers)), []).append(run)
    stacked = {g: np.stack([runs[r][1] for r in numbers]) for g, numbers in groups.items()}

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {(pair, k): np.zeros((4, len(numbers), k)) for (pair, k), numbers in groups.items()}
        for batch in batches:
            pairs, mx, my, hx, hy, *totals = (batch.column(i).to_numpy() for i in range(9))
            lists = [batch.column(i) for i in range(9, 12)]
            offsets, points = lists[0].offsets.to_numpy(), [c.values.to_numpy() for c in lists]
            for (pair, k), centers in stacked.items():
                mine = np.flatnonzero(pairs == pair)
                if not len(mine):
                    continue
                middle, half = np.stack([mx[mine], my[mine]], axis=1), np.stack([hx[mine], hy[mine]], axis=1)
                owner, (w, ox, oy, squares) = _owners(middle, half, centers), [c[mine] for c in totals]
                for i, center in enumerate(centers):
                    whole = owner[:, i] >= 0
                    at, (ax, ay) = owner[whole, i], (middle[whole] - center[owner[whole, i]]).T
                    n, dx, dy = w[whole], ox[whole], oy[whole]
                    cost = squares[whole] + 2 * (ax * dx + ay * dy) + n * (ax * ax + ay * ay)
                    for row, values in enumerate((n, dx + n * middle[whole, 0], dy + n * middle[whole, 1], cost)):
                        sums[pair, k][row, i] += np.bincount(at, values, k)
                    mixed = mine[~whole]
                    counts = offsets[mixed + 1] - offsets[mixed]
                    each = np.repeat(offsets[mixed], counts) + _spans(counts)
                    x, y, n = (c[each] for c in points)
                    distance = (x - center[:, :1]) ** 2 + (y - center[:, 1:]) ** 2
                    at, least = distance.argmin(axis=0), distance.min(axis=0)
                    for row, values in enumerate((n, n * x, n * y, n * least)):
                        sums[pair, k][row, i] += np.bincount(at, values, k)
        for (pair, k), numbers in groups.items():
            n, x, y, cost = sums[pair, k].reshape(4, -1)
            columns = [np.repeat(numbers, k).astype(np.int32), np.tile(np.arange(k, dtype=np.int32), len(numbers)), n, x, y, cost]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["run", "center", "n", "x", "y", "cost"])

    return add_up


def _pass(points: Points, runs: Mapping[int, tuple[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """Per run and center: rows, sums of x and y, cost, at the given centers."""
    partial = points.blocks.mapInArrow(_assigned_sums(runs), SUMS)
    found = {run: np.zeros((len(centers), 4)) for run, (_, centers) in runs.items()}
    for r in partial.groupBy("run", "center").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "cost")]).collect():
        found[r["run"]][r["center"]] = r["n"], r["x"], r["y"], r["cost"]
    return found


def best_of_each(
    points: Points, ks: Sequence[int], starts: int = 10, max_iter: int = 100, tolerance: float = 1e-4
) -> dict[tuple[tuple[str, str], int], Clusters]:
    """Per pair and number of clusters the cheapest of ``starts`` runs, the earliest of equals.

    A run ends after ``max_iter`` iterations, or when the squared moves of all centers together are at most
    ``tolerance`` of the columns' mean variance. A center that no point is nearest to stays where it is. With fewer distinct
    points than clusters every point is a center.
    """
    seeds = _seeds(points, max(ks, default=0), starts) if ks else {}
    runs, known = {}, []
    for (pair, start), chosen in sorted(seeds.items()):
        for k in ks:
            runs[len(known)] = pair, np.array(chosen[:k])
            known.append((pair, k, start))
    going, iterations = set(runs), dict.fromkeys(runs, 0)
    for _ in range(max_iter):
        if not going:
            break
        for run, sums in _pass(points, {r: runs[r] for r in sorted(going)}).items():
            pair, old = runs[run]
            n = sums[:, :1]
            new = np.where(n > 0, sums[:, 1:3] / np.maximum(n, 1e-300), old)
            runs[run], iterations[run] = (pair, new), iterations[run] + 1
            if ((new - old) ** 2).sum() <= tolerance * points.variances[pair]:
                going.discard(run)
    best: dict[tuple[tuple[str, str], int], Clusters] = {}
    last = _pass(points, runs) if runs else {}
    for run, (pair, k, _) in enumerate(known):
        sums, name = last[run], (points.pairs[pair], k)
        cost = float(sums[:, 3].sum())
        if name not in best or cost < best[name].cost:
            order = np.lexsort(runs[run][1].T[::-1])
            centers = tuple(map(tuple, runs[run][1][order].tolist()))
            best[name] = Clusters(centers, tuple(int(n) for n in sums[order, 0]), cost, iterations[run])
    return best


def best_kmeans(points: Points, ks: Sequence[int], starts: int = 10, **more) -> dict[int, Clusters]:
    """``best_of_each`` of points of one pair."""
    return {k: found for (_, k), found in best_of_each(points, ks, starts, **more).items()}


def squared_distance(columns: Sequence[str], center: Sequence[float]) -> Column:
    return sum(((F.col(c) - F.lit(float(x))) * (F.col(c) - F.lit(float(x))) for c, x in zip(columns, center)), F.lit(0.0))


def assign(df: DataFrame, columns: Sequence[str], centers: Sequence[Sequence[float]]) -> DataFrame:
    """Add the number of the nearest center (the lower of equals) and the squared distance to it."""
    options = [
        F.struct(squared_distance(columns, center).alias("distance2"), F.lit(i).alias("cluster"))
        for i, center in enumerate(centers)
    ]
    near = df.withColumn("_near", F.array_min(F.array(*options)))
    return near.select(*df.columns, F.col("_near.cluster").alias("cluster"), F.col("_near.distance2").alias("distance2"))


def squared_error(df: DataFrame, columns: Sequence[str], centers: Sequence[Sequence[float]]) -> DataFrame:
    """One row: the sum over all rows of the squared distance to the nearest center."""
    return assign(df, columns, centers).agg(F.sum("distance2").alias("sse"))


def elbow(
    df: DataFrame, pairs: Sequence[tuple[str, str]], ks: Sequence[int] = (2, 3, 4, 5), starts: int = 10, keys: Mapping[str, str] | None = None
) -> DataFrame:
    """Cost of the best clustering for every column pair and number of clusters."""
    schema = "x string, y string, k int, sse double"
    if not pairs:
        return df.sparkSession.createDataFrame([], schema)
    with weighted_points(df, pairs, keys) as points:
        best = best_of_each(points, ks, starts)
    return df.sparkSession.createDataFrame([(x, y, k, c.cost) for ((x, y), k), c in best.items()], schema)


def report(
    df: DataFrame, pairs: Sequence[tuple[str, str]], k: int = 3, starts: int = 10, keys: Mapping[str, str] | None = None
) -> DataFrame:
    """Per column pair one row per cluster, by rising center: rows, center, and the limits of a square view on all rows."""
    rows = []
    if pairs:
        box = {r["name"]: r for r in extents(df, *sorted({c for pair in pairs for c in pair})).collect()}
        with weighted_points(df, pairs, keys) as points:
            best = best_of_each(points, [k], starts)
        for ((x, y), _), found in best.items():
            half = max(box[x]["spread"] + 1, box[y]["spread"] + 1) / 2
            limits = [box[c]["mean"] + s * half for c in (x, y) for s in (-1, 1)]
            rows += [(x, y, i, n, *center, found.cost, *limits) for i, (n, center) in enumerate(zip(found.sizes, found.centers))]
    return df.sparkSession.createDataFrame(
        rows,
        "x string, y string, cluster int, counts long, center_x double, center_y double, sse double, "
        "x_low double, x_high double, y_low double, y_high double",
    )
