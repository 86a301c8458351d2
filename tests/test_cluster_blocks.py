import random

import numpy as np
import pytest

from tallyframe.operators import cluster as K


def _by_hand(points, centers):
    """Sums per center, every point looked at."""
    x, y, w = points.T
    distance = (x[:, None] - centers[:, 0]) ** 2 + (y[:, None] - centers[:, 1]) ** 2
    at, least = distance.argmin(axis=1), distance.min(axis=1)
    return np.stack([np.bincount(at, v, len(centers)) for v in (w, w * x, w * y, w * least)], axis=1)


@pytest.mark.parametrize("steps", [3, 50, 100_000])  # few values: many points on the line between two centers
def test_passes_look_at_few_points(spark, steps):
    rng = random.Random(steps)
    data = [(rng.randrange(steps) * 12.0 / steps, rng.randrange(steps) * 6.0 / steps) for _ in range(6000)]
    df = spark.createDataFrame(data, "x double, y double")
    runs = {0: (0, np.array([[4.0, 2.0], [8.0, 2.0]])), 1: (0, np.array([[2.0, 3.0], [10.0, 3.0], [6.0, 0.0]])), 2: (0, np.array([[1.0, 1.0]] * 3))}
    with K.weighted_points(df, [("x", "y")]) as points:
        every = np.array([tuple(r) for r in points.frame.select("x", "y", "weight").collect()])
        found = K._pass(points, runs)
        blocks = points.blocks.collect()
    assert sum(len(r.xs) for r in blocks) == len(every) == sum(1 for _ in set(data))
    for run, (_, centers) in runs.items():
        assert found[run] == pytest.approx(_by_hand(every, centers), rel=1e-9)
    owners = K._owners(np.array([(r.mx, r.my) for r in blocks]), np.array([(r.hx, r.hy) for r in blocks]), runs[0][1][None])
    if len(blocks) > 30:
        assert (owners >= 0).mean() > 0.6


def test_starts_beyond_the_first_bound(spark):
    """A bound that lets too few hashes through rises until every start has its points."""
    df = spark.createDataFrame([(float(i), 0.0) for i in range(400)] + [(1.0, float(i)) for i in range(1, 4)], "x double, y double")
    with K.weighted_points(df, [("x", "y"), ("y", "x")]) as points:
        seeds = K._seeds(points, 5, 12)
    assert sorted(seeds) == [(p, s) for p in (0, 1) for s in range(12)] and all(len(v) == 5 for v in seeds.values())
