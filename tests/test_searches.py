"""The registered searches are given every setting of their grids; the best model is scored on the test part."""

import pytest

from __spark_entry__ import queries
from tallyframe.operators import tuning as U

HOURS_SWEEP = {k: U.TREE_SWEEP[k] for k in ("depth", "bins")}
GRIDS = {
    "tun_train_validation": U.TREE_GRID,
    "tun_cross_validation": U.REGRESSION_GRID,
    "tun_sweep": U.TREE_SWEEP,
    "tun_cross_validation_pages": U.TREE_GRID,
    "tun_forest": U.FOREST_GRID,
    "tun_forest_cross_validation": U.FOREST_GRID,
    "tun_multiclass": U.MULTICLASS_GRID,
    "tun_train_validation_hours": U.REGRESSION_GRID,
    "tun_boosted": U.BOOSTED_GRID,
    "tun_sweep_multiclass": U.TREE_SWEEP,
    "tun_sweep_hours": HOURS_SWEEP,
}


@pytest.fixture
def given(monkeypatch):
    """The settings that a search was given; only the first two are trained here."""
    seen = []
    tv, cv, sweep = U.train_validation, U.cross_validation, U.sweep

    def tuner(run):
        def search(stages, estimator, grid, *rest):
            seen.extend(U.full_grid(grid))
            last = list(grid)[-1]
            return run(stages, estimator, {k: v[: 2 if k == last else 1] for k, v in grid.items()}, *rest)

        return search

    def some(train, validation, settings, *rest):
        seen.extend(settings)
        return sweep(train, validation, settings[:2], *rest)

    monkeypatch.setattr(U, "train_validation", tuner(tv))
    monkeypatch.setattr(U, "cross_validation", tuner(cv))
    monkeypatch.setattr(U, "sweep", some)
    return seen


@pytest.mark.parametrize("name", GRIDS)
def test_every_setting_is_given(spark, given, name):
    trials = queries()[name](spark, "/root/testdata/sf0.01").collect()
    assert given == U.full_grid(GRIDS[name])
    assert len(trials) == 2 and sum(r.test_metric is not None for r in trials) == 1
