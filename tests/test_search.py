"""All trials of a search at once against one fit per trial and fold."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from panelwright.config import EnsembleConfig
from panelwright.operators import forest as fo
from panelwright.operators import search as se
from panelwright.operators.ensemble import StackedEnsemble, draw_settings
from panelwright.operators.evaluate import ranking_metrics
from panelwright.session import materialize

BASE = EnsembleConfig(folds=2, max_bins=32, parallelism=8)
SPANS = {"rf_trees": (64, 70), "rf_max_depth": (None, 3), "rf_min_leaf": (1, 2), "gbt_rounds": (2, 5)}


@pytest.fixture(scope="module")
def rows(spark):
    """Rows with repeated and null keys."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(90, 5)), 1)
    label = np.where(x[:, 0] + rng.normal(size=90) > 0.4, "pos", "neg")
    keys = [None if i % 17 == 0 else f"S{i % 80}" for i in range(90)]
    given = spark.createDataFrame(pd.DataFrame({"sample_id": keys, "label": label, "x": x.tolist()}), "sample_id string, label string, x array<double>")
    return materialize(given.select("sample_id", "label", array_to_vector("x").alias("features")).coalesce(1), "search-test")


def test_all_trials_at_once_find_what_single_fits_find(rows, monkeypatch):
    fits, fit = [], StackedEnsemble.fit
    monkeypatch.setattr(StackedEnsemble, "fit", lambda self, given: fits.append(self.config) or fit(self, given))
    draws = draw_settings(BASE, 3, SPANS)
    together = StackedEnsemble(BASE).tune(rows, draws=draws)
    assert len(fits) == 1 and fits[0].rf_trees >= 64  # the refit alone
    monkeypatch.setattr(se, "goes_together", lambda draws: False)
    single = StackedEnsemble(BASE).tune(rows, draws=draws)
    assert len(fits) == 2 + 3 * BASE.folds
    found = [[tuple(r) for r in s.search_results.orderBy("trial").collect()] for s in (together, single)]
    assert [r[:-1] for r in found[0]] == [r[:-1] for r in found[1]]
    assert [r[-1] for r in found[0]] == pytest.approx([r[-1] for r in found[1]], abs=1e-9)
    assert together.config == single.config and together.best_score == max(r[-1] for r in found[0])


def test_trials_go_one_by_one_where_they_have_to(rows):
    draws = draw_settings(BASE, 2, SPANS)
    assert se.goes_together(draws)
    assert not se.goes_together([*draws, EnsembleConfig(rf_trees=fo.MANY_TREES - 1, folds=2, max_bins=32)])
    assert not se.goes_together([*draws, EnsembleConfig(rf_trees=64, folds=3, max_bins=32)])
    folded = rows.withColumn("search_fold", F.lit(0))
    for labels in ({"a": 1, "b": 1, "c": 1}, {None: 3, "b": 4}, {"neg": 1 << 24, "pos": 1}):
        assert se.trial_scores(folded, labels, 1.0, 2, draws, 1) is None
    # Every row is in the first fold, so its stack has no row to learn from.
    assert se.trial_scores(folded, {"neg": 50, "pos": 40}, 1.0, 2, draws, 1) is None


@pytest.mark.parametrize("n", [30, 500])
def test_trees_of_several_trials_are_prefixes_of_the_largest_forest(n):
    rng = np.random.default_rng(n)
    y, bins = (rng.random(n) < 0.4).astype(float), rng.integers(0, 40, (n, 5)).astype(np.uint8)
    w, held = np.where(y > 0, 1.3, 0.8), rng.integers(0, 40, (20, 5)).astype(np.uint8)
    shapes = [(64, None, 1), (90, 3, 1), (70, 5, 2), (71, None, 2)]
    draws = [EnsembleConfig(rf_trees=t, rf_max_depth=d, rf_min_leaf=m, max_bins=64) for t, d, m in shapes]
    sums = sum(se.forest_sums(y, w, bins, held, draws, part, 3) for part in range(3))
    for c, got in zip(draws, sums):
        p, want = fo.ForestParams(c.rf_trees, se.depth_of(c), c.rf_min_leaf, 64, c.seed), np.zeros(20)
        for tree in range(c.rf_trees):
            left, feature, cut, output, *_ = fo.grow(y, w, bins, tree, p)
            want += output.astype(np.float32)[fo.places(0, left, feature, cut, held)]
        assert got == pytest.approx(want, abs=1e-9)


def test_trees_grown_together_are_those_grown_alone():
    rng = np.random.default_rng(8)
    y, bins = (rng.random(200) < 0.5).astype(float), rng.integers(0, 9, (200, 4)).astype(np.uint8)
    p = fo.ForestParams(9, 30, 1, 16, 5)
    for tree, many in enumerate(fo.grow_many(y, np.where(y > 0, 1.1, 0.7), bins, list(range(9)), p)):
        one = fo.grow(y, np.where(y > 0, 1.1, 0.7), bins, tree, p)
        assert all(np.array_equal(a, b) for a, b in zip(one, many))


def test_metrics_of_groups_are_those_of_each(spark):
    cells = [(g, s, c) for g, scores in ((0, [1, 2, 2, 3]), (1, [3, 1, 2, 2]), (2, [1, 1, 1, 1])) for s, c in zip(scores, [0, 1, 0, 1])]
    scored = spark.createDataFrame([*cells, (3, 1, 0), (3, 2, 0)], "g int, score int, code int")
    found = {r.g: (r.roc_auc, r.average_precision) for r in ranking_metrics(scored, label="code", by=("g",)).collect()}
    assert found == {g: tuple(ranking_metrics(scored.where(F.col("g") == g), label="code").first()) for g in range(4)}
    assert found[3] == (None, None) and found[2][0] == 0.5
