"""Split, screen on the training rows, fit the stack, score the rest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.config import EnsembleConfig, PreprocessConfig, SelectConfig
from panelwright.operators.ensemble import StackedEnsemble
from panelwright.operators.panel import assemble_panel
from panelwright.operators.scoring import ScoringBundle
from panelwright.operators.split import stratified_folds, stratified_split
from panelwright.plans.screening import FeatureScreen
from panelwright.session import materialize
from panelwright.sources.matrix import join_samples


@dataclass
class Trained:
    screen: FeatureScreen
    stack: StackedEnsemble
    bundle: ScoringBundle
    samples: DataFrame  # sample_id, label, is_test
    train: DataFrame  # sample_id, label, features
    test: DataFrame


def panel_rows(screen: FeatureScreen, matrix: DataFrame, samples: DataFrame, check: bool = True) -> DataFrame:
    """``(sample_id, label, features)`` of the panel."""
    vectors = assemble_panel(screen.transform(matrix, check), len(screen.panel()))
    return vectors.join(samples.select("sample_id", "label"), "sample_id")


def fold_screens(
    cells: DataFrame, samples: DataFrame, preprocess: PreprocessConfig | None, select: SelectConfig | None,
    folds: int, seed: int,
) -> list[tuple[FeatureScreen, DataFrame, DataFrame]]:
    """Per fold: a screen that never saw the fold, and the cells outside and inside it."""
    placed = materialize(stratified_folds(samples.select("sample_id", "label"), folds=folds, seed=seed), "screen_folds")
    cells = join_samples(cells.drop("label"), placed, "fold")
    out = []
    for fold in range(folds):
        outside, inside = cells.where(F.col("fold") != fold), cells.where(F.col("fold") == fold)
        out.append((FeatureScreen(preprocess, select).fit(outside.drop("fold")), outside, inside))
    return out


def fold_parts(cells, samples, preprocess, select, folds: int, seed: int) -> list[tuple[DataFrame, DataFrame]]:
    """Per fold the panel rows to learn from and to hold out, each with the panel of that fold."""
    parts = []
    for screen, outside, inside in fold_screens(cells, samples, preprocess, select, folds, seed):
        pair = [panel_rows(screen, part.drop("fold"), samples, check=False) for part in (outside, inside)]
        parts.append((materialize(pair[0], "fold_rows"), materialize(pair[1], "fold_held")))
    return parts


def train(
    matrix: DataFrame,
    samples: DataFrame,
    preprocess: PreprocessConfig | None = None,
    select: SelectConfig | None = None,
    ensemble: EnsembleConfig | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    tune_trials: int | None = None,
    screen_per_fold: bool = False,
) -> Trained:
    """``matrix`` has sample_id, feature, value; ``samples`` sample_id, label.

    Nothing is learned from a test row. By default one panel, chosen on all
    training rows, serves every fold, so the out-of-fold scores are a little
    optimistic; ``screen_per_fold`` chooses a panel for each fold without its
    held-out rows, at the cost of one screen per fold.
    """
    parts = materialize(stratified_split(samples.select("sample_id", "label"), test_size=test_size, seed=seed), "split")
    cells = join_samples(matrix.drop("label"), parts, "is_test")
    fit_cells, held_cells = cells.where(~F.col("is_test")), cells.where("is_test")
    screen = FeatureScreen(preprocess, select).fit(fit_cells)
    rows = materialize(panel_rows(screen, fit_cells, parts, check=False), "train_rows")
    held = materialize(panel_rows(screen, held_cells, parts), "test_rows")
    stack = StackedEnsemble(ensemble)
    if screen_per_fold:
        if tune_trials:
            raise ValueError("a search uses one panel; leave out tune_trials or screen_per_fold")
        config = stack.config
        stack.fit_parts(rows, fold_parts(fit_cells, rows, preprocess, select, config.folds, config.seed))
    else:
        stack = stack.tune(rows, tune_trials) if tune_trials else stack.fit(rows)
    return Trained(screen, stack, ScoringBundle.of(screen, stack), parts, rows, held)
