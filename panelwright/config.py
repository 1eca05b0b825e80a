"""Settings of each stage, checked when they are created."""

from __future__ import annotations

from dataclasses import dataclass, field


def _require(condition: bool, message: str) -> None:
    if not condition:
        raise ValueError(message)


# The strings that the CSV reader of pandas takes for missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Accepted names of the sample key, most wanted first.
KEY_CANDIDATES = ("sample", "submitter_id.samples", "sampleid", "barcode")


DEEPEST = 30  # fixed value: the limit of MLlib trees, used where no limit is set


@dataclass(frozen=True)
class IngestConfig:
    label_column: str | None = None
    label_hints: tuple[str, ...] = ("vital_status",)
    cohort_prefix: str = "TCGA"
    key_length: int = 15
    min_samples: int = 100

    def __post_init__(self) -> None:
        _require(len(self.label_hints) > 0, "label_hints needs at least one hint")
        _require(bool(self.cohort_prefix), "cohort_prefix must not be empty")
        _require(self.key_length > 0, f"key_length must be positive; got {self.key_length}")


@dataclass(frozen=True)
class PreprocessConfig:
    pseudocount: float = 1.0
    min_expression: float = 1.0
    min_sample_fraction: float = 0.2
    variance_threshold: float = 0.1
    with_mean: bool = True
    with_std: bool = True

    def __post_init__(self) -> None:
        _require(
            0.0 <= self.min_sample_fraction <= 1.0,
            f"min_sample_fraction must be in [0, 1]; got {self.min_sample_fraction}",
        )


@dataclass(frozen=True)
class SelectConfig:
    n_mad: int = 2000
    k_best: int = 100
    scorer: str = "anova_f"
    seed: int = 42
    spread: str = "exact"  # or "sketch": medians whose rank is off by a bounded share

    def __post_init__(self) -> None:
        from panelwright.operators.scorers import SCORERS

        _require(
            self.n_mad > self.k_best,
            f"n_mad ({self.n_mad}) must exceed k_best ({self.k_best})",
        )
        _require(self.spread in ("exact", "sketch"), f"spread must be 'exact' or 'sketch'; got {self.spread!r}")
        _require(
            self.scorer in SCORERS,
            f"scorer {self.scorer!r} is not registered; valid: {sorted(SCORERS)}",
        )


@dataclass(frozen=True)
class EnsembleConfig:
    rf_trees: int = 500
    rf_max_depth: int | None = None
    rf_min_leaf: int = 2
    gbt_rounds: int = 300
    gbt_max_depth: int = 6
    gbt_learning_rate: float = 0.05
    gbt_subsample: float = 0.8
    gbt_colsample: float = 0.8
    meta_c: float = 1.0
    folds: int = 5
    seed: int = 42
    tune_trials: int = 30
    max_bins: int = 256
    parallelism: int = 4

    def __post_init__(self) -> None:
        _require(self.folds >= 2, f"folds must be at least 2; got {self.folds}")
        _require(
            (self.rf_max_depth is None or 0 < self.rf_max_depth <= DEEPEST) and 0 < self.gbt_max_depth <= DEEPEST,
            f"depths must be in 1..{DEEPEST}; got {self.rf_max_depth} and {self.gbt_max_depth}",
        )
        _require(
            0.0 < self.gbt_subsample <= 1.0,
            f"gbt_subsample must be in (0, 1]; got {self.gbt_subsample}",
        )
        _require(
            0.0 < self.gbt_colsample <= 1.0,
            f"gbt_colsample must be in (0, 1]; got {self.gbt_colsample}",
        )


@dataclass(frozen=True)
class AttributionConfig:
    learner: str = "gbt"
    n_top: int = 20
    max_display: int = 20
    max_samples: int | None = None
    seed: int = 42
    paths_per_chunk: int = field(default=20_000)
    rows_per_block: int = 2_000

    def __post_init__(self) -> None:
        _require(self.learner in ("gbt", "rf"), f"learner must be 'gbt' or 'rf'; got {self.learner!r}")
        _require(self.n_top > 0, f"n_top must be positive; got {self.n_top}")
        _require(self.max_display > 0, f"max_display must be positive; got {self.max_display}")
        _require(
            self.max_samples is None or self.max_samples > 0,
            f"max_samples must be positive; got {self.max_samples}",
        )
