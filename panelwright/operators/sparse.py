"""Statistics of a mostly empty matrix from its stored cells alone.

A cell that is not stored is zero. Its share of every statistic follows from counts:
a feature of n samples with s stored cells has n - s times the value that zero is
transformed to. Moments take that mass in by the pooled formula; medians take it in
as one weighted point per feature, which shifts the wanted rank, while histograms
and sorts see stored cells only. Samples times features is never built.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.operators.checks import MARKS, mark_sums
from panelwright.operators.moments import class_moments, feature_moments
from panelwright.session import materialize
from panelwright.sources.matrix import join_samples


@dataclass
class SparseMatrix:
    """Stored cells, each (sample, feature) once, and what they are part of.

    ``cells``: sample_id, feature, value, label; ``samples``: sample_id, label, each
    sample once; ``features``: feature and, if the source has an order, feature_pos.
    """

    cells: DataFrame
    samples: DataFrame
    features: DataFrame

    @classmethod
    def of(cls, cells: DataFrame, samples: DataFrame, features: DataFrame) -> SparseMatrix:
        """Add up repeated cells and write them once, clustered by feature.

        Cells of other samples or features, and samples or features that occur twice,
        are an error: zeros could not be counted.
        """
        if "label" not in samples.columns:
            samples = samples.withColumn("label", F.lit(None).cast("string"))
        samples = materialize(samples.select("sample_id", "label"), "samples")
        placed = [c for c in ("feature_pos",) if c in features.columns]
        features = materialize(features.select("feature", *placed), "features")
        for table, key in ((samples, "sample_id"), (features, "feature")):
            if table.where(F.col(key).isNull()).limit(1).count() or table.groupBy(key).count().where("count > 1").limit(1).count():
                raise ValueError(f"each {key} of a sparse matrix is given once and is not null")
        folded = cells.groupBy("sample_id", "feature").agg(F.sum(F.col("value").cast("double")).cast("float").alias("value"))
        folded = materialize(folded, "folded")
        for table, key in ((samples, "sample_id"), (features, "feature")):
            unknown = folded.join(table.select(key), key, "left_anti").limit(1).collect()
            if unknown:
                raise ValueError(f"a stored cell has the unknown {key} {unknown[0][key]!r}")
        return cls(join_samples(folded, samples), samples, features)

    def classes(self) -> DataFrame:
        """One row per class: its samples and the sums of their marks."""
        return self.samples.groupBy("label").agg(F.count("*").alias("n"), *mark_sums())


def sparse_moments(matrix: SparseMatrix, transform: Callable[[Column], Column] | None = None, min_expression: float = 1.0) -> DataFrame:
    """As ``class_moments`` of the filled matrix, with ``n_stored``; also for features
    and classes without a stored cell."""
    transform = transform or (lambda value: value)
    stored = class_moments(matrix.cells, transform(F.col("value")), min_expression).drop("feature_pos", *MARKS)
    stored = stored.withColumnsRenamed({c: f"_{c}" for c in stored.columns})
    # The classes, as many rows as there are labels, reach each feature as one array.
    listed = matrix.classes().agg(F.collect_list(F.struct("label", "n", *MARKS)).alias("c"))
    pos = F.col("feature_pos") if "feature_pos" in matrix.features.columns else F.lit(None)
    grid = matrix.features.select("feature", pos.cast("int").alias("feature_pos"), F.inline(listed.scalar()))
    both = grid.join(stored, (F.col("feature") == F.col("_feature")) & F.col("label").eqNullSafe(F.col("_label")), "left")
    zero = transform(F.lit(0.0).cast("float")).cast("float")
    n_stored = F.coalesce("_n", F.lit(0))
    rest, at = F.col("n") - n_stored, zero.cast("double")
    own_mean = F.coalesce("_mean", F.lit(0.0))
    mean = (n_stored * own_mean + F.when(rest > 0, rest * at).otherwise(0.0)) / F.col("n")
    both = both.withColumn("n_stored", n_stored).withColumn("_rest", rest).withColumn("mean", mean)
    away = F.col("_rest") * (at - F.col("mean")) * (at - F.col("mean"))
    within = F.coalesce(F.col("_var_pop") + (own_mean - F.col("mean")) * (own_mean - F.col("mean")), F.lit(0.0))
    spread = (F.col("n_stored") * within + F.when(F.col("_rest") > 0, away).otherwise(0.0)) / F.col("n")
    filled = F.when(F.col("_rest") > 0, at)
    expressed = F.when(zero >= F.lit(min_expression).cast("float"), F.col("_rest")).otherwise(0)
    return both.select(
        "feature", "label", "feature_pos", "n", *MARKS,
        *[F.coalesce(f"_{c}", F.lit(0)).alias(c) for c in ("n_missing", "n_negative", "n_infinite", "n_nonzero")],
        (F.coalesce("_n_expressed", F.lit(0)) + expressed).alias("n_expressed"),
        "mean", spread.alias("var_pop"), F.least("_low", filled).alias("low"), F.greatest("_high", filled).alias("high"), "n_stored",
    )


def sparse_anova_f(matrix: SparseMatrix, transform: Callable[[Column], Column] | None = None) -> DataFrame:
    """One-way ANOVA F of every feature of the filled matrix; NaN for a constant one."""
    return feature_moments(sparse_moments(matrix, transform)).select("feature", F.col("f_score").alias("score"))


def weighted_values(cells: DataFrame, stats: DataFrame, zero: Column, value: Column) -> DataFrame:
    """(feature, x, weight): stored cells of the features in ``stats`` with weight one, and
    a point per feature at ``zero`` that weighs as much as its cells that are not stored.

    ``stats`` has n and n_stored; ``zero`` and ``value`` may use its other columns.
    """
    kept = cells.join(stats, "feature").select("feature", value.alias("x"), F.lit(1).cast("bigint").alias("weight"))
    mass = stats.where("n > n_stored").select("feature", zero.alias("x"), (F.col("n") - F.col("n_stored")).alias("weight"))
    return kept.unionByName(mass)
