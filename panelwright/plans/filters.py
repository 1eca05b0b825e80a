"""The single filters, for use outside the preprocessor and the selector.

Both learn a mask from training cells and apply it unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.config import PreprocessConfig
from panelwright.operators.checks import check_features, require_long
from panelwright.operators.moments import class_moments, feature_moments
from panelwright.operators.order_stats import mad
from panelwright.operators.select import keep, surviving_names, top_by_mad
from panelwright.plans.screening import with_positions
from panelwright.session import materialize
from panelwright.sources.matrix import arrays_to_matrix


class FeatureFilter:
    stats: DataFrame | None = None

    def fitted(self) -> DataFrame:
        if self.stats is None:
            raise RuntimeError(f"{type(self).__name__} is not fitted: call fit() on the training rows first")
        return self.stats

    def transform(self, matrix: DataFrame) -> DataFrame:
        stats = self.fitted()
        require_long(matrix)
        check_features(matrix, stats)
        return keep(matrix, stats, "kept")

    def names(self) -> DataFrame:
        return surviving_names(self.fitted(), "kept")

    def n_removed(self) -> int:
        return self.fitted().where("not kept").count()


class ExpressionFilter(FeatureFilter):
    """Keep features expressed in enough samples; values are logs already."""

    def __init__(self, min_expression: float = 1.0, min_sample_fraction: float = 0.2) -> None:
        self.config = PreprocessConfig(min_expression=min_expression, min_sample_fraction=min_sample_fraction)

    def fit(self, matrix: DataFrame) -> ExpressionFilter:
        require_long(matrix)
        c = self.config
        stats = materialize(feature_moments(class_moments(matrix.drop("label"), None, c.min_expression)), "expressed")
        kept = F.col("frac_expressed") >= c.min_sample_fraction
        seen = stats.agg(F.count("*").alias("n"), F.count_if(kept).alias("kept")).first()
        if not seen.kept:
            raise ValueError(f"none of {seen.n} features reaches {c.min_expression} in enough samples")
        self.stats = with_positions(stats).withColumn("kept", kept)
        return self

    def transform_arrays(self, rows: DataFrame, sample: str, values: str) -> DataFrame:
        """Unnamed arrays of the fitted width take the fitted names."""
        return keep(arrays_to_matrix(rows, sample, values, self.fitted()), self.fitted(), "kept")


class MadFilter(FeatureFilter):
    """Keep the n features with the largest median absolute deviation."""

    def __init__(self, n: int = 2000) -> None:
        self.n = n

    def fit(self, matrix: DataFrame) -> MadFilter:
        require_long(matrix)
        moments = feature_moments(class_moments(matrix.drop("label")))
        stats = materialize(moments.select("feature", "feature_pos", "n"), "features")
        n_features = stats.count()
        if self.n >= n_features:
            raise ValueError(f"n ({self.n}) must be less than the number of features ({n_features})")
        spread = materialize(mad(matrix.withColumnRenamed("value", "x")), "mad")
        scored = with_positions(stats).join(spread, "feature")
        top = top_by_mad(scored, self.n).select("feature", F.lit(True).alias("kept"))
        marked = scored.join(top, "feature", "left").withColumn("kept", F.coalesce("kept", F.lit(False)))
        self.stats = materialize(marked, "mad_filter")
        return self

    def scores(self) -> DataFrame:
        return self.fitted().orderBy(F.desc("mad"), "feature_pos").select("feature", "mad")
