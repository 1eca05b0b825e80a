"""Fit on the training rows, replay anywhere: preprocessing and selection.

The fitted state is one table with a row per feature. Transforming is a join
with it, so only the features that are asked for are ever computed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.config import PreprocessConfig, SelectConfig
from panelwright.functions.scalar import log2_shift, zscore
from panelwright.operators.checks import mark_sums, marks_match, raise_on_domain, require_long, sample_marks
from panelwright.operators.moments import class_moments, feature_moments, log2_moments
from panelwright.operators.order_stats import mad
from panelwright.operators.quantile_sketch import sketched_mad
from panelwright.operators.running import ranks
from panelwright.operators.scorers import SCORERS
from panelwright.operators.select import funnel, keep, surviving_names, top_by_mad, top_by_score
from panelwright.operators.sparse import SparseMatrix, sparse_moments, weighted_values
from panelwright.session import materialize
from panelwright.sources.matrix import densify
from panelwright.sources.state import read_config, read_table, write_config, write_table


def with_positions(stats: DataFrame) -> DataFrame:
    """Positions 0, 1, ... in the order of the source, or of names if it gave none."""
    placed = ranks(stats, [("feature_pos", False), ("feature", False)], name="_place")
    return placed.withColumn("feature_pos", (F.col("_place") - 1).cast("int")).drop("_place")


class Preprocessor:
    """log2 -> expressed fraction -> variance -> z-score."""

    def __init__(self, config: PreprocessConfig | None = None) -> None:
        self.config = config or PreprocessConfig()
        self.stats: DataFrame | None = None
        self.n_rows = 0
        self.n_features = 0

    def fit(self, train: DataFrame | SparseMatrix, samples: DataFrame | None = None) -> Preprocessor:
        """Learn from training cells, or from the stored cells of a sparse matrix.

        ``samples`` are the sample ids of a long matrix where they are known; without
        them they are looked for in the cells.
        """
        c = self.config
        if isinstance(train, SparseMatrix):
            moments, samples = sparse_moments(train, self._logged, c.min_expression), train.samples
        else:
            require_long(train)
            moments = log2_moments(train, c.pseudocount, c.min_expression)
        stats = materialize(feature_moments(moments), "feature_stats")
        samples = sample_marks(train if samples is None else samples)
        expressed = F.col("frac_expressed") >= c.min_sample_fraction
        variable = expressed & (F.col("var_pop") > c.variance_threshold)
        seen = stats.agg(
            F.count("*").alias("features"),
            F.coalesce(F.sum("n_missing"), F.lit(0)).alias("missing"),
            F.coalesce(F.sum("n_negative"), F.lit(0)).alias("negative"),
            F.coalesce(F.sum(F.when(expressed, F.col("n_infinite"))), F.lit(0)).alias("infinite"),
            F.count_if(~marks_match(samples)).alias("incomplete"),
            F.max("n").alias("rows"),
            F.count_if(expressed).alias("expressed"),
            F.count_if(variable).alias("variable"),
        ).first()
        if not seen.features:
            raise ValueError("the training matrix is empty")
        raise_on_domain(seen.missing, seen.negative)
        if seen.incomplete:
            raise ValueError(f"the matrix is not complete: {seen.incomplete} features are not given once for each sample")
        if not seen.expressed:
            raise ValueError(
                f"none of {seen.features} features reaches min_expression={c.min_expression} "
                f"in a share of {c.min_sample_fraction} of the samples"
            )
        if seen.infinite:
            raise ValueError("matrix contains infinite values: they cannot be scaled")
        if not seen.variable:
            raise ValueError(f"no feature has variance above {c.variance_threshold}")
        self.n_rows, self.n_features = seen.rows, seen.features
        placed = with_positions(stats).withColumn("kept_expr", expressed).withColumn("kept_var", variable)
        self.stats = materialize(placed, "feature_stats")
        return self

    def _logged(self, value: Column) -> Column:
        return log2_shift(value, self.config.pseudocount)

    def _scaled(self, logged: Column) -> Column:
        return zscore(logged, F.col("mean"), F.col("std_pop"), self.config.with_mean, self.config.with_std)

    def bounds(self, stats: DataFrame) -> DataFrame:
        """feature, n, and the range of its scaled values: scaling keeps their order."""
        return stats.select("feature", "n", self._scaled(F.col("low")).alias("low"), self._scaled(F.col("high")).alias("high"))

    def sparse_values(self, matrix: SparseMatrix, stats: DataFrame) -> DataFrame:
        """(feature, x, weight) of the scaled features in ``stats``, zeros as one point each."""
        zero = self._scaled(self._logged(F.lit(0.0).cast("float")))
        return weighted_values(matrix.cells, stats, zero, self._scaled(self._logged(F.col("value"))))

    def fitted(self) -> DataFrame:
        if self.stats is None:
            raise RuntimeError("Preprocessor is not fitted: call fit() on the training rows first")
        return self.stats

    def check(self, matrix: DataFrame) -> None:
        """Domain and feature-set checks of new data, in one pass over it."""
        value = F.col("value")
        bad = value.isNull() | F.isnan(value)
        samples = sample_marks(matrix)
        seen = matrix.groupBy("feature").agg(
            F.count("*").alias("n"),
            *mark_sums(),
            F.count_if(bad).alias("missing"),
            F.count_if((value < 0) & ~bad).alias("negative"),
        )
        fitted = self.fitted().select("feature", F.lit(1).alias("fitted"))
        row = (
            seen.join(fitted, "feature", "full_outer")
            .agg(
                F.sum("missing").alias("missing"),
                F.sum("negative").alias("negative"),
                F.count_if(F.col("fitted").isNull() | F.col("n").isNull() | ~marks_match(samples)).alias("different"),
            )
            .first()
        )
        raise_on_domain(row.missing or 0, row.negative or 0)
        if row.different:
            raise ValueError("Column mismatch: the matrix does not have the fitted features for each sample")

    def transform(self, matrix: DataFrame, flag: str = "kept_var", stats: DataFrame | None = None,
                  check: bool = True) -> DataFrame:
        """Scaled cells ``(sample_id, feature, feature_pos, value[, label])`` of
        the features that carry ``flag``."""
        table = stats if stats is not None else self.fitted()
        require_long(matrix)
        if check:
            self.check(matrix)
        used = table.where(F.col(flag)).select("feature", F.col("feature_pos").alias("_pos"), "mean", "std_pop")
        scaled = self._scaled(self._logged(F.col("value")))
        extra = ["label"] if "label" in matrix.columns else []
        return matrix.join(used, "feature").select(
            "sample_id", "feature", F.col("_pos").alias("feature_pos"), scaled.alias("value"), *extra
        )

    def fit_transform(self, train: DataFrame) -> DataFrame:
        return self.fit(train).transform(train, check=False)

    def names(self) -> DataFrame:
        return surviving_names(self.fitted(), "kept_var")

    def save(self, path: str) -> None:
        write_table(self.fitted(), f"{path}/stats")
        counts = {"n_rows": self.n_rows, "n_features": self.n_features}
        write_config(self.fitted().sparkSession, f"{path}/config", self.config, counts)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preprocessor:
        config, counts = read_config(spark, f"{path}/config", PreprocessConfig)
        out = cls(config)
        out.stats = read_table(spark, f"{path}/stats")
        out.n_rows, out.n_features = counts["n_rows"], counts["n_features"]
        return out


class Selector:
    """Top n by median absolute deviation, then top k by a supervised score."""

    def __init__(self, config: SelectConfig | None = None) -> None:
        self.config = config or SelectConfig()
        self.stats: DataFrame | None = None

    def fit(
        self, scaled: DataFrame, labels: DataFrame | None = None, known: DataFrame | None = None, bounds: DataFrame | None = None
    ) -> Selector:
        """Learn both cuts from scaled training cells.

        ``labels`` gives sample_id and label when ``scaled`` has no label.
        ``known`` is the table of a fitted Preprocessor: its F score is used,
        since scaling does not change it; ``bounds`` are then those of its values.
        """
        require_long(scaled)
        c = self.config
        if labels is not None:
            scaled = _attach_labels(scaled, labels)
        if "label" not in scaled.columns:
            raise ValueError("supervised selection needs a label")
        if known is None:
            stats = materialize(feature_moments(class_moments(scaled)), "feature_stats")
            stats = materialize(with_positions(stats), "feature_stats")
            bounds = stats.select("feature", "n", "low", "high")
        else:
            stats = known.where("kept_var")
        cells = scaled.select("sample_id", "feature", F.col("value").alias("x"), "label")
        return self._choose(stats, known, cells, bounds, lambda _: cells)

    def fit_sparse(self, matrix: SparseMatrix, preprocessor: Preprocessor) -> Selector:
        """As ``fit`` on the scaled cells of a sparse matrix, from its stored cells.

        Only the neighbour scorer needs the cells of its features, those that pass the
        MAD cut, one by one; their zeros are filled in then.
        """
        known = preprocessor.fitted()
        stats = known.where("kept_var")
        values = preprocessor.sparse_values(matrix, stats)

        def filled(survivors: DataFrame) -> DataFrame:
            few = survivors.select("feature")
            dense = densify(matrix.cells.join(few, "feature", "left_semi"), matrix.samples, few)
            scaled = preprocessor.transform(dense, stats=known, check=False)
            return scaled.withColumnRenamed("value", "x").join(matrix.samples, "sample_id")

        return self._choose(stats, known, values, preprocessor.bounds(stats), filled, "weight")

    def _choose(self, stats, known, values, bounds, cells_of, weight: str | None = None) -> Selector:
        """Both cuts, on ``values`` (feature, x and a weight) with known bounds;
        ``cells_of(survivors)`` gives the cells for a scorer that needs them."""
        c = self.config
        n_features = stats.count()
        if c.n_mad >= n_features:
            raise ValueError(f"n_mad ({c.n_mad}) must be less than the number of features ({n_features})")
        if c.spread == "sketch":
            found = sketched_mad(values, weight=weight).drop("error")
        else:
            found = mad(values, weight=weight, bounds=bounds)
        spread = materialize(found, "mad")
        # From here on every input is a small written table.
        scored = stats.drop("median", "mad").join(spread, "feature")
        survivors = top_by_mad(scored, c.n_mad)
        if c.scorer == "anova_f":
            scores = survivors.withColumn("score", F.col("f_score"))
        else:
            survivors = materialize(survivors, "survivors")
            picked = cells_of(survivors).join(survivors.select("feature"), "feature", "left_semi")
            scores = materialize(survivors.join(SCORERS[c.scorer](picked, c.seed), "feature"), "scores")
        panel = top_by_score(scores, c.k_best).select("feature", F.lit(True).alias("kept_panel"))
        marks = scores.select("feature", F.lit(True).alias("kept_mad"), "score").join(panel, "feature", "left")
        base = known if known is not None else stats
        self.stats = materialize(
            base.drop("median", "mad")
            .join(spread, "feature", "left")
            .join(marks, "feature", "left")
            .withColumn("kept_mad", F.coalesce("kept_mad", F.lit(False)))
            .withColumn("kept_panel", F.coalesce("kept_panel", F.lit(False))),
            "feature_stats",
        )
        return self

    def fitted(self) -> DataFrame:
        if self.stats is None:
            raise RuntimeError("Selector is not fitted: call fit() on the training rows first")
        return self.stats

    def transform(self, scaled: DataFrame) -> DataFrame:
        require_long(scaled)
        return keep(scaled, self.fitted(), "kept_panel")

    def names(self) -> DataFrame:
        return surviving_names(self.fitted(), "kept_panel")

    def mad_scores(self) -> DataFrame:
        """Every input feature, widest spread first."""
        return (
            self.fitted().where("mad is not null").orderBy(F.desc("mad"), "feature_pos").select("feature", "mad")
        )

    def best_scores(self, n: int | None = None) -> DataFrame:
        """Supervised score of the features that passed the MAD cut."""
        usable = F.when(F.isnan("score"), F.lit(float("-inf"))).otherwise(F.col("score"))
        out = self.fitted().where("kept_mad").orderBy(usable.desc(), F.desc("feature_pos")).select("feature", "score")
        return out if n is None else out.limit(n)

    def save(self, path: str) -> None:
        write_table(self.fitted(), f"{path}/stats")
        write_config(self.fitted().sparkSession, f"{path}/config", self.config)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Selector:
        config, _ = read_config(spark, f"{path}/config", SelectConfig)
        out = cls(config)
        out.stats = read_table(spark, f"{path}/stats")
        return out


def _attach_labels(scaled: DataFrame, labels: DataFrame) -> DataFrame:
    """Join labels; samples and labels must be the same set."""
    have = scaled.select("sample_id").distinct().withColumn("_x", F.lit(1))
    given = labels.groupBy("sample_id").agg(F.count("*").alias("_y"))
    wrong = have.join(given, "sample_id", "full_outer").where("_x is null or _y is null or _y > 1")
    if wrong.limit(1).count():
        raise ValueError("the samples of the matrix and of the labels differ")
    return scaled.join(labels.select("sample_id", "label"), "sample_id")


class FeatureScreen:
    """Preprocessor and Selector fitted together."""

    def __init__(self, preprocess: PreprocessConfig | None = None, select: SelectConfig | None = None) -> None:
        self.preprocessor = Preprocessor(preprocess)
        self.selector = Selector(select)
        self._panel: list[tuple[str, float, float]] | None = None

    def fit(self, train: DataFrame | SparseMatrix, samples: DataFrame | None = None) -> FeatureScreen:
        """``samples`` as of ``Preprocessor.fit``."""
        self._panel = None
        pre = self.preprocessor.fit(train, samples)
        if isinstance(train, SparseMatrix):
            self.selector.fit_sparse(train, pre)
        else:
            kept = pre.bounds(pre.fitted().where("kept_var"))
            self.selector.fit(pre.transform(train, check=False), known=pre.stats, bounds=kept)
        return self

    @property
    def stats(self) -> DataFrame:
        return self.selector.fitted()

    def transform(self, matrix: DataFrame | SparseMatrix, check: bool = True) -> DataFrame:
        """Scaled cells of the panel; no other feature is computed or, on files
        that are clustered by feature, read. Zeros of a sparse matrix are filled in for
        the panel alone."""
        if isinstance(matrix, SparseMatrix):
            names = F.col("feature").isin([name for name, _, _ in self.panel()])
            wanted = densify(matrix.cells.where(names), matrix.samples, self.stats.where("kept_panel"))
            scaled = self.preprocessor.transform(wanted, "kept_panel", self.stats, check=False)
            return scaled.join(matrix.samples, "sample_id")
        if check:
            self.preprocessor.check(matrix)
        # At most k_best names: they go to the scan as a filter.
        wanted = matrix.where(F.col("feature").isin([name for name, _, _ in self.panel()]))
        return self.preprocessor.transform(wanted, "kept_panel", self.stats, check=False)

    def panel(self) -> list[tuple[str, float, float]]:
        """(name, mean, std) of the panel in input order; at most k_best rows."""
        if self._panel is None:
            rows = self.stats.where("kept_panel").orderBy("feature_pos").select("feature", "mean", "std_pop").collect()
            self._panel = [(r.feature, r.mean, r.std_pop) for r in rows]
        return self._panel

    def funnel(self) -> DataFrame:
        return funnel(self.stats)

    def save(self, path: str) -> None:
        self.preprocessor.save(f"{path}/preprocessor")
        self.selector.save(f"{path}/selector")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureScreen:
        out = cls()
        out.preprocessor = Preprocessor.load(spark, f"{path}/preprocessor")
        out.selector = Selector.load(spark, f"{path}/selector")
        return out
