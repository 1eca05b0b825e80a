"""Stack of a random forest and boosted trees under a logistic model.

The meta-model learns from out-of-fold probabilities; both base learners are
then fitted on all training rows. Fits are independent jobs, so a few run at
the same time and Spark shares the executors between them.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, replace
from contextvars import copy_context
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.config import DEEPEST, EnsembleConfig
from panelwright.operators.boosting import BoostedTrees, BoosterParams, SecondOrderBooster
from panelwright.operators.evaluate import classification_report, confusion, evaluate, ranking_metrics
from panelwright.operators.forest import MANY_TREES, ForestParams, GrownForest, ManyTrees, is_grown
from panelwright.operators.labels import class_codes, encode
from panelwright.operators.search import trial_scores
from panelwright.operators.split import stratified_folds
from panelwright.session import materialize, scratch
from panelwright.sources.state import read_config, write_config

log = logging.getLogger(__name__)

TOLERANCE = 1e-6


def forest(c: EnsembleConfig) -> RandomForestClassifier | ManyTrees:
    depth = DEEPEST if c.rf_max_depth is None else c.rf_max_depth
    by_level = RandomForestClassifier(
        featuresCol="features", labelCol="code", weightCol="w_rf", numTrees=c.rf_trees, maxDepth=depth,
        minInstancesPerNode=c.rf_min_leaf, featureSubsetStrategy="sqrt", maxBins=c.max_bins, seed=c.seed, maxMemoryInMB=1024,
    )
    if c.rf_trees < MANY_TREES or c.max_bins > 256:
        return by_level
    return ManyTrees(ForestParams(c.rf_trees, depth, c.rf_min_leaf, c.max_bins, c.seed), by_level)


def booster(c: EnsembleConfig) -> SecondOrderBooster:
    return SecondOrderBooster(BoosterParams(
        rounds=c.gbt_rounds, depth=c.gbt_max_depth, rate=c.gbt_learning_rate, subsample=c.gbt_subsample,
        colsample=c.gbt_colsample, bins=min(c.max_bins, 256), seed=c.seed,
    ))


def meta_model(c: EnsembleConfig, n_rows: int) -> LogisticRegression:
    """L2 penalty with inverse strength C: the loss here is a mean, hence C * n."""
    return LogisticRegression(
        featuresCol="meta", labelCol="code", regParam=1.0 / (c.meta_c * n_rows), elasticNetParam=0.0,
        standardization=False, maxIter=1000, tol=TOLERANCE, family="binomial",
    )


def _probability(model, rows: DataFrame, name: str) -> DataFrame:
    """Add P(positive) of a base model as a plain column."""
    if isinstance(model, BoostedTrees):
        return model.log_odds(rows, name).withColumn(name, 1.0 / (1.0 + F.exp(-F.col(name))))
    if isinstance(model, GrownForest):
        return model.probability(rows, name)
    used = model.copy()
    used.setRawPredictionCol(f"_{name}_raw").setProbabilityCol(f"_{name}_p").setPredictionCol(f"_{name}_y")
    out = used.transform(rows)
    return out.withColumn(name, vector_to_array(f"_{name}_p")[1]).drop(f"_{name}_raw", f"_{name}_p", f"_{name}_y")


@dataclass
class Weights:
    """Row weights from class counts: [fold][code] -> rows."""

    counts: dict[int, dict[int, int]]
    ratio: float | None = None  # given from outside, or that of these rows

    @property
    def total(self) -> dict[int, int]:
        out: dict[int, int] = {}
        for by_code in self.counts.values():
            for code, n in by_code.items():
                out[code] = out.get(code, 0) + n
        return out

    @property
    def positive_ratio(self) -> float:
        if self.ratio is not None:
            return self.ratio
        total = self.total
        if set(total) != {0, 1} or not total[1]:
            return 1.0
        return total[0] / total[1]

    def add(self, rows: DataFrame, without_fold: int | None) -> DataFrame:
        used = dict(self.total)
        if without_fold is not None:
            for code, n in self.counts.get(without_fold, {}).items():
                used[code] -= n
        n = sum(used.values())
        balanced = F.lit(1.0)
        for code, rows_of in used.items():
            if rows_of:
                balanced = F.when(F.col("code") == code, F.lit(n / (len(used) * rows_of))).otherwise(balanced)
        boosted = F.when(F.col("code") == 1, F.lit(self.positive_ratio)).otherwise(F.lit(1.0))
        return rows.withColumn("w_rf", balanced).withColumn("w_gbt", boosted)


def _in_parallel(spark: SparkSession, jobs: list[Callable], threads: int) -> list:
    pool = ThreadPool(max(1, min(threads, len(jobs))))
    inherit = inheritable_thread_target(spark)
    contexts = [copy_context() for _ in jobs]
    try:
        return pool.starmap(lambda context, job: context.run(job), list(zip(contexts, [inherit(job) for job in jobs])))
    finally:
        pool.close()


def _mean(aucs: list[float | None]) -> float:
    known = [auc for auc in aucs if auc is not None]
    return float(np.mean(known)) if known else float("-inf")


class StackedEnsemble:
    """Fit on ``(sample_id, label, features)``; predict on ``features``."""

    def __init__(self, config: EnsembleConfig | None = None) -> None:
        self.config = config or EnsembleConfig()
        self.rf: RandomForestClassificationModel | GrownForest | None = None
        self.gbt: BoostedTrees | None = None
        self.meta: LogisticRegressionModel | None = None
        self.classes: list[str] = []
        self.out_of_fold: DataFrame | None = None
        self.positive_ratio: float | None = None  # fixed for a search, else that of the rows

    # -- fitting ---------------------------------------------------------

    def fit(self, rows: DataFrame) -> StackedEnsemble:
        c = self.config
        codes = materialize(class_codes(rows), "classes")
        # Two classes are needed, so three rows are enough to see a fault.
        self.classes = [r.label for r in codes.orderBy("code").limit(3).collect()]
        if len(self.classes) != 2:
            raise ValueError(f"a stack needs exactly two classes; the labels have {self.classes}")
        folded = stratified_folds(encode(rows, codes), folds=c.folds, seed=c.seed)
        # Written first: tree jobs then run on partitions sized by bytes, and a
        # lost executor costs a read instead of the whole lineage.
        data = materialize(folded.select("sample_id", "code", "fold", "features"), "folds")
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._fit_coded(data)
        finally:
            data.unpersist()
        return self

    def _fit_coded(self, data: DataFrame) -> None:
        c = self.config
        counts: dict[int, dict[int, int]] = {}
        for r in data.groupBy("fold", "code").count().collect():  # folds * 2 rows
            counts.setdefault(r.fold, {})[r.code] = r["count"]
        weights = Weights(counts, self.positive_ratio)
        n_rows = sum(weights.total.values())

        def base(make: Callable, fold: int | None) -> Callable:
            part = data if fold is None else data.where(F.col("fold") != fold)
            return lambda: make(c).fit(weights.add(part, fold))

        slots = [*range(c.folds), None]
        models = _in_parallel(data.sparkSession, [base(make, f) for f in slots for make in (forest, booster)], c.parallelism)
        pairs = {slot: (models[2 * i], models[2 * i + 1]) for i, slot in enumerate(slots)}

        held_out = None
        for fold in range(c.folds):
            scored = self._base_scores(data.where(F.col("fold") == fold), *pairs[fold])
            scored = scored.select("sample_id", "fold", "code", "p_rf", "p_gbt")
            held_out = scored if held_out is None else held_out.unionByName(scored)
        self._fit_meta(held_out, n_rows)
        self.rf, self.gbt = pairs[None]

    def fit_parts(self, rows: DataFrame, parts: list[tuple[DataFrame, DataFrame]]) -> StackedEnsemble:
        """As ``fit``, with folds whose rows were made apart, such as by a screen of their own.

        ``parts`` has the rows to learn from and those to score, per fold;
        ``rows`` are all training rows, for the models that are kept.
        """
        c = self.config
        codes = materialize(class_codes(rows), "classes")
        self.classes = [r.label for r in codes.orderBy("code").limit(3).collect()]
        if len(self.classes) != 2:
            raise ValueError(f"a stack needs exactly two classes; the labels have {self.classes}")

        def coded(part: DataFrame) -> DataFrame:
            return materialize(encode(part, codes).select("sample_id", "code", "features"), "coded")

        def weighted(part: DataFrame) -> DataFrame:
            counts = {r.code: r["count"] for r in part.groupBy("code").count().collect()}  # two rows
            return Weights({0: counts}, self.positive_ratio).add(part, None)

        learned = [weighted(coded(part)) for part in [*(outside for outside, _ in parts), rows]]
        jobs = [lambda part=part, make=make: make(c).fit(part) for part in learned for make in (forest, booster)]
        models = _in_parallel(rows.sparkSession, jobs, c.parallelism)
        held_out = None
        for fold, (_, held) in enumerate(parts):
            scored = self._base_scores(coded(held), *models[2 * fold : 2 * fold + 2])
            scored = scored.select("sample_id", F.lit(fold).alias("fold"), "code", "p_rf", "p_gbt")
            held_out = scored if held_out is None else held_out.unionByName(scored)
        self._fit_meta(held_out, rows.count())
        self.rf, self.gbt = models[-2:]
        return self

    def _fit_meta(self, held_out: DataFrame, n_rows: int) -> None:
        self.out_of_fold = materialize(held_out, "out_of_fold")
        meta_rows = self.out_of_fold.withColumn("meta", array_to_vector(F.array("p_rf", "p_gbt")))
        self.meta = meta_model(self.config, n_rows).fit(meta_rows)

    @staticmethod
    def _base_scores(rows: DataFrame, rf, gbt) -> DataFrame:
        return _probability(gbt, _probability(rf, rows, "p_rf"), "p_gbt")

    # -- prediction ------------------------------------------------------

    def _fitted(self) -> None:
        if self.meta is None:
            raise RuntimeError("the stack is not fitted: it has no meta-model yet")

    def predict(self, rows: DataFrame) -> DataFrame:
        """Add probabilities (array in code order), score, code and prediction.

        Only narrow operations, so it also runs on a stream.
        """
        self._fitted()
        based = self._base_scores(rows, self.rf, self.gbt)
        based = based.withColumn("_meta", array_to_vector(F.array("p_rf", "p_gbt")))
        meta = self.meta.copy()
        meta.setFeaturesCol("_meta").setRawPredictionCol("_meta_raw")
        meta.setProbabilityCol("_meta_p").setPredictionCol("_meta_y")
        out = meta.transform(based).withColumn("probabilities", vector_to_array("_meta_p"))
        p = F.col("probabilities")
        names = F.array(*[F.lit(name) for name in self.classes])
        code = F.when(p[1] > p[0], 1).otherwise(0)
        return (
            out.withColumn("score", p[1])
            .withColumn("predicted_code", code)
            .withColumn("prediction", names[F.col("predicted_code")])
            .drop("_meta", "_meta_raw", "_meta_p", "_meta_y")
        )

    def evaluate(self, rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(metrics, per-class report, predictions) on labelled rows."""
        scored = materialize(
            self.predict(rows).select("sample_id", "label", "score", "prediction", "probabilities"), "predictions"
        )
        return evaluate(scored), classification_report(confusion(scored)), scored

    def importances(self, names: list[str]) -> DataFrame:
        """Gini importance of the forest per panel feature, largest first."""
        self._fitted()
        values = self.rf.featureImportances.toArray()
        if len(names) != len(values):
            raise ValueError(f"got {len(names)} names for {len(values)} features")
        spark = SparkSession.active()
        table = [(n, i, float(v)) for i, (n, v) in enumerate(zip(names, values))]
        out = spark.createDataFrame(table, "feature string, feature_pos int, importance double")
        return out.orderBy(F.desc("importance"), "feature_pos")

    # -- search ----------------------------------------------------------

    def tune(
        self, rows: DataFrame, trials: int | None = None, draws: list[EnsembleConfig] | None = None
    ) -> StackedEnsemble:
        """Random search for the best cross-validated ROC-AUC, then refit.

        ``draws`` replaces the random draws; ``search_results`` has one row per
        trial. The weight ratio of the classes is that of all ``rows`` in every
        fold. Where one task can hold the binned rows and all forests have many
        trees, the trials share their folds, bins and trees (``trial_scores``). Others
        run ``parallelism`` at a time; the tables of a fit are deleted as soon
        as it is scored. A fold with one class gives no score.
        """
        c = self.config
        draws = draws or draw_settings(c, trials or c.tune_trials)
        folded = stratified_folds(rows, folds=c.folds, seed=f"search-{c.seed}")
        data = materialize(folded.withColumnRenamed("fold", "search_fold"), "search").persist(StorageLevel.MEMORY_AND_DISK)
        labels = {r.label: r["count"] for r in data.groupBy("label").count().orderBy("label").limit(3).collect()}
        ratio = labels[min(labels)] / labels[max(labels)] if len(labels) == 2 else None

        def trial(drawn: EnsembleConfig) -> float:
            aucs = []
            for fold in range(c.folds):
                with scratch(data.sparkSession, "trial"):
                    stack = StackedEnsemble(replace(drawn, parallelism=1))
                    stack.positive_ratio = ratio
                    stack.fit(data.where(F.col("search_fold") != fold).drop("search_fold"))
                    scored = stack.predict(data.where(F.col("search_fold") == fold)).select("label", "score")
                    auc = ranking_metrics(scored).first().roc_auc
                aucs.append(auc)
            return _mean(aucs)

        with scratch(data.sparkSession, "search"):
            found = trial_scores(data, labels, ratio, c.folds, draws, c.parallelism)
        if found is None:
            jobs = [lambda drawn=drawn: trial(drawn) for drawn in draws]
            scores = _in_parallel(data.sparkSession, jobs, c.parallelism)
        else:
            scores = [_mean(aucs) for aucs in found]
        results = list(zip(range(len(draws)), draws, scores))
        data.unpersist()
        number, best, auc = max(results, key=lambda r: r[2])
        self.config = best
        self.best_trial, self.best_score = number, auc
        table = [
            (i, d.rf_trees, d.rf_max_depth, d.rf_min_leaf, d.gbt_rounds, d.gbt_max_depth,
             float(d.gbt_learning_rate), float(d.gbt_subsample), float(d.meta_c), score)
            for i, d, score in results
        ]
        self.search_results = rows.sparkSession.createDataFrame(
            table,
            "trial int, rf_trees int, rf_max_depth int, rf_min_leaf int, gbt_rounds int, gbt_max_depth int, "
            "gbt_learning_rate double, gbt_subsample double, meta_c double, mean_roc_auc double",
        )
        return self.fit(rows)

    # -- state -----------------------------------------------------------

    def save(self, path: str) -> None:
        self._fitted()
        if isinstance(self.rf, GrownForest):
            self.rf.save(f"{path}/rf")
        else:
            self.rf.write().overwrite().save(f"{path}/rf")
        self.gbt.save(f"{path}/gbt")
        self.meta.write().overwrite().save(f"{path}/meta")
        write_config(SparkSession.active(), f"{path}/config", self.config, {"classes": self.classes})

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> StackedEnsemble:
        config, extra = read_config(spark, f"{path}/config", EnsembleConfig)
        out = cls(config)
        out.classes = extra["classes"]
        grown = is_grown(spark, f"{path}/rf")
        out.rf = GrownForest.load(spark, f"{path}/rf") if grown else RandomForestClassificationModel.load(f"{path}/rf")
        out.gbt = BoostedTrees.load(f"{path}/gbt")
        out.meta = LogisticRegressionModel.load(f"{path}/meta")
        return out


# The ranges that the random search draws from.
# Whole numbers are drawn from low..high inclusive, the others evenly.
SEARCH_RANGES = {
    "rf_trees": (100, 599),
    "rf_max_depth": (None, 5, 10, 15, 20),
    "rf_min_leaf": (1, 7),
    "gbt_rounds": (100, 399),
    "gbt_max_depth": (3, 8),
    "gbt_learning_rate": (0.01, 0.30),
    "gbt_subsample": (0.6, 1.0),
    "meta_c": (0.01, 10.0),
}


def draw_settings(base: EnsembleConfig, trials: int, ranges: dict | None = None) -> list[EnsembleConfig]:
    """Seeded random draws; the class weight ratio is not searched."""
    rng = np.random.default_rng(base.seed)
    out = []
    for _ in range(trials):
        drawn = {}
        for name, span in {**SEARCH_RANGES, **(ranges or {})}.items():
            if name == "rf_max_depth":
                drawn[name] = span[int(rng.integers(len(span)))]
            elif isinstance(span[0], int):
                drawn[name] = int(rng.integers(span[0], span[1] + 1))
            else:
                drawn[name] = float(rng.uniform(*span))
        out.append(replace(base, **drawn))
    return out
