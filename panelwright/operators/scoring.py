"""Score records with a fitted bundle, on batch and streaming DataFrames.

A record is ``(patient_id STRING, expressions MAP<STRING, DOUBLE>)``. Everything
is a row-level expression: no explode, no grouping, so a stream needs no state.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.scalar import class_probabilities, log2_shift, zscore
from panelwright.operators.ensemble import StackedEnsemble
from panelwright.operators.tree_tables import NodeStack
from panelwright.plans.screening import FeatureScreen
from panelwright.sources.state import exists, read_table, write_table

RECORD_SCHEMA = "patient_id string, expressions map<string,double>"
SEPARATOR = "\x01"

# Kinds of refusal, as the status codes that callers know.
INVALID, MISSING, FAILED = 422, 400, 500

RESULT_COLUMNS = [
    "patient_id", "predicted_status", "risk_probability", "class_probabilities",
    "n_genes_received", "n_genes_used_by_model",
]


def _name_array(names: list[str]) -> Column:
    """One string literal, split once when the plan is optimised."""
    if not names:
        return F.array().cast("array<string>")
    return F.split(F.lit(SEPARATOR.join(names)), SEPARATOR)


def invalid_features(expressions: Column) -> Column:
    """Names whose value is null, negative, NaN or infinite."""

    def wrong(_, v):
        return v.isNull() | F.isnan(v) | (v < 0) | (v == F.lit(float("inf")))

    return F.map_keys(F.map_filter(expressions, wrong))


def missing_features(expressions: Column, required: list[str]) -> Column:
    return F.array_except(_name_array(required), F.map_keys(expressions))


def overflowing(expressions: Column, scaled: list[str]) -> Column:
    """Names that are scaled and whose value has no finite single-precision form."""
    big = F.map_filter(expressions, lambda _, v: v.cast("float") == F.lit(float("inf")).cast("float"))
    return F.array_intersect(F.map_keys(big), _name_array(scaled))


def panel_values(expressions: Column, panel: list[tuple[str, float, float]], c) -> Column:
    """Scaled panel values in panel order; no other feature is transformed."""
    names = [name for name, _, _ in panel]
    # Cut the map down by a hashed name set first: map lookups are linear.
    small = F.map_filter(expressions, lambda k, _: k.isin(names))

    def scaled(name: str, mean: float, std: float) -> Column:
        logged = log2_shift(small[F.lit(name)].cast("float"), c.pseudocount)
        return zscore(logged, F.lit(mean), F.lit(std), c.with_mean, c.with_std).cast("double")

    return F.array(*[scaled(*entry) for entry in panel])


def _listed(names: Column, n: int) -> Column:
    return F.concat_ws(", ", F.slice(names, 1, n))


@dataclass
class ScoringBundle:
    """Everything that scoring needs, loaded once per query."""

    screen: FeatureScreen
    stack: StackedEnsemble | NodeStack
    classes: list[str]
    required: list[str]  # every raw feature seen at fit, in input order
    scaled: list[str]  # those that reach the scaler
    panel: list[tuple[str, float, float]]

    @classmethod
    def of(cls, screen: FeatureScreen, stack: StackedEnsemble | NodeStack) -> ScoringBundle:
        stats = screen.stats.orderBy("feature_pos").select("feature", "kept_var").collect()  # one row per feature
        required = [r.feature for r in stats]
        if any(SEPARATOR in name for name in required):
            raise ValueError("feature names must not contain control characters")
        return cls(screen, stack, list(stack.classes), required, [r.feature for r in stats if r.kept_var], screen.panel())

    def save(self, path: str) -> None:
        self.screen.save(f"{path}/screen")
        self.stack.save(f"{path}/ensemble")
        spark = self.screen.stats.sparkSession
        codes = [(name, i) for i, name in enumerate(self.classes)]
        write_table(spark.createDataFrame(codes, "label string, code int").coalesce(1), f"{path}/classes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ScoringBundle:
        parts = ("screen/preprocessor", "screen/selector", "ensemble", "classes")
        for part in parts:
            if not exists(spark, f"{path}/{part}"):
                raise FileNotFoundError(f"scoring bundle lacks {path}/{part}; fit and save the models first")
        codes = read_table(spark, f"{path}/classes").orderBy("code").limit(3).collect()
        if [r.code for r in codes] != [0, 1]:
            raise RuntimeError(f"scoring needs exactly the classes [0, 1]; found {[r.code for r in codes]}")
        kind = NodeStack if exists(spark, f"{path}/ensemble/weights") else StackedEnsemble
        return cls.of(FeatureScreen.load(spark, f"{path}/screen"), kind.load(spark, f"{path}/ensemble"))

    def as_tables(self, spark: SparkSession) -> ScoringBundle:
        """The same bundle with its trees as node tables, scored without Python workers."""
        return self if isinstance(self.stack, NodeStack) else replace(self, stack=NodeStack.of(spark, self.stack))

    def triage(self, records: DataFrame) -> DataFrame:
        """Add ``reject_code`` and ``reject_reason``; both null for good records."""
        m = F.col("expressions")
        checked = records.withColumns({
            "_invalid": invalid_features(m),
            "_missing": missing_features(m, self.required),
            "_big": overflowing(m, self.scaled),
        })
        no_id = F.coalesce(F.length("patient_id"), F.lit(0)) == 0
        empty = F.coalesce(F.size(F.map_keys(m)), F.lit(0)) <= 0
        bad, gone, big = F.col("_invalid"), F.col("_missing"), F.col("_big")
        cases = [
            (no_id, INVALID, F.lit("patient_id must not be empty")),
            (empty, INVALID, F.lit("expressions must not be empty")),
            (F.size(bad) > 0, INVALID,
             F.concat(F.size(bad).cast("string"), F.lit(" value(s) below zero or not finite, of: "), _listed(bad, 5))),
            (F.size(gone) > 0, MISSING,
             F.concat(F.size(gone).cast("string"), F.lit(" needed value(s) absent, of: "), _listed(F.array_sort(gone), 10))),
            (F.size(big) > 0, FAILED, F.lit("a value is out of range for the fitted steps")),
        ]
        code, reason = F.lit(None).cast("int"), F.lit(None).cast("string")
        for test, number, text in reversed(cases):
            code = F.when(test, F.lit(number)).otherwise(code)
            reason = F.when(test, text).otherwise(reason)
        return checked.withColumns({"reject_code": code, "reject_reason": reason}).drop("_invalid", "_missing", "_big")

    def score(self, records: DataFrame) -> DataFrame:
        """Every record with its result, or with the reason it was refused."""
        triaged = self.triage(records)
        ok = F.col("reject_code").isNull()
        width = len(self.panel)
        values = panel_values(F.col("expressions"), self.panel, self.screen.preprocessor.config)
        # Refused records go through the model as zeros; their result is blanked.
        filler = F.array_repeat(F.lit(0.0), width)
        ready = triaged.withColumn("features", array_to_vector(F.when(ok, values).otherwise(filler)))
        out = self.stack.predict(ready)
        return out.select(
            "patient_id",
            F.when(ok, F.col("prediction")).alias("predicted_status"),
            F.when(ok, F.round("score", 6)).alias("risk_probability"),
            F.when(ok, class_probabilities(self.classes, F.col("probabilities"))).alias("class_probabilities"),
            F.when(ok, F.size(F.map_keys("expressions"))).alias("n_genes_received"),
            F.when(ok, F.lit(width)).alias("n_genes_used_by_model"),
            "reject_code",
            "reject_reason",
        )


READINESS_SCHEMA = (
    "status string, models_loaded boolean, n_expected_genes int, n_model_input_genes int, classes array<string>"
)


def readiness(spark: SparkSession, bundle: ScoringBundle | None) -> DataFrame:
    """One row: whether scoring can start, and what it expects."""
    row = ("unavailable", False, None, None, None)
    if bundle is not None:
        row = ("ok", True, len(bundle.required), len(bundle.panel), bundle.classes)
    return spark.createDataFrame([row], READINESS_SCHEMA)


def accepted(scored: DataFrame) -> DataFrame:
    return scored.where("reject_code is null").select(*RESULT_COLUMNS)


def rejected(scored: DataFrame) -> DataFrame:
    return scored.where("reject_code is not null").select("patient_id", "reject_code", "reject_reason")
