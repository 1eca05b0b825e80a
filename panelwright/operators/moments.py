"""One pass over the long matrix for every moment-based statistic.

``class_moments`` aggregates once per (feature, class) with map-side partial
aggregation. Expressed fraction, variance, scaling and the ANOVA F score all
follow from that small table, because a z-score does not change F.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.scalar import log2_shift
from panelwright.operators.checks import MARKS, mark_sums


def class_moments(
    matrix: DataFrame, transformed: Column | None = None, min_expression: float = 1.0
) -> DataFrame:
    """Moments of ``transformed`` (default: the raw value) per feature and class.

    ``matrix`` has sample_id, feature, value and optionally label and
    feature_pos. Checks on the raw value are counted in the same pass.
    """
    raw = F.col("value")
    x = raw if transformed is None else transformed
    bad = raw.isNull() | F.isnan(raw)
    label = F.col("label") if "label" in matrix.columns else F.lit(None).cast("string")
    pos = F.col("feature_pos") if "feature_pos" in matrix.columns else F.lit(None).cast("int")
    cells = matrix.select(
        "sample_id", "feature", label.alias("label"), pos.alias("_pos"), raw.alias("_raw"), bad.alias("_bad"), x.cast("float").alias("_x")
    )
    good = F.when(~F.col("_bad"), F.col("_x").cast("double"))
    return cells.groupBy("feature", "label").agg(
        F.min("_pos").alias("feature_pos"),
        F.count("*").alias("n"),
        *mark_sums(),
        F.count_if("_bad").alias("n_missing"),
        F.count_if((F.col("_raw") < 0) & ~F.col("_bad")).alias("n_negative"),
        F.count_if(F.abs(good) == F.lit(float("inf"))).alias("n_infinite"),
        F.count_if(F.col("_raw") != 0).alias("n_nonzero"),
        F.count_if(F.col("_x") >= F.lit(min_expression).cast("float")).alias("n_expressed"),
        F.avg(good).alias("mean"),
        F.var_pop(good).alias("var_pop"),
        F.min(good).alias("low"),
        F.max(good).alias("high"),
    )


def feature_moments(moments: DataFrame) -> DataFrame:
    """Combine the classes of each feature: pooled mean, variance and F.

    Deviations are taken from the grand mean in a second step; the shortcut
    with squared means cancels on data that is not centred.
    """
    of_feature = Window.partitionBy("feature")  # one row per class
    grand = (F.sum(F.col("n") * F.col("mean")).over(of_feature)) / F.sum("n").over(of_feature)
    parts = moments.withColumn("_shift", F.col("mean") - grand)
    within = F.col("n") * F.col("var_pop")
    between = F.col("n") * F.col("_shift") * F.col("_shift")
    stored = [c for c in ("n_stored",) if c in moments.columns]  # of a sparse matrix
    total = parts.groupBy("feature").agg(
        F.min("feature_pos").alias("feature_pos"),
        F.sum("n").alias("n"),
        *[F.sum(c).alias(c) for c in stored],
        F.count("*").alias("n_classes"),
        *[F.sum(mark).alias(mark) for mark in MARKS],
        F.sum("n_missing").alias("n_missing"),
        F.sum("n_negative").alias("n_negative"),
        F.sum("n_infinite").alias("n_infinite"),
        F.sum("n_nonzero").alias("n_nonzero"),
        F.sum("n_expressed").alias("n_expressed"),
        F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("mean"),
        F.sum(within).alias("_ssw"),
        F.sum(between).alias("_ssb"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    constant = F.col("low") == F.col("high")
    n, k = F.col("n"), F.col("n_classes")
    f_score = (
        F.when(constant | (k < 2) | (n <= k), F.lit(float("nan")))
        .when(F.col("_ssw") == 0, F.lit(float("inf")))
        .otherwise(F.try_divide(F.col("_ssb") / (k - 1), F.col("_ssw") / (n - k)))
    )
    variance = F.when(constant, F.lit(0.0)).otherwise((F.col("_ssw") + F.col("_ssb")) / n)
    return total.select(
        "feature",
        "feature_pos",
        "n",
        *MARKS,
        "n_missing",
        "n_negative",
        "n_infinite",
        "n_nonzero",
        (F.col("n_expressed") / n).alias("frac_expressed"),
        F.when(constant, F.col("low")).otherwise(F.col("mean")).alias("mean"),
        variance.alias("var_pop"),
        F.sqrt(variance).alias("std_pop"),
        "low",
        "high",
        f_score.alias("f_score"),
        *stored,
    )


def log2_moments(matrix: DataFrame, pseudocount: float = 1.0, min_expression: float = 1.0) -> DataFrame:
    """Moments of ``log2(value + pseudocount)``."""
    return class_moments(matrix, log2_shift(F.col("value"), pseudocount), min_expression)
