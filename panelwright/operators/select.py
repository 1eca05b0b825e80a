"""Cuts on the table of feature statistics, and applying a learned mask."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_by_mad(scores: DataFrame, n: int) -> DataFrame:
    """Exactly n features; ties at the cut go to the earlier position."""
    return scores.orderBy(F.desc("mad"), F.asc("feature_pos")).limit(n)


def top_by_score(scores: DataFrame, k: int, score: str = "score") -> DataFrame:
    """Exactly k features; NaN ranks last, ties go to the later position."""
    value = F.col(score)
    usable = F.when(value.isNull() | F.isnan(value), F.lit(float("-inf"))).otherwise(value)
    return scores.orderBy(usable.desc(), F.desc("feature_pos")).limit(k)


def keep(matrix: DataFrame, stats: DataFrame, flag: str) -> DataFrame:
    """Cells of the features that carry ``flag``; the mask is not recomputed."""
    return matrix.join(stats.where(F.col(flag)).select("feature"), "feature", "left_semi")


def surviving_names(stats: DataFrame, flag: str) -> DataFrame:
    """Names of the survivors, in input order."""
    return stats.where(F.col(flag)).orderBy("feature_pos").select("feature")


def funnel(stats: DataFrame) -> DataFrame:
    """Features left after each stage, and dropped by it."""
    order = [("raw", F.lit(True)), ("expressed", F.col("kept_expr")), ("variable", F.col("kept_var")),
             ("mad", F.col("kept_mad")), ("panel", F.col("kept_panel"))]
    present = [(name, flag) for name, flag in order if name == "raw" or _has(stats, name)]
    counts = stats.agg(*[F.count_if(flag).alias(name) for name, flag in present])
    rows = []
    for i, (name, _) in enumerate(present):
        before = present[i - 1][0] if i else name
        rows.append(
            F.struct(
                F.lit(i).alias("stage_no"),
                F.lit(name).alias("stage"),
                F.col(name).alias("n_features"),
                (F.col(before) - F.col(name)).alias("n_removed"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def _has(stats: DataFrame, stage: str) -> bool:
    flags = {"expressed": "kept_expr", "variable": "kept_var", "mad": "kept_mad", "panel": "kept_panel"}
    return flags[stage] in stats.columns


def pair_scores(names: DataFrame, scores: DataFrame, position: str = "feature_pos") -> DataFrame:
    """Pair names and scores by position; unequal lengths are an error."""
    paired = names.join(scores, position, "full_outer")
    absent = F.col("feature").isNull() | F.col("score").isNull()
    if paired.where(absent).limit(1).count():
        raise ValueError("names and scores have different lengths")
    return paired
