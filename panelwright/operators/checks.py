"""Checks that a matrix must pass before anything is learned from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

LONG_COLUMNS = ("sample_id", "feature", "value")


def require_long(matrix: DataFrame, *more: str) -> None:
    """Error unless ``matrix`` is a DataFrame in long form."""
    if not isinstance(matrix, DataFrame):
        raise TypeError(f"expected a DataFrame; got {type(matrix).__name__}")
    absent = [c for c in (*LONG_COLUMNS, *more) if c not in matrix.columns]
    if absent:
        raise TypeError(f"expected a long matrix; it lacks {absent}")


def domain_counts(matrix: DataFrame) -> DataFrame:
    """One row: cells, missing (null or NaN) and negative cells."""
    value = F.col("value")
    bad = value.isNull() | F.isnan(value)
    return matrix.agg(
        F.count("*").alias("n_cells"),
        F.count_if(bad).alias("n_missing"),
        F.count_if((value < 0) & ~bad).alias("n_negative"),
    )


def raise_on_domain(n_missing: int, n_negative: int) -> None:
    if n_missing:
        raise ValueError(f"matrix contains {n_missing} NaN or null values")
    if n_negative:
        raise ValueError(f"matrix contains {n_negative} negative values")


def check_domain(matrix: DataFrame) -> None:
    """Error on null, NaN or negative values; +inf passes."""
    row = domain_counts(matrix).first()
    raise_on_domain(row.n_missing, row.n_negative)


MARKS = ("mark_0", "mark_1")


def mark_sums() -> list[Column]:
    """Aggregates that tell, with the count, which samples a group has once each.

    Two hashes of the sample key, 31 bits each, so that sums over 2^32 samples fit.
    """
    return [
        F.sum(F.shiftright(F.xxhash64(F.lit(i), F.col("sample_id")), 32)).alias(name) for i, name in enumerate(MARKS)
    ]


def sample_marks(matrix: DataFrame) -> Row:
    """Number of samples and the sums of their marks."""
    return matrix.select("sample_id").distinct().agg(F.count("*").alias("n"), *mark_sums()).first()


def marks_match(samples: Row) -> Column:
    """Whether a group (``n`` and mark sums) has every sample exactly once.

    A missing and a repeated cell leave the count alone, but not the sums.
    """
    same = F.col("n") == samples.n
    for name in MARKS:
        same = same & (F.col(name) == F.lit(samples[name]))
    return F.coalesce(same, F.lit(False))


def incomplete_samples(matrix: DataFrame) -> DataFrame:
    """``(sample_id, n_missing, n_repeated)`` of samples without exactly one cell per feature."""
    n_features = matrix.select("feature").distinct().count()
    cells = matrix.groupBy("sample_id", "feature").agg(F.count("*").alias("n"))
    per_sample = cells.groupBy("sample_id").agg(
        (F.lit(n_features) - F.count("*")).alias("n_missing"), F.sum(F.col("n") - 1).alias("n_repeated")
    )
    return per_sample.where("n_missing > 0 OR n_repeated > 0")


def feature_mismatch(matrix: DataFrame, stats: DataFrame) -> DataFrame:
    """Features on one side only, or not given once per sample."""
    samples = sample_marks(matrix)
    seen = matrix.groupBy("feature").agg(F.count("*").alias("n"), *mark_sums())
    fitted = stats.select("feature", F.lit(True).alias("_fitted"))
    return (
        seen.join(fitted, "feature", "full_outer")
        .select(
            "feature",
            F.when(F.col("_fitted").isNull(), "unexpected")
            .when(F.col("n").isNull(), "missing")
            .when(~marks_match(samples), "incomplete")
            .alias("problem"),
        )
        .where("problem is not null")
    )


def check_features(matrix: DataFrame, stats: DataFrame) -> None:
    """Error unless the matrix has exactly the fitted features."""
    found = feature_mismatch(matrix, stats).orderBy("feature").limit(5).collect()
    if found:
        shown = ", ".join(f"{r.feature} ({r.problem})" for r in found)
        raise ValueError(f"Column mismatch with the fitted features: {shown}")
