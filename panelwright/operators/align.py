"""Match the samples of a matrix with the samples of a label table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.config import IngestConfig
from panelwright.functions.scalar import class_percentage, truncate_key
from panelwright.session import materialize
from panelwright.sources.matrix import join_samples

CELL_BYTES = 4  # single precision


def unique_label_keys(labels: DataFrame, length: int) -> DataFrame:
    """Truncated keys that occur once; every copy of a repeated key goes."""
    keyed = labels.select(truncate_key(F.col("sample_id"), length).alias("sample_id"), "label")
    return (
        keyed.groupBy("sample_id")
        .agg(F.count("*").alias("_n"), F.any_value("label").alias("label"))
        .where("_n = 1")
        .drop("_n")
    )


def unique_matrix_keys(matrix: DataFrame, length: int) -> DataFrame:
    """Truncated sample keys that stand for one column of the matrix.

    Only partial aggregates are shuffled. Two columns with the same full name
    are told apart by ``column_no``, or else by cells that repeat. A row of the
    file that repeats does so for every sample: rows are told apart by
    ``feature_pos``, or else a cell repeats only if some sample has it less often.
    """
    keyed = matrix.withColumn("_key", truncate_key(F.col("sample_id"), length))
    one_name = F.min("sample_id") == F.max("sample_id")
    if "column_no" in matrix.columns:
        single = keyed.groupBy("_key").agg((one_name & (F.min("column_no") == F.max("column_no"))).alias("_single"))
    else:
        row = "feature_pos" if "feature_pos" in matrix.columns else "feature"
        cells = materialize(
            keyed.groupBy("_key", row).agg(F.count("*").alias("_n"), F.min("sample_id").alias("_a"), F.max("sample_id").alias("_b")),
            "cells_of_keys",
        )
        usual = cells.groupBy(row).agg(F.min("_n").alias("_usual"))
        single = cells.join(usual, row).groupBy("_key").agg(
            ((F.min("_a") == F.max("_b")) & (F.max(F.col("_n") - F.col("_usual")) == 0)).alias("_single")
        )
    return single.where("_single").select(F.col("_key").alias("sample_id"))


def match_samples(matrix: DataFrame, labels: DataFrame, config: IngestConfig) -> DataFrame:
    """Samples on both sides with a unique key, null labels still included."""
    return unique_matrix_keys(matrix, config.key_length).join(
        unique_label_keys(labels, config.key_length), "sample_id"
    )


@dataclass
class Aligned:
    matrix: DataFrame  # sample_id, feature, [feature_pos], value, label
    samples: DataFrame  # sample_id, label
    n_samples: int
    n_unlabelled: int


def align(matrix: DataFrame, labels: DataFrame, config: IngestConfig) -> Aligned:
    """Inner join on truncated keys.

    The floor on the number of samples is tested before null labels go, and
    repeated keys go before null labels do.
    """
    matched = materialize(match_samples(matrix, labels, config), "matched")
    seen = matched.agg(
        F.count("*").alias("n"),
        F.count("label").alias("labelled"),
        (F.min("label") != F.max("label")).alias("two"),
    ).first()
    if seen.n < config.min_samples:
        raise ValueError(
            f"{seen.n} keys of {config.key_length} characters are in the matrix and in the labels; minimum: {config.min_samples}"
        )
    if not seen.two:
        raise ValueError("the samples in both tables do not have two distinct labels")
    samples = matched.where("label is not null")
    keyed = matrix.withColumn("sample_id", truncate_key(F.col("sample_id"), config.key_length))
    kept = [c for c in ("feature_pos",) if c in matrix.columns]
    cells = keyed.select("sample_id", "feature", *kept, F.col("value").cast("float").alias("value"))
    joined = join_samples(cells, samples)
    return Aligned(joined, samples, seen.labelled, seen.n - seen.labelled)


def class_distribution(samples: DataFrame) -> DataFrame:
    counts = samples.groupBy("label").agg(F.count("*").alias("n"))
    return counts.withColumn("percentage", class_percentage(F.col("n")))


def count_classes(samples: DataFrame) -> int:
    return samples.where("label is not null").select("label").distinct().count()


def require_two_classes(samples: DataFrame) -> None:
    n = count_classes(samples)
    if n < 2:
        raise ValueError(f"the labels have {n} distinct class(es); at least 2 are needed")


def feature_profile(matrix: DataFrame) -> DataFrame:
    """Per feature: cells, missing cells and whether every cell is zero."""
    value = F.col("value")
    bad = value.isNull() | F.isnan(value)
    return matrix.groupBy("feature").agg(
        F.count("*").alias("n_cells"),
        F.count_if(bad).alias("n_missing"),
        (F.count_if(bad | (value != 0)) == 0).alias("all_zero"),
    )


def distinct_sketches(matrix: DataFrame, bits: int = 12) -> DataFrame:
    """(feature, sketch) of the distinct values of each feature, missing cells apart.

    Sketches have 2^bits registers at most, an error of about 1.04 / 2^(bits / 2), and are
    kept as a table: those of later files are merged with it, not counted again.
    """
    value = F.col("value")
    # Zeros of both signs are one value.
    known = F.when(value.isNotNull() & ~F.isnan(value), F.xxhash64(value + F.lit(0.0).cast(matrix.schema["value"].dataType)))
    return matrix.groupBy("feature").agg(F.hll_sketch_agg(known, bits).alias("sketch"))


def merge_sketches(*tables: DataFrame) -> DataFrame:
    """Sketches of all tables together."""
    every = tables[0]
    for table in tables[1:]:
        every = every.unionByName(table)
    return every.groupBy("feature").agg(F.hll_union_agg("sketch", True).alias("sketch"))


def distinct_counts(sketches: DataFrame) -> DataFrame:
    return sketches.select("feature", F.hll_sketch_estimate("sketch").alias("n_distinct"))


def profile(matrix: DataFrame, samples: DataFrame) -> DataFrame:
    """Shape, cells, missing cells, size and types, as one row."""
    kind = matrix.schema["value"].dataType.simpleString()
    width = {"float": 4, "double": 8}[kind]
    rows = samples.agg(F.count("*").alias("n")).scalar()
    return (
        feature_profile(matrix)
        .agg(
            rows.alias("n_samples"),
            F.count("*").alias("n_features"),
            F.coalesce(F.sum("n_cells"), F.lit(0)).alias("n_cells"),
            F.coalesce(F.sum("n_missing"), F.lit(0)).alias("n_missing"),
            F.count_if("all_zero").alias("n_zero_features"),
        )
        .withColumn("size_mb", F.round(F.col("n_cells") * width / F.lit(1024.0 * 1024.0), 2))
        .withColumn("dtype_counts", F.create_map(F.lit(kind), F.col("n_features")))
    )


def validate(matrix: DataFrame, samples: DataFrame) -> DataFrame:
    """The gate after alignment; returns the one-row profile it passed on."""
    if matrix.schema["value"].dataType.simpleString() != "float":
        raise ValueError("matrix values must be single precision")
    require_two_classes(samples)
    report = materialize(profile(matrix, samples), "profile")
    missing = report.first().n_missing
    if missing:
        raise ValueError(f"matrix contains {missing} null or NaN values after alignment")
    return report


def metadata(report: DataFrame, samples: DataFrame, label_column: str, cohort_prefix: str) -> DataFrame:
    """What was ingested, as one row."""
    counts = class_distribution(samples).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", "n"))))
    )
    return report.select(
        "n_samples",
        "n_features",
        F.lit(label_column).alias("label_column_used"),
        F.lit(cohort_prefix).alias("cohort_prefix"),
        counts.scalar().alias("class_distribution"),
        "size_mb",
        "dtype_counts",
    )
