"""Class codes and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def class_codes(samples: DataFrame) -> DataFrame:
    """``(label, code)``: codes from 0 in alphabetical order."""
    in_order = Window.partitionBy(F.lit(0)).orderBy("label")  # one row per class
    classes = samples.where("label is not null").select("label").distinct()
    return classes.withColumn("code", F.row_number().over(in_order) - 1)


def encode(samples: DataFrame, codes: DataFrame) -> DataFrame:
    """Add ``code``; a label that was not fitted is an error."""
    unseen = F.raise_error(F.concat(F.lit("unseen label: "), F.coalesce("label", F.lit("null"))))
    return samples.join(codes, "label", "left").withColumn(
        "code", F.coalesce("code", F.when(F.col("code").isNull(), unseen.cast("int")))
    )


def decode(rows: DataFrame, codes: DataFrame, code: str = "code") -> DataFrame:
    return rows.join(codes.withColumnRenamed("code", code), code, "left")


def class_weights(samples: DataFrame) -> DataFrame:
    """``(label, n, balanced, positive_ratio)``.

    balanced is n / (k * n_class). positive_ratio is negatives / positives for
    the larger of two classes, and 1 for every other row.
    """
    everything = Window.partitionBy(F.lit(0))  # one row per class
    counts = samples.groupBy("label").agg(F.count("*").alias("n"))
    total = F.sum("n").over(everything)
    k = F.count("*").over(everything)
    is_positive = (k == 2) & (F.col("label") == F.max("label").over(everything))
    return counts.select(
        "label",
        "n",
        (total / (k * F.col("n"))).alias("balanced"),
        F.when(is_positive, (total - F.col("n")) / F.col("n")).otherwise(F.lit(1.0)).alias("positive_ratio"),
    )
