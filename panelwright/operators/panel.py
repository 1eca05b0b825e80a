"""Long panel cells -> one ordered vector per sample."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble_panel(cells: DataFrame, width: int) -> DataFrame:
    """``(sample_id, features)`` ordered by feature_pos.

    Repeated cells are folded with a partial aggregate first, so what is
    gathered per sample never exceeds the panel. A sample with another number
    of features, or with a repeated cell, is an error.
    """
    single = cells.groupBy("sample_id", "feature_pos").agg(
        F.max("value").alias("value"), F.count("*").alias("n")
    )
    gathered = single.groupBy("sample_id").agg(
        F.sort_array(F.collect_list(F.struct("feature_pos", "value"))).alias("row"), F.max("n").alias("n")
    )
    values = F.transform("row", lambda c: c["value"].cast("double"))
    complete = (F.size("row") == width) & (F.col("n") == 1)
    return gathered.select(
        "sample_id",
        array_to_vector(
            F.when(complete, values).otherwise(
                F.raise_error(F.concat(F.lit(f"expected {width} single cells for sample "), F.col("sample_id")))
            )
        ).alias("features"),
    )
