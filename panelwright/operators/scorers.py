"""Supervised scores of features: name -> (cells, seed) -> (feature, score).

``cells`` has sample_id, feature, x and label.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.scalar import digamma, seeded_hash
from panelwright.operators.moments import class_moments, feature_moments
from panelwright.operators.running import ranks, running_totals
from panelwright.session import materialize

NEIGHBOURS = 3
BLOCK_ROWS = 4096
HASH_UNIT = float(16**12)


def anova_f(cells: DataFrame, seed: int = 42) -> DataFrame:
    """One-way ANOVA F over the classes; NaN for a constant feature."""
    moments = class_moments(cells.select("sample_id", "feature", F.col("x").alias("value"), "label"))
    return feature_moments(moments).select("feature", F.col("f_score").alias("score"))


def _noise(seed: int) -> Column:
    """Standard normal drawn from a seeded hash of the cell, to break ties."""
    text = seeded_hash(seed, F.col("sample_id"), F.col("feature"))
    u1 = (F.conv(F.substring(text, 1, 12), 16, 10).cast("double") + 1.0) / (HASH_UNIT + 1.0)
    u2 = F.conv(F.substring(text, 13, 12), 16, 10).cast("double") / HASH_UNIT
    return F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def _jittered(cells: DataFrame, seed: int) -> DataFrame:
    """Unit-deviation values plus noise far below their resolution."""
    value = F.col("x").cast("double")
    scale = materialize(
        cells.groupBy("feature").agg(F.stddev_pop(value).alias("_std"), F.avg(F.abs(value)).alias("_size")),
        "scales",
    )
    std = F.when(F.col("_std") == 0, F.lit(1.0)).otherwise(F.col("_std"))
    noise = F.lit(1e-10) * F.greatest(F.lit(1.0), F.col("_size") / std) * _noise(seed)
    return cells.join(scale, "feature").select("sample_id", "feature", "label", (value / std + noise).alias("x"))


def mutual_information(cells: DataFrame, seed: int = 42, neighbours: int = NEIGHBOURS) -> DataFrame:
    """Nearest-neighbour mutual information of a continuous feature and a class.

    B. C. Ross, PLoS ONE 9(2), 2014. Each point takes the distance to its k-th
    neighbour of the same class, then counts points of any class nearer than
    that. Neighbours come from windows over blocks of ranks with a halo of k
    rows; the counting is one sweep over points and interval ends.
    """
    points = materialize(_jittered(cells, seed), "points")
    sizes = points.groupBy("feature", "label").agg(F.count("*").alias("class_rows")).where("class_rows > 1")
    sizes = materialize(sizes.withColumn("k", F.least(F.lit(neighbours), F.col("class_rows") - 1)), "sizes")

    ranked = ranks(points, [("x", False), ("sample_id", False)], ("feature", "label"))
    ends = materialize(_intervals(ranked.join(sizes.drop("class_rows"), ["feature", "label"]), neighbours), "intervals")

    kept = points.join(sizes.select("feature", "label"), ["feature", "label"])
    marks = kept.select("feature", "sample_id", F.col("x").alias("v"), F.lit(1).alias("kind"), F.lit(0).alias("sign"))
    for end in ("low", "high"):
        marks = marks.unionByName(
            ends.select("feature", "sample_id", F.col(end).alias("v"), F.col(f"{end}_kind").alias("kind"),
                        F.lit(1 if end == "high" else -1).alias("sign"))
        )
    marks = marks.withColumn("one", (F.col("kind") == 1).cast("bigint"))
    swept = running_totals(marks, [("v", False), ("kind", False), ("sample_id", False)], {"passed": "one"}, ("feature",))
    near = (
        swept.where("sign != 0")
        .groupBy("feature", "sample_id")
        .agg(F.sum(F.col("sign") * F.col("passed")).alias("m"))
        .groupBy("feature")
        .agg(F.avg(digamma(F.col("m"))).alias("psi_m"))
    )
    rows = F.col("class_rows")
    classes = sizes.groupBy("feature").agg(
        F.sum(rows).alias("n"),
        F.sum(rows * digamma(F.col("k"))).alias("sum_k"),
        F.sum(rows * digamma(rows)).alias("sum_c"),
    )
    score = digamma(F.col("n")) + F.col("sum_k") / F.col("n") - F.col("sum_c") / F.col("n") - F.col("psi_m")
    return classes.join(near, "feature").select("feature", F.greatest(F.lit(0.0), score).alias("score"))


def _intervals(ranked: DataFrame, neighbours: int) -> DataFrame:
    """Open interval of each point up to its k-th neighbour of the same class.

    ``kind`` orders marks at one value: 0 counts points below it, 1 is a point,
    2 counts points up to and including it.
    """
    at = F.col("rank") - 1
    block = F.floor(at / BLOCK_ROWS)
    place = at % BLOCK_ROWS
    homes = F.array_compact(
        F.array(
            block,
            F.when((place < neighbours) & (block > 0), block - 1),
            F.when(place >= BLOCK_ROWS - neighbours, block + 1),
        )
    )
    spread = ranked.withColumn("_home", block).withColumn("_block", F.explode(homes))
    line = Window.partitionBy("feature", "label", "_block").orderBy("rank")
    x = F.col("x")
    left = [F.lag("x", i).over(line).alias(f"_l{i}") for i in range(1, neighbours + 1)]
    right = [F.lead("x", i).over(line).alias(f"_r{i}") for i in range(1, neighbours + 1)]
    lefts = [F.col(f"_l{i}") for i in range(1, neighbours + 1)]
    rights = [F.col(f"_r{i}") for i in range(1, neighbours + 1)]
    gaps = F.array_sort(F.array_compact(F.array(*[x - c for c in lefts], *[c - x for c in rights])))
    near = (
        spread.select("*", *left, *right)
        .where("_block = _home")
        .withColumn("_r", F.element_at(gaps, F.col("k").cast("int")))
    )
    r = F.col("_r")
    # The neighbour itself is the end where it lies on that side, so that
    # rounding of x +- r cannot let it in.
    low = F.coalesce(*[F.when(x - c == r, c) for c in lefts], x - r)
    high = F.coalesce(*[F.when(c - x == r, c) for c in rights], x + r)
    tied = r == 0
    return near.select(
        "feature",
        "sample_id",
        low.alias("low"),
        F.when(tied, 0).otherwise(2).alias("low_kind"),
        high.alias("high"),
        F.when(tied, 2).otherwise(0).alias("high_kind"),
    )


SCORERS = {"anova_f": anova_f, "mutual_info": mutual_information}
