"""Exact medians and median absolute deviations of every feature, by counting.

A histogram with map-side combine finds the cell that holds the wanted rank,
and only that cell is looked at again, until it is small. No task ever holds
the values of a whole group, so a feature may have any number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.session import materialize

MAP_ROWS = 1 << 14  # rows of a range that are ranked in one sort
CELLS = 4096


def medians(
    values: DataFrame, group: str = "feature", value: str = "x", cells: int = CELLS, map_rows: int = MAP_ROWS,
    weight: str | None = None, bounds: DataFrame | None = None,
) -> DataFrame:
    """Median by repeated histograms, for groups of any size and any skew.

    A row counts ``weight`` times, a whole number; null values do not count.
    ``bounds`` has group, n (all weights), low and high where they are known: a scan less.
    """
    points = values.select(
        F.col(group), F.col(value).cast("double").alias("_x"), (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("_w")
    ).where("_x is not null")
    if bounds is None:
        bounds = points.groupBy(group).agg(F.sum("_w").alias("n"), F.min("_x").alias("low"), F.max("_x").alias("high"))
    # Two wanted ranks per group: the lower and the upper middle row.
    n = F.col("n")
    wanted = materialize(
        bounds.select(
            group,
            F.explode(F.array(((n + 1) / 2).cast("bigint"), (n / 2).cast("bigint") + 1)).alias("_rank"),
            n.alias("_rows"),
            F.col("low").cast("double").alias("_low"),
            F.col("high").cast("double").alias("_high"),
        )
        .select(group, "_rank", F.col("_rank").alias("_left"), "_rows", "_low", "_high")
        .distinct(),
        "ranks",
    )
    while wanted.where(f"_low < _high and _rows > {map_rows}").limit(1).count():
        wanted = materialize(_narrow(points, wanted, group, cells), "ranks")
    middle = _select(points, wanted, group)
    return middle.groupBy(group).agg(F.avg("_x").alias("median"))


def _inside(points: DataFrame, wanted: DataFrame, group: str) -> DataFrame:
    return points.join(wanted, group).where((F.col("_x") >= F.col("_low")) & (F.col("_x") <= F.col("_high")))


def _narrow(points: DataFrame, wanted: DataFrame, group: str, cells: int) -> DataFrame:
    """Replace each range by the histogram cell that holds the wanted rank."""
    # Halved before subtracting, so that the width of a range cannot overflow.
    width = F.col("_high") / 2 - F.col("_low") / 2
    place = F.try_divide(F.col("_x") / 2 - F.col("_low") / 2, width) * cells
    cell = F.least(F.lit(cells - 1), F.coalesce(place, F.lit(0.0)).cast("int"))
    counts = (
        _inside(points, wanted, group)
        .groupBy(group, "_rank", "_left", cell.alias("_cell"))
        .agg(F.count("*").alias("_rows"), F.sum("_w").alias("_weight"), F.min("_x").alias("_low"), F.max("_x").alias("_high"))
    )
    upto = Window.partitionBy(group, "_rank").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    return (
        counts.withColumn("_upto", F.sum("_weight").over(upto))
        .where((F.col("_upto") >= F.col("_left")) & (F.col("_upto") - F.col("_weight") < F.col("_left")))
        .select(
            group, "_rank", (F.col("_left") - (F.col("_upto") - F.col("_weight"))).alias("_left"), "_rows", "_low", "_high"
        )
    )


def _select(points: DataFrame, wanted: DataFrame, group: str) -> DataFrame:
    """Pick the wanted rank inside ranges that are now small."""
    done = wanted.where("_low = _high").select(group, "_rank", F.col("_low").alias("_x"))
    counts = (
        _inside(points, wanted.where("_low < _high"), group)
        .groupBy(group, "_rank", "_left", "_x")
        .agg(F.sum("_w").alias("_weight"))
    )
    upto = Window.partitionBy(group, "_rank").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    picked = (
        counts.withColumn("_upto", F.sum("_weight").over(upto))
        .where((F.col("_upto") >= F.col("_left")) & (F.col("_upto") - F.col("_weight") < F.col("_left")))
        .select(group, "_rank", "_x")
    )
    return done.unionByName(picked)


def mad(
    values: DataFrame, group: str = "feature", value: str = "x", weight: str | None = None, bounds: DataFrame | None = None
) -> DataFrame:
    """``(group, median, mad)`` without a consistency factor; arguments as of ``medians``."""
    # Written once: one row per group, broadcast only if its files are small.
    centre = materialize(medians(values, group, value, weight=weight, bounds=bounds), "medians")
    x, middle = F.col(value).cast("double"), F.col("median")
    count = (F.col(weight) if weight else F.lit(1)).alias("weight")
    away = values.join(centre, group).select(group, F.abs(x - middle).alias("away"), count)
    if bounds is not None:
        # The median lies between the bounds, so the farthest value is one of them.
        farthest = F.greatest(F.abs(F.col("high").cast("double") - middle), F.abs(F.col("low").cast("double") - middle))
        bounds = bounds.join(centre, group).select(group, "n", F.lit(0.0).alias("low"), farthest.alias("high"))
    spread = medians(away, group, "away", weight="weight", bounds=bounds).withColumnRenamed("median", "mad")
    return centre.join(spread, group)
