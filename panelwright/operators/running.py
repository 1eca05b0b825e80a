"""Running totals and ranks that never put one group in one task.

Rows are range-partitioned on (group, order) and written once, so a group of
any size spreads over many slices. Totals run inside each slice; a table of one
row per (group, slice) carries the offset of the slices before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.session import materialize


def _sort_key(name: str, descending: bool) -> Column:
    return F.col(name).desc() if descending else F.col(name).asc()


def running_totals(
    df: DataFrame,
    order: list[tuple[str, bool]],
    sums: dict[str, str],
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Add inclusive running totals ``{new column: summed column}``.

    ``order`` is a list of (column, descending). Rows that compare equal on
    ``by`` and ``order`` land in one slice: collapse ties first, or add a
    unique column to the order.
    """
    spark = df.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = [_sort_key(name, desc) for name, desc in order]
    keys = [*(F.col(b) for b in by), *sort]
    sliced = materialize(
        df.repartitionByRange(slices, *keys).withColumn("_slice", F.spark_partition_id()),
        "sliced",
    )

    inside = (
        Window.partitionBy(*by, "_slice").orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)
    )
    # One row per (group, slice): at most as many per group as there are slices.
    before = (
        Window.partitionBy(*by if by else [F.lit(0)])
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sliced.groupBy(*by, "_slice").agg(
        *[F.sum(col).alias(f"_sum_{new}") for new, col in sums.items()]
    )
    offsets = offsets.select(
        *by,
        "_slice",
        *[F.coalesce(F.sum(f"_sum_{new}").over(before), F.lit(0)).alias(f"_before_{new}") for new in sums],
    )
    local = sliced.select("*", *[F.sum(col).over(inside).alias(f"_in_{new}") for new, col in sums.items()])
    out = local.join(offsets, [*by, "_slice"])
    for new in sums:
        out = out.withColumn(new, F.col(f"_in_{new}") + F.col(f"_before_{new}"))
    helpers = ["_slice", *[f"_in_{n}" for n in sums], *[f"_before_{n}" for n in sums]]
    return out.drop(*helpers)


def ranks(df: DataFrame, order: list[tuple[str, bool]], by: tuple[str, ...] = (), name="rank") -> DataFrame:
    """1-based row numbers; ``order`` must be unique inside each group."""
    counted = df.withColumn("_one", F.lit(1).cast("bigint"))
    return running_totals(counted, order, {name: "_one"}, by).drop("_one")
