"""Stratified split, stratified folds and exact row subsample.

All three order rows by a seeded md5 of the sample key. Its leading hex digits cut
each class into cells, so exact ranks need only a small table of counts per (class,
cell) and a sort inside each cell. Cells are the leaves of a trie: one with more than
``CELL_ROWS`` rows is cut further by the next digits, until only repeats of one key
are left together. Leaves of any depth keep the order of the hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.scalar import seeded_hash
from panelwright.session import materialize

CELL_DIGITS = 3
CELL_ROWS = 1 << 18
HASH_DIGITS = 32


def hash_cells(samples: DataFrame, key: str, seed: int | str, by: tuple[str, ...], most: int) -> DataFrame:
    """Add ``_hash`` and ``_cell``, its leading digits down to the leaf of the trie."""
    keyed = samples.withColumn("_hash", seeded_hash(seed, F.col(key))).withColumn(
        "_cell", F.substring("_hash", 1, CELL_DIGITS)
    )
    while True:
        sizes = keyed.groupBy(*by, "_cell").agg(F.count("*").alias("_n"))
        big = sizes.where((F.col("_n") > most) & (F.length("_cell") < HASH_DIGITS))
        if big.isEmpty():
            return keyed
        big = materialize(big.select(*by, "_cell", F.lit(True).alias("_big")), "cells")
        deeper = F.substring(F.col("_hash"), F.lit(1), F.length("_cell") + CELL_DIGITS)
        keyed = (
            keyed.join(big, [*by, "_cell"], "left")
            .withColumn("_cell", F.when(F.col("_big"), deeper).otherwise(F.col("_cell")))
            .drop("_big")
        )


def hash_ranks(samples: DataFrame, key: str, seed: int | str, by: tuple[str, ...] = (), most: int = CELL_ROWS) -> DataFrame:
    """Add ``hash_rank`` (1-based, per ``by``) and ``group_rows``."""
    keyed = hash_cells(samples, key, seed, by, most)
    group = list(by) if by else [F.lit(0)]
    # One row per leaf enters these windows.
    earlier = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    cells = (
        keyed.groupBy(*by, "_cell")
        .agg(F.count("*").alias("_n"))
        .select(
            *by,
            "_cell",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_n").over(whole).alias("group_rows"),
        )
    )
    inside = Window.partitionBy(*by, "_cell").orderBy("_hash", key)
    return (
        keyed.withColumn("_in_cell", F.row_number().over(inside))
        .join(cells, [*by, "_cell"])
        .withColumn("hash_rank", (F.col("_before") + F.col("_in_cell")).cast("bigint"))
        .drop("_hash", "_cell", "_before", "_in_cell")
    )


def stratified_split(
    samples: DataFrame, key: str = "sample_id", label: str = "label", test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: round(test_size * n) rows of each class are true."""
    if not 0.0 < test_size < 1.0:
        raise ValueError(f"test_size must be in (0, 1); got {test_size}")
    ranked = hash_ranks(samples, key, seed, (label,))
    cut = F.round(F.lit(test_size) * F.col("group_rows"))
    return ranked.withColumn("is_test", F.col("hash_rank") <= cut).drop("hash_rank", "group_rows")


def stratified_folds(
    samples: DataFrame, key: str = "sample_id", label: str = "label", folds: int = 5, seed: int = 42
) -> DataFrame:
    """Add ``fold`` in 0..folds-1; class counts of folds differ by at most one."""
    if folds < 2:
        raise ValueError(f"folds must be at least 2; got {folds}")
    ranked = hash_ranks(samples, key, f"fold-{seed}", (label,))
    return ranked.withColumn("fold", ((F.col("hash_rank") - 1) % folds).cast("int")).drop(
        "hash_rank", "group_rows"
    )


def subsample(samples: DataFrame, limit: int | None, key: str = "sample_id", seed: int = 42) -> DataFrame:
    """Exactly ``limit`` rows when there are more, otherwise all of them."""
    if limit is None:
        return samples
    if limit <= 0:
        raise ValueError(f"limit must be positive; got {limit}")
    ranked = hash_ranks(samples, key, f"subsample-{seed}")
    return ranked.where(F.col("hash_rank") <= limit).drop("hash_rank", "group_rows")
