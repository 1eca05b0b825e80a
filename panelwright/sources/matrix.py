"""Matrices in: wide delimited files, arrays, and sparse cells."""

from __future__ import annotations

import csv
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.scalar import null_if_token
from panelwright.session import new_path
from panelwright.sources.state import exists

COMPRESSED = (".gz", ".deflate", ".snappy", ".zst", ".lz4")  # one task per file


def read_header(spark: SparkSession, path: str, sep: str = "\t") -> list[str]:
    """Names of the columns, from the first line only; repeats are kept."""
    if not exists(spark, path):
        raise FileNotFoundError(f"file not found: {path}")
    line = spark.read.text(path).head(1)
    if not line:
        raise ValueError(f"cannot read a header from {path}")
    return header_names(line[0].value, sep)


def header_names(line: str, sep: str) -> list[str]:
    csv.field_size_limit(max(csv.field_size_limit(), len(line)))
    return next(csv.reader([line], delimiter=sep), [])


def cells_of_line(line: Column, sep: str) -> Column:
    """The cells of a line; a separator inside a quoted cell does not count."""
    q = re.escape(sep)
    quoted = F.regexp_extract_all(line, F.lit(f'(?:^|{q})("[^"]*+(?:""[^"]*+)*+"|[^{q}]*+)'), F.lit(1))
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, f"\\Q{sep}\\E", -1))


def read_wide_matrix(spark: SparkSession, path: str, sep: str = "\t", partitions: int | None = None) -> DataFrame:
    """Features in rows, samples in columns -> ``(sample_id, feature,
    feature_pos, value, column_no)`` in single precision.

    Lines are split into one array, so the plan does not grow with the number
    of columns. ``column_no`` tells repeated sample names apart. A text that is
    no number, or a line of another width, is an error; the usual null tokens
    become null.
    """
    if not exists(spark, path):
        raise FileNotFoundError(f"file not found: {path}")
    text = spark.read.text(path)
    first = text.head(1)
    names = header_names(first[0].value, sep) if first else []
    if len(names) < 2:
        raise ValueError(f"cannot read sample names from the header of {path}")
    # Each file of a folder repeats the header; no line of numbers equals it.
    lines = text.where((F.col("value") != first[0].value) & (F.col("value") != ""))
    if not lines.limit(1).count():
        raise ValueError(f"matrix is empty: {path}")
    # Line order inside the file: ids grow with the position in the input.
    lines = lines.withColumn("feature_pos", F.monotonically_increasing_id())
    # A compressed file arrives in one partition; spread its lines before they
    # grow. Inputs that are split already are not shuffled.
    wanted = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = text.inputFiles()
    if partitions or (len(files) < wanted and all(f.endswith(COMPRESSED) for f in files)):
        lines = lines.repartition(wanted)
    row, quote = cells_of_line(F.col("value"), sep), F.lit('"')
    problem = F.concat(F.lit(f"expected {len(names)} cells in the line of "), F.col("row")[0])
    whole = F.when(F.size("row") == len(names), F.col("row")).otherwise(F.raise_error(problem))
    cells = lines.select("feature_pos", row.alias("row")).select(
        F.btrim(F.col("row")[0], quote).alias("feature"),
        "feature_pos",
        F.posexplode(F.slice(whole, 2, len(names) - 1)).alias("column_no", "text"),
    )
    ids = F.split(F.lit("\n".join(names[1:])), "\n", -1)  # one literal, split when the plan is optimised
    number = null_if_token(F.trim(F.btrim("text", quote)))
    return cells.select(
        F.element_at(ids, F.col("column_no") + 1).alias("sample_id"),
        "feature",
        "feature_pos",
        number.cast("float").alias("value"),
        "column_no",
    )


def arrays_to_matrix(rows: DataFrame, sample: str, values: str, stats: DataFrame) -> DataFrame:
    """Unnamed arrays get the fitted names by position; another width is an error."""
    n = stats.count()
    checked = rows.select(
        F.col(sample).cast("string").alias("sample_id"),
        F.when(F.size(values) == n, F.col(values))
        .otherwise(F.raise_error(F.lit(f"Column mismatch: expected {n} values per row")))
        .alias("_v"),
    )
    cells = checked.select("sample_id", F.posexplode("_v").alias("feature_pos", "value"))
    return cells.join(stats.select("feature", "feature_pos"), "feature_pos").select(
        "sample_id", "feature", "feature_pos", F.col("value").cast("float").alias("value")
    )


def arrays_to_long(rows: DataFrame, sample: str, values: str, prefix: str = "f") -> DataFrame:
    """Arrays without fitted names: positions name the features."""
    cells = rows.select(F.col(sample).cast("string").alias("sample_id"), F.posexplode(values).alias("feature_pos", "v"))
    return cells.select(
        "sample_id",
        F.concat(F.lit(prefix), F.lpad(F.col("feature_pos").cast("string"), 3, "0")).alias("feature"),
        "feature_pos",
        F.col("v").cast("float").alias("value"),
    )


def densify(cells: DataFrame, samples: DataFrame, features: DataFrame) -> DataFrame:
    """Sum sparse cells per (sample, feature) and fill the rest with zero."""
    return fill_zeros(stored_rows(cells, samples), features).select("sample_id", "feature", "value")


def stored_rows(cells: DataFrame, samples: DataFrame) -> DataFrame:
    """``(sample_id, stored, known)``: the folded cells of each sample as one array, and
    whether ``samples`` has it.

    Repeated cells are folded first, so an array is never longer than there are features.
    """
    folded = cells.groupBy("sample_id", "feature").agg(F.sum(F.col("value").cast("double")).alias("value"))
    held = folded.select("sample_id", F.struct("feature", "value").alias("_cell"), F.lit(False).alias("_known"))
    given = samples.select("sample_id", F.lit(None).cast(held.schema["_cell"].dataType).alias("_cell"), F.lit(True).alias("_known"))
    return held.unionByName(given).groupBy("sample_id").agg(
        F.collect_list("_cell").alias("stored"), F.max("_known").alias("known")
    )


def fill_zeros(rows: DataFrame, features: DataFrame) -> DataFrame:
    """The cells of ``stored_rows``, those that are not stored as zero; other columns of ``rows`` stay.

    The feature names reach each row as one array, computed once. Zeros come from a generator:
    they are neither shuffled nor aggregated, so no task holds more than one row of them.
    """
    names = features.select("feature").distinct().agg(F.sort_array(F.collect_set("feature"))).scalar()
    others = [c for c in rows.columns if c not in ("stored", "known")]
    wanted = F.col("_wanted")

    def single(feature: Column, value: Column) -> Column:
        return F.struct(feature.alias("feature"), value.cast("float").alias("value"))

    def kept(cell: Column) -> Column:
        # A cell without a value counts as zero where the matrix has its place.
        placed = F.when(F.array_contains(wanted, cell["feature"]), F.lit(0.0))
        return single(cell["feature"], F.coalesce(cell["value"], placed))

    absent = F.array_except(wanted, F.transform("stored", lambda cell: cell["feature"]))
    zeros = F.transform(absent, lambda name: single(name, F.lit(0.0)))
    # Subqueries do not reach into the functions of arrays, columns do.
    placed_rows = rows.withColumn("_wanted", F.when(F.col("known"), names).otherwise(F.array().cast("array<string>")))
    return placed_rows.select(*others, F.inline(F.concat(F.transform("stored", kept), zeros)))


def join_samples(cells: DataFrame, samples: DataFrame, *folders: str) -> DataFrame:
    """Cells with the columns of their sample, written once, clustered by feature.

    Later steps read the result several times; none goes back to the source.
    """
    spark = cells.sparkSession
    joined = cells.join(samples, "sample_id")
    path = new_path(spark, "cells")
    write_matrix(joined, path, *folders)
    return spark.read.schema(joined.schema).parquet(path)


def write_matrix(matrix: DataFrame, path: str, *folders: str) -> None:
    """Long matrix clustered by feature, in one directory per value of ``folders``.

    Row-group statistics then let a scan of a panel skip other features, and a
    task sees few features, which makes partial aggregation effective. The
    range covers (feature, sample), so one large feature spans many files.
    """
    ranged = matrix.repartitionByRange("feature", "sample_id").sortWithinPartitions(*folders, "feature", "sample_id")
    ranged.write.mode("overwrite").partitionBy(*folders).parquet(path)
