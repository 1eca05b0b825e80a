"""Fitted state on disk: parquet tables and one-row JSON settings."""

from __future__ import annotations

import dataclasses
import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        raise FileNotFoundError(f"fitted state not found: {path}")
    return spark.read.parquet(path)


def write_config(spark: SparkSession, path: str, config: Any, extra: dict | None = None) -> None:
    text = json.dumps({"config": dataclasses.asdict(config), "extra": extra or {}})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_config(spark: SparkSession, path: str, kind: type) -> tuple[Any, dict]:
    if not exists(spark, path):
        raise FileNotFoundError(f"fitted state not found: {path}")
    saved = json.loads(spark.read.text(path).first().value)
    return kind(**saved["config"]), saved["extra"]


def write_ranking(ranking: DataFrame, path: str) -> None:
    """Attribution ranking as CSV with a header, sorted, in one small file.

    The ranking has one row per panel feature.
    """
    named = ranking.select("feature", "mean_shap", "mean_abs_shap")
    ordered = named.coalesce(1).sortWithinPartitions(named.mean_abs_shap.desc(), named.feature)
    # The first header cell is blank, as readers of the published table expect.
    ordered.withColumnRenamed("feature", "").write.mode("overwrite").option("header", True).csv(path)


def read_ranking(spark: SparkSession, path: str) -> DataFrame:
    schema = "feature string, mean_shap double, mean_abs_shap double"
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
