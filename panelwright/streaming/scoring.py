"""Structured Streaming around the same scoring function as the batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from panelwright.operators.scoring import RECORD_SCHEMA, ScoringBundle


def read_records(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON records, one per line, from files that arrive in ``path``."""
    reader = spark.readStream.schema(RECORD_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def start_scoring(
    bundle: ScoringBundle, records: DataFrame, output: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Write results and refusals side by side, each record exactly once.

    No state and no watermark: a record is scored on its own.
    """
    outcome = F.when(F.col("reject_code").isNull(), "accepted").otherwise("rejected")
    writer = (
        bundle.score(records)
        .withColumn("outcome", outcome)
        .writeStream.format("parquet")
        .partitionBy("outcome")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_results(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.parquet(output)
