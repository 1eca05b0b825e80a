"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # A panel of up to 200 names reaches the parquet scan as an IN filter.
    "spark.sql.parquet.pushdown.inFilterThreshold": "200",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("panelwright")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without one gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="panelwright-"))
    return context.getCheckpointDir().rstrip("/")


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def run_folder(spark: SparkSession) -> str:
    """The folder of this application inside the shared one."""
    return f"{shared_folder(spark)}/panelwright-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_scratch.get() or run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clean_up(spark: SparkSession) -> None:
    """Delete the tables that this application has written to the shared folder.

    DataFrames that were built on them cannot be read any more.
    """
    delete_folder(spark, run_folder(spark))


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[None]:
    """Tables that are written inside the block are deleted at its end."""
    path = new_path(spark, name)
    token = _scratch.set(path)
    try:
        yield
    finally:
        _scratch.reset(token)
        delete_folder(spark, path)


def materialize(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` once, with ``options`` of the writer, and read it back.

    The lineage is cut at files that outlive executors, later passes do not
    recompute it, and Catalyst knows its true size: a join with the result is
    broadcast only when the files are below ``autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()
_shipping = Lock()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    with _shipping:  # models are fitted in parallel threads
        if app in _shipped:
            return
        package = Path(__file__).parent
        base = f"{tempfile.mkdtemp(prefix='panelwright-')}/panelwright"
        spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", package.parent, package.name))
        _shipped.add(app)
