"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.session import ship_package

#: A word is a run of anything but these six ASCII characters.
WORD = r"[^\x20\x09-\x0D]+"
SLICE = 4_000_000  # bytes that are held as Python objects at a time


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def id_bucket(column: str, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % buckets


def words(text: str) -> list[bytes]:
    """Words with A-Z in lower case, as UTF-8. ``bytes`` splits on exactly the
    six characters of ``WORD`` and lower-cases ASCII letters only."""
    return text.encode().lower().split()


def texts_of(column: pa.Array) -> list[str]:
    """Python strings, nulls as empty texts."""
    return [t or "" for t in column.to_pylist()]


def slices(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of about ``limit`` characters, one text at least."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def byte_slices(batch: pa.RecordBatch, names: list[str], limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text or binary values
    in some columns, one row at least."""
    n = len(batch)
    size = np.zeros(n, dtype=np.int64)
    for name in names:
        column = batch.column(name)
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            size += pc.fill_null(pc.binary_length(column), 0).to_numpy()
    ends = np.cumsum(size)
    start = 0
    while start < n:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def append_columns(
    df: DataFrame,
    compute: Callable[..., list],
    fields: list[tuple[str, str]],
    inputs: list[str],
    keep: list[str],
) -> DataFrame:
    """``keep`` of ``df`` and new ``fields``, one Arrow batch at a time.

    ``compute`` gets the batch's ``inputs`` and returns one list or Arrow array
    per field. It sees a part of a batch with about ``SLICE`` bytes at a time, so
    what is held as Python objects does not depend on the size of batches. A narrow
    step: nothing is shuffled, and a lost executor only costs its own partitions.
    """
    ship_package(df.sparkSession)
    new = T.StructType([T.StructField(name, T._parse_datatype_string(kind)) for name, kind in fields])
    schema = T.StructType([*[df.schema[c] for c in keep], *new.fields])
    kinds = [_arrow(f.dataType) for f in new.fields]
    names = schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, inputs):
                columns = compute(*[batch.column(c) for c in inputs])
                made = [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *made], names=names)

    needed = list(dict.fromkeys([*keep, *inputs]))
    return df.select(*[F.col(f"`{c}`") for c in needed]).mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def map_batches(df: DataFrame, run: Callable, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` after the package is on its way to the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)
