import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from panelwright.session import local_session, materialize


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def long(spark):
    """{feature: [values of S0, S1, ...]} -> long matrix, optionally labelled."""

    def build(columns: dict, labels: list | None = None):
        rows = [
            (f"S{i}", feature, None if v is None else float(v), pos, labels[i] if labels else None)
            for pos, (feature, values) in enumerate(columns.items())
            for i, v in enumerate(values)
        ]
        df = spark.createDataFrame(
            rows, "sample_id string, feature string, value float, feature_pos int, label string"
        )
        # Written once, so that no later job starts Python workers for it.
        return materialize(df if labels else df.drop("label"), "fixture")

    return build
