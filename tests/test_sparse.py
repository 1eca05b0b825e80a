"""Statistics from stored cells alone, against the filled matrix and by hand."""

import math
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelwright.config import PreprocessConfig, SelectConfig
from panelwright.functions.scalar import log2_shift
from panelwright.operators.moments import class_moments, feature_moments
from panelwright.operators.order_stats import mad, medians
from panelwright.operators.sparse import SparseMatrix, sparse_anova_f, sparse_moments, weighted_values
from panelwright.plans.screening import FeatureScreen, Preprocessor
from panelwright.session import materialize
from panelwright.sources.matrix import densify

NUMBERS = "n n_missing n_negative n_infinite n_nonzero frac_expressed mean var_pop std_pop low high f_score mark_0 mark_1".split()


def build(spark, columns, labels, stored_zero=()):
    """{feature: [values of S0, S1, ...]}, zeros left out but for ``stored_zero``."""
    n = len(labels)
    cells = [(f"S{i}", f, float(v)) for f, values in columns.items() for i, v in enumerate(values) if v or (f, i) in stored_zero]
    samples = spark.createDataFrame([(f"S{i}", labels[i]) for i in range(n)], "sample_id string, label string")
    features = spark.createDataFrame([(f, i) for i, f in enumerate(columns)], "feature string, feature_pos int")
    return SparseMatrix.of(spark.createDataFrame(cells, "sample_id string, feature string, value double"), samples, features)


def filled(matrix):
    dense = densify(matrix.cells, matrix.samples, matrix.features).join(matrix.samples, "sample_id")
    return materialize(dense.join(matrix.features, "feature"), "filled")


def by_feature(df):
    return {r.feature: r for r in df.collect()}


def same(a, b):
    if a is None or b is None:
        return a is b
    if isinstance(a, float) and (math.isnan(a) or math.isnan(b)):
        return math.isnan(a) and math.isnan(b)
    return a == pytest.approx(b, rel=1e-9, abs=1e-12)


COLUMNS = {
    "FULL": [1, 2, 3, 4, 5, 6, 7],
    "HALF": [0, 2, 0, 4, 0, 8, 0],
    "ONE": [0, 0, 0, 0, 0, 9, 0],
    "NONE": [0] * 7,
    "CLASS": [3, 3, 3, 0, 0, 0, 0],
    "SAME": [5] * 7,
    "ZERO_STORED": [0, 1, 0, 0, 0, 0, 6],
}
LABELS = ["a", "a", "a", "b", "b", "b", "c"]


@pytest.mark.parametrize("transform", [None, log2_shift, lambda v: log2_shift(v, 0.5)])
@pytest.mark.parametrize("least", [0.0, 1.0])
def test_moments_equal_those_of_the_filled_matrix(spark, transform, least):
    matrix = build(spark, COLUMNS, LABELS, {("ZERO_STORED", 0), ("ZERO_STORED", 3)})
    dense = filled(matrix)
    x = None if transform is None else transform(F.col("value"))
    want = by_feature(feature_moments(class_moments(dense, x, least)))
    got = by_feature(feature_moments(sparse_moments(matrix, transform, least)))
    assert set(got) == set(want) == set(COLUMNS)
    for f in want:
        for c in NUMBERS:
            assert same(got[f][c], want[f][c]), (f, c, got[f][c], want[f][c])
        assert got[f].feature_pos == want[f].feature_pos
        assert got[f].n_stored == sum(map(bool, COLUMNS[f])) + 2 * (f == "ZERO_STORED")


def test_f_of_a_feature_without_cells_is_nan(spark):
    scores = {r.feature: r.score for r in sparse_anova_f(build(spark, COLUMNS, LABELS)).collect()}
    assert math.isnan(scores["NONE"]) and math.isnan(scores["SAME"]) and scores["CLASS"] == math.inf


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from([0, 0, 0, 1.5, 2.25, 7, 40]), min_size=9, max_size=9), min_size=1, max_size=6))
def test_medians_with_a_mass_at_zero(spark, rows):
    columns = {f"F{i}": row for i, row in enumerate(rows)}
    matrix = build(spark, columns, ["a"] * 9)
    stats = materialize(feature_moments(sparse_moments(matrix)), "stats")
    # A transformed zero may lie in the middle of the others.
    values = weighted_values(matrix.cells, stats, F.lit(2.0), F.col("value")).cache()
    want = {}
    for f, row in columns.items():
        x = [v or 2.0 for v in row]
        m = statistics.median(x)
        want[f] = (m, statistics.median(abs(v - m) for v in x))
    got = {r.feature: (r.median, r.mad) for r in mad(values, weight="weight").collect()}
    assert got == want
    narrowed = medians(values, cells=3, map_rows=1, weight="weight")
    assert {r.feature: r.median for r in narrowed.collect()} == {f: m for f, (m, _) in want.items()}


def screens(spark):
    columns = {f"G{i:02d}": [(7 * i + 3 * j * j + i * j) % (5 + i % 4) * (j % (1 + i % 3) == 0) for j in range(40)] for i in range(14)}
    matrix = build(spark, columns, ["x" if j % 3 else "y" for j in range(40)])
    return matrix, filled(matrix)


@pytest.mark.parametrize("scorer", ["anova_f", "mutual_info"])
def test_screen_equals_that_of_the_filled_matrix(spark, scorer):
    matrix, dense = screens(spark)
    preprocess = PreprocessConfig(min_expression=0.5, min_sample_fraction=0.2, variance_threshold=0.05)
    select = SelectConfig(n_mad=6, k_best=3, scorer=scorer)
    want = by_feature(FeatureScreen(preprocess, select).fit(dense, matrix.samples).stats)
    screen = FeatureScreen(preprocess, select).fit(matrix)
    got = by_feature(screen.stats)
    assert set(got) == set(want)
    for f in want:
        for c in ("kept_expr", "kept_var", "kept_mad", "kept_panel", "feature_pos"):
            assert got[f][c] == want[f][c], (f, c)
        for c in ("mean", "std_pop", "median", "mad", "score"):
            assert same(got[f][c], want[f][c]), (f, c, got[f][c], want[f][c])
    assert sum(r.kept_panel for r in got.values()) == 3
    cells = {(r.sample_id, r.feature): r.value for r in screen.transform(matrix).collect()}
    full = {(r.sample_id, r.feature): r.value for r in screen.transform(dense.select("sample_id", "feature", "value")).collect()}
    assert cells.keys() == full.keys() and all(same(cells[k], full[k]) for k in full)


def test_no_plan_fills_the_matrix(spark):
    matrix, _ = screens(spark)
    pre = Preprocessor(PreprocessConfig(min_expression=0.5, variance_threshold=0.05)).fit(matrix)
    stats = pre.fitted()
    values = pre.sparse_values(matrix, stats.where("kept_var"))
    assert values.count() <= matrix.cells.count() + stats.count()
    for df in (values, sparse_moments(matrix, log2_shift)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # The only generator makes one row per feature and class.
    grid = sparse_moments(matrix)
    assert grid.count() == matrix.features.count() * 2


def test_unknown_and_repeated_keys_are_errors(spark):
    cells = spark.createDataFrame([("S0", "A", 1.0), ("S0", "A", 2.0)], "sample_id string, feature string, value double")
    samples = spark.createDataFrame([("S0", "a"), ("S1", "b")], "sample_id string, label string")
    features = spark.createDataFrame([("A",), ("B",)], "feature string")
    assert [tuple(r) for r in SparseMatrix.of(cells, samples, features).cells.select("sample_id", "feature", "value").collect()] == [("S0", "A", 3.0)]
    for bad in ((cells, samples.where("sample_id = 'S1'"), features), (cells, samples, features.where("feature = 'B'")),
                (cells, samples.unionByName(samples), features), (cells, samples, features.unionByName(features))):
        with pytest.raises(ValueError, match="sparse matrix|unknown"):
            SparseMatrix.of(*bad)


def test_domain_errors_of_stored_cells(spark):
    matrix = build(spark, {"A": [0, -1, 2], "B": [1, 2, 0]}, ["a", "b", "a"])
    with pytest.raises(ValueError, match="negative"):
        Preprocessor().fit(matrix)
