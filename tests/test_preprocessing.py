import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.config import PreprocessConfig
from panelwright.functions.scalar import log2_shift
from panelwright.operators import checks
from panelwright.plans.screening import Preprocessor
from panelwright.sources.matrix import arrays_to_matrix

OPEN = {"min_expression": 0.0, "min_sample_fraction": 0.0}
# log2 values of four samples: at a cut of 2 in a quarter of them, bean is out and oat just in.
GRAINS = {"rye": [2, 3, 5, 4], "bean": [1, 0, 1.5, 1], "oat": [0, 0, 3, 1]}


def test_log2_values_and_type(long):
    df = long({"rye": [15, 0], "oat": [31, 1]}).withColumn("x", log2_shift(F.col("value")))
    assert dict(df.dtypes)["x"] == "float"
    assert {(r.sample_id, r.feature): r.x for r in df.collect()} == {
        ("S0", "rye"): 4.0, ("S1", "rye"): 0.0, ("S0", "oat"): 5.0, ("S1", "oat"): 1.0
    }


@pytest.mark.parametrize("values, word", [([1.0, float("nan")], "NaN"), ([1.0, None], "NaN"), ([1.0, -0.5], "negative")])
def test_bad_values_are_errors_at_fit_and_transform(long, values, word):
    with pytest.raises(ValueError, match=word):
        Preprocessor(PreprocessConfig(**OPEN)).fit(long({"A": values, "B": [1, 2]}))
    with pytest.raises(ValueError, match=word):
        checks.check_domain(long({"A": values}))
    fitted = Preprocessor(PreprocessConfig(**OPEN)).fit(long({"A": [1, 2], "B": [1, 5]}))
    with pytest.raises(ValueError, match=word):
        fitted.transform(long({"A": values, "B": [1, 5]}))


def test_infinity_passes_the_domain_check_but_cannot_be_scaled(long):
    df = long({"A": [1.0, float("inf")], "B": [1, 5]})
    checks.check_domain(df)
    with pytest.raises(ValueError, match="infinite"):
        Preprocessor(PreprocessConfig(**OPEN)).fit(df)


def test_other_features_are_a_mismatch(long):
    fitted = Preprocessor(PreprocessConfig(**OPEN)).fit(long({"A": [1, 2], "B": [1, 5]}))
    with pytest.raises(ValueError, match="Column mismatch"):
        fitted.transform(long({"X": [1, 2], "B": [1, 5]}))
    with pytest.raises(ValueError, match="Column mismatch"):
        checks.check_features(long({"X": [1, 2], "B": [1, 5]}), fitted.stats)
    gap = long({"A": [1, 2], "B": [1, 5]}).where("not (sample_id = 'S1' and feature = 'A')")
    with pytest.raises(ValueError, match="Column mismatch"):
        fitted.transform(gap)


def _holes(long):
    """Matrices that are not given once for each sample and feature."""
    full = long({"A": [1, 2], "B": [1, 5]})
    one = full.where("sample_id = 'S0' and feature = 'A'")
    without = full.where("not (sample_id = 'S0' and feature = 'A')")
    return {
        "one cell missing": without,
        "samples that lack different features": without.where("not (sample_id = 'S1' and feature = 'B')"),
        "a missing and a repeated cell": without.unionByName(full.where("sample_id = 'S1' and feature = 'A'")),
        "a repeated cell": full.unionByName(one),
        "crosswise": without.where("not (sample_id = 'S1' and feature = 'B')")
        .unionByName(full.where("sample_id = 'S1' and feature = 'A'")).unionByName(full.where("sample_id = 'S0' and feature = 'B'")),
    }


def test_incomplete_matrices_are_errors(long):
    fitted = Preprocessor(PreprocessConfig(**OPEN)).fit(long({"A": [1, 2], "B": [1, 5]}))
    for name, df in _holes(long).items():
        with pytest.raises(ValueError, match="not complete"):
            Preprocessor(PreprocessConfig(**OPEN)).fit(df)
        with pytest.raises(ValueError, match="Column mismatch"):
            fitted.check(df)
        with pytest.raises(ValueError, match="incomplete"):
            checks.check_features(df, fitted.stats)
        assert checks.incomplete_samples(df).count() > 0, name
    found = checks.incomplete_samples(_holes(long)["crosswise"]).orderBy("sample_id").collect()
    assert [tuple(r) for r in found] == [("S0", 1, 1), ("S1", 1, 1)]


def test_expression_cut_is_inclusive_on_both_sides(long):
    raw = {name: [2.0**v - 1 for v in values] for name, values in GRAINS.items()}
    stats = Preprocessor(PreprocessConfig(min_expression=2.0, min_sample_fraction=0.25, variance_threshold=0.0)).fit(long(raw)).stats
    assert {r.feature for r in stats.where("kept_expr").collect()} == {"rye", "oat"}
    assert stats.where("not kept_expr").count() == 1


def test_guards(long):
    with pytest.raises(ValueError, match="min_sample_fraction"):
        PreprocessConfig(min_sample_fraction=2.0)
    with pytest.raises(ValueError, match="none of 3 features"):
        Preprocessor(PreprocessConfig(min_expression=50.0)).fit(long(GRAINS))
    with pytest.raises(ValueError, match="variance"):
        Preprocessor(PreprocessConfig(variance_threshold=50.0, **OPEN)).fit(long({"A": [1, 2]}))
    with pytest.raises(RuntimeError, match="not fitted"):
        Preprocessor().transform(long(GRAINS))


def _from_log2(values):
    return [2.0**v - 1 for v in values]


def test_variance_is_of_the_population_and_strict(long):
    df = long({"EDGE": _from_log2([1, 2, 3, 4]), "WIDE": _from_log2([0, 2, 3, 5])})
    pre = Preprocessor(PreprocessConfig(variance_threshold=1.25, **OPEN)).fit(df)
    assert [r.feature for r in pre.names().collect()] == ["WIDE"]


def test_scaling_of_known_and_constant_features(long):
    df = long({"KNOWN": _from_log2([1, 2, 3, 4]), "FLAT": [5, 5, 5, 5]})
    pre = Preprocessor(PreprocessConfig(variance_threshold=-1.0, **OPEN))
    rows = pre.fit_transform(df).orderBy("feature", "sample_id").collect()
    assert [r.value for r in rows[:4]] == [0.0] * 4
    assert np.allclose([r.value for r in rows[4:]], [-1.3416, -0.4472, 0.4472, 1.3416], atol=1e-4)
    off = Preprocessor(PreprocessConfig(variance_threshold=-1.0, with_mean=False, with_std=False, **OPEN))
    rows = off.fit_transform(df.where("feature = 'KNOWN'")).orderBy("sample_id").collect()
    assert [r.value for r in rows] == [1.0, 2.0, 3.0, 4.0]


def test_replay_uses_training_statistics(long):
    pre = Preprocessor(PreprocessConfig(**OPEN)).fit(long({"A": _from_log2([1, 2, 3, 4])}))
    rows = pre.transform(long({"A": _from_log2([2.5, 10.0])})).orderBy("sample_id").collect()
    assert np.allclose([r.value for r in rows], [0.0, 7.5 / np.sqrt(1.25)], atol=1e-5)


def test_names_keep_the_input_order(long):
    df = long({"Z": _from_log2([1, 4]), "A": _from_log2([1, 3]), "M": _from_log2([0, 5])})
    pre = Preprocessor(PreprocessConfig(**OPEN)).fit(df)
    assert [r.feature for r in pre.names().collect()] == ["Z", "A", "M"]


def test_arrays_take_fitted_names(spark, long):
    stats = Preprocessor(PreprocessConfig(**OPEN)).fit(long({"Z": [1, 2], "A": [1, 5]})).stats
    rows = spark.createDataFrame([("r", [1.0, 2.0])], "id string, v array<float>")
    got = arrays_to_matrix(rows, "id", "v", stats).orderBy("feature_pos").collect()
    assert [(r.feature, r.value) for r in got] == [("Z", 1.0), ("A", 2.0)]
    short = spark.createDataFrame([("r", [1.0])], "id string, v array<float>")
    with pytest.raises(Exception, match="Column mismatch"):
        arrays_to_matrix(short, "id", "v", stats).collect()


def test_state_round_trip(spark, long, tmp_path):
    pre = Preprocessor(PreprocessConfig(pseudocount=1.0, **OPEN)).fit(long({"A": [1, 2], "B": [1, 5]}))
    pre.save(str(tmp_path / "pre"))
    again = Preprocessor.load(spark, str(tmp_path / "pre"))
    assert again.config == pre.config
    saved, fitted = (s.drop("f_score").orderBy("feature").collect() for s in (again.stats, pre.stats))
    assert saved == fitted
    with pytest.raises(RuntimeError):
        Preprocessor().save(str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        Preprocessor.load(spark, str(tmp_path / "none"))
