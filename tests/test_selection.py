import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.config import SelectConfig
from panelwright.functions.scalar import digamma
from panelwright.operators.order_stats import mad, medians, medians
from panelwright.operators.scorers import anova_f, mutual_information
from panelwright.operators.select import funnel, pair_scores, top_by_mad, top_by_score
from panelwright.plans.screening import FeatureScreen, Selector

# Medians 6, 40 and 3; absolute deviations {4, 2, 2, 8}, {0, 0, 0, 0}, {1, 0, 0, 60}: MAD 3, 0 and 0.5.
HEIGHTS = {"hill": [2, 4, 8, 14], "plain": [40] * 4, "tower": [2, 3, 3, 63]}


def _mads(df):
    return {r.feature: (r.median, r.mad) for r in mad(df.withColumnRenamed("value", "x")).collect()}


def test_mad_by_hand_and_outliers(long):
    assert _mads(long(HEIGHTS)) == {"hill": (6.0, 3.0), "plain": (40.0, 0.0), "tower": (3.0, 0.5)}


def test_even_median_averages_the_middle(long):
    assert _mads(long({"A": [1, 2, 3, 4]}))["A"] == (2.5, 1.0)


def test_selector_cuts(long):
    labels = ["a", "a", "b", "b"]
    picked = Selector(SelectConfig(n_mad=2, k_best=1)).fit(long(HEIGHTS, labels))
    assert [r.feature for r in picked.names().collect()] == ["hill"]
    assert picked.stats.where("not kept_mad").count() == 1
    assert {r.feature for r in picked.transform(long(HEIGHTS)).select("feature").collect()} == {"hill"}
    assert picked.mad_scores().first().feature == "hill"
    assert picked.best_scores(1).count() == 1


def test_selector_guards(spark, long):
    with pytest.raises(ValueError, match="must be less"):
        Selector(SelectConfig(n_mad=10, k_best=2)).fit(long(HEIGHTS, ["a", "a", "b", "b"]))
    with pytest.raises(ValueError, match="must exceed"):
        SelectConfig(n_mad=5, k_best=5)
    with pytest.raises(ValueError, match="not registered"):
        SelectConfig(scorer="none")
    with pytest.raises(RuntimeError, match="not fitted"):
        Selector().transform(long(HEIGHTS))
    with pytest.raises(ValueError, match="label"):
        Selector(SelectConfig(n_mad=2, k_best=1)).fit(long(HEIGHTS))
    few = spark.createDataFrame([("S0", "a"), ("S1", "b")], "sample_id string, label string")
    with pytest.raises(ValueError, match="differ"):
        Selector(SelectConfig(n_mad=2, k_best=1)).fit(long(HEIGHTS), few)


def test_separate_labels_equal_a_label_column(spark, long):
    names = ["a", "a", "b", "b"]
    table = spark.createDataFrame([(f"S{i}", n) for i, n in enumerate(names)], "sample_id string, label string")
    config = SelectConfig(n_mad=2, k_best=1)
    both = [Selector(config).fit(*given).stats.where("kept_panel").collect()
            for given in ((long(HEIGHTS), table), (long(HEIGHTS, names),))]
    assert both[0] == both[1]


def test_ties_at_the_cuts(spark):
    rows = [("a", 0, 1.0, 5.0), ("b", 1, 1.0, 5.0), ("c", 2, 1.0, float("nan")), ("d", 3, 2.0, None)]
    df = spark.createDataFrame(rows, "feature string, feature_pos int, mad double, score double")
    assert [r.feature for r in top_by_mad(df, 2).collect()] == ["d", "a"]
    assert [r.feature for r in top_by_score(df, 1).collect()] == ["b"]
    assert {r.feature for r in top_by_score(df, 2).collect()} == {"a", "b"}


def _f(groups):
    values = np.concatenate(groups)
    between = sum(len(g) * (g.mean() - values.mean()) ** 2 for g in groups)
    within = sum(((g - g.mean()) ** 2).sum() for g in groups)
    k, n = len(groups), len(values)
    return (between / (k - 1)) / (within / (n - k))


@pytest.mark.parametrize("k", [2, 3])
def test_anova_f(long, k):
    rng = np.random.default_rng(k)
    values = (rng.normal(1000, 1, 60)).astype(np.float32)
    labels = [f"c{i % k}" for i in range(60)]
    df = long({"A": values, "FLAT": [0.1] * 60}, labels).withColumnRenamed("value", "x")
    got = {r.feature: r.score for r in anova_f(df).collect()}
    groups = [values[np.array(labels) == f"c{i}"].astype(float) for i in range(k)]
    assert got["A"] == pytest.approx(_f(groups), rel=1e-9)
    assert math.isnan(got["FLAT"])


def test_anova_f_of_a_perfect_split_is_infinite(long):
    df = long({"A": [1, 1, 2, 2]}, ["a", "a", "b", "b"]).withColumnRenamed("value", "x")
    assert anova_f(df).first().score == float("inf")


@pytest.mark.parametrize("cells, map_rows", [(16, 4), (64, 10)])
def test_median_by_counting_equals_numpy(spark, cells, map_rows):
    rng = np.random.default_rng(7)
    groups = {
        "hot": np.r_[np.zeros(900), rng.lognormal(0, 4, 301)],  # one value holds most rows
        "wide": rng.normal(0, 1, 500) * 10.0 ** rng.integers(-6, 6, 500),
        "even": np.array([1.0, 2.0]),
        "one": np.array([3.5]),
        "flat": np.full(40, -2.25),
        "signed": rng.normal(-5, 3, 77),
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "feature string, x double")
    want = {g: float(np.median(v)) for g, v in groups.items()}
    for method in (medians(df, cells=cells, map_rows=map_rows), medians(df)):
        assert {r.feature: r.median for r in method.collect()} == pytest.approx(want, rel=1e-12)


def test_digamma(spark):
    got = [r.d for r in spark.range(1, 50).select(digamma(F.col("id")).alias("d")).collect()]
    harmonic = np.cumsum([0.0] + [1 / i for i in range(1, 49)]) - 0.5772156649015329
    assert np.allclose(got, harmonic, atol=1e-12)


def _brute_information(x, labels, k=3):
    """All pairs, without noise: the values have no ties."""
    x = np.asarray(x, dtype=np.float32).astype(float)
    x = x / x.std()
    labels = np.array(labels)
    counts = {c: (labels == c).sum() for c in set(labels)}
    used = np.array([counts[c] > 1 for c in labels])
    x, labels = x[used], labels[used]
    psi = lambda n: sum(1 / i for i in range(1, int(n))) - 0.5772156649015329
    terms = []
    for i in range(len(x)):
        d = np.abs(x - x[i])
        own = np.sort(d[(labels == labels[i]) & (np.arange(len(x)) != i)])
        kk = min(k, len(own))
        terms.append(psi(kk) - psi(counts[labels[i]]) - psi((d < own[kk - 1]).sum()))
    return max(0.0, psi(len(x)) + np.mean(terms))


@pytest.mark.parametrize("block", [4096, 5])
def test_mutual_information_equals_all_pairs(long, monkeypatch, block):
    """Also with blocks so small that every neighbour search crosses one."""
    monkeypatch.setattr("panelwright.operators.scorers.BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    labels = [str(c) for c in rng.choice(3, 90, p=[0.7, 0.25, 0.05])] + ["alone"]
    y = np.array([len(c) + ord(c[0]) % 3 for c in labels])
    columns = {"INFORMED": y * 2 + rng.normal(0, 1, 91), "NOISE": rng.normal(0, 1, 91)}
    df = long(columns, labels).withColumnRenamed("value", "x")
    got = {r.feature: r.score for r in mutual_information(df).collect()}
    for name, values in columns.items():
        assert got[name] == pytest.approx(_brute_information(values, labels), abs=1e-9)
    assert got["INFORMED"] > got["NOISE"]


def test_mutual_information_is_repeatable_with_ties(long):
    df = long({"A": [0] * 20 + [1] * 20}, ["a", "b"] * 20).withColumnRenamed("value", "x")
    assert mutual_information(df).collect() == mutual_information(df).collect()


def test_pairing_needs_equal_lengths(spark):
    names = spark.createDataFrame([(0, "a"), (1, "b")], "feature_pos int, feature string")
    scores = spark.createDataFrame([(0, 1.0)], "feature_pos int, score double")
    with pytest.raises(ValueError, match="lengths"):
        pair_scores(names, scores)


def test_screen_end_to_end_and_reload(spark, long, tmp_path):
    rng = np.random.default_rng(0)
    labels = ["a", "b"] * 20
    shift = np.array([0.0, 3.0] * 20)
    columns = {f"G{i}": rng.uniform(1, 50, 40) + (shift * 10 if i < 2 else 0) for i in range(8)}
    columns["OFF"] = [0.0] * 40
    screen = FeatureScreen(select=SelectConfig(n_mad=6, k_best=2)).fit(long(columns, labels))
    counts = [r.n_features for r in screen.funnel().orderBy("stage_no").collect()]
    assert counts == [9, 8, 8, 6, 2]
    screen.save(str(tmp_path / "screen"))
    again = FeatureScreen.load(spark, str(tmp_path / "screen"))
    assert again.panel() == screen.panel()
    assert again.selector.config == screen.selector.config
    assert funnel(again.stats).count() == 5
    assert again.transform(long(columns)).count() == 80
