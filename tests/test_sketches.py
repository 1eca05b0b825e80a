"""Quantile and distinct sketches against exact results; cells of hash ranks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.config import PreprocessConfig, SelectConfig
from panelwright.operators import align as al
from panelwright.operators import split
from panelwright.operators.boosting import bin_edges
from panelwright.operators.order_stats import mad
from panelwright.operators.quantile_sketch import pruned, quantiles, sketch, sketched_mad
from panelwright.plans.screening import FeatureScreen


def true_range(x, w, cut):
    return w[x < cut].sum() / w.sum(), w[x <= cut].sum() / w.sum()


@pytest.mark.parametrize("kind", ["even", "skewed", "one heavy value", "ties"])
def test_rank_error_is_below_what_is_stated(spark, kind):
    rng = np.random.default_rng(1)
    n = 20_000
    x = rng.normal(size=n) if kind != "ties" else rng.integers(0, 400, n).astype(float)
    w = np.ones(n)
    if kind == "skewed":
        w = np.exp(3 * rng.normal(size=n)) * (1 + 50 * (x > 1.5))
    if kind == "one heavy value":
        x[: n // 3] = 0.25
        w[0] = 5000.0
    df = spark.createDataFrame([("f", float(a), float(b)) for a, b in zip(x, w)], "feature string, x double, w double").repartition(7)
    shares = [i / 50 for i in range(1, 50)]
    row = quantiles(sketch(df, weight="w", points=64, held=700, fan=3), shares).first()
    assert 0 < row.error < 0.15
    for share, cut in zip(shares, row.quantiles):
        low, high = true_range(x, w, cut)
        assert low - row.error - 1e-9 <= share <= high + row.error + 1e-9


def test_few_distinct_values_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(f"f{i % 3}", float(rng.integers(0, 9)), int(rng.integers(1, 5))) for i in range(600)]
    df = spark.createDataFrame(rows, "feature string, x double, w int").repartition(5)
    found = {r.feature: r for r in sketched_mad(df, weight="w", points=16).collect()}
    want = {r.feature: r for r in mad(df, weight="w").collect()}
    assert set(found) == set(want)
    for f, r in found.items():
        assert (r.error, r.median, r.mad) == (0.0, want[f].median, want[f].mad)


def test_odd_values(spark):
    rows = [("a", None, 1.0), ("a", float("nan"), 1.0), ("a", 3.0, 1.0), ("a", 4.0, 0.0), ("a", 5.0, -1.0), (None, 1.0, 1.0),
            ("b", float("inf"), 2.0), ("b", -0.0, 2.0), ("b", 0.0, 2.0), ("c", 1.0, None)]
    df = spark.createDataFrame(rows, "feature string, x double, w double").withColumns({"total": F.lit(1), "values": F.lit(2)})
    found = {r.feature: r for r in sketch(df, weight="w").collect()}
    assert set(found) == {"a", "b"}
    assert (found["a"]["values"], found["a"].total) == ([3.0], 1.0)
    assert (found["b"]["values"], found["b"].weights, found["b"].error) == ([0.0, float("inf")], [4.0, 2.0], 0.0)
    assert sketch(df.limit(0), weight="w").count() == 0
    with pytest.raises(ValueError):
        sketch(df, points=1)


def test_pruning_keeps_the_weight_of_every_group():
    rng = np.random.default_rng(3)
    group, value, weight = rng.integers(0, 5, 4000), rng.normal(size=4000), rng.integers(1, 9, 4000).astype(float)
    g, v, w, names, moved = pruned(group, value, weight, 50)
    assert names.tolist() == [0, 1, 2, 3, 4]
    for i in range(5):
        assert w[g == i].sum() == weight[group == i].sum() and (g == i).sum() <= 50
        assert (np.diff(v[g == i]) > 0).all() and 0 < moved[i] <= w[g == i].sum() / 50 * 1.2


def test_bin_edges_follow_the_weights(spark):
    rows = [(w, [float(i), 1.0]) for i, w in enumerate([1.0] * 90 + [91.0] * 10)]
    edges = bin_edges(spark.createDataFrame(rows, "w double, x array<double>"), 4)
    assert edges[0].tolist() == [91.0, 94.0, 97.0] and edges[1].tolist() == [1.0]


def test_a_screen_by_sketches_is_the_same_where_they_are_exact(spark, long):
    rng = np.random.default_rng(4)
    cells = long({f"f{i}": rng.integers(0, 40 + i, 60).tolist() for i in range(8)}, ["a", "b"] * 30)
    cuts = PreprocessConfig(min_expression=0.0, variance_threshold=0.0)
    picked = [
        FeatureScreen(cuts, SelectConfig(n_mad=5, k_best=3, spread=spread)).fit(cells).stats.select("feature", "mad", "kept_panel").collect()
        for spread in ("exact", "sketch")
    ]
    assert sorted(picked[0]) == sorted(picked[1])
    with pytest.raises(ValueError, match="spread"):
        SelectConfig(spread="guess")


def test_distinct_sketches_merge(spark):
    cells = spark.range(30_000).select(
        F.when(F.col("id") % 2 == 0, "many").otherwise("few").alias("feature"),
        F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.col("id") % 14).cast("float").alias("value"),
    )
    zeros = spark.createDataFrame([("few", 0.0), ("few", -0.0), ("few", None), ("none", None)], "feature string, value float")
    parts = [al.distinct_sketches(cells.where(F.col("value") % 3 == i)) for i in range(3)] + [al.distinct_sketches(zeros)]
    found = {r.feature: r.n_distinct for r in al.distinct_counts(al.merge_sketches(*parts)).collect()}
    assert found["few"] == 8 and found["none"] == 0
    assert abs(found["many"] - 15_000) < 0.05 * 15_000


@pytest.mark.parametrize("most", [1, 3, 1 << 18])
def test_hash_ranks_do_not_depend_on_cells(spark, most):
    rows = [(f"S{i}", "big" if i % 500 else "small") for i in range(3000)]
    people = spark.createDataFrame(rows, "sample_id string, label string")
    ranked = split.hash_ranks(people, "sample_id", 7, ("label",), most)
    want = {(r.sample_id, r.label): r for r in split.hash_ranks(people, "sample_id", 7, ("label",)).collect()}
    for r in ranked.collect():
        assert (r.hash_rank, r.group_rows) == (want[r.sample_id, r.label].hash_rank, want[r.sample_id, r.label].group_rows)
    for label in ("big", "small"):
        n = sum(r[1] == label for r in rows)
        assert sorted(r.hash_rank for r in want.values() if r.label == label) == list(range(1, n + 1))


def test_cells_hold_few_rows_whatever_the_class(spark):
    people = spark.range(4500).select(
        F.concat(F.lit("S"), "id").alias("sample_id"), F.when(F.col("id") % 1000 == 0, "small").otherwise("big").alias("label")
    )
    cells = split.hash_cells(people, "sample_id", 1, ("label",), 2)
    sizes = cells.groupBy("label", "_cell").count()
    assert sizes.agg(F.max("count")).first()[0] <= 2
    assert sizes.agg(F.max(F.length("_cell"))).first()[0] == 6
    repeated = spark.createDataFrame([("S1", "a")] * 5, "sample_id string, label string")
    assert sorted(r.hash_rank for r in split.hash_ranks(repeated, "sample_id", 1, ("label",), 2).collect()) == [1, 2, 3, 4, 5]
