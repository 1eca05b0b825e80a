import pytest
from pyspark.sql import functions as F

from panelwright.config import IngestConfig, PreprocessConfig, SelectConfig
from panelwright.operators import split
from panelwright.operators.align import align, unique_label_keys
from panelwright.operators.moments import log2_moments
from panelwright.operators.running import running_totals
from panelwright.plans import workloads as wl
from panelwright.plans.filters import ExpressionFilter, MadFilter
from panelwright.plans.screening import FeatureScreen
from panelwright.sources.matrix import read_wide_matrix, write_matrix

FOLDER = "/root/testdata/sf0.001"
# Four samples at a cut of 3 in half of them: rye has 3 of 4, oat exactly 2, bean 1.
GRAINS = {"rye": [3, 7, 4, 1], "bean": [9, 2, 0, 1], "oat": [0, 3, 5, 2]}
# Medians 6, 40 and 3; absolute deviations {4, 2, 2, 8}, {0, 0, 0, 0}, {1, 0, 0, 60}: MAD 3, 0 and 0.5.
HEIGHTS = {"hill": [2, 4, 8, 14], "plain": [40] * 4, "tower": [2, 3, 3, 63]}


def _features(df):
    return [r.feature for r in df.select("feature").distinct().orderBy("feature").collect()]


def test_expression_filter(spark, long):
    kept = ExpressionFilter(3.0, 0.5).fit(long(GRAINS))
    assert [r.feature for r in kept.names().collect()] == ["rye", "oat"]
    assert kept.n_removed() == 1
    assert _features(kept.transform(long(GRAINS))) == ["oat", "rye"]
    rows = spark.createDataFrame([("r", [8.0, 6.0, 4.0])], "id string, v array<float>")
    got = kept.transform_arrays(rows, "id", "v").collect()
    assert {(r.feature, r.value) for r in got} == {("rye", 8.0), ("oat", 4.0)}
    with pytest.raises(ValueError, match="Column mismatch"):
        kept.transform(long({"rye": [1], "millet": [1], "oat": [1]}))


def test_mad_filter(spark, long):
    kept = MadFilter(2).fit(long(HEIGHTS))
    assert [r.feature for r in kept.names().collect()] == ["hill", "tower"]
    assert kept.n_removed() == 1
    assert [r.mad for r in kept.scores().collect()] == [3.0, 0.5, 0.0]
    assert _features(kept.transform(long(HEIGHTS))) == ["hill", "tower"]
    with pytest.raises(ValueError, match="Column mismatch"):
        kept.transform(long({"valley": [1, 2]}))
    # Unnamed arrays are never taken for a matrix here.
    arrays = spark.createDataFrame([("r", [1.0, 2.0, 3.0])], "id string, v array<float>")
    with pytest.raises(TypeError):
        kept.transform(arrays)


def test_guards(long):
    with pytest.raises(ValueError, match="min_sample_fraction"):
        ExpressionFilter(min_sample_fraction=-0.1)
    with pytest.raises(ValueError, match="none of 3 features"):
        ExpressionFilter(min_expression=50.0).fit(long(GRAINS))
    with pytest.raises(ValueError, match="must be less"):
        MadFilter(3).fit(long(HEIGHTS))
    with pytest.raises(TypeError):
        ExpressionFilter().fit([[1.0]])
    for unfitted in (ExpressionFilter(), MadFilter()):
        with pytest.raises(RuntimeError, match="not fitted"):
            unfitted.transform(long(HEIGHTS))


# -- plans --------------------------------------------------------------


def _plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_moments_fold_before_their_only_shuffle(spark, long):
    plan = _plan(log2_moments(long(HEIGHTS, ["a", "a", "b", "b"])))
    assert plan.count("Exchange (") <= 2 and "partial_avg" in plan
    assert "Python" not in plan


def test_matrix_needs_no_cross_join(spark):
    items = wl.purchases(spark, FOLDER, F.col("p_brand"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in _plan(items)
    plan = _plan(wl.spend_matrix(spark, FOLDER))
    for wrong in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert wrong not in plan + _plan(items)


def test_no_text_is_read_after_alignment(spark, tmp_path):
    lines = ["id\t" + "\t".join(f"TCGA-{i:04d}" for i in range(120))]
    lines += [f"g{j}\t" + "\t".join(str(i % (j + 2)) for i in range(120)) for j in range(3)]
    (tmp_path / "m.tsv").write_text("\n".join(lines) + "\n")
    cells = read_wide_matrix(spark, str(tmp_path / "m.tsv"))
    labels = spark.createDataFrame([(f"TCGA-{i:04d}", "ab"[i % 2]) for i in range(120)], "sample_id string, label string")
    out = align(cells, labels, IngestConfig())
    assert "Scan text" in _plan(cells) and "Scan text" not in _plan(out.matrix) + _plan(out.samples)
    assert out.matrix.count() == 360


def test_panel_names_reach_the_scan(spark, tmp_path):
    cells = wl.spend_matrix(spark, FOLDER)
    path = str(tmp_path / "m")
    write_matrix(cells, path)
    screen = FeatureScreen(PreprocessConfig(), SelectConfig(n_mad=12, k_best=2)).fit(cells)
    plan = _plan(screen.transform(spark.read.parquet(path), check=False))
    assert "In(feature, [Brand#" in plan
    assert "BroadcastHashJoin" in plan and "Python" not in plan


@pytest.mark.parametrize("share", [0.34, 0.95])
def test_hot_keys_keep_results_whole(spark, share):
    """One class, one key and one feature hold much of the data."""
    n = 6000
    hot = int(n * share)
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("sample_id"), F.when(F.col("id") < hot, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 7)).alias("label")
    )
    parts = split.stratified_split(rows)
    counts = {(r.label, r.is_test): r["count"] for r in parts.groupBy("label", "is_test").count().collect()}
    assert counts[("hot", True)] == round(0.2 * hot) and counts[("hot", False)] == hot - round(0.2 * hot)
    assert parts.count() == n
    keys = rows.select(F.col("label").alias("sample_id"), F.lit("x").alias("label"))
    assert unique_label_keys(keys.unionByName(keys.limit(1).withColumn("sample_id", F.lit("single"))), 9).count() == 1
    totals = running_totals(rows.withColumn("one", F.lit(1)), [("sample_id", False)], {"t": "one"}, ("label",))
    assert totals.where("label = 'hot'").agg(F.max("t"), F.count_distinct("t")).first() == (hot, hot)
