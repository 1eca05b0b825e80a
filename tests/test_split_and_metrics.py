import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.operators import evaluate as ev
from panelwright.operators import split
from panelwright.operators.labels import class_codes, class_weights, decode, encode
from panelwright.operators.running import ranks, running_totals


def _people(spark, counts):
    rows = [(f"{label}{i}", label) for label, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "sample_id string, label string")


def test_split_counts_and_repeatability(spark):
    people = _people(spark, {"a": 80, "b": 20})
    parts = split.stratified_split(people)
    assert {(r.label, r.is_test): r["count"] for r in parts.groupBy("label", "is_test").count().collect()} == {
        ("a", True): 16, ("a", False): 64, ("b", True): 4, ("b", False): 16
    }
    again = split.stratified_split(people.repartition(5).orderBy(F.desc("sample_id")))
    assert sorted(parts.collect()) == sorted(again.select(parts.columns).collect())
    other = split.stratified_split(people, seed=1)
    assert sorted(parts.collect()) != sorted(other.select(parts.columns).collect())
    with pytest.raises(ValueError):
        split.stratified_split(people, test_size=1.0)


def test_folds_cover_each_row_once_and_evenly(spark):
    folds = split.stratified_folds(_people(spark, {"a": 83, "b": 17}), folds=5)
    assert folds.count() == 100
    table = folds.groupBy("label", "fold").count().collect()
    for label, sizes in (("a", {16, 17}), ("b", {3, 4})):
        assert {r["count"] for r in table if r.label == label} == sizes
    with pytest.raises(ValueError):
        split.stratified_folds(folds, folds=1)


def test_subsample_is_exact(spark):
    people = _people(spark, {"a": 500})
    assert split.subsample(people, 37).count() == 37
    assert split.subsample(people, 5000).count() == 500
    assert split.subsample(people, None) is people
    with pytest.raises(ValueError):
        split.subsample(people, 0)


def test_running_totals_over_a_hot_group(spark):
    """One group holds most rows; ties in the order are split by a unique id."""
    rng = np.random.default_rng(1)
    rows = [("hot" if i % 10 else f"g{i}", float(rng.integers(0, 3)), i, int(rng.integers(0, 9))) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, x double, id long, w long")
    got = running_totals(df, [("x", True), ("id", False)], {"total": "w"}, ("g",))
    want, sums = {}, {}
    for g, x, i, w in sorted(rows, key=lambda r: (-r[1], r[2])):
        sums[g] = sums.get(g, 0) + w
        want[i] = sums[g]
    assert {r.id: r.total for r in got.collect()} == want
    assert got.columns == [*df.columns, "total"]
    spread = got.where("g = 'hot'").select("id").count()
    assert spread == 2700


def test_ranks_without_groups(spark):
    df = spark.range(1000).withColumn("x", (F.col("id") * 7919) % 1000)
    got = ranks(df, [("x", False)]).collect()
    assert all(r["rank"] == r.x + 1 for r in got)


METRIC_ROWS = ([0.9, 0.8, 0.7, 0.6, 0.5, 0.4], [1, 0, 1, 0, 0, 1])


def _scored(spark, scores, labels):
    return spark.createDataFrame(list(zip(scores, labels)), "score double, label int")


def test_ranking_metrics_by_hand(spark):
    row = ev.ranking_metrics(_scored(spark, *METRIC_ROWS)).first()
    assert row.roc_auc == pytest.approx(5 / 9)
    assert row.average_precision == pytest.approx(0.7222, abs=1e-4)


def test_ranking_metrics_with_ties(spark):
    rng = np.random.default_rng(2)
    scores, labels = rng.integers(0, 6, 400) / 5, rng.integers(0, 2, 400)
    pos, neg = scores[labels == 1], scores[labels == 0]
    auc = np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))
    steps, last = 0.0, 0.0
    for cut in sorted(set(scores), reverse=True):
        recall = (pos >= cut).mean()
        steps += (recall - last) * (pos >= cut).sum() / (scores >= cut).sum()
        last = recall
    row = ev.ranking_metrics(_scored(spark, scores.tolist(), labels.tolist())).first()
    assert (row.roc_auc, row.average_precision) == pytest.approx((auc, steps))


@pytest.mark.parametrize("labels", [[1, 1, 1], [0, 1, 2]])
def test_ranking_metrics_need_two_classes(spark, labels):
    row = ev.ranking_metrics(_scored(spark, [0.1, 0.2, 0.3], labels)).first()
    assert row.roc_auc is None and row.average_precision is None


def _called(spark, labels, predictions):
    df = spark.createDataFrame(list(zip(labels, predictions)), "label int, prediction int")
    return ev.confusion(df)


def test_macro_and_weighted_f1(spark):
    row = ev.agreement_metrics(_called(spark, [1, 0, 1, 0, 0, 1, 0, 0], [1, 1, 1, 0, 0, 0, 0, 0])).first()
    assert row.macro_f1 == pytest.approx(0.7333, abs=1e-4)
    assert row.weighted_f1 == pytest.approx(0.75)
    assert row.accuracy == pytest.approx(0.75)
    assert row.cohen_kappa == pytest.approx((0.75 - 0.53125) / (1 - 0.53125))


def test_a_class_never_called_counts_as_zero(spark):
    row = ev.agreement_metrics(_called(spark, [0, 0, 1], [0, 0, 0])).first()
    assert row.macro_f1 == pytest.approx(0.4)
    assert row.cohen_kappa == pytest.approx(0.0)


def test_report(spark):
    report = ev.classification_report(_called(spark, [1, 0, 1, 0], [1, 1, 1, 0]))
    rows = {r.name: r for r in report.collect()}
    assert set(rows) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert rows["1"].precision == pytest.approx(2 / 3) and rows["1"].recall == 1.0
    assert rows["accuracy"].precision is None and rows["accuracy"].f1_score == 0.75
    text = ev.report_text(report)
    assert "0.6667" in text and "weighted avg" in text


def test_codes(spark):
    people = _people(spark, {"Dead": 2, "Alive": 3})
    codes = class_codes(people)
    assert {r.label: r.code for r in codes.collect()} == {"Alive": 0, "Dead": 1}
    back = decode(encode(people, codes).select("sample_id", "code"), codes)
    assert sorted(r.label for r in back.collect()) == ["Alive"] * 3 + ["Dead"] * 2
    with pytest.raises(Exception, match="unseen label"):
        encode(_people(spark, {"Other": 1}), codes).collect()


@pytest.mark.parametrize(
    "counts, ratios",
    [({"a": 30, "b": 10}, {"a": 1.0, "b": 3.0}), ({"a": 5}, {"a": 1.0}), ({"a": 1, "b": 2, "c": 3}, dict.fromkeys("abc", 1.0))],
)
def test_class_weights(spark, counts, ratios):
    rows = class_weights(_people(spark, counts)).collect()
    assert {r.label: r.positive_ratio for r in rows} == ratios
    total = sum(counts.values())
    assert all(r.balanced == pytest.approx(total / (len(counts) * counts[r.label])) for r in rows)
