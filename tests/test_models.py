import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from panelwright.config import AttributionConfig, EnsembleConfig, PreprocessConfig, SelectConfig
from panelwright.functions.scalar import bar_position, direction
from panelwright.operators.attribution import TreeAttribution, pack, shapley, top_ranked, tree_paths
from panelwright.operators.ensemble import SEARCH_RANGES, StackedEnsemble, draw_settings
from panelwright.operators.panel import assemble_panel
from panelwright.operators.scoring import ScoringBundle, accepted, readiness, rejected
from panelwright.operators.split import stratified_folds
from panelwright.plans.training import fold_screens, train
from panelwright.session import materialize, new_path, run_folder, scratch
from panelwright.sources.matrix import join_samples
from panelwright.sources.state import exists, read_ranking, write_ranking
from panelwright.streaming.scoring import read_records, read_results, start_scoring

SMALL = EnsembleConfig(rf_trees=4, rf_max_depth=4, gbt_rounds=4, gbt_max_depth=3, folds=2, max_bins=16, gbt_subsample=1.0)
NAMES = [f"G{i}" for i in range(6)]


@pytest.fixture(scope="module")
def cohort(spark):
    """120 samples, six features; G0 and G1 tell the classes apart."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(120):
        label = "Dead" if i % 3 == 0 else "Alive"
        for j, name in enumerate(NAMES):
            value = rng.uniform(0, 40) + (60 if label == "Dead" and j < 2 else 0)
            rows.append((f"P{i:03d}", name, float(value), label))
    cells = spark.createDataFrame(rows, "sample_id string, feature string, value float, label string")
    cells = materialize(cells, "fixture")
    return cells.drop("label"), cells.select("sample_id", "label").distinct()


@pytest.fixture(scope="module")
def model(cohort):
    return train(*cohort, PreprocessConfig(), SelectConfig(n_mad=5, k_best=4), SMALL)


@pytest.mark.parametrize("wrong", [{"folds": 1}, {"gbt_subsample": 0.0}, {"gbt_colsample": 1.5}, {"rf_max_depth": 31}, {"gbt_max_depth": 0}])
def test_ensemble_guards(wrong):
    with pytest.raises(ValueError):
        EnsembleConfig(**wrong)


def test_unfitted_and_single_class(spark):
    rows = spark.createDataFrame([("a", "x")], "sample_id string, label string").withColumn(
        "features", array_to_vector(F.array(F.lit(1.0)))
    )
    with pytest.raises(RuntimeError, match="not fitted"):
        StackedEnsemble().predict(rows)
    with pytest.raises(ValueError, match="two classes"):
        StackedEnsemble(SMALL).fit(rows)


def test_panel_rows_are_ordered_and_complete(spark):
    rows = [("s", 1, 2.0), ("s", 0, 1.0), ("t", 0, 3.0), ("t", 1, 4.0)]
    df = spark.createDataFrame(rows, "sample_id string, feature_pos int, value float")
    got = {r.sample_id: r.features.toArray().tolist() for r in assemble_panel(df, 2).collect()}
    assert got == {"s": [1.0, 2.0], "t": [3.0, 4.0]}
    for wrong in (df.where("not (sample_id = 't' and feature_pos = 1)"), df.unionByName(df.limit(1))):
        with pytest.raises(Exception, match="expected 2 single cells"):
            assemble_panel(wrong, 2).collect()


def test_no_training_row_is_tested(model):
    train_ids = {r.sample_id for r in model.train.collect()}
    test_ids = {r.sample_id for r in model.test.collect()}
    assert len(train_ids) == 96 and len(test_ids) == 24 and not train_ids & test_ids


def test_joined_cells_are_written_once(cohort, model):
    written = join_samples(cohort[0], model.samples, "is_test")
    joined = cohort[0].join(model.samples, "sample_id")
    assert written.columns == joined.columns
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, joined.collect()))
    assert "Join" not in written._jdf.queryExecution().toString()


def test_screens_of_folds_never_see_their_fold(cohort):
    """A feature that tells classes apart only inside one fold is not in that fold's panel."""
    cells, samples = cohort
    placed = stratified_folds(samples, folds=3, seed=42)
    leaked = cells.join(placed, "sample_id").withColumn(
        "value", F.when((F.col("feature") == "G5") & (F.col("fold") == 1), F.when(F.col("label") == "Dead", 9000.0).otherwise(0.0))
        .otherwise(F.col("value")).cast("float"),
    )
    leaked = materialize(leaked.select("sample_id", "feature", "value"), "leaked")
    screens = fold_screens(leaked, samples, PreprocessConfig(), SelectConfig(n_mad=5, k_best=3), 3, 42)
    means = {}
    for fold, (screen, outside, inside) in enumerate(screens):
        assert not {r.sample_id for r in outside.select("sample_id").distinct().collect()} & {
            r.sample_id for r in inside.select("sample_id").distinct().collect()
        }
        means[fold] = screen.stats.where("feature = 'G5'").first()["mean"]
    # Values of fold 1 move the mean of G5 in the screens of the other folds only.
    plain = fold_screens(cells, samples, PreprocessConfig(), SelectConfig(n_mad=5, k_best=3), 3, 42)
    same = [screen.stats.where("feature = 'G5'").first()["mean"] == means[fold] for fold, (screen, _, _) in enumerate(plain)]
    assert same == [False, True, False]


def test_training_with_a_panel_per_fold(cohort):
    fitted = train(*cohort, PreprocessConfig(), SelectConfig(n_mad=5, k_best=4), SMALL, screen_per_fold=True)
    folds = fitted.stack.out_of_fold.collect()
    assert {r.sample_id for r in folds} == {r.sample_id for r in fitted.train.collect()} and len(folds) == 96
    assert fitted.stack.evaluate(fitted.test)[0].first().roc_auc > 0.95
    with pytest.raises(ValueError, match="one panel"):
        train(*cohort, PreprocessConfig(), SelectConfig(n_mad=5, k_best=4), SMALL, tune_trials=1, screen_per_fold=True)


def test_tables_of_a_block_are_deleted(spark):
    with scratch(spark, "trial"):
        path = new_path(spark, "inside")
        spark.range(3).write.parquet(path)
        assert exists(spark, path)
    assert not exists(spark, path) and new_path(spark, "x").startswith(run_folder(spark))


def test_out_of_fold_scores_cover_each_row_once(model):
    folds = model.stack.out_of_fold
    assert folds.count() == 96
    assert {r.sample_id for r in folds.collect()} == {r.sample_id for r in model.train.collect()}


def test_meta_model_sits_at_the_penalised_optimum(model):
    """Gradient of C * sum(loss) + |w|^2 / 2 is zero; the intercept is free."""
    rows = model.stack.out_of_fold.toPandas()
    x, y = rows[["p_rf", "p_gbt"]].to_numpy(), rows["code"].to_numpy()
    w, b = model.stack.meta.coefficients.toArray(), model.stack.meta.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(x.T @ (p - y) + w).max() < 1e-2
    assert abs((p - y).sum()) < 1e-2


def test_predictions(model):
    rows = model.stack.predict(model.test).collect()
    for r in rows:
        assert sum(r.probabilities) == pytest.approx(1.0)
        assert r.prediction == ("Dead" if r.probabilities[1] > r.probabilities[0] else "Alive")
    metrics, report, scored = model.stack.evaluate(model.test)
    assert metrics.first().roc_auc > 0.95
    assert report.count() == 5 and scored.count() == 24


def test_importances(model):
    names = [n for n, _, _ in model.bundle.panel]
    rows = model.stack.importances(names).collect()
    assert rows[0].feature in ("G0", "G1")
    assert sum(r.importance for r in rows) == pytest.approx(1.0)
    with pytest.raises(ValueError, match="names"):
        model.stack.importances(names[:-1])


def test_one_fit_and_one_search_are_at_the_defaults(monkeypatch):
    from types import SimpleNamespace

    from panelwright.plans import catalog

    seen = []

    class Stack:
        def __init__(self, config):
            seen.append(config)

        def tune(self, rows, trials=None, draws=None):
            seen.append((rows, trials, draws))
            return SimpleNamespace(search_results="results")

        def evaluate(self, rows):
            return rows, None, None

    monkeypatch.setattr(catalog, "StackedEnsemble", Stack)
    monkeypatch.setattr(catalog, "train", lambda *a: SimpleNamespace(stack=Stack(a[4]), test="test", train="train"))
    monkeypatch.setattr(catalog, "trained", lambda *a: SimpleNamespace(train="train"))
    monkeypatch.setattr(catalog.wl, "spend_matrix", lambda *a, **b: None)
    monkeypatch.setattr(catalog.wl, "customers", lambda *a: None)
    assert catalog.QUERIES["stack_defaults"](None, "") == "test" and catalog.QUERIES["search_defaults"](None, "") == "results"
    assert seen == [EnsembleConfig(), EnsembleConfig(), ("train", None, None)]


def test_the_checked_search_has_all_trials_at_the_defaults(spark, monkeypatch):
    from types import SimpleNamespace

    from panelwright.plans import catalog

    seen, names = [], list(SEARCH_RANGES)

    class Stack:
        def __init__(self, config):
            self.config = config

        def tune(self, rows, trials=None, draws=None):
            seen.append((self.config, rows, trials, draws))
            drawn = draw_settings(self.config, self.config.tune_trials, {"rf_trees": (50, 110)})
            table = [(i, *[getattr(d, n) for n in names], float(i)) for i, d in enumerate(drawn)]
            columns = [f"{n} {'int' if isinstance(getattr(self.config, n) or 1, int) else 'double'}" for n in names]
            self.search_results = spark.createDataFrame(table, ", ".join(["trial int", *columns, "mean_roc_auc double"]))
            self.best_score, self.n_outside = 29.0, sum(not 100 <= d.rf_trees <= 599 for d in drawn)
            seen.append(self.n_outside)
            return self

    monkeypatch.setattr(catalog, "StackedEnsemble", Stack)
    monkeypatch.setattr(catalog, "trained", lambda *a: SimpleNamespace(train="train"))
    found = catalog.QUERIES["search_checks"](spark, "").first()
    assert seen[0] == (EnsembleConfig(), "train", None, None) and seen[1] > 0
    assert (found.n_trials, found.n_outside, found.best_is_largest) == (30, seen[1], True)


def test_search_draws_stay_in_range_and_repeat():
    draws = draw_settings(EnsembleConfig(), 40)
    assert draws == draw_settings(EnsembleConfig(), 40)
    for d in draws:
        for name, span in SEARCH_RANGES.items():
            value = getattr(d, name)
            assert value in span if name == "rf_max_depth" else span[0] <= value <= span[1]


def test_search_keeps_the_best_trial(model):
    tiny = EnsembleConfig(rf_trees=2, rf_max_depth=2, gbt_rounds=1, gbt_max_depth=2, folds=2, max_bins=16)
    spans = {"rf_trees": (2, 3), "gbt_rounds": (1, 2), "gbt_max_depth": (2, 2), "rf_max_depth": (2, 3)}
    stack = StackedEnsemble(tiny).tune(model.train, draws=draw_settings(tiny, 2, spans))
    rows = stack.search_results.collect()
    assert len(rows) == 2 and stack.best_score == max(r.mean_roc_auc for r in rows)
    assert stack.rf is not None and stack.config.rf_trees in (2, 3)


# -- attribution --------------------------------------------------------

# Depth 3, feature 0 twice on one path.
TREE = pd.DataFrame(
    [
        (0, 0, 100.0, 0.0, 1, 2, 0, 5.0),
        (0, 1, 60.0, 0.0, 3, 4, 1, 1.0),
        (0, 2, 40.0, 7.0, -1, -1, -1, None),
        (0, 3, 24.0, 0.0, 5, 6, 0, 2.0),
        (0, 4, 36.0, -1.0, -1, -1, -1, None),
        (0, 5, 8.0, 3.0, -1, -1, -1, None),
        (0, 6, 16.0, -4.0, -1, -1, -1, None),
    ],
    columns=["tree", "id", "cover", "output", "left", "right", "feature", "threshold"],
)


def _expected(x, known, node=0):
    """Mean output when only the features in ``known`` are given."""
    at = TREE.loc[node]
    if at.left < 0:
        return at.output
    children = (int(at.left), int(at.right))
    if at.feature in known:
        return _expected(x, known, children[0] if x[int(at.feature)] <= at.threshold else children[1])
    return sum(TREE.loc[c].cover / at.cover * _expected(x, known, c) for c in children)


@pytest.mark.parametrize("x", [(1.0, 0.5, 9.0), (2.0, 1.0, 0.0), (4.0, 0.0, 0.0), (6.0, 3.0, 0.0), (5.0, 3.0, 0.0)])
def test_one_tree_equals_the_definition(x):
    paths = tree_paths(TREE)
    phi = np.zeros((1, 3))
    shapley(np.array([x]), pack(paths), phi)
    for j in range(3):
        others = [i for i in range(3) if i != j]
        want = sum(
            math.factorial(len(s)) * math.factorial(2 - len(s)) / 6 * (_expected(x, {*s, j}) - _expected(x, set(s)))
            for k in range(3)
            for s in itertools.combinations(others, k)
        )
        assert phi[0, j] == pytest.approx(want, abs=1e-12)
    assert phi[0, 2] == 0.0
    assert paths["base"].sum() == pytest.approx(_expected(x, set()))


@pytest.mark.parametrize("learner, chunk", [("gbt", 20_000), ("gbt", 7), ("rf", 20_000)])
def test_values_add_up_to_the_model_output(model, learner, chunk):
    names = [n for n, _, _ in model.bundle.panel]
    shap = TreeAttribution(model.stack, names, AttributionConfig(learner=learner, paths_per_chunk=chunk)).fit(model.test)
    p = F.col(f"p_{learner}")
    output = F.ln(p / (1 - p)) if learner == "gbt" else p
    outputs = {r.sample_id: r.o for r in model.stack.predict(model.test).select("sample_id", output.alias("o")).collect()}
    sums = {r.sample_id: sum(r.phi) for r in shap.values.collect()}
    assert {k: shap.base_value + v for k, v in sums.items()} == pytest.approx(outputs, abs=1e-4)


def test_ranking_and_plot_tables(spark, model, tmp_path):
    names = [n for n, _, _ in model.bundle.panel]
    config = AttributionConfig(max_display=2, max_samples=10)
    with pytest.raises(RuntimeError, match="not fitted"):
        TreeAttribution(model.stack, names, config).ranking()
    shap = TreeAttribution(model.stack, names, config).fit(model.train)
    assert shap.values.count() == 10
    assert (shap.negative, shap.positive) == ("Alive", "Dead")
    ranking = shap.ranking().collect()
    assert len(ranking) == 4 and ranking[0].feature in ("G0", "G1")
    assert shap.bars().count() == 2 and shap.summary_points().count() == 20
    write_ranking(shap.ranking(), str(tmp_path / "r"))
    back = read_ranking(spark, str(tmp_path / "r")).collect()
    assert [r.feature for r in back] == [r.feature for r in ranking]


def test_direction_orders_but_does_not_filter(spark):
    rows = [("a", 0, -0.1, 0.1), ("b", 1, -0.3, 0.3), ("c", 2, -0.2, 0.2)]
    df = spark.createDataFrame(rows, "feature string, feature_pos int, mean_shap double, mean_abs_shap double")
    assert [r.feature for r in top_ranked(df, 2, "positive").collect()] == ["a", "c"]
    assert [r.feature for r in top_ranked(df, 2, "negative").collect()] == ["b", "c"]
    assert [r.feature for r in top_ranked(df, 2).collect()] == ["b", "c"]
    with pytest.raises(ValueError, match="direction"):
        top_ranked(df, 2, "sideways")
    shown = df.select(direction(F.col("mean_shap")).alias("d"), bar_position(F.col("mean_shap") * 2).alias("p")).collect()
    assert [r.d for r in shown] == ["alive"] * 3
    assert [r.p for r in shown] == pytest.approx([25.0, 0.0, 0.0])


def test_attribution_guards(model):
    names = [n for n, _, _ in model.bundle.panel]
    for wrong in ({"learner": "svm"}, {"n_top": 0}, {"max_display": 0}, {"max_samples": 0}):
        with pytest.raises(ValueError):
            AttributionConfig(**wrong)
    with pytest.raises(ValueError, match="names"):
        TreeAttribution(model.stack, names[:-1])
    with pytest.raises(RuntimeError, match="fitted"):
        TreeAttribution(StackedEnsemble(SMALL), names)


# -- scoring ------------------------------------------------------------


def _records(spark, changes):
    good = {name: 3.5 for name in NAMES}
    rows = [(key, None if c is None else {**good, **c}) for key, c in changes.items()]
    return spark.createDataFrame(rows, "patient_id string, expressions map<string,double>")


def test_bad_records(spark, model):
    bundle = model.bundle
    rows = _records(spark, {
        "good": {}, "extra": {"X": 1.0}, "": {}, "negative": {"G1": -1.0}, "nan": {"G2": float("nan")},
        "inf": {"G3": float("inf")}, "-inf": {"G3": float("-inf")}, "null": {"G4": None}, "none": None,
        "huge": {"G0": 1e300},
    })
    short = rows.where("patient_id = 'good'").withColumn("patient_id", F.lit("short")).withColumn(
        "expressions", F.map_filter("expressions", lambda k, _: k != "G5"))
    blank = short.withColumn("patient_id", F.lit("blank")).withColumn(
        "expressions", F.map_filter("expressions", lambda k, _: F.lit(False)))
    # Whatever is wrong with a value comes before what is missing.
    both = short.withColumn("patient_id", F.lit("both")).withColumn(
        "expressions", F.map_concat(F.map_filter("expressions", lambda k, _: k != "G0"), F.create_map(F.lit("G0"), F.lit(-2.0))))
    scored = bundle.score(rows.unionByName(short).unionByName(blank).unionByName(both))
    codes = {r.patient_id: r.reject_code for r in rejected(scored).collect()}
    assert codes == {"": 422, "negative": 422, "nan": 422, "inf": 422, "-inf": 422, "null": 422, "none": 422,
                     "blank": 422, "both": 422, "short": 400, "huge": 500}
    reasons = {r.patient_id: r.reject_reason for r in rejected(scored).collect()}
    assert "G1" in reasons["negative"] and "G5" in reasons["short"]
    good = {r.patient_id: r for r in accepted(scored).collect()}
    assert set(good) == {"good", "extra"}
    assert (good["good"].n_genes_received, good["extra"].n_genes_received) == (6, 7)
    assert good["extra"].risk_probability == good["good"].risk_probability
    assert good["good"].n_genes_used_by_model == 4
    assert good["good"].risk_probability == good["good"].class_probabilities["Dead"]
    assert set(good["good"].class_probabilities) == {"Alive", "Dead"}


def test_records_score_like_the_test_matrix(cohort, model):
    cells, _ = cohort
    rows = cells.groupBy(F.col("sample_id").alias("patient_id")).agg(
        F.map_from_entries(F.collect_list(F.struct("feature", F.col("value").cast("double")))).alias("expressions"))
    got = {r.patient_id: r.risk_probability for r in accepted(model.bundle.score(rows)).collect()}
    want = {r.sample_id: round(r.score, 6) for r in model.stack.predict(model.test).collect()}
    assert {k: got[k] for k in want} == pytest.approx(want, abs=2e-6)
    panel = model.screen.transform(cells).groupBy("feature_pos").agg(F.count("*")).count()
    assert panel == 4
    assert model.test.select(F.size(vector_to_array("features")).alias("n")).distinct().collect()[0].n == 4


def test_stream_equals_batch(spark, model, tmp_path):
    rows = _records(spark, {f"p{i}": {"G0": float(10 * i), "G1": float(-1 if i == 3 else i)} for i in range(8)})
    rows.repartition(4).write.json(str(tmp_path / "in"))
    stream = read_records(spark, str(tmp_path / "in"), files_per_trigger=1)
    start_scoring(model.bundle, stream, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    got = read_results(spark, str(tmp_path / "out"))
    assert {r.outcome: r["count"] for r in got.groupBy("outcome").count().collect()} == {"accepted": 7, "rejected": 1}
    columns = ["patient_id", "predicted_status", "risk_probability", "reject_code"]
    batch = model.bundle.score(rows).select(columns).collect()
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, batch))
    # A second run finds nothing new: each record is written once.
    start_scoring(model.bundle, stream, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    assert read_results(spark, str(tmp_path / "out")).count() == 8


def test_bundle_on_disk(spark, model, tmp_path):
    path = str(tmp_path / "bundle")
    model.bundle.save(path)
    again = ScoringBundle.load(spark, path)
    rows = _records(spark, {"a": {}, "b": {"G0": 90.0, "G1": 80.0}})
    assert again.score(rows).collect() == model.bundle.score(rows).collect()
    ready = readiness(spark, again).first()
    assert (ready.status, ready.n_expected_genes, ready.n_model_input_genes, ready.classes) == ("ok", 6, 4, ["Alive", "Dead"])
    assert readiness(spark, None).first().status == "unavailable"
    wrong = spark.createDataFrame([("Alive", 0), ("Dead", 2)], "label string, code int")
    wrong.write.mode("overwrite").parquet(f"{path}/classes")
    with pytest.raises(RuntimeError, match=r"\[0, 1\]"):
        ScoringBundle.load(spark, path)
    with pytest.raises(FileNotFoundError):
        ScoringBundle.load(spark, str(tmp_path / "none"))
