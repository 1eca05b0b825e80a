"""Every operator as a query over the star-schema tables.

A query takes (spark, folder) and returns a DataFrame over the whole tables.
``panelwright.plans.oracles`` has the same results in plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.config import AttributionConfig, EnsembleConfig, IngestConfig, PreprocessConfig, SelectConfig
from panelwright.functions.scalar import (
    bar_position,
    class_probabilities,
    direction,
    log2_shift,
    null_if_token,
    strip,
    truncate_key,
)
from panelwright.operators import align as al
from panelwright.operators import attribution as at
from panelwright.operators import checks, evaluate, labels, select, split
from panelwright.operators.boosting import BoostedTrees, BoosterParams, SecondOrderBooster
from panelwright.operators.ensemble import SEARCH_RANGES, StackedEnsemble, draw_settings
from panelwright.operators.moments import class_moments, feature_moments
from panelwright.operators.order_stats import mad, medians
from panelwright.operators.panel import assemble_panel
from panelwright.operators.quantile_sketch import quantiles, sketch, sketched_mad
from panelwright.operators.running import ranks
from panelwright.operators.scorers import anova_f, mutual_information
from panelwright.operators.scoring import ScoringBundle, accepted, readiness, rejected
from panelwright.operators.sparse import sparse_anova_f, sparse_moments, weighted_values
from panelwright.plans import workloads as wl
from panelwright.plans.screening import FeatureScreen, Preprocessor, Selector
from panelwright.plans.training import Trained, fold_screens, train
from panelwright.session import materialize, new_path
from panelwright.sources import matrix as mx
from panelwright.sources import phenotype as ph
from panelwright.sources import state
from panelwright.streaming.scoring import read_records, read_results, start_scoring

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Six digits, with NaN as null so that both engines agree on it."""
    return df.withColumns({n: F.round(F.nanvl(F.col(n).cast("double"), F.lit(None)), 6) for n in names})


# -- sources ------------------------------------------------------------


@query
def wide_matrix_scan(spark, folder):
    """Customers as rows and brands as columns of a gzip TSV file."""
    cells = wl.spend_matrix(spark, folder, labelled=False)
    path = new_path(spark, "wide")
    wide = cells.groupBy("sample_id").pivot("feature").agg(F.max("value"))
    wide.write.option("sep", "\t").option("header", True).option("compression", "gzip").csv(path)
    long = mx.read_wide_matrix(spark, path)
    return rounded(long.select("sample_id", "feature", "value"), "value")


def _cohort_table(spark, folder) -> DataFrame:
    """Keys of two cohorts, some padded; labels with null tokens."""
    key = F.concat(F.when(F.col("c_custkey") % 5 == 0, "GTEX-").otherwise("TCGA-"), "c_name")
    label = (
        F.when(F.col("c_acctbal") < 0, "NA")
        .when(F.col("c_custkey") % 13 == 0, "Not Reported")
        .otherwise(wl.segment_label())
    )
    return wl.table(spark, folder, "customer").select(
        F.col("c_acctbal").alias("balance"),
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(" "), key, F.lit("  "))).otherwise(key).alias("Sample"),
        label.alias("vital_status.demographic"),
        F.col("c_nationkey").alias("vital_status.nation"),
    )


@query
def label_scan(spark, folder):
    """Columns found by name, pruned scan, trim, cohort, null tokens."""
    path = new_path(spark, "labels")
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    _cohort_table(spark, folder).write.options(sep="\t", header=True, compression="gzip", **keep_blanks).csv(path)
    found, _ = ph.read_labels(spark, path, IngestConfig())
    return found


@query
def cohort_filter_counts(spark, folder):
    """Rows kept and dropped by the cohort prefix."""
    table = _cohort_table(spark, folder).select(F.col("Sample").alias("sample_id"))
    return ph.cohort_counts(table, "TCGA")


@query
def label_override(spark, folder):
    """An override that is in the header wins over the hints."""
    table = _cohort_table(spark, folder)
    found, _ = ph.from_table(table, IngestConfig(label_column="vital_status.nation"))
    return ph.label_counts(found).select("label", "n")


@query
def key_normalisation(spark, folder):
    """Trimmed and truncated keys with their label, null tokens as null."""
    table = _cohort_table(spark, folder)
    key = strip(F.col("Sample"))
    return table.select(
        key.alias("key"), truncate_key(key, 21).alias("short_key"),
        null_if_token(F.col("`vital_status.demographic`")).alias("label"),
    )


@query
def colliding_keys_dropped(spark, folder):
    """Orders keyed by customer and day, cut to customer and year; a key
    that occurs twice goes entirely."""
    orders = wl.table(spark, folder, "orders")
    customer = F.lpad(F.col("o_custkey").cast("string"), 9, "0")
    keys = F.concat_ws("-", customer, F.date_format("o_orderdate", "yyyyMMdd"), "o_orderkey")
    named = orders.select(keys.alias("sample_id"), F.col("o_orderstatus").alias("label"))
    return al.unique_label_keys(named, 14)


# -- alignment ----------------------------------------------------------

ALIGN = IngestConfig(cohort_prefix="Customer", key_length=18, min_samples=50)


def _two_sides(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Matrix with a second column for some customers; labels with repeats,
    gaps and nulls."""
    number = F.substring("sample_id", 10, 9).cast("bigint")
    copies = F.when(number % 10 == 0, F.array(F.lit("-A"), F.lit("-B"))).otherwise(F.array(F.lit("-A")))
    cells = wl.spend_matrix(spark, folder, labelled=False)
    cells = cells.withColumn("_copy", F.explode(copies)).withColumn("sample_id", F.concat("sample_id", "_copy"))
    customer = wl.table(spark, folder, "customer").where("c_custkey % 7 <> 0")
    label = F.when(F.col("c_acctbal") >= 0, wl.segment_label())
    given = customer.select(F.col("c_name").alias("sample_id"), label.alias("label"))
    twins = customer.where("c_custkey % 11 = 0").select(
        F.col("c_name").alias("sample_id"), F.lit(None).cast("string").alias("label")
    )
    return cells.drop("_copy"), given.unionByName(twins)


@query
def sample_alignment(spark, folder):
    """Repeated keys go first, null labels last."""
    cells, given = _two_sides(spark, folder)
    out = al.align(cells, given, ALIGN)
    return out.matrix.groupBy("sample_id", "label").agg(
        F.count("*").alias("n_features"), F.round(F.sum(F.col("value").cast("double")), 6).alias("total")
    )


@query
def incomplete_samples(spark, folder):
    """Customers without exactly one purchase of every brand."""
    names = wl.table(spark, folder, "customer").select("c_custkey", F.col("c_name").alias("sample_id"))
    bought = wl.purchases(spark, folder, F.col("p_brand")).withColumnRenamed("sample_id", "c_custkey")
    return checks.incomplete_samples(bought.join(names, "c_custkey").select("sample_id", "feature", "value"))


@query
def ingest_metadata(spark, folder):
    """Validation gate and the one-row summary."""
    cells, given = _two_sides(spark, folder)
    out = al.align(cells, given, ALIGN)
    report = al.validate(out.matrix, out.samples)
    row = al.metadata(report, out.samples, "label", ALIGN.cohort_prefix)
    return row.select(
        "n_samples", "n_features", "label_column_used", "cohort_prefix", "size_mb",
        F.col("class_distribution")["neg"].alias("n_neg"), F.col("class_distribution")["pos"].alias("n_pos"),
        F.col("dtype_counts")["float"].alias("n_float_features"),
    )


@query
def matrix_profile(spark, folder):
    """Shape, cells, missing cells, all-zero features."""
    cells = wl.spend_matrix(spark, folder, by_type=True, labelled=False)
    return al.profile(cells, wl.customers(spark, folder)).drop("dtype_counts")


@query
def feature_profile(spark, folder):
    """A3, A4 per feature."""
    return al.feature_profile(wl.embedding_matrix(spark, folder))


@query
def class_distribution(spark, folder):
    """Rows and percentage per class."""
    table = wl.table(spark, folder, "customer").select(F.col("c_mktsegment").alias("label"))
    return rounded(al.class_distribution(table), "percentage")


@query
def class_guard(spark, folder):
    """A2: number of classes of two label columns."""
    rows = wl.table(spark, folder, "labels")
    out = None
    for name in ("quality", "toxic"):
        named = rows.select(F.lit(name).alias("label_column"), F.col(name).alias("label")).where("label is not null")
        counted = named.groupBy("label_column").agg(F.count_distinct("label").alias("n_classes"))
        out = counted if out is None else out.unionByName(counted)
    return out.withColumn("usable", F.col("n_classes") >= 2)


# -- labels -------------------------------------------------------------


@query
def label_encoding(spark, folder):
    """alphabetical codes, and back."""
    rows = wl.table(spark, folder, "customer").select(
        F.col("c_name").alias("sample_id"), F.col("c_mktsegment").alias("label")
    )
    codes = materialize(labels.class_codes(rows), "classes")
    coded = labels.encode(rows, codes).select("sample_id", "code")
    return labels.decode(coded, codes).select("sample_id", "code", "label")


@query
def class_weights(spark, folder):
    """Balanced weights and the negative to positive ratio."""
    rows = wl.table(spark, folder, "labels")
    out = None
    for name in ("quality", "toxic"):
        table = labels.class_weights(rows.select(F.col(name).alias("label"))).withColumn("target", F.lit(name))
        out = table if out is None else out.unionByName(table)
    return rounded(out, "balanced", "positive_ratio")


# -- checks -------------------------------------------------------------


@query
def domain_check(spark, folder):
    """P10: missing and negative cells of signed vectors."""
    return checks.domain_counts(wl.embedding_matrix(spark, folder))


@query
def feature_set_check(spark, folder):
    """What differs between the fitted features and new data."""
    cells = wl.spend_matrix(spark, folder, labelled=False)
    fitted = cells.where("feature <> 'Brand#1'").select("feature").distinct()
    return checks.feature_mismatch(cells.where("feature <> 'Brand#2'"), fitted)


@query
def positional_arrays(spark, folder):
    """Unnamed arrays take the fitted names."""
    rows = wl.table(spark, folder, "embeddings")
    names = materialize(
        mx.arrays_to_long(rows, "vec_id", "embedding").groupBy("feature").agg(F.min("feature_pos").alias("feature_pos")),
        "names",
    )
    return rounded(mx.arrays_to_matrix(rows, "vec_id", "embedding", names), "value")


@query
def name_score_pairing(spark, folder):
    """Importance-like scores paired with names by position."""
    stats = _vector_stats(spark, folder)
    names, scores = stats.select("feature_pos", "feature"), stats.select("feature_pos", F.col("var_pop").alias("score"))
    return rounded(select.pair_scores(names, scores), "score")


# -- screening ----------------------------------------------------------


def _vector_stats(spark, folder) -> DataFrame:
    return materialize(feature_moments(class_moments(wl.embedding_matrix(spark, folder))), "vector_stats")


@query
def log2_values(spark, folder):
    """F1 on every cell of the spend matrix."""
    cells = wl.spend_matrix(spark, folder, labelled=False)
    return rounded(cells.select("sample_id", "feature", log2_shift(F.col("value")).alias("x")), "x")


@query
def expressed_fraction(spark, folder):
    """Default cut on the brand-and-type matrix, from its stored cells."""
    stats = feature_moments(sparse_moments(wl.sparse_spend(spark, folder, by_type=True), log2_shift, 1.0))
    out = stats.select("feature", "frac_expressed", (F.col("frac_expressed") >= 0.2).alias("kept_expr"))
    return rounded(out, "frac_expressed")


@query
def variance_and_scale(spark, folder):
    """Population moments of log2 values, from stored cells."""
    stats = feature_moments(sparse_moments(wl.sparse_spend(spark, folder), log2_shift))
    out = stats.select("feature", "mean", "var_pop", "std_pop", (F.col("var_pop") > 6.0).alias("kept"))
    return rounded(out, "mean", "var_pop", "std_pop")


@query
def preprocess_values(spark, folder):
    """The whole preprocessor, fitted and replayed."""
    cells = wl.spend_matrix(spark, folder)
    out = Preprocessor(wl.SPEND_PREPROCESS).fit_transform(cells)
    return rounded(out.select("sample_id", "feature", "value"), "value")


@query
def mad_scores(spark, folder):
    """A11, T3 on scaled brand values, from stored cells."""
    screen = FeatureScreen(wl.SPEND_PREPROCESS, wl.SPEND_SELECT).fit(wl.sparse_spend(spark, folder))
    return rounded(screen.selector.mad_scores(), "mad")


@query
def mad_of_vectors(spark, folder):
    """A11 on signed vectors."""
    cells = wl.embedding_matrix(spark, folder).withColumnRenamed("value", "x")
    return rounded(mad(cells), "median", "mad")


@query
def sketched_mad_of_vectors(spark, folder):
    """A11, opt-in: medians from sketches; a group with few distinct values is exact, larger ones
    are within the stated error, which ``sketch_errors`` measures."""
    cells = wl.embedding_matrix(spark, folder).withColumnRenamed("value", "x")
    found = sketched_mad(cells, points=1 << 20)
    return rounded(found.select("feature", "median", "mad"), "median", "mad")


@query
def sketch_errors(spark, folder):
    """Quantiles of prices by return flag, weighted by quantity, from 100 points;
    those whose true share of the weight is off by more than the stated error."""
    items = wl.table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("feature"), F.col("l_extendedprice").cast("double").alias("x"), F.col("l_quantity").alias("w")
    )
    shares = [0.1, 0.25, 0.5, 0.75, 0.9]
    found = quantiles(sketch(items, weight="w", points=100, held=4096, fan=4), shares)
    wanted = F.array(*[F.lit(s) for s in shares])
    picked = materialize(
        found.select("feature", "error", F.explode(F.arrays_zip(wanted.alias("share"), "quantiles")).alias("q"))
        .select("feature", "error", F.col("q.share").alias("share"), F.col("q.quantiles").alias("cut")),
        "quantiles",
    )
    below, upto = F.when(F.col("x") < F.col("cut"), F.col("w")), F.when(F.col("x") <= F.col("cut"), F.col("w"))
    held = items.join(picked, "feature").groupBy("feature", "share").agg(
        F.coalesce(F.sum(below), F.lit(0.0)).alias("below"), F.sum(upto).alias("upto"), F.sum("w").alias("w"), F.first("error").alias("error")
    )
    room = F.col("error") + 1e-9
    wrong = (F.col("below") / F.col("w") > F.col("share") + room) | (F.col("upto") / F.col("w") < F.col("share") - room)
    return held.groupBy("feature").agg(
        F.count("*").alias("n_quantiles"), F.count_if(wrong).alias("n_wrong"), (F.max("error") < 0.1).alias("small_error")
    )


@query
def distinct_values(spark, folder):
    """Distinct values per feature, counted, and whether the merged sketches of two halves agree to 5 %."""
    cells = wl.spend_matrix(spark, folder, by_type=True, labelled=False)
    half = F.pmod(F.xxhash64("sample_id"), F.lit(2))
    parts = [materialize(al.distinct_sketches(cells.where(half == i)), "sketches") for i in (0, 1)]
    estimate = al.distinct_counts(al.merge_sketches(*parts)).withColumnRenamed("n_distinct", "estimate")
    exact = cells.groupBy("feature", "value").count().groupBy("feature").agg(F.count("*").alias("n_distinct"))
    close = F.abs(F.col("estimate") - F.col("n_distinct")) <= 0.05 * F.col("n_distinct")
    return exact.join(estimate, "feature").select("feature", "n_distinct", close.alias("close"))


@query
def median_by_counting(spark, folder):
    """The method for groups of any size, forced to narrow by histograms."""
    cells = materialize(wl.spend_matrix(spark, folder).withColumn("x", log2_shift(F.col("value"))), "logged")
    return rounded(medians(cells, cells=64, map_rows=100), "median")


@query
def anova_f_of_brands(spark, folder):
    """A12, two classes, from stored cells."""
    return rounded(sparse_anova_f(wl.sparse_spend(spark, folder), log2_shift), "score")


@query
def anova_f_of_vectors(spark, folder):
    """A12, eight classes."""
    return rounded(anova_f(wl.embedding_matrix(spark, folder).withColumnRenamed("value", "x")), "score")


@query
def mutual_information_of_vectors(spark, folder):
    """A13 over all vectors, dimensions and classes."""
    cells = wl.embedding_matrix(spark, folder).withColumnRenamed("value", "x")
    return rounded(mutual_information(cells), "score")


@query
def top_features_by_mad(spark, folder):
    """Ten widest dimensions of the vectors."""
    cells = wl.embedding_matrix(spark, folder).withColumnRenamed("value", "x")
    scored = mad(cells).join(_vector_stats(spark, folder).select("feature", "feature_pos"), "feature")
    return rounded(select.top_by_mad(scored, 10).select("feature", "mad"), "mad")


@query
def top_features_by_f(spark, folder):
    """Ten best dimensions of the vectors."""
    stats = _vector_stats(spark, folder).withColumn("score", F.col("f_score"))
    return rounded(select.top_by_score(stats, 10).select("feature", "score"), "score")


@query
def mask_application(spark, folder):
    """Cells of the features whose mask is set."""
    stats = _vector_stats(spark, folder).withColumn("kept", F.col("f_score") > 1.0)
    cells = select.keep(wl.embedding_matrix(spark, folder), stats, "kept")
    return rounded(cells.select("sample_id", "feature", "value"), "value")


@query
def surviving_names(spark, folder):
    """Names left by the preprocessor, with their input position."""
    pre = Preprocessor(wl.SPEND_PREPROCESS).fit(wl.spend_matrix(spark, folder))
    return pre.names().join(pre.fitted().select("feature", "feature_pos"), "feature")


@query
def panel_screen(spark, folder):
    """The panel of the spend matrix, from stored cells."""
    stats = FeatureScreen(wl.SPEND_PREPROCESS, wl.SPEND_SELECT).fit(wl.sparse_spend(spark, folder)).stats
    panel = stats.where("kept_panel").select("feature", "mad", F.col("score").alias("f_score"), "feature_pos")
    placed = ranks(panel, [("f_score", True), ("feature_pos", True)])
    return rounded(placed.select("feature", "mad", "f_score", "rank"), "mad", "f_score")


@query
def ranked_scores(spark, folder):
    """Supervised score of the MAD survivors only."""
    screen = FeatureScreen(wl.SPEND_PREPROCESS, wl.SPEND_SELECT).fit(wl.spend_matrix(spark, folder))
    return rounded(screen.selector.best_scores(), "score")


@query
def vector_selector(spark, folder):
    """T5 with the nearest-neighbour score on unscaled vectors."""
    chosen = Selector(SelectConfig(n_mad=20, k_best=8, scorer="mutual_info"))
    chosen.fit(wl.embedding_matrix(spark, folder))
    out = chosen.fitted().where("kept_mad").select("feature", "mad", "score", "kept_panel")
    return rounded(out, "mad", "score")


@query
def feature_funnel(spark, folder):
    """Features left and removed per stage."""
    return FeatureScreen(wl.SPEND_PREPROCESS, wl.SPEND_SELECT).fit(wl.spend_matrix(spark, folder)).funnel()


@query
def median_of_stored_cells(spark, folder):
    """Medians and spreads of the brand-and-type matrix, zeros as one weighted point per
    feature, forced to narrow by histograms."""
    found = wl.sparse_spend(spark, folder, by_type=True)
    stats = materialize(feature_moments(sparse_moments(found, log2_shift)), "stats")
    values = weighted_values(found.cells, stats.select("feature", "n", "n_stored"), log2_shift(F.lit(0.0)), log2_shift(F.col("value")))
    centre = medians(values, cells=16, map_rows=50, weight="weight", bounds=stats.select("feature", "n", "low", "high"))
    wide = mad(values, weight="weight").select("feature", "mad")
    return rounded(centre.join(wide, "feature"), "median", "mad")


@query
def dense_panel_screen(spark, folder):
    """The same panel from the filled matrix, its samples known."""
    screen = FeatureScreen(wl.SPEND_PREPROCESS, wl.SPEND_SELECT)
    stats = screen.fit(wl.spend_matrix(spark, folder), wl.customers(spark, folder)).stats
    return rounded(stats.where("kept_panel").select("feature", "mad", F.col("score").alias("f_score")), "mad", "f_score")


@query
def panel_of_stored_cells(spark, folder):
    """Scaled values of the panel, zeros filled in for its features alone."""
    found = wl.sparse_spend(spark, folder)
    screen = FeatureScreen(wl.SPEND_PREPROCESS, wl.SPEND_SELECT).fit(found)
    return rounded(screen.transform(found).select("sample_id", "feature", "value", "label"), "value")


@query
def screen_train_only(spark, folder):
    """Fitted on the training rows, replayed on the test rows."""
    cells = wl.spend_matrix(spark, folder, labelled=False)
    parts = materialize(split.stratified_split(wl.customers(spark, folder)), "split")
    both = mx.join_samples(cells, parts, "is_test")
    screen = FeatureScreen(wl.SPEND_PREPROCESS, SelectConfig(n_mad=4, k_best=2)).fit(both.where("not is_test"))
    held = screen.transform(both.where("is_test"))
    out = held.groupBy("feature").agg(
        F.count("*").alias("n_test"), F.avg("value").alias("test_mean"), F.max("value").alias("test_max")
    )
    fitted = screen.stats.select("feature", F.col("mean").alias("train_mean"), F.col("score").alias("train_f"))
    return rounded(out.join(fitted, "feature"), "test_mean", "test_max", "train_mean", "train_f")


@query
def screen_state_round_trip(spark, folder):
    """The fitted table after saving and loading."""
    path = new_path(spark, "screen")
    FeatureScreen(wl.SPEND_PREPROCESS, wl.SPEND_SELECT).fit(wl.spend_matrix(spark, folder)).save(path)
    stats = FeatureScreen.load(spark, path).stats
    out = stats.select("feature", "mean", "std_pop", "mad", "kept_expr", "kept_var", "kept_mad", "kept_panel")
    return rounded(out, "mean", "std_pop", "mad")


@query
def panels_per_fold(spark, folder):
    """The panel of each fold, chosen without the rows of the fold."""
    cells = wl.spend_matrix(spark, folder, labelled=False)
    select = SelectConfig(n_mad=4, k_best=2)
    out = None
    for fold, (screen, _, _) in enumerate(fold_screens(cells, wl.customers(spark, folder), wl.SPEND_PREPROCESS, select, 3, 42)):
        part = screen.stats.where("kept_panel").select(F.lit(fold).alias("fold"), "feature", "mean", "score")
        out = part if out is None else out.unionByName(part)
    return rounded(out, "mean", "score")


# -- splits -------------------------------------------------------------


@query
def stratified_split(spark, folder):
    """20 % of each class."""
    return split.stratified_split(wl.customers(spark, folder))


@query
def stratified_folds(spark, folder):
    """Five folds over the market segments."""
    rows = wl.table(spark, folder, "customer").select(
        F.col("c_name").alias("sample_id"), F.col("c_mktsegment").alias("label")
    )
    return split.stratified_folds(rows)


@query
def row_subsample(spark, folder):
    """Exactly 100 orders."""
    orders = wl.table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("sample_id"))
    return split.subsample(orders, 100)


# -- metrics ------------------------------------------------------------


def _scored(spark, folder) -> DataFrame:
    """Account balance as a score for the segment label."""
    return wl.table(spark, folder, "customer").select(
        wl.segment_label().alias("label"),
        F.col("c_acctbal").alias("score"),
        F.when(F.col("c_acctbal") > 4500, "pos").otherwise("neg").alias("prediction"),
    )


@query
def ranking_metrics(spark, folder):
    """A17, A18 on nearly distinct scores."""
    return rounded(evaluate.ranking_metrics(_scored(spark, folder)), "roc_auc", "average_precision")


@query
def ranking_metrics_with_ties(spark, folder):
    """A17, A18 on line items, fifty distinct scores."""
    items = wl.table(spark, folder, "lineitem").select(
        F.col("l_quantity").alias("score"), F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label")
    )
    return rounded(evaluate.ranking_metrics(items), "roc_auc", "average_precision")


@query
def agreement_metrics(spark, folder):
    """A19, A20 and their companions."""
    table = evaluate.confusion(_scored(spark, folder))
    return rounded(evaluate.agreement_metrics(table), "macro_f1", "weighted_f1", "accuracy", "cohen_kappa")


@query
def classification_report(spark, folder):
    """A21 on three classes of orders, predicted from their price."""
    price = F.col("o_totalprice")
    guess = F.when(price > 300000, "P").when(price > 150000, "O").otherwise("F")
    orders = wl.table(spark, folder, "orders").select(F.col("o_orderstatus").alias("label"), guess.alias("prediction"))
    report = evaluate.classification_report(evaluate.confusion(orders)).drop("part")
    return rounded(report, "precision", "recall", "f1_score")


@query
def evaluation_bundle(spark, folder):
    """All headline metrics in one row."""
    row = evaluate.evaluate(_scored(spark, folder))
    return rounded(row, *row.columns)


# -- models -------------------------------------------------------------

_trained: dict[tuple[str, str], Trained] = {}


def trained(spark: SparkSession, folder: str) -> Trained:
    """One small stack per session and folder, shared by the queries below."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _trained:
        cells = wl.spend_matrix(spark, folder, labelled=False)
        _trained[key] = train(
            cells, wl.customers(spark, folder), wl.MODEL_PREPROCESS, wl.MODEL_SELECT, wl.MODEL_ENSEMBLE
        )
    return _trained[key]


def _panel_names(t: Trained) -> list[str]:
    return [name for name, _, _ in t.bundle.panel]


@query
def panel_assembly(spark, folder):
    """M1: vectors of the flagship panel, taken apart again."""
    cells = wl.spend_matrix(spark, folder)
    screen = FeatureScreen(wl.SPEND_PREPROCESS, wl.SPEND_SELECT).fit(cells)
    rows = assemble_panel(screen.transform(cells), len(screen.panel()))
    out = rows.select("sample_id", F.posexplode(vector_to_array("features")).alias("place", "value"))
    return rounded(out, "value")


@query
def booster_first_round(spark, folder):
    """M3: the nodes of one round of depth two on nation and balance of the customers,
    positives twice as heavy."""
    found = _first_round(spark, folder)
    nodes = found.table(spark).select("id", "left", "right", "feature", "threshold", "output", "cover")
    return rounded(nodes, "threshold", "output", "cover")


def _customer_rows(spark, folder) -> DataFrame:
    positive = wl.segment_label() == "pos"
    x = F.array(F.col("c_nationkey").cast("double"), F.floor(F.col("c_acctbal") / 1000).cast("double"))
    return wl.table(spark, folder, "customer").select(
        F.col("c_name").alias("sample_id"), positive.cast("int").alias("code"),
        F.when(positive, 2.0).otherwise(1.0).alias("w_gbt"), array_to_vector(x).alias("features"),
    )


def _first_round(spark, folder) -> BoostedTrees:
    params = BoosterParams(rounds=1, depth=2, rate=0.3, subsample=1.0, colsample=1.0)
    return SecondOrderBooster(params).fit(_customer_rows(spark, folder))


@query
def booster_first_scores(spark, folder):
    """M3, M6: log-odds of every customer after that round."""
    scored = _first_round(spark, folder).log_odds(_customer_rows(spark, folder), "log_odds")
    return rounded(scored.select("sample_id", "log_odds"), "log_odds")


@query
def booster_in_jobs(spark, folder):
    """M3: the same nodes, histograms by a Spark job per level."""
    params = BoosterParams(rounds=1, depth=2, rate=0.3, subsample=1.0, colsample=1.0)
    nodes = SecondOrderBooster(params, task_cells=0).fit(_customer_rows(spark, folder)).table(spark)
    return rounded(nodes.select("id", "left", "right", "feature", "threshold", "output", "cover"), "threshold", "output", "cover")


@query
def booster_defaults(spark, folder):
    """M3 with every setting at its default: log-odds of the held-out rows."""
    t = trained(spark, folder)
    codes = F.when(F.col("label") == t.stack.classes[1], 1).otherwise(0)
    model = SecondOrderBooster().fit(t.train.withColumn("code", codes).withColumn("w_gbt", F.lit(1.0)))
    return model.log_odds(t.test, "log_odds").select("sample_id", "label", "log_odds")


@query
def stack_fold_coverage(spark, folder):
    """Each training row is scored once, by models that did not see it."""
    folds = trained(spark, folder).stack.out_of_fold
    bad = (F.col("p_rf") < 0) | (F.col("p_rf") > 1) | (F.col("p_gbt") < 0) | (F.col("p_gbt") > 1)
    return folds.groupBy("fold", "code").agg(F.count("*").alias("n_rows"), F.count_if(bad).alias("n_bad"))


@query
def stack_predictions(spark, folder):
    """M2-M6: class and probabilities of the held-out rows."""
    t = trained(spark, folder)
    out = t.stack.predict(t.test)
    p = F.col("probabilities")
    return out.select("sample_id", "label", "prediction", "p_rf", "p_gbt", p[0].alias("p_neg"), p[1].alias("p_pos"))


@query
def stack_prediction_checks(spark, folder):
    """M6: rows scored, probabilities that do not sum to one, wrong classes."""
    t = trained(spark, folder)
    p = F.col("probabilities")
    wrong = F.when(p[1] > p[0], "pos").otherwise("neg") != F.col("prediction")
    return t.stack.predict(t.test).agg(
        F.count("*").alias("n_rows"), F.count_if(F.abs(p[0] + p[1] - 1) > 1e-9).alias("n_bad_sums"),
        F.count_if(wrong).alias("n_wrong_class"),
    )


@query
def stack_evaluation(spark, folder):
    """A22 on the held-out rows."""
    t = trained(spark, folder)
    return t.stack.evaluate(t.test)[0]


@query
def forest_importances(spark, folder):
    """A16."""
    t = trained(spark, folder)
    return t.stack.importances(_panel_names(t))


@query
def importance_checks(spark, folder):
    """The importances cover the panel, sum to one and are in order."""
    t = trained(spark, folder)
    table = t.stack.importances(_panel_names(t))
    rows = table.collect()  # one per panel feature
    values = [r.importance for r in rows]
    seen = (len(rows), abs(sum(values) - 1) < 1e-9, values == sorted(values, reverse=True),
            sorted(r.feature for r in rows) == sorted(_panel_names(t)))
    return spark.createDataFrame([seen], "n_features bigint, sums_to_one boolean, in_order boolean, is_panel boolean")


def _search(spark, folder) -> StackedEnsemble:
    """All default trials and folds, draws of the real ranges."""
    return StackedEnsemble(EnsembleConfig()).tune(trained(spark, folder).train)


@query
def search_checks(spark, folder):
    """M7: one row per trial, settings inside their ranges, the best is the largest; takes long."""
    stack = _search(spark, folder)
    rows = stack.search_results.collect()  # one per trial
    outside = sum(
        not all(r[name] in span if name == "rf_max_depth" else span[0] <= r[name] <= span[1] for name, span in SEARCH_RANGES.items())
        for r in rows
    )
    best = max(r.mean_roc_auc for r in rows)
    return spark.createDataFrame(
        [(len({r.trial for r in rows}), outside, stack.best_score == best)],
        "n_trials bigint, n_outside bigint, best_is_largest boolean",
    )


@query
def random_search(spark, folder):
    """M7: two trials over the cross-validated stack, drawn from the fixed ranges but for few trees and rounds."""
    base = EnsembleConfig(folds=2, max_bins=32, parallelism=8)
    draws = draw_settings(base, 2, {"rf_trees": (3, 6), "gbt_rounds": (2, 4)})
    return StackedEnsemble(base).tune(trained(spark, folder).train, draws=draws).search_results


@query
def stack_defaults(spark, folder):
    """A22 with every model setting at its default, over all training rows; takes long."""
    cells = wl.spend_matrix(spark, folder, labelled=False)
    t = train(cells, wl.customers(spark, folder), wl.MODEL_PREPROCESS, wl.MODEL_SELECT, EnsembleConfig())
    return t.stack.evaluate(t.test)[0]


@query
def search_defaults(spark, folder):
    """M7 with all default trials and folds, draws of the real ranges; takes long."""
    return _search(spark, folder).search_results


# -- attribution --------------------------------------------------------


def _explained(spark, folder, learner: str) -> tuple[Trained, at.TreeAttribution]:
    t = trained(spark, folder)
    return t, at.TreeAttribution(t.stack, _panel_names(t), AttributionConfig(learner=learner)).fit(t.train)


def _additivity(spark, folder, learner: str) -> DataFrame:
    t, shap = _explained(spark, folder, learner)
    sums = shap.long().groupBy("sample_id").agg(
        F.sum(F.col("shap_value").cast("double")).alias("total"), F.count("*").alias("n_values")
    )
    p = F.col(f"p_{learner}")
    target = F.ln(p / (1 - p)) if learner == "gbt" else p
    model = t.stack.predict(t.train).select("sample_id", target.alias("output"))
    gap = F.abs(F.col("total") + F.lit(shap.base_value) - F.col("output"))
    return sums.join(model, "sample_id").agg(
        F.count("*").alias("n_samples"), F.sum("n_values").alias("n_values"), F.count_if(gap > 1e-4).alias("n_violations")
    )


@query
def shap_additivity_boosted(spark, folder):
    """H1-H3: base value plus attributions gives the log-odds of each row."""
    return _additivity(spark, folder, "gbt")


@query
def shap_additivity_forest(spark, folder):
    """H1-H3 for the forest: they give its probability."""
    return _additivity(spark, folder, "rf")


@query
def shap_values(spark, folder):
    """H1: signed value per sample and feature."""
    return _explained(spark, folder, "gbt")[1].long()


@query
def shap_summary_points(spark, folder):
    """H4: values behind the summary of the most important features."""
    return _explained(spark, folder, "gbt")[1].summary_points()


@query
def shap_ranking_file(spark, folder):
    """The ranking written as CSV and read back."""
    ranking = _explained(spark, folder, "gbt")[1].ranking()
    path = new_path(spark, "ranking")
    state.write_ranking(ranking, path)
    return state.read_ranking(spark, path)


#: Two small trees: (tree, id, cover, output, left, right, feature, threshold). The second splits twice on one feature.
FIXED_TREES = [
    (0, 0, 100.0, 0.0, 1, 2, 0, 4500.0), (0, 1, 60.0, 0.0, 3, 4, 1, 12.0), (0, 2, 40.0, 0.0, 5, 6, 2, 0.5),
    (0, 3, 20.0, 8.0, -1, -1, -1, 0.0), (0, 4, 40.0, -2.0, -1, -1, -1, 0.0),
    (0, 5, 10.0, 5.0, -1, -1, -1, 0.0), (0, 6, 30.0, 1.0, -1, -1, -1, 0.0),
    (1, 0, 80.0, 0.0, 1, 2, 0, 7000.0), (1, 1, 64.0, 0.0, 3, 4, 0, 1000.0), (1, 2, 16.0, 9.0, -1, -1, -1, 0.0),
    (1, 3, 16.0, 3.0, -1, -1, -1, 0.0), (1, 4, 48.0, 0.0, 5, 6, 1, 6.0),
    (1, 5, 12.0, 4.0, -1, -1, -1, 0.0), (1, 6, 36.0, -4.0, -1, -1, -1, 0.0),
]


def _fixed_attributions(spark, folder) -> DataFrame:
    """Signed values of two fixed trees for every customer."""
    nodes = spark.createDataFrame(
        FIXED_TREES, "tree int, id int, cover double, output double, left int, right int, feature int, threshold double"
    )
    paths = materialize(at.path_table(nodes), "paths")
    x = F.array(F.col("c_acctbal"), F.col("c_nationkey").cast("double"), (wl.segment_label() == "pos").cast("double"))
    rows = wl.table(spark, folder, "customer").select(F.col("c_name").alias("sample_id"), x.alias("x"))
    found = at.explain_in_blocks(rows, paths, 3, 3, 4)
    names = F.array(*[F.lit(n) for n in ("balance", "nation", "segment")])
    return found.select("sample_id", F.posexplode("phi").alias("feature_pos", "shap_value")).withColumn(
        "feature", names[F.col("feature_pos")]
    )


@query
def fixed_tree_attributions(spark, folder):
    """H1: exact Shapley values of two fixed trees."""
    out = _fixed_attributions(spark, folder).select("sample_id", "feature", F.col("shap_value").cast("double").alias("shap_value"))
    return out.withColumn("shap_value", F.round("shap_value", 4))


@query
def fixed_tree_ranking(spark, folder):
    """Their ranking, written and read back."""
    path = new_path(spark, "ranking")
    state.write_ranking(at.rank_attributions(materialize(_fixed_attributions(spark, folder), "values")), path)
    out = state.read_ranking(spark, path).select("feature", F.col("mean_shap").cast("double"), F.col("mean_abs_shap").cast("double"))
    return out.withColumns({c: F.round(c, 3) for c in ("mean_shap", "mean_abs_shap")})


def _signed_ranking(spark, folder) -> DataFrame:
    cells = wl.embedding_matrix(spark, folder)
    return at.rank_attributions(cells.withColumnRenamed("value", "shap_value"))


@query
def attribution_ranking(spark, folder):
    """A15, F5 with the signed vector values as attributions."""
    out = _signed_ranking(spark, folder).withColumns(
        {"direction": direction(F.col("mean_shap")), "bar": bar_position(F.col("mean_shap"))}
    )
    return rounded(out.drop("feature_pos"), "mean_shap", "mean_abs_shap", "bar")


@query
def attribution_top_by_direction(spark, folder):
    """T4: five first by size and by either sign."""
    table = materialize(_signed_ranking(spark, folder), "ranking")
    out = None
    for way in (None, "positive", "negative"):
        part = at.top_ranked(table, 5, way).withColumn("way", F.lit(way or "size"))
        out = part if out is None else out.unionByName(part)
    return rounded(out.drop("feature_pos"), "mean_shap", "mean_abs_shap")


# -- scoring ------------------------------------------------------------


def _spend_screen(spark, folder) -> FeatureScreen:
    return FeatureScreen(wl.SPEND_PREPROCESS, wl.SPEND_SELECT).fit(wl.sparse_spend(spark, folder))


@query
def fixed_stack_predictions(spark, folder):
    """M4, M6: probabilities and classes of all customers from node tables, on the flagship panel."""
    found = wl.sparse_spend(spark, folder)
    screen = _spend_screen(spark, folder)
    rows = assemble_panel(screen.transform(found), len(screen.panel()))
    out = wl.fixed_stack(spark).predict(rows)
    return rounded(out.select("sample_id", "prediction", "p_rf", "p_gbt", F.col("score").alias("p_pos")), "p_rf", "p_gbt", "p_pos")


def _fixed_results(scored: DataFrame) -> DataFrame:
    p = F.col("class_probabilities")
    return accepted(scored).select(
        "patient_id", "predicted_status", "risk_probability", p["neg"].alias("p_neg"), p["pos"].alias("p_pos"),
        F.col("n_genes_received").cast("bigint").alias("n_genes_received"),
        F.col("n_genes_used_by_model").cast("bigint").alias("n_genes_used_by_model"),
    )


@query
def fixed_stack_records(spark, folder):
    """Results of all good records, from a bundle of node tables that was saved and loaded."""
    path = new_path(spark, "bundle")
    ScoringBundle.of(_spend_screen(spark, folder), wl.fixed_stack(spark)).save(path)
    return _fixed_results(ScoringBundle.load(spark, path).score(records(spark, folder)))


@query
def fixed_stack_stream(spark, folder):
    """The same results from a stream of files."""
    bundle = ScoringBundle.of(_spend_screen(spark, folder), wl.fixed_stack(spark))
    path, output, checkpoint = (new_path(spark, n) for n in ("records", "scored", "progress"))
    records(spark, folder).write.json(path)
    start_scoring(bundle, read_records(spark, path, 4), output, checkpoint).awaitTermination()
    return _fixed_results(read_results(spark, output))


@query
def stack_as_tables(spark, folder):
    """M2-M6: the trained stack as node tables; rows scored, and those that differ from its own predictions."""
    t = trained(spark, folder)
    columns = ["sample_id", "prediction", "p_rf", "p_gbt", "score"]
    own = materialize(t.stack.predict(t.test).select(*columns), "own").alias("o")
    tables = t.bundle.as_tables(spark).stack.predict(t.test).select(*columns).alias("t")
    far = [F.abs(F.col(f"o.{c}") - F.col(f"t.{c}")) > 1e-9 for c in columns[2:]]
    different = far[0] | far[1] | far[2] | (F.col("o.prediction") != F.col("t.prediction"))
    both = own.join(tables, F.col("o.sample_id") == F.col("t.sample_id"), "full_outer")
    return both.agg(F.count("*").alias("n_rows"), F.count_if(F.coalesce(different, F.lit(True))).alias("n_different"))


@query
def probability_maps(spark, folder):
    """rounded class probabilities as a map."""
    p = (F.col("c_acctbal") + 1000.0) / 11999.3
    made = wl.table(spark, folder, "customer").select("c_custkey", p.alias("p"))
    out = made.withColumn("m", class_probabilities(["neg", "pos"], F.array(1 - F.col("p"), F.col("p"))))
    return out.select("c_custkey", F.col("m")["neg"].alias("p_neg"), F.col("m")["pos"].alias("p_pos"),
                      F.size(F.map_keys("m")).cast("bigint").alias("n_classes"))


def records(spark, folder) -> DataFrame:
    """One record per customer; some are broken in a known way."""
    cells = wl.spend_matrix(spark, folder, labelled=False)
    single = cells.groupBy("sample_id").agg(
        F.sort_array(F.collect_list(F.struct("feature", F.col("value").cast("double").alias("value")))).alias("e")
    )
    number = F.substring("sample_id", 10, 9).cast("bigint")
    fault = F.when(number % 5 == 0, number / 5 % 7).otherwise(99).cast("int")
    first = F.col("e")[0]

    def changed(value):
        head = F.array(F.struct(first["feature"].alias("feature"), value.cast("double").alias("value")))
        return F.concat(head, F.slice("e", 2, F.size("e") - 1))

    extra = F.array(F.struct(F.lit("extra").alias("feature"), F.lit(1.0).alias("value")))
    entries = (
        F.when(fault == 0, F.slice("e", 1, 0))
        .when(fault == 1, changed(F.lit(-1.0)))
        .when(fault == 2, changed(F.lit(float("nan"))))
        .when(fault == 3, changed(F.lit(float("inf"))))
        .when(fault == 4, F.slice("e", 2, F.size("e") - 1))
        .when(fault == 5, F.concat("e", extra))
        .otherwise(F.col("e"))
    )
    return single.select(
        F.when(fault == 6, "").otherwise(F.col("sample_id")).alias("patient_id"),
        F.map_from_entries(entries).alias("expressions"),
    )


@query
def score_records(spark, folder):
    """One result per good record."""
    return accepted(trained(spark, folder).bundle.score(records(spark, folder)))


@query
def scored_record_counts(spark, folder):
    """What was received and used, per good record."""
    good = accepted(trained(spark, folder).bundle.score(records(spark, folder)))
    probabilities = F.map_values("class_probabilities")
    bad = (F.abs(probabilities[0] + probabilities[1] - 1) > 2e-6) | (
        F.col("risk_probability") != F.col("class_probabilities")["pos"]
    )
    return good.select("patient_id", F.col("n_genes_received").cast("bigint").alias("n_genes_received"),
                       F.col("n_genes_used_by_model").cast("bigint").alias("n_genes_used_by_model"), bad.alias("bad"))


@query
def rejected_records(spark, folder):
    """R2: records refused, with the kind and the reason."""
    return rejected(trained(spark, folder).bundle.score(records(spark, folder)))


@query
def bundle_readiness(spark, folder):
    """The saved bundle, loaded again."""
    path = new_path(spark, "bundle")
    trained(spark, folder).bundle.save(path)
    row = readiness(spark, ScoringBundle.load(spark, path))
    return row.select(
        "status", "models_loaded", F.col("n_expected_genes").cast("bigint").alias("n_expected_genes"),
        F.col("n_model_input_genes").cast("bigint").alias("n_model_input_genes"),
        F.array_join("classes", ",").alias("classes"),
    )


@query
def stream_against_batch(spark, folder):
    """The same records as a file stream; counts rows that differ."""
    bundle = trained(spark, folder).bundle
    rows = records(spark, folder)
    path, output, checkpoint = (new_path(spark, n) for n in ("records", "scored", "progress"))
    sent = materialize(rows, "sent")
    sent.write.json(path)
    start_scoring(bundle, read_records(spark, path, 4), output, checkpoint).awaitTermination()
    # Ids may be empty and repeat, so equal result rows are counted instead of joined.
    columns = ["patient_id", "risk_probability", "reject_code", "reject_reason"]
    streamed = read_results(spark, output).groupBy(*columns).agg(F.count("*").alias("n_stream"))
    batch = bundle.score(sent).groupBy(*columns).agg(F.count("*").alias("n_batch"))
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"b.{c}")) for c in columns]
    both = batch.alias("b").join(streamed.alias("s"), same[0] & same[1] & same[2] & same[3], "full_outer")
    n_batch, n_stream = F.coalesce("n_batch", F.lit(0)), F.coalesce("n_stream", F.lit(0))
    return both.agg(F.sum(n_stream).alias("n_records"), F.sum(F.abs(n_batch - n_stream)).alias("n_different"))
