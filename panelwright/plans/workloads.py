"""Matrices and label tables built from the star-schema test tables.

spend: sample = customer, feature = brand (or brand and type), value = quantity
bought, label = market segment group; filled with zeros, or as stored cells only. embeddings: 64 signed values per vector,
eight classes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.config import EnsembleConfig, PreprocessConfig, SelectConfig
from panelwright.operators.sparse import SparseMatrix
from panelwright.operators.tree_tables import NodeStack
from panelwright.session import materialize
from panelwright.sources.matrix import arrays_to_long, fill_zeros, stored_rows

POSITIVE_SEGMENTS = ("BUILDING", "MACHINERY")

# With the default cuts every brand passes; these make each filter bite.
SPEND_PREPROCESS = PreprocessConfig(min_expression=5.0, min_sample_fraction=0.5, variance_threshold=6.0)
SPEND_SELECT = SelectConfig(n_mad=4, k_best=3)
# Cuts for the models: keep most brands.
MODEL_PREPROCESS = PreprocessConfig(min_expression=1.0, min_sample_fraction=0.2, variance_threshold=0.1)
MODEL_SELECT = SelectConfig(n_mad=16, k_best=8)
MODEL_ENSEMBLE = EnsembleConfig(rf_trees=10, rf_max_depth=5, gbt_rounds=8, gbt_max_depth=3, folds=3, max_bins=32, parallelism=8)

#: A small stack of fixed trees over three features: (tree, id, left, right, feature, threshold, output).
#: Outputs of the forest add up to a probability, those of the booster to log-odds.
FIXED_FOREST = [
    (0, 0, 1, 2, 0, 0.25, 0.0), (0, 1, 3, 4, 1, -0.4, 0.0), (0, 2, -1, -1, -1, 0.0, 0.375),
    (0, 3, -1, -1, -1, 0.0, 0.0625), (0, 4, 5, 6, 2, 0.65, 0.0), (0, 5, -1, -1, -1, 0.0, 0.25), (0, 6, -1, -1, -1, 0.0, 0.125),
    (1, 0, 1, 2, 2, -0.15, 0.0), (1, 1, -1, -1, -1, 0.0, 0.4375), (1, 2, 3, 4, 2, 0.85, 0.0),
    (1, 3, -1, -1, -1, 0.0, 0.03125), (1, 4, -1, -1, -1, 0.0, 0.3125),
]
FIXED_BOOSTER = [
    (0, 0, 1, 2, 1, 0.05, 0.0), (0, 1, 3, 4, 0, -0.75, 0.0), (0, 2, 5, 6, 2, 0.35, 0.0), (0, 3, -1, -1, -1, 0.0, -0.5),
    (0, 4, -1, -1, -1, 0.0, 0.25), (0, 5, -1, -1, -1, 0.0, 0.75), (0, 6, -1, -1, -1, 0.0, -0.125),
    (1, 0, -1, -1, -1, 0.0, 0.0625),
    (2, 0, 1, 2, 0, 0.95, 0.0), (2, 1, -1, -1, -1, 0.0, 0.375), (2, 2, -1, -1, -1, 0.0, -1.0),
]
FIXED_WEIGHTS = (-1.25, 1.5, 1.75)  # intercept, forest, booster


def fixed_stack(spark: SparkSession) -> NodeStack:
    schema = "tree int, id int, left int, right int, feature int, threshold double, output double"
    forest, booster = (spark.createDataFrame(nodes, schema) for nodes in (FIXED_FOREST, FIXED_BOOSTER))
    return NodeStack(["neg", "pos"], forest, booster, FIXED_WEIGHTS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def segment_label() -> F.Column:
    return F.when(F.col("c_mktsegment").isin(*POSITIVE_SEGMENTS), "pos").otherwise("neg")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """``(sample_id, label)``, one row per customer."""
    return table(spark, folder, "customer").select(F.col("c_name").alias("sample_id"), segment_label().alias("label"))


#: Line items that one task joins with their orders at most.
JOIN_ROWS = 1 << 20


def purchases(spark: SparkSession, folder: str, feature) -> DataFrame:
    """Sparse cells, one per line item: customer, feature, quantity."""
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", F.col("l_quantity").alias("value"))
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("sample_id"))
    parts = table(spark, folder, "part").select("p_partkey", feature.alias("feature"))
    joined = items.join(parts, items.l_partkey == parts.p_partkey)
    # Counted from file footers: with many line items the tasks grow in number, not in size.
    tasks = items.count() // JOIN_ROWS + 1
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        joined, orders = joined.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    return joined.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("sample_id", "feature", "value")


_built: dict[tuple[str, str, bool], DataFrame] = {}


def spend_matrix(spark: SparkSession, folder: str, by_type: bool = False, labelled: bool = True) -> DataFrame:
    """Dense ``(sample_id, feature, value[, label])``, written once per session and folder."""
    key = (spark.sparkContext.applicationId, folder, by_type)
    if key not in _built:
        _built[key] = build_spend_matrix(spark, folder, by_type)
    return _built[key] if labelled else _built[key].drop("label")


def build_spend_matrix(spark: SparkSession, folder: str, by_type: bool = False) -> DataFrame:
    """The labelled matrix, written.

    Names and labels join the rows of the customers, before their zeros are filled in.
    """
    feature = F.concat_ws("/", "p_brand", "p_type") if by_type else F.col("p_brand")
    features = table(spark, folder, "part").select(feature.alias("feature"))
    customer = table(spark, folder, "customer")
    rows = stored_rows(purchases(spark, folder, feature), customer.select(F.col("c_custkey").alias("sample_id")))
    named = rows.withColumnRenamed("sample_id", "c_custkey").join(
        customer.select("c_custkey", F.col("c_name").alias("sample_id"), segment_label().alias("label")), "c_custkey"
    )
    return materialize(fill_zeros(named, features).select("sample_id", "feature", "value", "label"), "spend")


_folded: dict[tuple[str, str, bool], SparseMatrix] = {}


def sparse_spend(spark: SparkSession, folder: str, by_type: bool = False) -> SparseMatrix:
    """The spend matrix as its stored cells, line items added up, written once per session and folder."""
    key = (spark.sparkContext.applicationId, folder, by_type)
    if key not in _folded:
        feature = F.concat_ws("/", "p_brand", "p_type") if by_type else F.col("p_brand")
        features = table(spark, folder, "part").select(feature.alias("feature")).distinct()
        names = table(spark, folder, "customer").select(F.col("c_custkey").alias("sample_id"), F.col("c_name").alias("name"))
        bought = purchases(spark, folder, feature)
        # Line items are folded by the number of the customer before the name is joined.
        folded = bought.groupBy("sample_id", "feature").agg(F.sum("value").alias("value")).join(names, "sample_id")
        cells = folded.select(F.col("name").alias("sample_id"), "feature", "value")
        _folded[key] = SparseMatrix.of(cells, customers(spark, folder), features)
    return _folded[key]


def embedding_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """``(sample_id, feature, feature_pos, value, label)``."""
    rows = table(spark, folder, "embeddings")
    labels = rows.select(F.col("vec_id").cast("string").alias("sample_id"), F.col("label").cast("string").alias("label"))
    return arrays_to_long(rows, "vec_id", "embedding").join(labels, "sample_id")
