import gzip

import pytest
from pyspark.sql import functions as F

from panelwright.config import IngestConfig
from panelwright.operators import align as al
from panelwright.plans import workloads as wl
from panelwright.session import materialize
from panelwright.sources import matrix as mx
from panelwright.sources import phenotype as ph


@pytest.mark.parametrize(
    "columns, want",
    [
        (["Sample", "x"], "Sample"),
        (["x", "submitter_id.samples"], "submitter_id.samples"),
        (["barcode", "sampleID"], "sampleID"),
        (["my_sample_id", "x"], "my_sample_id"),
        (["SAMPLE", "sample"], "sample"),  # names that differ in case: the last
    ],
)
def test_key_column(columns, want):
    assert ph.find_key_column(columns) == want


def test_no_key_column():
    with pytest.raises(KeyError):
        ph.find_key_column(["a", "b"])


def test_label_column():
    columns = ["s", "vital_status.demographic", "vital_status.diag"]
    assert ph.find_label_column(columns, ("vital_status",), "s") == "vital_status.demographic"
    assert ph.find_label_column(columns, ("vital_status",), columns[1]) == "vital_status.diag"
    with pytest.raises(KeyError):
        ph.find_label_column(columns, ("Vital_Status",), "s")  # hints are not lower-cased
    header = ["sample", *columns[1:]]
    assert ph.resolve_columns(header, IngestConfig(label_column="vital_status.diag"))[1] == "vital_status.diag"
    assert ph.resolve_columns(header, IngestConfig(label_column="absent"))[1] == "vital_status.demographic"


@pytest.mark.parametrize("wrong", [{"label_hints": ()}, {"cohort_prefix": ""}, {"key_length": 0}])
def test_config_guards(wrong):
    with pytest.raises(ValueError):
        IngestConfig(**wrong)


def _gz(path, lines):
    with gzip.open(path, "wt") as f:
        f.write("\n".join("\t".join(line) for line in lines) + "\n")
    return str(path)


def test_label_file(spark, tmp_path):
    path = _gz(tmp_path / "p.tsv.gz", [
        ["x", "Sample", "vital_status", "VITAL_STATUS"],
        ["1", "TCGA-1", "NA", "q"], ["1", "TCGA-2", "", "q"], ["1", "TCGA-3", "null", "q"],
        ["1", "TCGA-4", "Not Reported", "q"], ["1", " TCGA-5 ", "Alive", "q"],
        ["1", "GTEX-6", "Alive", "q"], ["1", "tcga-7", "Alive", "q"],
    ])
    found, label = ph.read_labels(spark, path, IngestConfig())
    assert label == "vital_status"
    assert {(r.sample_id, r.label) for r in found.collect()} == {
        ("TCGA-1", None), ("TCGA-2", None), ("TCGA-3", None), ("TCGA-4", "Not Reported"), ("TCGA-5", "Alive")
    }
    with pytest.raises(ValueError, match="starts with"):
        ph.read_labels(spark, path, IngestConfig(cohort_prefix="TARGET"))
    with pytest.raises(FileNotFoundError):
        ph.read_labels(spark, str(tmp_path / "none"), IngestConfig())


def test_wide_matrix_file(spark, tmp_path):
    path = _gz(tmp_path / "m.tsv.gz", [
        ["id", "S1", "S2", "S1"], ["Gb", "1.5", "NA", "3"], ["Ga", "0", "inf", "7e2"],
    ])
    rows = mx.read_wide_matrix(spark, path).orderBy("feature_pos", "column_no").collect()
    assert [(r.feature, r.sample_id, r.value) for r in rows] == [
        ("Gb", "S1", 1.5), ("Gb", "S2", None), ("Gb", "S1", 3.0),
        ("Ga", "S1", 0.0), ("Ga", "S2", float("inf")), ("Ga", "S1", 700.0),
    ]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        mx.read_wide_matrix(spark, _gz(tmp_path / "t.tsv.gz", [["id", "S"], ["G", "abc"]])).collect()
    with pytest.raises(Exception, match="expected 3 cells in the line of G"):
        mx.read_wide_matrix(spark, _gz(tmp_path / "s.tsv.gz", [["id", "S", "T"], ["G", "1"]])).collect()
    quoted = _gz(tmp_path / "q.tsv.gz", [["id", '"S"', "T"], ['"G"', '"1"', ""]])
    rows = mx.read_wide_matrix(spark, quoted).orderBy("column_no").collect()
    assert [(r.sample_id, r.feature, r.value) for r in rows] == [("S", "G", 1.0), ("T", "G", None)]
    with pytest.raises(ValueError, match="empty"):
        mx.read_wide_matrix(spark, _gz(tmp_path / "e.tsv.gz", [["id", "S"]]))
    with pytest.raises(FileNotFoundError):
        mx.read_wide_matrix(spark, str(tmp_path / "none"))


def test_very_wide_matrix(spark, tmp_path):
    n = 25_000
    path = _gz(tmp_path / "w.tsv.gz", [["id", *(f"s{i}" for i in range(n))], ["G", *["1"] * n]])
    assert mx.read_wide_matrix(spark, path).agg(F.sum("value")).first()[0] == n


def _labels(spark, rows):
    return spark.createDataFrame(rows, "sample_id string, label string")


def test_every_copy_of_a_key_goes(spark):
    rows = [("K-1-a", "x"), ("K-1-b", None), ("K-2-a", "y"), ("K-3-a", None)]
    got = al.unique_label_keys(_labels(spark, rows), 3).collect()
    assert {(r.sample_id, r.label) for r in got} == {("K-2", "y"), ("K-3", None)}


def _cohort(spark, n, n_null, extra=()):
    ids = [f"TCGA-{i:04d}" for i in range(n)]
    cells = spark.createDataFrame(
        [(s, f, 1.0) for s in [*ids, *extra] for f in ("A", "B")], "sample_id string, feature string, value float"
    )
    rows = [(s, None if i < n_null else ("a", "b")[i % 2]) for i, s in enumerate(ids)]
    return materialize(cells, "fixture"), materialize(_labels(spark, rows), "fixture")


def test_floor_counts_samples_before_null_labels_go(spark):
    out = al.align(*_cohort(spark, 100, 5), IngestConfig())
    assert (out.n_samples, out.n_unlabelled) == (95, 5)
    assert out.matrix.count() == 190
    with pytest.raises(ValueError, match="minimum: 100"):
        al.align(*_cohort(spark, 99, 0), IngestConfig())


def test_two_classes_are_needed(spark):
    cells, rows = _cohort(spark, 100, 0)
    with pytest.raises(ValueError, match="two distinct"):
        al.align(cells, rows.withColumn("label", F.lit("a")), IngestConfig())


def test_matrix_collisions(spark):
    # Cut to nine characters, the extra column is a copy of sample 3.
    cells, rows = _cohort(spark, 101, 0, extra=["TCGA-0003-B"])
    out = al.align(cells, rows, IngestConfig(key_length=9))
    assert out.n_samples == 100
    assert out.matrix.where("sample_id = 'TCGA-0003'").count() == 0
    # The same full name twice shows as repeated cells.
    cells, rows = _cohort(spark, 101, 0, extra=["TCGA-0003"])
    assert al.align(cells, rows, IngestConfig()).n_samples == 100


def test_repeated_rows_of_the_file_keep_all_samples(spark):
    cells, rows = _cohort(spark, 100, 0)
    again = cells.unionByName(cells.where("feature = 'A'"))
    assert al.align(again, rows, IngestConfig()).n_samples == 100
    placed = cells.withColumn("feature_pos", F.when(F.col("feature") == "A", 0).otherwise(1))
    repeated = placed.unionByName(placed.where("feature = 'A'").withColumn("feature_pos", F.lit(2)))
    assert al.align(repeated, rows, IngestConfig()).n_samples == 100
    half = placed.withColumn("column_no", F.when((F.col("sample_id") == "TCGA-0007") & (F.col("feature") == "A"), 500).otherwise(1))
    single = al.unique_matrix_keys(half, 15)  # two columns of one name, half of the cells each
    assert single.count() == 99 and single.where("sample_id = 'TCGA-0007'").count() == 0


def test_separators_inside_quotes(spark, tmp_path):
    path = _gz(tmp_path / "s.tsv.gz", [["id", '"S\t1"', "T"], ['"a\tb"', "1", '"2"'], ['"say ""x"""', "3", "4"], ["c", "", "5"]])
    rows = mx.read_wide_matrix(spark, path).orderBy("feature_pos", "column_no").collect()
    assert [(r.sample_id, r.value) for r in rows] == [("S\t1", 1.0), ("T", 2.0), ("S\t1", 3.0), ("T", 4.0), ("S\t1", None), ("T", 5.0)]
    assert rows[0].feature == "a\tb"


def test_null_twin_removes_the_valid_one(spark):
    cells, rows = _cohort(spark, 102, 0)
    out = al.align(cells, rows.unionByName(_labels(spark, [("TCGA-0005", None)])), IngestConfig())
    assert out.samples.where("sample_id = 'TCGA-0005'").count() == 0


def test_validation_and_metadata(spark):
    cells, rows = _cohort(spark, 100, 0)
    out = al.align(cells.withColumn("value", F.when(F.col("feature") == "B", 0.0).otherwise(1.0)), rows, IngestConfig())
    report = al.validate(out.matrix, out.samples)
    row = report.first()
    assert (row.n_samples, row.n_features, row.n_cells, row.n_zero_features) == (100, 2, 200, 1)
    meta = al.metadata(report, out.samples, "vital_status", "TCGA").first()
    assert meta.class_distribution == {"a": 50, "b": 50}
    assert meta.dtype_counts == {"float": 2}
    with pytest.raises(ValueError, match="null or NaN"):
        al.validate(out.matrix.withColumn("value", F.lit(float("nan")).cast("float")), out.samples)
    with pytest.raises(ValueError, match="single precision"):
        al.validate(out.matrix.withColumn("value", F.lit(1.0)), out.samples)
    with pytest.raises(ValueError, match="class"):
        al.validate(out.matrix, out.samples.where("label = 'a'"))


def test_clustered_layout_round_trip(spark, long, tmp_path):
    cells = long({"B": [1, 2], "A": [3, 4]})
    mx.write_matrix(cells, str(tmp_path / "m"))
    back = spark.read.parquet(str(tmp_path / "m"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, cells.collect()))


def test_densify_fills_with_zero(spark):
    cells = spark.createDataFrame([("s", "a", 2.0), ("s", "a", 3.0)], "sample_id string, feature string, value double")
    samples = spark.createDataFrame([("s",), ("t",)], "sample_id string")
    features = spark.createDataFrame([("a",), ("b",)], "feature string")
    got = {(r.sample_id, r.feature): r.value for r in mx.densify(cells, samples, features).collect()}
    assert got == {("s", "a"): 5.0, ("s", "b"): 0.0, ("t", "a"): 0.0, ("t", "b"): 0.0}


def test_densify_with_nulls_repeats_and_strangers(spark):
    cells = spark.createDataFrame(
        [("s", "a", None), ("s", None, 2.0), ("s", "z", None), ("s", "y", 7.0), ("u", "a", 4.0), ("u", "b", None), (None, "a", 1.0)],
        "sample_id string, feature string, value double",
    )
    samples = spark.createDataFrame([("s",), ("s",), (None,)], "sample_id string")
    features = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "feature string")
    rows = [tuple(r) for r in mx.densify(cells, samples, features).collect()]
    assert len(rows) == len(set(rows))
    assert {(s, f): v for s, f, v in rows} == {
        ("s", "a"): 0.0, ("s", "b"): 0.0, ("s", None): 2.0, ("s", "z"): None, ("s", "y"): 7.0,
        ("u", "a"): 4.0, ("u", "b"): None, (None, "a"): 1.0, (None, "b"): 0.0,
    }


def test_zeros_are_made_after_the_last_aggregate_and_shuffle(spark):
    cells = spark.createDataFrame([("s", "a", 2.0)], "sample_id string, feature string, value double")
    samples = spark.createDataFrame([("s",), ("t",)], "sample_id string")
    features = spark.createDataFrame([("a",), ("b",)], "feature string")
    dense = mx.densify(cells, samples, features)
    plan = dense._jdf.queryExecution().executedPlan().toString()  # parents come before children
    assert 0 <= plan.find("Generate") < plan.find("Aggregate") < plan.find("Exchange")


def test_tasks_of_the_purchase_join_grow_with_the_line_items(spark, tmp_path, monkeypatch):
    folder, n = str(tmp_path), 60
    ids = spark.range(n)
    ids.selectExpr("id as l_orderkey", "id % 5 as l_partkey", "cast(id as double) as l_quantity").write.parquet(f"{folder}/lineitem.parquet")
    ids.selectExpr("id as o_orderkey", "id % 7 as o_custkey").write.parquet(f"{folder}/orders.parquet")
    spark.range(5).selectExpr("id as p_partkey", "concat('B', id) as p_brand").write.parquet(f"{folder}/part.parquet")
    few = wl.purchases(spark, folder, F.col("p_brand"))
    monkeypatch.setattr(wl, "JOIN_ROWS", 3)
    many = wl.purchases(spark, folder, F.col("p_brand"))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey" in plan and f", {n // 3 + 1}), REPARTITION_BY_NUM" in plan
