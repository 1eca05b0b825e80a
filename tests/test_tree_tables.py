"""Scoring from node tables: against a recursive walk, packs, odd values, broken tables."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from panelwright.operators.tree_tables import NodeStack, add_score, packs
from panelwright.session import new_path

SCHEMA = "tree int, id int, left int, right int, feature int, threshold double, output double"


def grown(rng, trees, depth, width):
    """Random trees with ids in the order of a depth-first walk."""
    out = []
    for t in range(trees):
        nodes = []

        def grow(level):
            at = len(nodes)
            nodes.append(None)
            if level and rng.uniform() < 0.85:
                f, cut = int(rng.integers(width)), float(rng.integers(-3, 4))
                left = grow(level - 1)
                nodes[at] = (t, at, left, grow(level - 1), f, cut, 0.0)
            else:
                nodes[at] = (t, at, -1, -1, -1, None, float(rng.normal()))
            return at

        grow(depth)
        out += nodes
    return out


def slow_score(nodes, x):
    by_id = {(n[0], n[1]): n for n in nodes}

    def walk(t, i):
        _, _, left, right, f, cut, output = by_id[t, i]
        return output if left < 0 else walk(t, left if x[f] <= cut else right)

    return sum(walk(t, 0) for t in sorted({n[0] for n in nodes}))


@pytest.mark.parametrize("most", [1, 40, 1 << 18])
def test_scores_equal_a_recursive_walk(spark, most):
    rng = np.random.default_rng(3)
    nodes = grown(rng, 7, 5, 3)
    rows = [(i, [float(v) for v in rng.integers(-3, 4, 3)]) for i in range(60)]
    rows += [(60, [math.nan, 0.0, math.inf]), (61, [-math.inf] * 3)]
    df = spark.createDataFrame(rows, "n int, x array<double>")
    model = packs(spark.createDataFrame(nodes, SCHEMA), most)
    assert len(model) == (1 if most > 1000 else 7 if most == 1 else len(model)) and len(model) >= 1
    got = {r.n: r.s for r in add_score(df, model, "s", "x").collect()}
    assert got == pytest.approx({n: slow_score(nodes, x) for n, x in rows}, abs=1e-12)


def test_scoring_is_one_row_level_expression(spark):
    nodes = grown(np.random.default_rng(0), 3, 4, 2)
    df = spark.range(5).select(F.array(F.col("id").cast("double"), F.lit(0.5)).alias("x"))
    scored = add_score(df, packs(spark.createDataFrame(nodes, SCHEMA)), "s", "x")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Arrow", "Join", "Exchange hash"):
        assert word not in plan


def test_no_trees_and_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    df = spark.createDataFrame([(1, [0.0])], "n int, x array<double>")
    assert add_score(df, packs(empty), "s", "x").first().s == 0.0
    one = packs(spark.createDataFrame([(0, 0, -1, -1, -1, None, 2.5)], SCHEMA))
    assert add_score(df, one, "s", "x").first().s == 2.5
    assert add_score(df.limit(0), one, "s", "x").count() == 0


@pytest.mark.parametrize("nodes", [
    [(0, 0, 1, 2, 0, 0.0, 0.0), (0, 1, -1, -1, -1, 0.0, 1.0)],  # a child is absent
    [(0, 1, -1, -1, -1, 0.0, 1.0)],  # no root
    [(0, 0, 1, 1, 0, 0.0, 0.0), (0, 1, -1, -1, -1, 0.0, 1.0), (0, 2, -1, -1, -1, 0.0, 1.0)],  # two parents
])
def test_broken_tables_are_refused(spark, nodes):
    with pytest.raises(ValueError, match="tree 0"):
        packs(spark.createDataFrame(nodes, SCHEMA))


def test_stack_of_tables_survives_a_round_trip(spark):
    rng = np.random.default_rng(5)
    forest, booster = (spark.createDataFrame(grown(rng, n, 3, 2), SCHEMA) for n in (2, 3))
    stack = NodeStack(["no", "yes"], forest, booster, (0.1, 0.5, -0.7))
    x = F.array(F.col("id").cast("double") - 10, F.lit(1.0))
    rows = spark.range(20).select("id", array_to_vector(x).alias("features"))
    path = new_path(spark, "tables")
    stack.save(path)
    pick = ["id", "p_rf", "p_gbt", "score", "prediction"]
    first = sorted(map(tuple, stack.predict(rows).select(*pick).collect()))
    again = sorted(map(tuple, NodeStack.load(spark, path).predict(rows).select(*pick).collect()))
    assert first == again and len({r[-1] for r in first}) >= 1
    for r in stack.predict(rows).collect():
        assert sum(r.probabilities) == pytest.approx(1.0)
        odds = 0.1 + 0.5 * r.p_rf - 0.7 * r.p_gbt
        assert r.score == pytest.approx(1 / (1 + math.exp(-odds)))
        assert r.prediction == ("yes" if r.score > 0.5 else "no")


def test_two_classes_are_needed(spark):
    with pytest.raises(ValueError, match="two classes"):
        NodeStack(["a"], spark.createDataFrame([], SCHEMA), spark.createDataFrame([], SCHEMA), (0.0, 1.0, 1.0))
