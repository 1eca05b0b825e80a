"""Second-order boosting: against a slow version, both ways to grow, and held-out rows."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from panelwright.operators import boosting
from panelwright.operators.boosting import BoostedTrees, BoosterParams, SecondOrderBooster
from panelwright.session import new_path


def rows_of(spark, n, width, seed=0, levels=12):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, levels, size=(n, width)).astype(float)
    y = ((x[:, 0] > levels / 2) ^ (x[:, 1] > levels / 3) ^ (rng.uniform(size=n) < 0.1)).astype(int)
    table = [(f"S{i}", int(y[i]), 1.0 + 0.5 * (i % 3), x[i].tolist()) for i in range(n)]
    df = spark.createDataFrame(table, "sample_id string, code int, w_gbt double, x array<double>")
    return df.withColumn("features", array_to_vector("x")), x, y, np.array([r[2] for r in table])


def slow_trees(x, y, w, p):
    """Every row and column of every round, in plain loops."""
    margin, out = [0.0] * len(y), []
    for _ in range(p.rounds):
        g = [w[i] * (1 / (1 + math.exp(-margin[i])) - y[i]) for i in range(len(y))]
        h = [w[i] * (1 / (1 + math.exp(-margin[i]))) * (1 - 1 / (1 + math.exp(-margin[i]))) for i in range(len(y))]
        nodes, level = [{"rows": list(range(len(y))), "split": None}], [0]
        for _ in range(p.depth):
            below = []
            for node in level:
                rows = nodes[node]["rows"]
                total_g, total_h = sum(g[i] for i in rows), sum(h[i] for i in rows)
                best = None
                for f in range(x.shape[1]):
                    for v in sorted(set(x[:, f])):
                        left = [i for i in rows if x[i, f] <= v]
                        gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                        if hl < p.least_hessian or total_h - hl < p.least_hessian:
                            continue
                        gain = gl**2 / (hl + p.l2) + (total_g - gl) ** 2 / (total_h - hl + p.l2) - total_g**2 / (total_h + p.l2)
                        if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, f, v)
                if best:
                    nodes[node]["split"] = best[1:] + (len(nodes), len(nodes) + 1)
                    for side in (True, False):
                        below.append(len(nodes))
                        nodes.append({"rows": [i for i in rows if (x[i, best[1]] <= best[2]) == side], "split": None})
            level = below
        tree = []
        for node in nodes:
            total_g, total_h = sum(g[i] for i in node["rows"]), sum(h[i] for i in node["rows"])
            node["output"] = -p.rate * total_g / (total_h + p.l2)
            tree.append((node["split"], node["output"], total_h))
            if not node["split"]:
                for i in node["rows"]:
                    margin[i] += node["output"]
        out.append(tree)
    return out


@pytest.mark.parametrize("task_cells", [10**9, 0])
def test_trees_equal_the_slow_version(spark, task_cells):
    df, x, y, w = rows_of(spark, 150, 3, levels=6)
    p = BoosterParams(rounds=2, depth=3, rate=0.5, subsample=1.0, colsample=1.0)
    nodes = SecondOrderBooster(p, task_cells).fit(df).nodes
    want = slow_trees(x, y, w, p)
    assert len(nodes) == sum(map(len, want))
    for t, i, left, right, feature, threshold, output, cover in nodes:
        split, wanted, total_h = want[t][i]
        assert (feature, threshold, left, right) == (split or (-1, None, -1, -1))
        assert output == pytest.approx(wanted, abs=1e-8) and cover == pytest.approx(total_h, abs=1e-6)


def test_both_ways_and_any_partitions_give_the_same_trees(spark, monkeypatch):
    monkeypatch.setattr(boosting, "REFRESH", 2)
    df, *_ = rows_of(spark, 400, 5, seed=3, levels=40)
    p = BoosterParams(rounds=3, depth=3, rate=0.3, subsample=0.7, colsample=0.6, bins=16)
    in_task = SecondOrderBooster(p).fit(df).nodes
    assert SecondOrderBooster(p).fit(df.repartition(5)).nodes == in_task
    assert SecondOrderBooster(p, task_cells=0).fit(df.repartition(3)).nodes == in_task
    assert len({n[4] for n in in_task if n[0] == 0 and n[4] >= 0}) <= 3  # three of five columns


def test_drawn_shares():
    key = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, size=50_000)
    p = BoosterParams(subsample=0.8, colsample=0.8)
    first, second = boosting.drawn(key, 0, p), boosting.drawn(key, 1, p)
    assert abs(first.mean() - 0.8) < 0.01 and abs((first & second).mean() - 0.64) < 0.01
    chosen = [boosting.columns_of(10, r, p).tolist() for r in range(50)]
    assert all(len(set(c)) == 8 and c == sorted(c) for c in chosen) and len(set(map(tuple, chosen))) > 10


def test_log_odds_walk_the_nodes_and_survive_saving(spark):
    df, x, y, _ = rows_of(spark, 500, 4, seed=5)
    model = SecondOrderBooster(BoosterParams(rounds=40, depth=3, rate=0.2)).fit(df.where(F.pmod(F.xxhash64("sample_id"), F.lit(4)) != 0))
    path = new_path(spark, "booster")
    model.save(path)
    scored = {r.sample_id: r.z for r in BoostedTrees.load(path).log_odds(df, "z").collect()}
    trees = {}
    for t, i, left, right, f, cut, output, _ in model.nodes:
        trees.setdefault(t, {})[i] = (left, right, f, cut, output)
    for row in range(0, 500, 37):
        total = 0.0
        for nodes in trees.values():
            i = 0
            while nodes[i][0] >= 0:
                left, right, f, cut, _ = nodes[i]
                i = left if x[row, f] <= cut else right
            total += nodes[i][4]
        assert scored[f"S{row}"] == pytest.approx(total, abs=1e-12)
    held = df.where(F.pmod(F.xxhash64("sample_id"), F.lit(4)) == 0).select("sample_id", "code").collect()
    assert np.mean([(scored[r.sample_id] > 0) == r.code for r in held]) > 0.8


def test_odd_tables(spark):
    df, *_ = rows_of(spark, 30, 2)
    flat = df.withColumn("features", array_to_vector(F.array(F.lit(1.0), F.lit(2.0))))
    for cells in (10**9, 0):
        model = SecondOrderBooster(BoosterParams(rounds=2, depth=2), cells).fit(flat)
        assert [n[:5] for n in model.nodes] == [(0, 0, -1, -1, -1), (1, 0, -1, -1, -1)]
    with pytest.raises(ValueError, match="rows and features"):
        SecondOrderBooster().fit(df.limit(0))
    with pytest.raises(ValueError, match="bins"):
        BoosterParams(bins=300)
