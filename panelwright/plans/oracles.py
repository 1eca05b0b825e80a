"""The same results as ``panelwright.plans.catalog`` in plain SQL.

Written from the definitions of the operators, without any of their code, to
run on the same tables in DuckDB.
"""

from __future__ import annotations

from panelwright.plans.workloads import FIXED_BOOSTER, FIXED_FOREST, FIXED_WEIGHTS

LABEL = "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'pos' ELSE 'neg' END"


def _spend(feature: str = "p_brand") -> str:
    return f"""
cells AS (
  SELECT o_custkey, {feature} AS feature, sum(l_quantity) AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2),
spend AS (
  SELECT c_name AS sample_id, c_custkey, f.feature, {LABEL} AS label,
         CAST(coalesce(quantity, 0) AS FLOAT) AS value
  FROM customer CROSS JOIN (SELECT DISTINCT {feature} AS feature FROM part) f
  LEFT JOIN cells ON o_custkey = c_custkey AND cells.feature = f.feature),
logged AS (
  SELECT *, CAST(CAST(log2(value + CAST(1 AS FLOAT)) AS FLOAT) AS DOUBLE) AS x FROM spend)"""


SPEND = _spend()

VECTORS = """
vectors AS (
  SELECT CAST(vec_id AS VARCHAR) AS sample_id, 'f' || lpad(CAST(pos AS VARCHAR), 3, '0') AS feature,
         pos AS feature_pos, CAST(embedding[pos + 1] AS DOUBLE) AS x, CAST(label AS VARCHAR) AS label
  FROM embeddings, range(64) r(pos))"""


def _screen(source: str, n_mad: int, k: int) -> str:
    """Statistics of ``source`` with the spend cuts: expressed 5.0 in half of
    the samples, variance above 6."""
    return f"""
base AS (
  SELECT feature, count(*) AS n, avg(CASE WHEN x >= 5 THEN 1.0 ELSE 0.0 END) AS frac,
         avg(x) AS mean, var_pop(x) AS variance, stddev_pop(x) AS std
  FROM {source} GROUP BY feature),
flags AS (
  SELECT *, frac >= 0.5 AS kept_expr, frac >= 0.5 AND variance > 6.0 AS kept_var,
         CAST(row_number() OVER (ORDER BY feature) - 1 AS INT) AS feature_pos
  FROM base),
scaled AS (
  SELECT s.sample_id, s.feature, s.label,
         CAST(CAST((x - mean) / CASE WHEN std = 0 THEN 1 ELSE std END AS FLOAT) AS DOUBLE) AS z
  FROM {source} s JOIN flags USING (feature) WHERE kept_var),
centre AS (SELECT feature, median(z) AS med FROM scaled GROUP BY feature),
spread AS (SELECT feature, median(abs(z - med)) AS mad FROM scaled JOIN centre USING (feature) GROUP BY feature),
wide AS (SELECT * FROM spread JOIN flags USING (feature) ORDER BY mad DESC, feature_pos LIMIT {n_mad}),
{_f_score(source)},
survivors AS (SELECT * FROM wide JOIN f_scores USING (feature)),
panel AS (SELECT * FROM survivors ORDER BY score DESC, feature_pos DESC LIMIT {k})"""


def _f_score(source: str) -> str:
    return f"""by_class AS (
  SELECT feature, label, count(*) AS n, avg(x) AS m, var_pop(x) * count(*) AS ss FROM {source} GROUP BY 1, 2),
grand AS (SELECT feature, avg(x) AS g, count(*) AS total FROM {source} GROUP BY 1),
f_scores AS (
  SELECT feature, (sum(c.n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(ss) / (max(total) - count(*))) AS score
  FROM by_class c JOIN grand USING (feature) GROUP BY feature)"""


def _best_split(name: str, source: str) -> str:
    """The split of the rows in ``source`` with the largest gain, L2 penalty one."""
    return f"""
{name}_total AS (SELECT sum(g) AS g, sum(h) AS h FROM {source}),
{name}_values AS (
  SELECT feature, v, sum(g) AS g, sum(h) AS h
  FROM (SELECT 0 AS feature, f0 AS v, g, h FROM {source} UNION ALL SELECT 1, f1, g, h FROM {source}) GROUP BY 1, 2),
{name}_left AS (
  SELECT feature, v, sum(g) OVER upto AS gl, sum(h) OVER upto AS hl
  FROM {name}_values WINDOW upto AS (PARTITION BY feature ORDER BY v)),
{name}_gain AS (
  SELECT feature, v, gl, hl, gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1) AS gain
  FROM {name}_left, {name}_total WHERE hl >= 1 AND h - hl >= 1),
{name}_split AS (SELECT * FROM {name}_gain WHERE gain > 1e-6 ORDER BY gain DESC, feature, v LIMIT 1)"""


def _node(number: str, name: str, first_child: str) -> str:
    return f"""SELECT {number} AS id, coalesce({first_child}, -1) AS "left", coalesce({first_child} + 1, -1) AS "right",
  coalesce(feature, -1) AS feature, v AS threshold, -0.3 * t.g / (t.h + 1) AS output, t.h AS cover
FROM {name}_total t LEFT JOIN {name}_split ON true WHERE t.g IS NOT NULL"""


def _leaf(number: str, side: str, name: str) -> str:
    g, h = ("s.gl", "s.hl") if side == "left" else ("t.g - s.gl", "t.h - s.hl")
    return f"SELECT {number}, -1, -1, -1, NULL, -0.3 * ({g}) / ({h} + 1), {h} FROM {name}_total t, {name}_split s"


BOOSTER = f"""WITH given AS (
  SELECT c_name, CAST(c_nationkey AS DOUBLE) AS f0, floor(c_acctbal / 1000) AS f1,
         CASE WHEN {LABEL} = 'pos' THEN -1.0 ELSE 0.5 END::DOUBLE AS g, CASE WHEN {LABEL} = 'pos' THEN 0.5 ELSE 0.25 END::DOUBLE AS h
  FROM customer),{_best_split('n0', 'given')},
rows1 AS (SELECT given.* FROM given, n0_split WHERE if(feature = 0, f0, f1) <= v),
rows2 AS (SELECT given.* FROM given, n0_split WHERE if(feature = 0, f0, f1) > v),{_best_split('n1', 'rows1')},{_best_split('n2', 'rows2')},
first2 AS (SELECT CASE WHEN count(*) > 0 THEN 5 ELSE 3 END AS id FROM n1_split),
nodes AS (
  {_node('0', 'n0', 'CASE WHEN feature IS NOT NULL THEN 1 END')}
  UNION ALL {_node('1', 'n1', 'CASE WHEN feature IS NOT NULL THEN 3 END')}
  UNION ALL {_node('2', 'n2', 'CASE WHEN feature IS NOT NULL THEN (SELECT id FROM first2) END')}
  UNION ALL {_leaf('3', 'left', 'n1')} UNION ALL {_leaf('4', 'right', 'n1')}
  UNION ALL {_leaf('(SELECT id FROM first2)', 'left', 'n2')} UNION ALL {_leaf('(SELECT id FROM first2) + 1', 'right', 'n2')})"""

BOOSTER_NODES = f"""{BOOSTER}
SELECT id, "left", "right", feature, round(threshold, 6) AS threshold, round(output, 6) AS output, round(cover, 6) AS cover FROM nodes"""

SCREEN = f"WITH {SPEND}, {_screen('logged', 4, 3)}"

SCORED = f"""WITH scored AS (
  SELECT {LABEL} AS label, c_acctbal AS score,
         CASE WHEN c_acctbal > 4500 THEN 'pos' ELSE 'neg' END AS prediction FROM customer)"""

RANKING = """
by_score AS (
  SELECT score, count(*) FILTER (WHERE y) AS p, count(*) FILTER (WHERE NOT y) AS n FROM binary_rows GROUP BY score),
run AS (
  SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM by_score WINDOW w AS (ORDER BY score DESC)),
ranking AS (
  SELECT sum(n * (tp - p / 2.0)) / (CAST(sum(p) AS DOUBLE) * sum(n)) AS roc_auc,
         sum(p * CAST(tp AS DOUBLE) / (tp + fp)) / sum(p) AS average_precision
  FROM run)"""


def _classes(source: str) -> str:
    return f"""
names AS (SELECT label FROM {source} UNION SELECT prediction FROM {source}),
counts AS (
  SELECT names.label, (SELECT count(*) FROM {source} s WHERE s.label = names.label) AS support,
         (SELECT count(*) FROM {source} s WHERE s.prediction = names.label) AS called,
         (SELECT count(*) FROM {source} s WHERE s.label = names.label AND s.prediction = names.label) AS tp
  FROM names),
per_class AS (
  SELECT *, CASE WHEN called = 0 THEN 0 ELSE tp / CAST(called AS DOUBLE) END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE tp / CAST(support AS DOUBLE) END AS recall,
         CASE WHEN support + called = 0 THEN 0 ELSE 2 * tp / CAST(support + called AS DOUBLE) END AS f1_score
  FROM counts),
total AS (SELECT CAST(sum(support) AS DOUBLE) AS n FROM per_class),
agreement AS (
  SELECT avg(f1_score) AS macro_f1, sum(f1_score * support) / max(n) AS weighted_f1, sum(tp) / max(n) AS accuracy,
         (sum(tp) / max(n) - sum(CAST(support AS DOUBLE) * called) / (max(n) * max(n)))
           / (1 - sum(CAST(support AS DOUBLE) * called) / (max(n) * max(n))) AS cohen_kappa
  FROM per_class, total)"""


def _fold_panel(fold: int) -> str:
    rows = f"(SELECT l.* FROM logged l JOIN folded USING (sample_id) WHERE fold <> {fold})"
    return f"""(WITH outside AS {rows}, {_screen('outside', 4, 2)}
SELECT CAST({fold} AS INT) AS fold, feature, round(mean, 6) AS mean, round(score, 6) AS score FROM panel)"""


# Shapley values by enumeration: every set of known features, the unknown ones by the share of training rows.
SUBSETS = """subsets AS (SELECT a.i AS s0, b.i AS s1, c.i AS s2 FROM range(2) a(i), range(2) b(i), range(2) c(i)),
seen AS (
  SELECT c_name, CASE WHEN c_acctbal <= 4500 THEN 1.0 ELSE 0.0 END AS o0, CASE WHEN c_nationkey <= 12 THEN 1.0 ELSE 0.0 END AS o1,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 0.0 ELSE 1.0 END AS o2,
         CASE WHEN c_acctbal <= 7000 THEN 1.0 ELSE 0.0 END AS q0, CASE WHEN c_acctbal <= 1000 THEN 1.0 ELSE 0.0 END AS q1,
         CASE WHEN c_nationkey <= 6 THEN 1.0 ELSE 0.0 END AS q2
  FROM customer),
shares AS (
  SELECT c_name, s0, s1, s2, if(s0 = 1, o0, 0.6) AS a, if(s1 = 1, o1, 1.0 / 3) AS b, if(s2 = 1, o2, 0.25) AS c,
         if(s0 = 1, q0, 0.8) AS d, if(s0 = 1, q1, 0.25) AS e, if(s1 = 1, q2, 0.25) AS f
  FROM seen, subsets),
worth AS (
  SELECT c_name, s0, s1, s2, a * (b * 8 - (1 - b) * 2) + (1 - a) * (c * 5 + (1 - c))
         + d * (e * 3 + (1 - e) * (f * 4 - (1 - f) * 4)) + (1 - d) * 9 AS v
  FROM shares),
phi AS (
  SELECT c_name AS sample_id, feature, sum(if(own = 1, 1, -1) * v * CASE others WHEN 1 THEN 1.0 / 6 ELSE 1.0 / 3 END) AS shap
  FROM (SELECT c_name, v, unnest(['balance', 'nation', 'segment']) AS feature, unnest([s0, s1, s2]) AS own,
               unnest([s1 + s2, s0 + s2, s0 + s1]) AS others FROM worth)
  GROUP BY 1, 2)"""


COHORT = f"""cohort AS (
  SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'GTEX-' ELSE 'TCGA-' END || c_name AS key, c_nationkey,
         CASE WHEN c_acctbal < 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'Not Reported' ELSE {LABEL} END AS label
  FROM customer)"""

ALIGNED = f"""{SPEND},
left_keys AS (
  SELECT sample_id, count(*) AS copies FROM (
    SELECT c_name AS sample_id FROM customer
    UNION ALL SELECT c_name FROM customer WHERE c_custkey % 10 = 0) GROUP BY 1),
right_keys AS (
  SELECT sample_id, count(*) AS copies, max(label) AS label FROM (
    SELECT c_name AS sample_id, CASE WHEN c_acctbal >= 0 THEN {LABEL} END AS label FROM customer WHERE c_custkey % 7 <> 0
    UNION ALL SELECT c_name, NULL FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 11 = 0) GROUP BY 1),
matched AS (
  SELECT sample_id, r.label FROM left_keys l JOIN right_keys r USING (sample_id)
  WHERE l.copies = 1 AND r.copies = 1 AND r.label IS NOT NULL)"""

SPLIT = f"""parts AS (
  SELECT sample_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(sample_id || '|42'), sample_id)
           <= round(0.2 * count(*) OVER (PARTITION BY label)) AS is_test
  FROM (SELECT c_name AS sample_id, {LABEL} AS label FROM customer))"""


def _digamma(n: str) -> str:
    shift = " + ".join(f"1.0 / (n + {j})" for j in range(10))
    text = (
        f"(ln(n + 10) - 0.5 / (n + 10) - 1.0 / (12 * pow(n + 10, 2)) + 1.0 / (120 * pow(n + 10, 4))"
        f" - 1.0 / (252 * pow(n + 10, 6)) + 1.0 / (240 * pow(n + 10, 8)) - ({shift}))"
    )
    return text.replace("n +", f"CAST({n} AS DOUBLE) +")


def _mutual_information(source: str) -> str:
    """Nearest-neighbour estimate by comparing all pairs of a feature."""
    unit = "281474976710656.0"
    return f"""
sizes_of AS (SELECT feature, stddev_pop(x) AS std, avg(abs(x)) AS size FROM {source} GROUP BY feature),
hashed AS (
  SELECT s.*, CASE WHEN std = 0 THEN 1 ELSE std END AS unit, size, md5(sample_id || '|' || s.feature || '|42') AS h
  FROM {source} s JOIN sizes_of USING (feature)),
jittered AS (
  SELECT sample_id, feature, label,
         x / unit + 1e-10 * greatest(1.0, size / unit)
           * (sqrt(-2.0 * ln((CAST(('0x' || substr(h, 1, 12)) AS BIGINT) + 1.0) / ({unit} + 1.0)))
              * cos(2 * pi() * (CAST(('0x' || substr(h, 13, 12)) AS BIGINT) / {unit}))) AS v
  FROM hashed),
class_rows AS (SELECT feature, label, count(*) AS n_c FROM jittered GROUP BY 1, 2 HAVING count(*) > 1),
points AS (SELECT * FROM jittered JOIN class_rows USING (feature, label)),
radius AS (
  SELECT a.feature, a.sample_id, a.v, a.n_c, least(3, a.n_c - 1) AS k,
         list_sort(list(abs(a.v - b.v)))[least(3, a.n_c - 1)] AS r
  FROM points a JOIN points b ON a.feature = b.feature AND a.label = b.label AND a.sample_id <> b.sample_id
  GROUP BY a.feature, a.sample_id, a.v, a.n_c),
near AS (
  SELECT q.feature, q.sample_id, q.n_c, q.k, count(*) AS m
  FROM radius q JOIN points p ON p.feature = q.feature AND (abs(p.v - q.v) < q.r OR p.v = q.v)
  GROUP BY q.feature, q.sample_id, q.n_c, q.k),
information AS (
  SELECT feature, greatest(0.0, {_digamma('count(*)')} + avg({_digamma('k')}) - avg({_digamma('n_c')})
           - avg({_digamma('m')})) AS score
  FROM near GROUP BY feature)"""


def _records() -> str:
    """Faults of the records, as they are made for scoring."""
    return """faults AS (
  SELECT c_name, c_custkey, CASE WHEN c_custkey % 5 = 0 THEN (c_custkey // 5) % 7 ELSE 99 END AS fault,
         (SELECT count(DISTINCT p_brand) FROM part) AS width, (SELECT min(p_brand) FROM part) AS first_name
  FROM customer)"""


def _top(order: str, way: str) -> str:
    return (
        f"(SELECT feature, round(mean_shap, 6) AS mean_shap, round(mean_abs_shap, 6) AS mean_abs_shap, '{way}' AS way "
        f"FROM signed ORDER BY {order}, feature_pos LIMIT 5)"
    )


SIGNED = f"""WITH {VECTORS},
signed AS (SELECT feature, feature_pos, avg(x) AS mean_shap, avg(abs(x)) AS mean_abs_shap FROM vectors GROUP BY 1, 2)"""

FOLDS = """row_number() OVER (PARTITION BY label ORDER BY md5(sample_id || '|fold-42'), sample_id)"""



def _values(kind: str, nodes: list[tuple]) -> str:
    return ", ".join(f"('{kind}', {', '.join(map(str, n))})" for n in nodes)


# Scaled panel values of each customer in panel order, and the leaf of each fixed tree that they reach.
FIXED_STACK = f"""{SCREEN.replace('WITH', 'WITH RECURSIVE', 1)},
given AS (
  SELECT sample_id, list(z ORDER BY p.feature_pos) AS x FROM scaled s JOIN panel p USING (feature) GROUP BY 1),
nodes(kind, tree, id, "left", "right", feature, threshold, output) AS (
  VALUES {_values('rf', FIXED_FOREST)}, {_values('gbt', FIXED_BOOSTER)}),
walk AS (
  SELECT sample_id, x, kind, tree, 0 AS id FROM given, (SELECT DISTINCT kind, tree FROM nodes)
  UNION ALL
  SELECT sample_id, x, kind, tree, CASE WHEN x[n.feature + 1] <= n.threshold THEN n."left" ELSE n."right" END
  FROM walk JOIN nodes n USING (kind, tree, id) WHERE n."left" >= 0),
sums AS (
  SELECT sample_id, CAST(sum(output) FILTER (kind = 'rf') AS DOUBLE) AS p_rf,
         1 / (1 + exp(-CAST(sum(output) FILTER (kind = 'gbt') AS DOUBLE))) AS p_gbt
  FROM walk JOIN nodes USING (kind, tree, id) WHERE "left" < 0 GROUP BY 1),
scores AS (
  SELECT *, 1 / (1 + exp(-({FIXED_WEIGHTS[0]} + {FIXED_WEIGHTS[1]} * p_rf + {FIXED_WEIGHTS[2]} * p_gbt))) AS p FROM sums)"""

FIXED_RECORDS = f"""{FIXED_STACK}, {_records()}
SELECT c_name AS patient_id, CASE WHEN p > 1 - p THEN 'pos' ELSE 'neg' END AS predicted_status,
       round(p, 6) AS risk_probability, round(1 - p, 6) AS p_neg, round(p, 6) AS p_pos,
       width + CASE WHEN fault = 5 THEN 1 ELSE 0 END AS n_genes_received, (SELECT count(*) FROM panel) AS n_genes_used_by_model
FROM faults JOIN scores ON c_name = sample_id WHERE fault IN (5, 99)"""

ORACLES: dict[str, str] = {
    "wide_matrix_scan": f"""WITH {SPEND}
SELECT feature AS sample_id, sample_id AS feature, round(CAST(value AS DOUBLE), 6) AS value FROM spend""",
    "label_scan": f"WITH {COHORT} SELECT key AS sample_id, label FROM cohort WHERE starts_with(key, 'TCGA')",
    "cohort_filter_counts": f"""WITH {COHORT}
SELECT count(*) FILTER (WHERE starts_with(key, 'TCGA')) AS n_kept,
       count(*) FILTER (WHERE NOT starts_with(key, 'TCGA')) AS n_dropped FROM cohort""",
    "label_override": f"""WITH {COHORT}
SELECT CAST(c_nationkey AS VARCHAR) AS label, count(*) AS n FROM cohort WHERE starts_with(key, 'TCGA') GROUP BY 1""",
    "key_normalisation": f"WITH {COHORT} SELECT key, substr(key, 1, 21) AS short_key, label FROM cohort",
    "colliding_keys_dropped": """WITH keyed AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '-' || strftime(o_orderdate, '%Y') AS sample_id, o_orderstatus AS label
  FROM orders)
SELECT sample_id, max(label) AS label FROM keyed GROUP BY 1 HAVING count(*) = 1""",
    "sample_alignment": f"""WITH {ALIGNED}
SELECT sample_id, m.label, count(*) AS n_features, round(sum(CAST(value AS DOUBLE)), 6) AS total
FROM matched m JOIN spend USING (sample_id) GROUP BY 1, 2""",
    "ingest_metadata": f"""WITH {ALIGNED}
SELECT (SELECT count(*) FROM matched) AS n_samples, count(DISTINCT feature) AS n_features, 'label' AS label_column_used,
       'Customer' AS cohort_prefix, round(count(*) * 4 / (1024.0 * 1024.0), 2) AS size_mb,
       (SELECT count(*) FROM matched WHERE label = 'neg') AS n_neg,
       (SELECT count(*) FROM matched WHERE label = 'pos') AS n_pos, count(DISTINCT feature) AS n_float_features
FROM matched m JOIN spend USING (sample_id)""",
    "matrix_profile": f"""WITH {_spend("p_brand || '/' || p_type")},
zero AS (SELECT feature FROM spend GROUP BY 1 HAVING max(value) = 0)
SELECT count(DISTINCT sample_id) AS n_samples, count(DISTINCT feature) AS n_features, count(*) AS n_cells,
       CAST(0 AS BIGINT) AS n_missing, (SELECT count(*) FROM zero) AS n_zero_features,
       round(count(*) * 4 / (1024.0 * 1024.0), 2) AS size_mb FROM spend""",
    "feature_profile": f"""WITH {VECTORS}
SELECT feature, count(*) AS n_cells, count(*) FILTER (WHERE x IS NULL OR isnan(x)) AS n_missing,
       max(abs(x)) = 0 AS all_zero FROM vectors GROUP BY 1""",
    "class_distribution": """SELECT c_mktsegment AS label, count(*) AS n,
       round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percentage FROM customer GROUP BY 1""",
    "class_guard": """SELECT 'quality' AS label_column, count(DISTINCT quality) AS n_classes,
       count(DISTINCT quality) >= 2 AS usable FROM labels
UNION ALL SELECT 'toxic', count(DISTINCT toxic), count(DISTINCT toxic) >= 2 FROM labels""",
    "label_encoding": """SELECT c_name AS sample_id, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INT) AS code,
       c_mktsegment AS label FROM customer""",
    "class_weights": " UNION ALL ".join(
        f"""SELECT {t} AS label, count(*) AS n,
  round(sum(count(*)) OVER () / CAST(count(*) OVER () * count(*) AS DOUBLE), 6) AS balanced,
  CASE WHEN count(*) OVER () = 2 AND {t} = max({t}) OVER ()
       THEN round((sum(count(*)) OVER () - count(*)) / CAST(count(*) AS DOUBLE), 6) ELSE 1.0 END AS positive_ratio,
  '{t}' AS target FROM labels GROUP BY {t}"""
        for t in ("quality", "toxic")
    ),
    "domain_check": f"""WITH {VECTORS}
SELECT count(*) AS n_cells, count(*) FILTER (WHERE x IS NULL OR isnan(x)) AS n_missing,
       count(*) FILTER (WHERE x < 0) AS n_negative FROM vectors""",
    "feature_set_check": """SELECT DISTINCT p_brand AS feature,
       CASE p_brand WHEN 'Brand#1' THEN 'unexpected' ELSE 'missing' END AS problem
FROM part WHERE p_brand IN ('Brand#1', 'Brand#2')""",
    "positional_arrays": f"""WITH {VECTORS}
SELECT sample_id, feature, CAST(feature_pos AS INT) AS feature_pos, round(x, 6) AS value FROM vectors""",
    "name_score_pairing": f"""WITH {VECTORS}
SELECT CAST(feature_pos AS INT) AS feature_pos, feature, round(var_pop(x), 6) AS score FROM vectors GROUP BY 1, 2""",
    "log2_values": f"WITH {SPEND} SELECT sample_id, feature, round(x, 6) AS x FROM logged",
    "expressed_fraction": f"""WITH {_spend("p_brand || '/' || p_type")}
SELECT feature, round(avg(CASE WHEN x >= 1 THEN 1.0 ELSE 0.0 END), 6) AS frac_expressed,
       count(*) FILTER (WHERE x >= 1) * 5 >= count(*) AS kept_expr FROM logged GROUP BY 1""",
    "variance_and_scale": f"""WITH {SPEND}
SELECT feature, round(avg(x), 6) AS mean, round(var_pop(x), 6) AS var_pop, round(stddev_pop(x), 6) AS std_pop,
       var_pop(x) > 6.0 AS kept FROM logged GROUP BY 1""",
    "preprocess_values": f"{SCREEN} SELECT sample_id, feature, round(z, 6) AS value FROM scaled",
    "mad_scores": f"{SCREEN} SELECT feature, round(mad, 6) AS mad FROM spread",
    "mad_of_vectors": f"""WITH {VECTORS}, centre AS (SELECT feature, median(x) AS med FROM vectors GROUP BY 1)
SELECT feature, round(med, 6) AS median, round(median(abs(x - med)), 6) AS mad
FROM vectors JOIN centre USING (feature) GROUP BY feature, med""",
    "sketched_mad_of_vectors": f"""WITH {VECTORS}, centre AS (SELECT feature, median(x) AS med FROM vectors GROUP BY 1)
SELECT feature, round(med, 6) AS median, round(median(abs(x - med)), 6) AS mad
FROM vectors JOIN centre USING (feature) GROUP BY feature, med""",
    "sketch_errors": """SELECT l_returnflag AS feature, CAST(5 AS BIGINT) AS n_quantiles, CAST(0 AS BIGINT) AS n_wrong, TRUE AS small_error
FROM lineitem GROUP BY 1""",
    "distinct_values": f"""WITH {_spend("p_brand || '/' || p_type")}
SELECT feature, count(DISTINCT value) AS n_distinct, TRUE AS close FROM spend GROUP BY 1""",
    "median_by_counting": f"WITH {SPEND} SELECT feature, round(median(x), 6) AS median FROM logged GROUP BY 1",
    "anova_f_of_brands": f"""WITH {SPEND}, {_f_score('logged')}
SELECT feature, round(score, 6) AS score FROM f_scores""",
    "anova_f_of_vectors": f"""WITH {VECTORS}, {_f_score('vectors')}
SELECT feature, round(score, 6) AS score FROM f_scores""",
    "mutual_information_of_vectors": f"""WITH {VECTORS}, {_mutual_information('vectors')}
SELECT feature, round(score, 6) AS score FROM information""",
    "top_features_by_mad": f"""WITH {VECTORS}, centre AS (SELECT feature, median(x) AS med FROM vectors GROUP BY 1),
spread AS (
  SELECT feature, feature_pos, median(abs(x - med)) AS mad FROM vectors JOIN centre USING (feature) GROUP BY 1, 2)
SELECT feature, round(mad, 6) AS mad FROM (SELECT * FROM spread ORDER BY mad DESC, feature_pos LIMIT 10)""",
    "top_features_by_f": f"""WITH {VECTORS}, {_f_score('vectors')}
SELECT feature, round(score, 6) AS score FROM (SELECT * FROM f_scores ORDER BY score DESC, feature DESC LIMIT 10)""",
    "mask_application": f"""WITH {VECTORS}, {_f_score('vectors')}
SELECT sample_id, feature, round(x, 6) AS value FROM vectors JOIN f_scores USING (feature) WHERE score > 1.0""",
    "surviving_names": f"{SCREEN} SELECT feature, feature_pos FROM flags WHERE kept_var",
    "panel_screen": f"""{SCREEN}
SELECT feature, round(mad, 6) AS mad, round(score, 6) AS f_score,
       row_number() OVER (ORDER BY score DESC, feature_pos DESC) AS rank FROM panel""",
    "dense_panel_screen": f"{SCREEN} SELECT feature, round(mad, 6) AS mad, round(score, 6) AS f_score FROM panel",
    "panel_of_stored_cells": f"""{SCREEN}
SELECT sample_id, feature, round(z, 6) AS value, label FROM scaled WHERE feature IN (SELECT feature FROM panel)""",
    "median_of_stored_cells": f"""WITH {_spend("p_brand || '/' || p_type")},
centre AS (SELECT feature, median(x) AS med FROM logged GROUP BY feature)
SELECT feature, round(any_value(med), 6) AS median, round(median(abs(x - med)), 6) AS mad
FROM logged JOIN centre USING (feature) GROUP BY feature""",
    "booster_first_round": BOOSTER_NODES,
    "booster_in_jobs": BOOSTER_NODES,
    "booster_first_scores": f"""{BOOSTER.replace('WITH given', 'WITH RECURSIVE given', 1)},
walk AS (
  SELECT c_name, f0, f1, 0 AS id FROM given
  UNION ALL
  SELECT c_name, f0, f1, CASE WHEN if(n.feature = 0, f0, f1) <= n.threshold THEN n."left" ELSE n."right" END
  FROM walk JOIN nodes n USING (id) WHERE n."left" >= 0)
SELECT c_name AS sample_id, round(output, 6) AS log_odds FROM walk JOIN nodes USING (id) WHERE "left" < 0""",
    "ranked_scores": f"{SCREEN} SELECT feature, round(score, 6) AS score FROM survivors",
    "vector_selector": f"""WITH {VECTORS}, centre AS (SELECT feature, median(x) AS med FROM vectors GROUP BY 1),
spread AS (
  SELECT feature, feature_pos, median(abs(x - med)) AS mad FROM vectors JOIN centre USING (feature) GROUP BY 1, 2),
wide AS (SELECT * FROM spread ORDER BY mad DESC, feature_pos LIMIT 20),
chosen AS (SELECT v.* FROM vectors v JOIN wide USING (feature)), {_mutual_information('chosen')},
best AS (
  SELECT feature FROM information JOIN wide USING (feature) ORDER BY score DESC, feature_pos DESC LIMIT 8)
SELECT feature, round(mad, 6) AS mad, round(score, 6) AS score,
       feature IN (SELECT feature FROM best) AS kept_panel FROM information JOIN wide USING (feature)""",
    "feature_funnel": f"""{SCREEN},
funnel AS (
  SELECT 0 AS stage_no, 'raw' AS stage, count(*) AS n FROM flags
  UNION ALL SELECT 1, 'expressed', count(*) FROM flags WHERE kept_expr
  UNION ALL SELECT 2, 'variable', count(*) FROM flags WHERE kept_var
  UNION ALL SELECT 3, 'mad', count(*) FROM wide UNION ALL SELECT 4, 'panel', count(*) FROM panel)
SELECT CAST(stage_no AS INT) AS stage_no, stage, n AS n_features,
       coalesce(lag(n) OVER (ORDER BY stage_no) - n, 0) AS n_removed FROM funnel""",
    "screen_train_only": f"""WITH {SPEND}, {SPLIT},
train_rows AS (SELECT l.* FROM logged l JOIN parts p USING (sample_id) WHERE NOT is_test), {_screen('train_rows', 4, 2)},
held AS (
  SELECT feature, CAST(CAST((x - mean) / std AS FLOAT) AS DOUBLE) AS z
  FROM logged JOIN parts USING (sample_id) JOIN panel USING (feature) WHERE is_test)
SELECT feature, count(*) AS n_test, round(avg(z), 6) AS test_mean, round(max(z), 6) AS test_max,
       round(any_value(mean), 6) AS train_mean, round(any_value(score), 6) AS train_f
FROM held JOIN panel USING (feature) GROUP BY feature""",
    "screen_state_round_trip": f"""{SCREEN}
SELECT f.feature, round(f.mean, 6) AS mean, round(f.std, 6) AS std_pop, round(s.mad, 6) AS mad, f.kept_expr, f.kept_var,
       f.feature IN (SELECT feature FROM wide) AS kept_mad, f.feature IN (SELECT feature FROM panel) AS kept_panel
FROM flags f LEFT JOIN spread s USING (feature)""",
    "panels_per_fold": f"""WITH {SPEND}, folded AS (
  SELECT sample_id, CAST(({FOLDS} - 1) % 3 AS INT) AS fold FROM (SELECT c_name AS sample_id, {LABEL} AS label FROM customer))
{_fold_panel(0)} UNION ALL {_fold_panel(1)} UNION ALL {_fold_panel(2)}""",
    "fixed_tree_attributions": f"WITH {SUBSETS} SELECT sample_id, feature, round(shap, 4) AS shap_value FROM phi",
    "fixed_tree_ranking": f"""WITH {SUBSETS}
SELECT feature, round(avg(shap), 3) AS mean_shap, round(avg(abs(shap)), 3) AS mean_abs_shap FROM phi GROUP BY 1""",
    "stratified_split": f"WITH {SPLIT} SELECT sample_id, label, is_test FROM parts",
    "stratified_folds": f"""SELECT sample_id, label, CAST(({FOLDS} - 1) % 5 AS INT) AS fold
FROM (SELECT c_name AS sample_id, c_mktsegment AS label FROM customer)""",
    "row_subsample": """SELECT sample_id FROM (SELECT CAST(o_orderkey AS VARCHAR) AS sample_id FROM orders)
ORDER BY md5(sample_id || '|subsample-42'), sample_id LIMIT 100""",
    "ranking_metrics": f"""{SCORED}, binary_rows AS (SELECT score, label = 'pos' AS y FROM scored), {RANKING}
SELECT round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision FROM ranking""",
    "ranking_metrics_with_ties": f"""WITH binary_rows AS (SELECT l_quantity AS score, l_returnflag = 'R' AS y FROM lineitem),
{RANKING}
SELECT round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision FROM ranking""",
    "agreement_metrics": f"""{SCORED}, {_classes('scored')}
SELECT round(macro_f1, 6) AS macro_f1, round(weighted_f1, 6) AS weighted_f1, round(accuracy, 6) AS accuracy,
       round(cohen_kappa, 6) AS cohen_kappa FROM agreement""",
    "classification_report": f"""WITH called_orders AS (
  SELECT o_orderstatus AS label,
         CASE WHEN o_totalprice > 300000 THEN 'P' WHEN o_totalprice > 150000 THEN 'O' ELSE 'F' END AS prediction
  FROM orders), {_classes('called_orders')}
SELECT label AS name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, support
FROM per_class
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / CAST(sum(support) AS DOUBLE), 6), CAST(sum(support) AS BIGINT) FROM per_class
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1_score), 6),
       CAST(sum(support) AS BIGINT) FROM per_class
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1_score * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM per_class""",
    "evaluation_bundle": f"""{SCORED}, binary_rows AS (SELECT score, label = 'pos' AS y FROM scored), {RANKING},
{_classes('scored')}
SELECT round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision, round(macro_f1, 6) AS macro_f1,
       round(weighted_f1, 6) AS weighted_f1, round(accuracy, 6) AS accuracy, round(cohen_kappa, 6) AS cohen_kappa
FROM ranking, agreement""",
    "panel_assembly": f"""{SCREEN}
SELECT sample_id, CAST(dense_rank() OVER (ORDER BY p.feature_pos) - 1 AS INT) AS place, round(z, 6) AS value
FROM scaled s JOIN panel p USING (feature)""",
    "stack_fold_coverage": f"""WITH {SPLIT},
folds AS (SELECT label, ({FOLDS} - 1) % 3 AS fold FROM parts WHERE NOT is_test)
SELECT CAST(fold AS INT) AS fold, CAST(label = 'pos' AS INT) AS code, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_bad
FROM folds GROUP BY 1, 2""",
    "stack_prediction_checks": f"""WITH {SPLIT}
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_bad_sums, CAST(0 AS BIGINT) AS n_wrong_class FROM parts WHERE is_test""",
    **{
        f"shap_additivity_{name}": f"""WITH {SPLIT}
SELECT count(*) AS n_samples, 8 * count(*) AS n_values, CAST(0 AS BIGINT) AS n_violations FROM parts WHERE NOT is_test"""
        for name in ("boosted", "forest")
    },
    "attribution_ranking": f"""{SIGNED}
SELECT feature, round(mean_shap, 6) AS mean_shap, round(mean_abs_shap, 6) AS mean_abs_shap,
       CASE WHEN mean_shap < 0 THEN 'alive' ELSE 'dead' END AS direction,
       round((greatest(-0.4, least(0.4, mean_shap)) + 0.4) / 0.8 * 100, 6) AS bar FROM signed""",
    "attribution_top_by_direction": SIGNED + " " + " UNION ALL ".join([
        _top("mean_abs_shap DESC", "size"), _top("mean_shap DESC", "positive"), _top("mean_shap", "negative")
    ]),
    "probability_maps": """SELECT c_custkey, round(1 - (c_acctbal + 1000.0) / CAST(11999.3 AS DOUBLE), 6) AS p_neg,
       round((c_acctbal + 1000.0) / CAST(11999.3 AS DOUBLE), 6) AS p_pos, CAST(2 AS BIGINT) AS n_classes FROM customer""",
    "scored_record_counts": f"""WITH {_records()}
SELECT c_name AS patient_id, width + CASE WHEN fault = 5 THEN 1 ELSE 0 END AS n_genes_received,
       CAST(8 AS BIGINT) AS n_genes_used_by_model, FALSE AS bad FROM faults WHERE fault IN (5, 99)""",
    "rejected_records": f"""WITH {_records()}
SELECT CASE WHEN fault = 6 THEN '' ELSE c_name END AS patient_id,
       CAST(CASE WHEN fault = 4 THEN 400 ELSE 422 END AS INT) AS reject_code,
       CASE fault WHEN 0 THEN 'expressions must not be empty' WHEN 4 THEN '1 needed value(s) absent, of: ' || first_name
            WHEN 6 THEN 'patient_id must not be empty' ELSE '1 value(s) below zero or not finite, of: ' || first_name END AS reject_reason
FROM faults WHERE fault NOT IN (5, 99)""",
    "bundle_readiness": """SELECT 'ok' AS status, TRUE AS models_loaded, count(DISTINCT p_brand) AS n_expected_genes,
       CAST(8 AS BIGINT) AS n_model_input_genes, 'neg,pos' AS classes FROM part""",
    "stream_against_batch": f"""WITH {_records()}
SELECT count(*) AS n_records, CAST(0 AS BIGINT) AS n_different FROM faults""",
    "fixed_stack_predictions": f"""{FIXED_STACK}
SELECT sample_id, CASE WHEN p > 1 - p THEN 'pos' ELSE 'neg' END AS prediction, round(p_rf, 6) AS p_rf,
       round(p_gbt, 6) AS p_gbt, round(p, 6) AS p_pos FROM scores""",
    "fixed_stack_records": FIXED_RECORDS,
    "fixed_stack_stream": FIXED_RECORDS,
    "stack_as_tables": f"""WITH {SPLIT} SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM parts WHERE is_test""",
    "incomplete_samples": """WITH bought AS (
  SELECT c_name, p_brand, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
), one AS (SELECT c_name, count(*) AS features, sum(n) AS cells FROM bought GROUP BY 1)
SELECT c_name AS sample_id, (SELECT count(DISTINCT p_brand) FROM bought) - features AS n_missing,
       CAST(cells - features AS BIGINT) AS n_repeated
FROM one WHERE cells <> features OR features < (SELECT count(DISTINCT p_brand) FROM bought)""",
    "importance_checks": """SELECT CAST(8 AS BIGINT) AS n_features, TRUE AS sums_to_one, TRUE AS in_order, TRUE AS is_panel""",
    "search_checks": """SELECT CAST(30 AS BIGINT) AS n_trials, CAST(0 AS BIGINT) AS n_outside, TRUE AS best_is_largest""",
}
