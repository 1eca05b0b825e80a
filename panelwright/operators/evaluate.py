"""Metrics with the definitions used for imbalanced binary targets.

Ranking metrics work on one row per distinct score and a distributed running
total; the others on the confusion table, which has one row per class pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators.running import running_totals


def ranking_metrics(scored: DataFrame, score: str = "score", label: str = "label", by: tuple[str, ...] = ()) -> DataFrame:
    """One row, or one per group of ``by``: exact ROC-AUC (ties averaged) and average precision.

    The larger of two labels is positive. Any other number of classes gives
    nulls.
    """
    bounds = scored.agg(F.min(label), F.max(label))
    low, high = bounds.first()
    y, s = F.col(label), F.col(score).cast("double")
    others = (y != F.lit(low)) & (y != F.lit(high))
    by_score = scored.groupBy(*by, s.alias("score")).agg(
        F.count_if(y == F.lit(high)).alias("p"),
        F.count_if(y != F.lit(high)).alias("n"),
        F.count_if(others).alias("other"),
    )
    run = running_totals(by_score, [("score", True)], {"tp": "p", "fp": "n"}, by)
    p, n = F.col("p").cast("double"), F.col("n").cast("double")
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    sums = run.groupBy(*by).agg(
        F.sum("p").cast("double").alias("pos"),
        F.sum("n").cast("double").alias("neg"),
        F.sum("other").alias("other"),
        F.sum(n * (tp - p / 2)).alias("wins"),
        F.sum(p * tp / (tp + fp)).alias("steps"),
    )
    binary = (F.col("other") == 0) & (F.col("pos") > 0) & (F.col("neg") > 0)
    return sums.select(
        *by,
        F.when(binary, F.try_divide("wins", F.col("pos") * F.col("neg"))).alias("roc_auc"),
        F.when(binary, F.try_divide("steps", F.col("pos"))).alias("average_precision"),
    )


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def per_class(table: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of each class that occurs on either
    side; an undefined ratio is 0."""
    sides = table.select(
        F.explode(
            F.array(
                F.struct(F.col("label").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("called")),
                F.struct(F.col("prediction").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("called")),
            )
        ).alias("s"),
        F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit"),
    )
    # Each cell is seen twice, once per side.
    sums = sides.groupBy("s.label").agg(
        F.sum("s.support").alias("support"),
        F.sum("s.called").alias("called"),
        (F.sum("hit") / 2).alias("tp"),
    )
    zero = F.lit(0.0)
    return sums.select(
        "label",
        F.coalesce(F.try_divide("tp", "called"), zero).alias("precision"),
        F.coalesce(F.try_divide("tp", "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("tp"), F.col("support") + F.col("called")), zero).alias("f1_score"),
        "support",
        "called",
        "tp",
    )


def agreement_metrics(table: DataFrame) -> DataFrame:
    """One row: macro F1, weighted F1, accuracy and Cohen's kappa."""
    n = F.col("n_rows")
    sums = per_class(table).agg(
        F.avg("f1_score").alias("macro_f1"),
        F.sum(F.col("f1_score") * F.col("support")).alias("_weighted"),
        F.sum("support").cast("double").alias("n_rows"),
        F.sum("tp").alias("_hits"),
        F.sum(F.col("support").cast("double") * F.col("called")).alias("_chance"),
    )
    observed, chance = F.col("_hits") / n, F.col("_chance") / (n * n)
    return sums.select(
        "macro_f1",
        (F.col("_weighted") / n).alias("weighted_f1"),
        observed.alias("accuracy"),
        F.try_divide(observed - chance, F.lit(1.0) - chance).alias("cohen_kappa"),
    )


def classification_report(table: DataFrame) -> DataFrame:
    """Rows per class, then accuracy, macro avg and weighted avg."""
    classes = per_class(table)
    s = F.col("support")
    names = ("precision", "recall", "f1_score")
    overall = classes.agg(
        F.sum(s).alias("support"),
        (F.sum("tp") / F.sum(s)).alias("acc"),
        *[F.avg(m).alias(f"macro_{m}") for m in names],
        *[(F.sum(F.col(m) * s) / F.sum(s)).alias(f"weighted_{m}") for m in names],
    )
    none = F.lit(None).cast("double")
    summary = overall.select(
        F.inline(
            F.array(
                F.struct(F.lit("accuracy").alias("name"), none.alias("precision"), none.alias("recall"),
                         F.col("acc").alias("f1_score"), F.col("support"), F.lit(1).alias("part")),
                *[
                    F.struct(F.lit(f"{kind} avg").alias("name"),
                             *[F.col(f"{kind}_{m}").alias(m) for m in names],
                             F.col("support"), F.lit(part).alias("part"))
                    for part, kind in ((2, "macro"), (3, "weighted"))
                ],
            )
        )
    )
    rows = classes.select(F.col("label").cast("string").alias("name"), *names, "support", F.lit(0).alias("part"))
    return rows.unionByName(summary)


def report_text(report: DataFrame, digits: int = 4) -> str:
    """Text table of a report: a few rows more than there are classes."""
    rows = report.orderBy("part", "name").collect()
    width = max(12, *(len(r.name) for r in rows)) if rows else 12
    lines = [" " * width + "".join(f"{h:>10}" for h in ("precision", "recall", "f1-score", "support"))]
    for r in rows:
        cells = ["" if v is None else f"{v:.{digits}f}" for v in (r.precision, r.recall, r.f1_score)]
        lines.append(f"{r.name:>{width}}" + "".join(f"{c:>10}" for c in cells) + f"{r.support:>10}")
    return "\n".join(lines)


def evaluate(scored: DataFrame, score="score", label="label", prediction="prediction") -> DataFrame:
    """All headline metrics as one row."""
    table = confusion(scored, label, prediction)
    ranking, agreement = ranking_metrics(scored, score, label), agreement_metrics(table)
    packed = agreement.select(F.struct(*agreement.columns))
    return ranking.withColumn("_agreement", packed.scalar()).select(*ranking.columns, "_agreement.*")
