"""Column expressions. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from panelwright.config import NULL_TOKENS


def log2_shift(value: Column, pseudocount: float = 1.0) -> Column:
    """``log2(value + pseudocount)`` on single precision, as FLOAT."""
    shifted = value.cast("float") + F.lit(pseudocount).cast("float")
    return F.log2(shifted).cast("float")


def zscore(value: Column, mean: Column, std: Column, with_mean=True, with_std=True) -> Column:
    """Centre and scale in DOUBLE; a zero deviation counts as one."""
    out = value.cast("double")
    if with_mean:
        out = out - mean
    if with_std:
        out = out / F.when(std == 0, F.lit(1.0)).otherwise(std)
    return out.cast("float")


def null_if_token(text: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    return F.when(text.isin(*tokens), F.lit(None)).otherwise(text)


def strip(text: Column) -> Column:
    """Trim all white space, not only blanks."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def truncate_key(key: Column, length: int) -> Column:
    return F.substring(key, 1, length)


def seeded_hash(seed: int | str, *parts: Column) -> Column:
    """Stable hash order of rows, the same on every run and cluster."""
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def class_percentage(count: Column) -> Column:
    """Share of the total, as a percentage, over a small table of classes."""
    whole = Window.partitionBy(F.lit(1))
    return F.lit(100.0) * count / F.sum(count).over(whole)


def class_probabilities(classes: list[str], probabilities: Column, digits: int = 6) -> Column:
    """Array of probabilities -> map of class to rounded probability."""
    names = F.array(*[F.lit(c) for c in classes])
    return F.map_from_arrays(names, F.transform(probabilities, lambda p: F.round(p, digits)))


def direction(mean_shap: Column, negative: str = "alive", positive: str = "dead") -> Column:
    return F.when(mean_shap < 0, F.lit(negative)).otherwise(F.lit(positive))


def bar_position(mean_shap: Column, limit: float = 0.4) -> Column:
    """Place a signed value on a 0..100 bar, clamped to +-limit."""
    clamped = F.greatest(F.lit(-limit), F.least(F.lit(limit), mean_shap))
    return (clamped + limit) / (2 * limit) * 100


def digamma(n: Column) -> Column:
    """Digamma of a positive integer: recurrence up to n + 10, then the
    asymptotic series, which is exact to double precision there."""
    x = n.cast("double")
    shift = sum((F.lit(1.0) / (x + j) for j in range(1, 10)), F.lit(1.0) / x)
    y = x + 10
    inv2 = F.lit(1.0) / (y * y)
    series = inv2 * (
        F.lit(1 / 12) - inv2 * (F.lit(1 / 120) - inv2 * (F.lit(1 / 252) - inv2 * F.lit(1 / 240)))
    )
    return F.ln(y) - F.lit(0.5) / y - series - shift
