"""Small column functions: missing values, safe numbers, lists, harmonic numbers, rounding rules."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_null(col: Column, also: Iterable[str] = ()) -> Column:
    """Trimmed text, null if it is empty, says null in any case, or is one of `also`."""
    text = F.trim(col.cast("string"))
    return F.when((text != "") & (F.lower(text) != "null") & ~text.isin(*also) if also else (text != "") & (F.lower(text) != "null"), text)


def safe_double(col: Column) -> Column:
    """The number a text holds, null for anything else."""
    return F.trim(col.cast("string")).try_cast("double")


def normal_list(values: Column) -> Column:
    """Trimmed values without empty ones; of those equal but for case the first stays, in order.

    Case is folded with lower(), so letters such as the sharp s fold to themselves.
    """
    kept = F.filter(F.transform(values, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))
    return F.aggregate(
        kept,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.concat(acc, F.array(x))),
    )


def harmonic_gap(n: Column, k: Column) -> Column:
    """digamma(n) - digamma(k) of whole numbers: the sum of 1/j for k <= j < n; by series where it is long."""
    series = lambda x: F.log(x) - 1 / (2 * x) - 1 / (12 * x * x)
    exact = F.aggregate(F.when(n > k, F.sequence(k, n - 1)).otherwise(F.array().cast("array<long>")), F.lit(0.0), lambda acc, j: acc + 1 / j)
    return F.when(n <= 10_000, exact).otherwise(series(n.cast("double")) - series(F.lit(10_000.0)) + F.aggregate(F.sequence(k, F.lit(9_999).cast("long")), F.lit(0.0), lambda acc, j: acc + 1 / j))


def unit_ball(d: int) -> float:
    return math.pi ** (d / 2) / math.gamma(d / 2 + 1)


def clusters_for_entropy(entropy: Column, low: float = 5.0, high: float = 21.0, least: int = 5, most: int = 128, gamma: float = 1.0) -> Column:
    """Cluster count that grows from `least` to `most` as the entropy goes from low to high; halves to even."""
    t = (F.greatest(F.lit(low), F.least(F.lit(high), entropy)) - low) / (high - low)
    return F.when(entropy < low, F.lit(least)).otherwise(F.bround(least * F.pow(F.lit(most / least), F.pow(t, F.lit(gamma))), 0).cast("int"))


def scott_bandwidth(n: Column, d: int) -> Column:
    return F.pow(n.cast("double"), F.lit(-1.0 / (d + 4)))


def percent(value: Column, level: Column) -> Column:
    """Two places at level 1, four above."""
    return F.when(level == 1, F.round(value, 2)).otherwise(F.round(value, 4))


def two_formats(text: Column, first: str = "dd/MM/yyyy HH:mm:ss", second: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """A time in either format as UTC text."""
    t = F.trim(text)
    return F.date_format(F.coalesce(F.try_to_timestamp(t, F.lit(first)), F.try_to_timestamp(t, F.lit(second))), "yyyy-MM-dd HH:mm:ss")
