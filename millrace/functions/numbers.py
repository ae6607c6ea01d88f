"""Ratios, correlations with confidence intervals, and distances on the globe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metres: mean radius for matching, and the rounder one of radius look-ups.
EARTH, EARTH_ROUND = 6_371_008.8, 6_371_000.0


def ratio(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """scale * part / whole as a double; null where whole is zero."""
    return F.try_divide(F.lit(float(scale)) * part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole, 100.0)


def pearson(x: str, y: str, window=None, least: int = 3) -> Column:
    """Pearson correlation; null for fewer than `least` pairs or a constant column."""
    pair = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(pair, F.col(x).cast("double")), F.when(pair, F.col(y).cast("double"))
    over = (lambda c: c.over(window)) if window is not None else (lambda c: c)
    n, low = over(F.count(a)), over(F.least(F.stddev_pop(a), F.stddev_pop(b))) if window is None else F.least(over(F.stddev_pop(a)), over(F.stddev_pop(b)))
    r = F.try_divide(over(F.covar_pop(a, b)), over(F.stddev_pop(a)) * over(F.stddev_pop(b)))
    return F.when((n >= least) & (low > 0), r)


def fisher_bound(r: Column, n: Column, sign: int) -> Column:
    """A bound of the 95 % interval of a correlation; null for three pairs or fewer, or |r| of 1."""
    bounded = F.when((n > 3) & (F.abs(r) < 1), r)
    return F.round(F.tanh(F.atanh(bounded) + F.lit(sign * 1.96) / F.sqrt(F.greatest(n - 3, F.lit(1)).cast("double"))), 6)


def strength(r: Column) -> Column:
    return F.when(r.isNull(), "not calculable").when(F.abs(r) < 0.3, "weak").when(F.abs(r) < 0.6, "moderate").otherwise("strong")


def direction(r: Column) -> Column:
    return F.when(r.isNull(), "not_calculable").when(r > 0, "positive").when(r < 0, "negative").otherwise("none")


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH) -> Column:
    """Metres between two points, by the haversine formula with its root clamped to 1."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    return F.lit(2.0 * radius) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))
