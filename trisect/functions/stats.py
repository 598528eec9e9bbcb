"""Column expressions for the closed-form parts of the statistics."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
EMPTY_SHARE = 1e-8
KS_TERMS = 100
NORMAL_TERMS = 120


def psi_term(expected: Column, actual: Column) -> Column:
    """One bin's part of the population stability index; an empty share counts as EMPTY_SHARE."""
    p = F.when(expected == 0, EMPTY_SHARE).otherwise(expected)
    q = F.when(actual == 0, EMPTY_SHARE).otherwise(actual)
    return (p - q) * F.log(p / q)


def js_term(p: Column, q: Column, m: Column) -> Column:
    """One bin's part of the Jensen-Shannon divergence of p and q, with m the mixture of both."""
    side = lambda share: F.when(share > 0, share * F.log(share / m)).otherwise(F.lit(0.0))
    return (side(p) + side(q)) / 2


def ks_pvalue(stat: Column, n_ref: Column, n_cur: Column) -> Column:
    """Two-sided asymptotic p-value of the two-sample Kolmogorov-Smirnov statistic.

    The limiting distribution has two series; each is used where it converges in few terms.
    """
    x = stat * F.sqrt(n_ref.cast("double") * n_cur / (n_ref.cast("double") + n_cur))
    terms = F.sequence(F.lit(1), F.lit(KS_TERMS))
    upper = 2.0 * F.aggregate(
        terms,
        F.lit(0.0),
        lambda total, k: total + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * x * x),
    )
    lower = F.sqrt(F.lit(2 * math.pi)) / x * F.aggregate(
        terms,
        F.lit(0.0),
        lambda total, k: total + F.exp(-(2 * k - 1) * (2 * k - 1) * (math.pi**2) / (8 * x * x)),
    )
    return F.when(x <= 0, F.lit(1.0)).when(x < 1, 1 - lower).otherwise(upper)


def normal_two_sided(z: Column) -> Column:
    """Probability that a standard normal value is at least as far from 0 as ``z``.

    The series of the error function has positive terms only; where it would need too many, the tail's asymptotic form serves.
    """
    x = F.abs(z) / math.sqrt(2.0)
    start = F.struct(x.alias("term"), x.alias("total"))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(NORMAL_TERMS)),
        start,
        lambda s, k: F.struct(
            (s["term"] * 2.0 * x * x / (2.0 * k + 1.0)).alias("term"),
            (s["total"] + s["term"] * 2.0 * x * x / (2.0 * k + 1.0)).alias("total"),
        ),
        lambda s: 1.0 - s["total"] * F.exp(-x * x) * (2.0 / math.sqrt(math.pi)),
    )
    tail = F.exp(-x * x) / (x * math.sqrt(math.pi)) * (1.0 - 1.0 / (2.0 * x * x) + 3.0 / (4.0 * x * x * x * x))
    return F.when(x > 5.0, tail).otherwise(F.greatest(series, F.lit(0.0)))


def lerp(low: Column, high: Column, weight: Column) -> Column:
    """Linear interpolation, anchored at the nearer end so that weight 1 gives ``high`` exactly."""
    gap = high - low
    return F.when(weight >= 0.5, high - gap * (1 - weight)).otherwise(low + gap * weight)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, null for an empty whole."""
    return F.when(whole != 0, part.cast("double") / whole)
