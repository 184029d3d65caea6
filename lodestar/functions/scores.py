"""Statistics as column expressions over counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def chi2_score(a: Column, b: Column, c: Column, d: Column, n: Column | None = None) -> Column:
    """χ² of a 2×2 table (a: both, b: term only, c: category only, d: neither).

    In double, without the constant factor ``n`` unless it is given. A zero
    denominator gives null.
    """
    a, b, c, d = (x.cast("double") for x in (a, b, c, d))
    cross = a * d - b * c
    score = F.try_divide(cross * cross, (a + b) * (a + c) * (b + d) * (c + d))
    return score if n is None else score * n


def inverse_doc_freq(n_docs: Column, doc_freq: Column) -> Column:
    """Smoothed inverse document frequency, ln((N + 1) / (df + 1))."""
    return F.log((n_docs + 1) / (doc_freq + 1))


def equality_selectivity(ndv: Column) -> Column:
    return F.try_divide(F.lit(1.0), ndv)


def inequality_selectivity(ndv: Column) -> Column:
    return F.lit(1.0) - equality_selectivity(ndv)


def join_selectivity(left_ndv: Column, right_ndv: Column) -> Column:
    return F.try_divide(F.lit(1.0), F.greatest(left_ndv, right_ndv))


def or_selectivity(x: Column, y: Column) -> Column:
    """Upper bound for a disjunction of conditions whose interaction is unknown."""
    return F.least(x + y, F.lit(1.0))


def ln_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x > 0: Stirling's series eight places up."""
    y = x + 8.0
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)
    product = reduce(lambda value, k: value * (x + float(k)), range(1, 8), x)
    # fixed value: half the logarithm of 2 pi
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - F.log(product)


def chi2_log_p(chi2: Column, dof: Column) -> Column:
    """Natural logarithm of the p-value of a χ² statistic with ``dof`` degrees of freedom.

    The upper regularised incomplete gamma function Q(dof / 2, chi2 / 2): above the mean by its
    continued fraction, evaluated from the end and kept in logarithms because p underflows; below by
    one less the series of the lower function. Steps grow with the root of ``dof``, in line with
    convergence near the mean. Null for a null argument or no degree of freedom.
    """
    a, x = dof.cast("double") / 2, chi2 / 2
    steps = (F.lit(80) + 12 * F.sqrt(a)).cast("int")
    weight = a * F.log(x) - x
    fraction = F.aggregate(F.sequence(steps, F.lit(1), F.lit(-1)), x + 2.0 * steps + 1 - a,
                           lambda f, i: x + 2.0 * i - 1 - a - i * (i - a) / f)
    upper = weight - ln_gamma(a) - F.log(fraction)
    terms = F.aggregate(
        F.sequence(F.lit(1), steps), F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda s, i: F.struct((s["term"] * x / (a + i)).alias("term"),
                              (s["sum"] + s["term"] * x / (a + i)).alias("sum")), lambda s: s["sum"])
    lower = F.log1p(-F.least(F.exp(weight - ln_gamma(a + 1.0)) * terms, F.lit(1.0)))
    return F.when(dof <= 0, F.lit(None)).when(x <= 0, F.lit(0.0)).when(x > a + 1, upper).otherwise(lower)
