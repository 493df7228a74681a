"""Tail probabilities as native column expressions (Spark has no erf or incomplete gamma).

* ``erfc``: a power series near 0 and a continued fraction in the tail.
* ``chi2_sf``: upper tail of chi-square with integer dof k, a finite sum folded with ``aggregate(sequence(...))``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(x))


def erfc(x) -> Column:
    """Complementary error function, about 13 significant digits in either branch."""
    x = _c(x).cast("double")
    z = F.abs(x)
    gauss = F.exp(-z * z) / F.lit(math.sqrt(math.pi))
    # below 2: 1 - 2 z gauss * sum of (2 z^2)^n / (1 * 3 * ... * (2n + 1))
    near = F.aggregate(F.sequence(F.lit(1), F.lit(50)), F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")),
                       lambda a, n: F.struct((a["t"] * 2.0 * z * z / (n * 2 + 1)).alias("t"),
                                             (a["s"] + a["t"] * 2.0 * z * z / (n * 2 + 1)).alias("s")))["s"]
    # from 2 on: gauss / (z + (1/2) / (z + (2/2) / (z + (3/2) / ...))), from the inside out
    far = F.aggregate(F.sequence(F.lit(120), F.lit(1), F.lit(-1)), z, lambda a, k: z + k / 2 / a)
    ans = F.when(z < 2, F.lit(1.0) - 2.0 * z * gauss * near).otherwise(gauss / far)
    return F.when(x.isNull(), F.lit(None).cast("double")).when(x >= 0, ans).otherwise(F.lit(2.0) - ans)


def normal_two_sided_p(z) -> Column:
    """``2 * P(Z > z)`` clipped to [0, 1] (z already includes any continuity correction)."""
    z = _c(z)
    p = erfc(z / F.lit(math.sqrt(2.0)))
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))


def chi2_sf(x, k) -> Column:
    """P(X > x) for X ~ chi-square with integer dof ``k`` >= 1; NULL when x or k is NULL.

    k even: exp(-x/2) * sum_{i=0}^{k/2-1} (x/2)^i / i!
    k odd : erfc(sqrt(x/2)) + sum_{i=0}^{(k-3)/2} T_i,  T_0 = sqrt(2x/pi) exp(-x/2),  T_i = T_{i-1} * x / (2i+1)
    """
    x = _c(x).cast("double")
    k = _c(k).cast("int")
    half = x / F.lit(2.0)
    # even: terms t_i = t_{i-1} * (x/2) / i, t_0 = 1
    even_terms = F.aggregate(
        F.sequence(F.lit(0), F.greatest(k / 2 - 1, F.lit(0)).cast("int")),
        F.struct(F.lit(0.0).alias("t"), F.lit(0.0).alias("s")),
        lambda acc, i: F.struct(
            F.when(i == 0, F.lit(1.0)).otherwise(acc["t"] * half / i).alias("t"),
            (acc["s"] + F.when(i == 0, F.lit(1.0)).otherwise(acc["t"] * half / i)).alias("s"),
        ),
    )["s"]
    even = F.exp(-half) * even_terms
    t0 = F.sqrt(F.lit(2.0) * x / F.lit(math.pi)) * F.exp(-half)
    odd_terms = F.aggregate(
        F.sequence(F.lit(0), F.greatest((k - 3) / 2, F.lit(0)).cast("int")),
        F.struct(F.lit(0.0).alias("t"), F.lit(0.0).alias("s")),
        lambda acc, i: F.struct(
            F.when(i == 0, t0).otherwise(acc["t"] * x / (i * 2 + 1)).alias("t"),
            (acc["s"] + F.when(i == 0, t0).otherwise(acc["t"] * x / (i * 2 + 1))).alias("s"),
        ),
    )["s"]
    odd = erfc(F.sqrt(half)) + F.when(k >= 3, odd_terms).otherwise(F.lit(0.0))
    res = F.when(x.isNull() | k.isNull() | (k < 1), F.lit(None).cast("double")) \
        .when(x <= 0, F.lit(1.0)) \
        .when(k % 2 == 0, even).otherwise(odd)
    return F.least(F.greatest(res, F.lit(0.0)), F.lit(1.0))


def mwu_exact_p(u: Column, n1: Column, n2: Column) -> Column:
    """Two-sided p of Mann-Whitney's U without ties: twice the share of arrangements with U of at most the smaller.

    The number of arrangements with U = k is that of partitions of k into at most m parts of at most j, grown from
    j = 0 to the larger group: p(i, j, k) = p(i, j - 1, k) + p(i - 1, j, k - j). The fold keeps, for every i up to the
    smaller group's size m, the counts for k up to U.
    """
    m, most = F.least(n1, n2).cast("int"), F.greatest(n1, n2).cast("int")
    low = F.least(u, n1 * n2 - u).cast("int")
    start = F.concat(F.array(F.lit(1.0)), F.array_repeat(F.lit(0.0), low))

    def moved(a: Column, j: Column) -> Column:
        return F.slice(F.concat(F.array_repeat(F.lit(0.0), j), a), F.lit(1), low + 1)

    def grown(state: Column, j: Column) -> Column:
        return F.aggregate(F.slice(state, F.lit(2), m), F.slice(state, 1, 1), lambda done, own: F.concat(done, F.array(
            F.zip_with(own, moved(F.element_at(done, -1), j), lambda x, y: x + y))))
    counts = F.aggregate(F.sequence(F.lit(1), most), F.array_repeat(start, m + 1), grown)
    within = F.aggregate(F.element_at(counts, -1), F.lit(0.0), lambda s, x: s + x)
    arrangements = F.aggregate(F.sequence(F.lit(1), m), F.lit(1.0), lambda c, i: c * (most + i) / i)
    return F.least(F.lit(1.0), 2.0 * within / arrangements)
