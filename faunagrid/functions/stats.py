"""Expressions for diversity statistics."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHIFT = 8
#: Coefficients of Stirling's series for ln gamma, of 1/z, 1/z^3, and so on.
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680)


def lgamma(x: Column) -> Column:
    """ln gamma for x > 0: Stirling's series at x + 8, less the logarithm of x (x + 1) ... (x + 7)."""
    x = x.cast("double")
    z = x + _SHIFT
    series = sum((F.lit(c) / F.pow(z, F.lit(float(2 * i + 1))) for i, c in enumerate(_STIRLING)), F.lit(0.0))
    below = reduce(lambda a, b: a * b, (x + i for i in range(_SHIFT)))
    return (z - 0.5) * F.log(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + series - F.log(below)


def missed(n: Column, ni: Column, m: float) -> Column:
    """C(n - ni, m) / C(n, m): the share of samples of m records without the species.

    The same as C(n - m, ni) / C(n, ni), so that the product has as many factors as the smaller of m and ni.
    """
    if float(m).is_integer() and m >= 0:
        fewer = (ni < int(m)) & (F.floor(ni) == ni)
        factors = F.when(fewer, ni).otherwise(F.lit(int(m))).cast("int")
        left = n - F.when(fewer, F.lit(int(m))).otherwise(ni)
        product = F.aggregate(F.sequence(F.lit(0), factors - 1), F.lit(1.0), lambda done, k: done * ((left - k).cast("double") / (n - k)))
        return F.when(factors > 0, product).otherwise(1.0)
    return F.exp(lgamma(n - ni + 1) + lgamma(n - m + 1) - lgamma(n - ni - m + 1) - lgamma(n + 1))


def es_term(n: Column, ni: Column, m: float) -> Column:
    """A species' share in the expected number of species among m of the n records of its cell."""
    return F.when(n - ni >= m, 1 - missed(n, ni, m)).when(n >= m, F.lit(1.0))


def entropy_term(p: Column) -> Column:
    """-p ln p, 0 for p = 0."""
    return F.when(p > 0, -p * F.log(p)).otherwise(F.when(p == 0, F.lit(0.0)))
