"""Price rules as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from offerloom.functions import special

_TINY = 1e-7


def price_rejected(low: Column, high: Column, price: Column, a: float = 1000.0, b: float = 400.0, c: float = 2.5) -> Column:
    """True if the price is so far outside the product's range that they can't be the same thing; false if it may be;
    null where a price is unknown or lies inside the range. The larger price may be a / (smaller + b) + c times the smaller."""
    near = F.when(price <= low, low).when(price >= high, high)
    small, large = F.least(near, price), F.greatest(near, price)
    return F.when(near.isNotNull() & price.isNotNull(), large / (small + _TINY) > F.lit(a) / (small + b) + c + _TINY)  # greatest() passes over nulls


def constant_outlier(low: Column, high: Column, price: Column, c: float = 1.25) -> Column:
    """0 for a price outside the range by more than a ratio of c, else 1; 1 where there is nothing to compare."""
    outlier = ((price < low) & (low / price > c)) | ((price > high) & (price / high > c))
    return F.when(outlier, 0).otherwise(1)


def bartlett_statistic(n: Column, mean: Column, m2: Column, price: Column) -> Column:
    """Bartlett's statistic for equal variances of a sample (size, mean, sum of squared deviations) and the sample with
    one price more. Null with fewer than two prices or where all are equal but for rounding."""
    m2_more = m2 + (price - mean) * (price - mean) * n / (n + 1)
    v1, v2 = m2 / (n - 1), m2_more / n
    free = 2 * n - 1
    pooled = (m2 + m2_more) / free
    top = free * F.log(pooled) - (n - 1) * F.log(v1) - n * F.log(v2)
    below = 1 + (1 / (n - 1) + 1 / n - 1 / free) / 3
    return F.when((n >= 2) & (m2 > 1e-9), top / below)


@F.pandas_udf(DoubleType())
def chi2_tail(t: pd.Series) -> pd.Series:
    """P(chi-square of one degree of freedom > t); Spark has no such function."""
    return pd.Series(special.chi2_one_tail(t.to_numpy(dtype="float64")))


def bartlett_p(n: Column, mean: Column, m2: Column, low: Column, high: Column, price: Column) -> Column:
    """The p-value of the test; 1 with too few prices, without variance, or inside the range."""
    inside = price.between(low, high)
    return F.when(inside, 1.0).otherwise(F.coalesce(F.nanvl(chi2_tail(bartlett_statistic(n, mean, m2, price)), F.lit(1.0)), F.lit(1.0)))
