"""Error measures as aggregate expressions and the normal quantile."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, functions as F


def rmse(label: Column, prediction: Column) -> Column:
    return F.sqrt(F.avg((prediction - label) * (prediction - label)))


def r2(label: Column, prediction: Column) -> Column:
    """One minus residual over total sum of squares; null for fewer than two rows.

    A constant label counts as 1 when it is hit exactly and as 0 otherwise. Rows
    count where both are there.
    """
    miss = F.avg((prediction - label) * (prediction - label))
    spread = F.var_pop(F.when(prediction.isNotNull(), label))
    return F.when(
        F.count(prediction - label) >= 2,
        F.when(spread > 0, 1 - miss / spread).otherwise(F.when(miss == 0, 1.0).otherwise(0.0)),
    )


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation over rows with both; null where one does not vary.

    ``F.corr`` divides by the spread and fails on a constant under ANSI rules.
    ``F.regr_r2`` does not: for a constant it is null or 1, with no covariance.
    """
    together, share = F.covar_pop(a, b), F.regr_r2(a, b)
    return F.when(together != 0, F.signum(together) * F.sqrt(share)).when(share == 0, 0.0)


def r2_corr(label: Column, prediction: Column) -> Column:
    """Squared correlation."""
    return F.pow(correlation(label, prediction), F.lit(2.0))


# Published coefficients of Acklam's rational approximation to the
# inverse normal distribution (relative error below 1.2e-9).
_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
      1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
      6.680131188771972e+01, -1.328068155288572e+01, 1.0)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
      -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
      3.754408661907416e+00, 1.0)
_TAIL = 0.02425


def _poly(coefficients, x: Column) -> Column:
    return reduce(lambda acc, c: acc * x + F.lit(c), coefficients[1:], F.lit(coefficients[0]))


def probit(p: Column) -> Column:
    """Inverse of the standard normal distribution function."""
    q = p - F.lit(0.5)
    middle = q * _poly(_A, q * q) / _poly(_B, q * q)
    low = F.sqrt(F.lit(-2.0) * F.ln(p))
    high = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - p))
    return (
        F.when((p <= 0) | (p >= 1), F.lit(None).cast("double"))
        .when(p < _TAIL, _poly(_C, low) / _poly(_D, low))
        .when(p > 1 - _TAIL, -(_poly(_C, high) / _poly(_D, high)))
        .otherwise(middle)
    )


def order_statistic_median(i: Column, n: int) -> Column:
    """Filliben's estimate of the median of the i-th of n uniform order statistics."""
    last = math.pow(0.5, 1.0 / n)
    return (
        F.when(i == n, F.lit(last))
        .when(i == 1, F.lit(1.0 - last))
        .otherwise((i - F.lit(0.3175)) / F.lit(n + 0.365))
    )
