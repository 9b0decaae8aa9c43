"""Power and other value transforms with known parameters, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statloom.functions.coerce import column


def _scaled_power(log_value: Column, lam: float) -> Column:
    """(v**lam - 1) / lam written through log v, which stays exact as lam nears 0."""
    return log_value if lam == 0 else F.expm1(log_value * lam) / lam


def box_cox(c: Column | str, lam: float) -> Column:
    """Box-Cox transform; null where the value is not positive."""
    c = column(c)
    return F.when(c > 0, _scaled_power(F.log(c), lam))


def inverse_box_cox(c: Column | str, lam: float) -> Column:
    """Back-transform; null where no original value exists."""
    c = column(c)
    if lam == 0:
        return F.exp(c)
    base = c * lam + 1.0
    return F.when(base > 0, F.pow(base, F.lit(1.0 / lam)))


def yeo_johnson(c: Column | str, lam: float) -> Column:
    """Yeo-Johnson transform for values of any sign."""
    c = column(c)
    return F.when(c >= 0, _scaled_power(F.log1p(c), lam)).when(
        c < 0, -_scaled_power(F.log1p(-c), 2.0 - lam)
    )


def natural_log(c: Column | str) -> Column:
    c = column(c)
    return F.when(c > 0, F.log(c))


def square_root(c: Column | str) -> Column:
    c = column(c)
    return F.when(c >= 0, F.sqrt(c))


def inverse(c: Column | str) -> Column:
    return F.try_divide(F.lit(1.0), column(c))


def z_score(c: Column | str, mean: Column | float, std: Column | float) -> Column:
    """Standardised value; null when the spread is 0."""
    mean = mean if isinstance(mean, Column) else F.lit(mean)
    std = std if isinstance(std, Column) else F.lit(std)
    return F.try_divide(column(c) - mean, std)
