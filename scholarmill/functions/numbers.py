"""Log-scale arithmetic, intervals and the normal distribution as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formula 7.1.26 of Abramowitz and Stegun for the error function.
_ERF_P = 0.3275911
_ERF_TERMS = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, within 1e-7."""
    u = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1.0 / (1.0 + _ERF_P * u)
    poly = F.lit(0.0)
    for a in reversed(_ERF_TERMS):
        poly = (poly + a) * t
    erf = 1.0 - poly * F.exp(-u * u)
    return F.when(z >= 0, 0.5 * (1.0 + erf)).otherwise(0.5 * (1.0 - erf))


def normal_percentile(score: Column, mean: Column, std: Column) -> Column:
    """Share of a normal population below ``score``, in percent, kept within 0 and 100."""
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100.0 * normal_cdf((score - mean) / std)))


def raw_count(log_score: Column) -> Column:
    """Back from log1p to a count, which is never negative."""
    return F.greatest(F.lit(0.0), F.expm1(log_score))


def interval(log_score: Column, half_width: Column) -> tuple[Column, Column]:
    """Lower and upper bound on the log scale."""
    return log_score - half_width, log_score + half_width
