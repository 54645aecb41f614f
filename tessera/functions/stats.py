"""Statistical column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Chebyshev fit of ln(erfc(x) exp(x^2) / t) in t = 1 / (1 + x/2)
# (relative error of erfc below 1.2e-7 for every x >= 0), constant term first.
ERFC_CHEBYSHEV = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
                  0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def erfc_pos(x: Column) -> Column:
    """erfc(x) for x >= 0; the error is relative, so small tails keep their digits."""
    t = 1.0 / (1.0 + 0.5 * x)
    poly = F.lit(ERFC_CHEBYSHEV[-1])
    for c in reversed(ERFC_CHEBYSHEV[:-1]):
        poly = c + t * poly
    return t * F.exp(-x * x + poly)


def two_sided_p(z: Column) -> Column:
    """Two-sided normal tail probability of a z statistic."""
    return erfc_pos(F.abs(z) / F.sqrt(F.lit(2.0)))


def two_sided_p_sql(z: str) -> str:
    """Same formula as SQL text (for oracle queries)."""
    x = f"(abs({z}) / sqrt(2.0))"
    t = f"(1.0 / (1.0 + 0.5 * {x}))"
    poly = str(ERFC_CHEBYSHEV[-1])
    for c in reversed(ERFC_CHEBYSHEV[:-1]):
        poly = f"({c} + {t} * {poly})"
    return f"({t} * exp(-{x} * {x} + {poly}))"


def modified_z(x, median, mad) -> Column:
    """0.6745 * (x - median) / MAD."""
    xc = F.col(x) if isinstance(x, str) else x
    return F.lit(0.6745) * (xc - median) / mad
