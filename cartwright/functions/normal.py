"""Normal distribution as native column expressions.

Hart's rational approximation with a continued-fraction tail is good to about 1e-14 and stays inside code generation.
Quantiles are only ever needed at fixed probabilities, so they come from ``statistics.NormalDist`` as literals.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hart's coefficients, highest power first.
_HART_NUM = (
    3.52624965998911e-02,
    0.700383064443688,
    6.37396220353165,
    33.912866078383,
    112.079291497871,
    221.213596169931,
    220.206867912376,
)
_HART_DEN = (
    8.83883476483184e-02,
    1.75566716318264,
    16.064177579207,
    86.7807322029461,
    296.564248779674,
    637.333633378831,
    793.826512519948,
    440.413735824752,
)
SQRT_2PI = 2.5066282746310002


def _horner(x: Column, coefficients: tuple[float, ...]) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def norm_sf_abs(z: Column) -> Column:
    """Upper tail of the standard normal at |z|."""
    a = F.abs(z)
    e = F.exp(-a * a / 2)
    central = e * _horner(a, _HART_NUM) / _horner(a, _HART_DEN)
    tail = a + 0.65
    for k in (4.0, 3.0, 2.0, 1.0):
        tail = a + F.lit(k) / tail
    return (
        F.when(a > 37, F.lit(0.0))
        .when(a < 7.07106781186547, central)
        .otherwise(e / (tail * SQRT_2PI))
    )


def norm_cdf(z: Column) -> Column:
    tail = norm_sf_abs(z)
    return F.when(z > 0, 1 - tail).otherwise(tail)


def two_sided_p(z: Column) -> Column:
    return 2 * norm_sf_abs(z)


def z_quantile(p: float) -> float:
    """Standard normal quantile of a fixed probability."""
    return NormalDist().inv_cdf(p)
