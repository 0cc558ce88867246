"""Column functions shared by the operators."""

from cartwright.functions.scalars import (
    attach_row,
    elapsed_days,
    exact_avg,
    exact_sum,
    month_index,
    percent,
    ratio,
    surrogate_key,
)
from cartwright.functions.normal import norm_cdf, two_sided_p, z_quantile

__all__ = [
    "attach_row",
    "elapsed_days",
    "exact_avg",
    "exact_sum",
    "month_index",
    "norm_cdf",
    "percent",
    "ratio",
    "surrogate_key",
    "two_sided_p",
    "z_quantile",
]
