"""Missing-value and division rules.

Inside the engine missing is NULL; NaN and infinities are removed at the edge.
Every division is guarded, because ANSI mode raises on a zero divisor.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-9


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    return F.when(~F.isnan(_c(c)), _c(c))


def finite(c) -> Column:
    """NaN and both infinities become NULL."""
    c = _c(c).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(math.inf)), c)


def to_number(c) -> Column:
    """Text to double; what does not parse becomes NULL."""
    return finite(_c(c).try_cast("double"))


def nonzero(c) -> Column:
    return F.when(_c(c) != 0, _c(c))


def safe_div_eps(a, b, eps: float = EPS) -> Column:
    """a / (b + eps), with b = 0 as missing; eps is added, it is no guard."""
    return _c(a) / F.nullif(nonzero(b) + F.lit(eps), F.lit(0.0))


def safe_div_guard(a, b, least: float = 1e-12) -> Column:
    """a / b where \\|b\\| > least, else NULL."""
    return F.when(F.abs(_c(b)) > least, _c(a) / _c(b))


def ieee_div(a, b) -> Column:
    """a / b of doubles as IEEE has it: a zero divisor gives NaN or an infinity, whose sign heeds that of the zero; NULL stays NULL."""
    a, b = _c(a).cast("double"), _c(b).cast("double")
    return F.when(b == 0, a * F.pow(b, F.lit(-1.0))).otherwise(a / b)


def cv_ratio(std, mean) -> Column:
    """std / max(\\|mean\\|, 1e-9)."""
    return _c(std) / F.greatest(F.abs(_c(mean)), F.lit(EPS))


def null_max(c, bound: float) -> Column:
    """The greater of a column and a bound; NULL stays NULL."""
    return F.when(_c(c).isNotNull(), F.greatest(_c(c), F.lit(bound)))


def null_min(c, bound: float) -> Column:
    return F.when(_c(c).isNotNull(), F.least(_c(c), F.lit(bound)))


def clip(c, low: float, high: float) -> Column:
    return null_min(null_max(c, low), high)


def is_true(condition: Column) -> Column:
    """A comparison with a missing value counts as False."""
    return F.coalesce(condition, F.lit(False))


def log_nonzero(c) -> Column:
    """ln of the value; zero, negative and missing give NULL."""
    return F.log(nonzero(_c(c).cast("double")))
