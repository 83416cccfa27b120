"""Number expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from .base import Col, as_list, col


def safe_ratio(a: Col, b: Col) -> Column:
    """a / b, and 0 when b is 0 or either side is missing."""
    return F.coalesce(F.try_divide(col(a).cast("double"), col(b).cast("double")), F.lit(0.0))


def sum_cols(cols) -> Column:
    return reduce(lambda a, b: a + b, [col(c) for c in as_list(cols)])


def fill(c: Col, value="other") -> Column:
    return F.coalesce(col(c), F.lit(value))


def pct(c: Col, q: float) -> Column:
    """Percentile with linear interpolation, as an aggregate.

    It keeps the distinct values of a group in memory; for groups with many distinct values use
    ``operators.ordered.exact_quantiles``.
    """
    return F.percentile(col(c), F.lit(q))
