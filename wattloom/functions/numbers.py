"""Rounding that does not depend on how a sum was split between tasks."""

from pyspark.sql import Column, functions as F


def steady_round(col: Column | str, digits: int) -> Column:
    """Round half up, after removing the last-bits noise that the order of a sum leaves.

    Without the first step a mean of exactly 24.69375 comes out as 24.6937 or 24.6938 depending
    on the partitions it was summed in.
    """
    return F.round(F.round(col, digits + 6), digits)


def pearson(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over the pairs where both sides are known; NULL if a side is constant.

    Written out because ``corr`` divides by zero on a constant column, an error under ANSI rules.
    """
    x, y = (F.col(c).cast("double") if isinstance(c, str) else c for c in (x, y))
    spread = (F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y)))
    return F.try_divide(F.covar_pop(x, y), spread)
