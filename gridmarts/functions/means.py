"""Means that do not depend on the order in which rows are added up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_mean(scale: int = 5) -> Callable[[Column], Column]:
    """A drop-in for ``F.avg`` that sums in decimals of ``scale`` places.

    A double sum changes in its last bits with the partitioning. A decimal sum does
    not, so a rerun or a retried task gives the same mean. The terms must fit
    DECIMAL(18, scale) and are rounded to it; a NaN among them makes the mean NaN, as it does that of F.avg.
    """

    def mean(col: Column) -> Column:
        total = F.sum(F.when(~F.isnan(col.cast("double")), col).cast(f"decimal(18,{scale})")).cast("double")
        number = col.cast("double")
        return F.when(F.bool_or(F.isnan(number)), float("nan")).otherwise(F.try_divide(total, F.count(col)))

    return mean
