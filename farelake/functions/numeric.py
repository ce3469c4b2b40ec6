"""Sums of doubles that do not depend on the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LAST_BITS = 1e-14
# Whole numbers below this are exact as doubles.
_MOST_UNITS = 1 << 53


def exact_parts(value: str | Column, places: int = 4) -> tuple[Column, Column]:
    """Two aggregates whose sums over any parts of the rows give :func:`exact_sum`.

    The first counts units of ``10**-places`` as a bigint, exact in any order; the second
    adds up the values that are no multiple of it. Either is null where there are none.
    """
    col = F.col(value) if isinstance(value, str) else value
    scale = F.lit(float(10**places))
    counted = F.rint(col * scale).try_cast("bigint")
    near = F.abs(counted / scale - col) <= F.abs(col) * _LAST_BITS
    multiple = F.coalesce(near & (F.abs(counted) < _MOST_UNITS), F.lit(False))
    units = F.when(multiple, counted)
    too_large = F.raise_error(F.lit("a sum of exact units is beyond a bigint")).cast("bigint")
    total = F.coalesce(F.try_sum(units), F.when(F.count(units) > 0, too_large))
    return total, F.sum(F.when(~multiple, col))


def exact_total(units: Column, rest: Column, places: int = 4) -> Column:
    """The sum that two parts stand for."""
    scale = F.lit(float(10**places))
    return F.when(units.isNull(), rest).otherwise(units / scale + F.coalesce(rest, F.lit(0.0)))


def exact_sum(value: str | Column, places: int = 4) -> Column:
    """Sum of a double column, exact when every value has at most ``places`` decimals.

    A plain ``sum`` of doubles depends on how rows were split into tasks, so a
    retried or re-partitioned run of a very large month can differ in the cents.
    Here each value that is a multiple of ``10**-places``, up to the last bits of a
    double, is counted in such units as a bigint; their total is exact in any order.
    Values that are no multiple (a third of a cent, NaN, infinity) or have 2**53 units
    are summed apart as doubles and added to it. A total beyond a bigint stops the
    query. Only primitive types are used, so the aggregate stays in generated code.
    """
    return exact_total(*exact_parts(value, places), places)


def exact_avg(value: str | Column, places: int = 4) -> Column:
    """Mean of a double column over :func:`exact_sum`; null when there are no values."""
    present = F.count(value)
    return F.when(present > 0, exact_sum(value, places) / present)
