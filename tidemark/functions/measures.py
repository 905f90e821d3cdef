"""Sums and percentages that give the same answer on every run.

A sum of doubles depends on the order in which rows arrive; a sum of decimals does not. Values that a decimal holds
exactly are summed as decimal. All others (beyond 10**15, finer than eight digits, infinite, NaN) are
summed as doubles, as a plain sum would, so that none is cut or lost. The result is a double.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Sums of up to 10**15 such values stay within the 38 digits of a decimal.
EXACT = "decimal(23,8)"


def exact_part(column: str | Column) -> Column:
    """The value as a decimal that equals it; NULL if there is none."""
    column = F.col(column) if isinstance(column, str) else column
    exact = column.try_cast(EXACT)
    return F.when(exact.cast("double") == column.cast("double"), exact)


def rest_part(column: str | Column) -> Column:
    """The value as a double where ``exact_part`` has none."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(exact_part(column).isNull(), column.cast("double"))


def total(exact: Column, rest: Column) -> Column:
    """What the sums of both parts come to."""
    return plus(exact.cast("double"), rest)


def money_sum(column: str | Column) -> Column:
    return total(F.sum(exact_part(column)), F.sum(rest_part(column)))


def money_avg(column: str | Column) -> Column:
    return F.try_divide(money_sum(column), F.count(column))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``part`` as a rounded percentage of ``whole``; NULL where ``whole`` is zero."""
    return F.round(raw_percent(part, whole), digits)


def raw_percent(part: Column, whole: Column) -> Column:
    return part * F.lit(100.0) / F.nullif(whole, F.lit(0))


def plus(left: Column, right: Column) -> Column:
    """A sum in which one missing side counts as nothing, as in SUM."""
    return F.coalesce(left + right, left, right)
