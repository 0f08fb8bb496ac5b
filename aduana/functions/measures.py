"""Arithmetic of the reports: calendar, ratios, weighted means, bands."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(year: str | Column, month: str | Column) -> Column:
    return F.make_date(_col(year), _col(month), F.lit(1))


def from_epoch_ms(c: str | Column) -> Column:
    return F.timestamp_millis(_col(c))


def days_since(opened: str | Column, as_of: dt.date) -> Column:
    """Whole days up to `as_of`; reports name their date, none reads the clock."""
    return F.date_diff(F.lit(as_of), _col(opened))


def ratio(num: str | Column, den: str | Column, digits: int) -> Column:
    """num / den rounded half up, null on a zero or null denominator."""
    return F.round(F.try_divide(_col(num).cast("double"), _col(den).cast("double")), digits)


def percent(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(_col(num).cast("double"), _col(den).cast("double")) * 100, digits)


def percent_change(now: str | Column, before: str | Column, digits: int = 2) -> Column:
    return percent(_col(now) - _col(before), before, digits)


def mean_years(total_days: str | Column, n: str | Column, days_per_year: float, digits: int) -> Column:
    """Mean age from a day total and a count, the two parts that can be pre-aggregated.

    Divided as decimals, so a mean that lies exactly between two figures is rounded up.
    """
    days = _col(n).cast("decimal(18,0)") * F.lit(Decimal(str(days_per_year)))
    return rounded(F.try_divide(_col(total_days).cast("decimal(20,0)"), days), digits)


def rounded(c: Column, digits: int) -> Column:
    return F.round(c, digits).cast("double")


def weighted_mean(mean: str | Column, n: str | Column) -> Column:
    """Aggregate: sum(mean * n) / sum(n) as a decimal, null when the weights add up to zero.

    The means are rounded figures, so they are summed as exact decimals and the result does not
    depend on the order in which partitions arrive.
    """
    exact = F.sum(_col(mean).cast("decimal(12,2)") * _col(n))
    return F.try_divide(exact, F.sum(_col(n)).cast("decimal(20,0)"))


# Lower bound in years and label of each maturity band, oldest first.
MATURITY_BANDS = [
    (20, "Setor Maduro (20+ anos)"),
    (10, "Setor Estabelecido (10-20 anos)"),
    (5, "Setor Emergente (5-10 anos)"),
]
YOUNGEST_BAND = "Setor Novo (< 5 anos)"


def maturity_band(years: Column) -> Column:
    """Band of an unrounded mean age; an unknown age falls in the youngest band."""
    (bound, label), *rest = MATURITY_BANDS
    banded = F.when(years >= bound, label)
    for bound, label in rest:
        banded = banded.when(years >= bound, label)
    return banded.otherwise(YOUNGEST_BAND)
