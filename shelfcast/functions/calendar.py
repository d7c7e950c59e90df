"""Date expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position in a cycle, 6 places."""
    angle = value * F.lit(2 * math.pi) / period
    return F.round(F.sin(angle), 6), F.round(F.cos(angle), 6)


def week_start(date: str | Column) -> Column:
    """The Monday of the week."""
    return F.date_trunc("week", date).cast("date")


def easter(year: Column) -> Column:
    """Easter Sunday of a Gregorian year (the anonymous computus)."""
    def div(a: Column, b: int) -> Column:
        return F.floor(a / b)

    golden, century = year % 19, div(year, 100)
    skipped = div(century, 4)
    correction = div(century - div(century + 8, 25) + 1, 3)
    epact = (golden * 19 + century - skipped - correction + 15) % 30
    weekday = ((century % 4) * 2 + div(year % 100, 4) * 2 - epact - (year % 4) + 32) % 7
    late = div(golden + epact * 11 + weekday * 22, 451)
    count = epact + weekday - late * 7 + 114
    return F.make_date(year.cast("int"), div(count, 31).cast("int"), (count % 31 + 1).cast("int"))
