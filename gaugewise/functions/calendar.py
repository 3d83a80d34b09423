"""Calendar rules: parsing, water year and month, the season definitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugewise.fixed_values import SEASONS
from gaugewise.functions.rules import ColumnOrName, as_col


def parse_time(c: ColumnOrName, pattern: str) -> Column:
    """Text to a zone-free timestamp; NULL where the text does not fit the pattern."""
    return F.try_to_timestamp(as_col(c), F.lit(pattern)).cast("timestamp_ntz")


def parse_date(c: ColumnOrName, pattern: str) -> Column:
    return F.to_date(parse_time(c, pattern))


def season(date: ColumnOrName, definition: str) -> Column:
    """Season by month under one of the named definitions in `SEASONS`."""
    month = F.month(as_col(date))
    groups, other = SEASONS[definition]
    result = None
    for name, first, last in groups:
        test = month.between(first, last)
        result = F.when(test, F.lit(name)) if result is None else result.when(test, F.lit(name))
    return result.when(month.isNotNull(), F.lit(other))


def water_year(date: ColumnOrName, first_month: int = 11) -> Column:
    d = as_col(date)
    return F.year(d) + (F.month(d) >= first_month).cast("int")


def water_month(date: ColumnOrName, value: ColumnOrName) -> Column:
    """October = 1 .. September = 12, only where a value was observed."""
    return F.when(as_col(value).isNotNull(), (F.month(as_col(date)) + 2) % 12 + 1)


def month_start(date: ColumnOrName) -> Column:
    return F.trunc(as_col(date), "MM")


def month_label(date: ColumnOrName) -> Column:
    return F.date_format(as_col(date), "MMM")


def year_start(year: ColumnOrName) -> Column:
    return F.make_date(as_col(year), F.lit(1), F.lit(1))


def span_days(first: ColumnOrName, last: ColumnOrName) -> Column:
    """Calendar days from `first` to `last`, both included."""
    return F.datediff(as_col(last), as_col(first)) + 1
