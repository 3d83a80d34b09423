"""NULL rules that differ from SQL's defaults, as column expressions and aggregates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_member(c: ColumnOrName, values: Sequence) -> Column:
    """Membership that is never NULL: a NULL is simply not in the list."""
    return F.coalesce(as_col(c).isin(list(values)), F.lit(False))


def if_else(condition: Column, yes: Column, no: Column) -> Column:
    """Three-valued choice: an unknown condition gives NULL instead of falling through to `no`."""
    return F.when(condition, yes).when(~condition, no)


def strict(aggregate: Callable[[Column], Column], c: ColumnOrName) -> Column:
    """An aggregate that is NULL as soon as one input is NULL."""
    col = as_col(c)
    return F.when(F.count(col) == F.count(F.lit(1)), aggregate(col))


def count_values(c: ColumnOrName) -> Column:
    return F.count(as_col(c))


def count_missing(c: ColumnOrName) -> Column:
    return F.count_if(as_col(c).isNull())


def n_unique(c: ColumnOrName) -> Column:
    """Number of different values with NULL counted as one of them."""
    col = as_col(c)
    return F.count_distinct(col) + F.max(col.isNull().cast("int"))


def n_unique_few(c: ColumnOrName) -> Column:
    """`n_unique` for a column whose domain is small by nature (years, months): no second shuffle."""
    col = as_col(c)
    return F.size(F.collect_set(col)) + F.max(col.isNull().cast("int"))


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """part / whole * 100, NULL where there is no whole; `digits` rounds half to even."""
    value = F.try_divide(part, whole) * 100
    return value if digits is None else F.bround(value, digits)


def recode(c: ColumnOrName, mapping: Mapping[str, str], default: Column | None = None) -> Column:
    """Replace listed values; others keep their value, or get `default` when one is given."""
    col = as_col(c)
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    found = F.create_map(*pairs)[col]
    return F.coalesce(found, col if default is None else default)
