"""Text rules: censored results, titles, output keys."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugewise.fixed_values import FILE_NAME_REPLACEMENTS, TITLE_WITHOUT_UNIT
from gaugewise.functions.rules import ColumnOrName, as_col


def to_number(c: ColumnOrName) -> Column:
    """Text to double; anything that is not a number becomes NULL."""
    return as_col(c).try_cast("double")


def censored_number(c: ColumnOrName) -> Column:
    """The number inside a censored result such as `<0.05`."""
    return F.regexp_replace(as_col(c), "<", "").try_cast("double")


def censored_flag(c: ColumnOrName) -> Column:
    """`<` for a result that carries the mark, else NULL."""
    return F.when(as_col(c).contains("<"), F.lit("<"))


def snake_case(name: str) -> str:
    """A header as lower-case words joined by underscores."""
    split = re.sub(r"([a-z])([A-Z])", r"\1_\2", name.replace("%", "_percent_").replace("#", "_number_"))
    words = re.sub(r"[^0-9A-Za-z]+", "_", split).strip("_").lower()
    return f"x{words}" if words[:1].isdigit() else words


def panel_title(variable: ColumnOrName, unit: ColumnOrName, bare: Sequence[str] = TITLE_WITHOUT_UNIT) -> Column:
    """`VARIABLE (unit)`; the listed variables show their name alone."""
    v = as_col(variable)
    shown_unit = F.coalesce(as_col(unit), F.lit("NA"))
    return F.when(v.isin(list(bare)), v).otherwise(F.concat(v, F.lit(" ("), shown_unit, F.lit(")")))


def output_key(*words: ColumnOrName) -> Column:
    """Words joined by `_`, made safe for use as a file name."""

    def safe(word: ColumnOrName) -> Column:
        col = as_col(word)
        for old, new in FILE_NAME_REPLACEMENTS.items():
            col = F.replace(col, F.lit(old), F.lit(new))
        return col

    return F.concat_ws("_", *[safe(w) for w in words])
