"""A total derived from two components that are reported as text, some of them censored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewise.functions.rules import as_col
from gaugewise.functions.text import censored_flag, censored_number, to_number
from gaugewise.operators.lookups import join_same


def pivot_components(
    df: DataFrame, ids: Sequence[str], name: str, value: str, components: Sequence[str]
) -> DataFrame:
    """One column per component, as text; a sample that reports one twice keeps its greatest number.

    Texts are compared by the number they hold, a text without one (a censored result) counts as less than any
    number, and equal numbers go by text. `repeated_components` lists such samples.
    """
    keep = df.where(F.col(name).isin(list(components)))
    greatest = F.max_by(value, F.struct(to_number(value).alias("number"), F.col(value).alias("text")))
    return keep.groupBy(*ids).pivot(name, list(components)).agg(greatest)


def repeated_components(
    df: DataFrame, ids: Sequence[str], name: str, value: str, components: Sequence[str]
) -> DataFrame:
    """Samples that report a component more than once: how often, and the least and greatest number."""
    number = to_number(value)
    keep = df.where(F.col(name).isin(list(components))).groupBy(*ids, name)
    found = keep.agg(F.count(F.lit(1)).alias("n_reports"), F.min(number).alias("least"), F.max(number).alias("greatest"))
    return found.where("n_reports > 1")


def with_component_total(wide: DataFrame, components: Sequence[str], total: str) -> DataFrame:
    """Add the sum of the numeric components; a missing or censored part counts 0, an all-zero sum is NULL."""
    parts = [F.coalesce(to_number(as_col(f"`{c}`")), F.lit(0.0)) for c in components]
    return wide.withColumn(total, F.nullif(sum(parts[1:], parts[0]), F.lit(0.0)))


def unpivot_components(
    wide: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """Back to one row per (sample, component), values as text."""
    text = wide.withColumns({c: F.col(f"`{c}`").cast("string") for c in columns})
    return text.unpivot(list(ids), [f"`{c}`" for c in columns], name, value).withColumn(
        name, F.regexp_replace(name, "`", "")
    )


def component_total(
    df: DataFrame,
    ids: Sequence[str],
    components: Sequence[str],
    total: str,
    name: str = "parameter",
    text: str = "formatted_result",
    number: str = "numeric_result",
    flag: str = "result_qualifier",
) -> DataFrame:
    """Component and total rows per sample, with number and flag taken from the text."""
    wide = with_component_total(pivot_components(df, ids, name, text, components), components, total)
    long = unpivot_components(wide, ids, [*components, total], name, text)
    return long.withColumns({flag: censored_flag(text), number: censored_number(text)})


def append_new_rows(df: DataFrame, extra: DataFrame) -> DataFrame:
    """Append the rows of `extra` that `df` does not hold yet, compared over the columns they share.

    Columns only `df` has are NULL in the appended rows.
    """
    shared = [c for c in extra.columns if c in df.columns]
    new = join_same(extra, df.select(*shared).distinct(), shared, "left_anti")
    return df.unionByName(new, allowMissingColumns=True)
