"""Mass flux: concentration times same-day flow, in the current and the earlier definitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugewise.fixed_values import COUNT_UNIT, COUNT_VARIABLE, FLUX_UNITS
from gaugewise.functions.rules import as_col


def flux_unit(unit: str | Column) -> Column:
    u = as_col(unit)
    return F.when(u == COUNT_UNIT, F.lit("No/s")).when(u.isNotNull(), F.lit("mg/s"))


def has_flux(flow: str = "daily_flow_cms", unit: str = "unit_code") -> Column:
    """Whether a row has flow and a unit that allows a flux."""
    return F.col(flow).isNotNull() & F.col(unit).isin(list(FLUX_UNITS))


def flux(
    df: DataFrame, value: str = "measurement_value", flow: str = "daily_flow_cms", unit: str = "unit_code"
) -> DataFrame:
    """Flux per second for rows with flow and a unit that allows it.

    `value` becomes the flux and `unit` its unit; the concentration and its unit move to `conc` and
    `conc_unit`.
    """
    factor = F.when(F.col(unit) == COUNT_UNIT, F.lit(10)).otherwise(F.lit(1))
    return (
        df.where(has_flux(flow, unit))
        .withColumns({"conc": F.col(value), "conc_unit": F.col(unit), "volume_conversion_factor": factor})
        .withColumns(
            {
                value: F.col("conc") * F.col("volume_conversion_factor") * 1000 * F.col(flow),
                unit: flux_unit("conc_unit"),
            }
        )
    )


# Earlier definitions as (mass factor, count factor, mass unit, count unit, value column);
# flux = value * factor * flow * seconds per day.
DAILY_FLUX = {
    "kg_per_day": (0.001, 10 * 1000 / 1e6, "kg/d", "mio No/d", "measurement_max_dl_sub"),
    "first_draft": (0.001, 0.1 * 0.001, "mg/d", "No/d", "measurement_value"),
}
SECONDS_PER_DAY = 86400


def daily_flux(
    df: DataFrame,
    variables: Sequence[str],
    definition: str = "kg_per_day",
    count_variable: str = COUNT_VARIABLE,
    flow: str = "daily_flow_cms",
) -> DataFrame:
    """Add `flux` and `flux_unit` per day; rows of other variables get NULL, no row is lost or repeated."""
    mass, count, mass_unit, count_unit, value = DAILY_FLUX[definition]
    is_count = F.col("variable_name") == count_variable
    included = F.col("variable_name").isin(list(variables))
    factor = F.when(is_count, F.lit(count)).otherwise(F.lit(mass))
    return df.withColumns(
        {
            "flux": F.when(included | is_count, F.col(value) * factor * (F.col(flow) * SECONDS_PER_DAY)),
            "flux_unit": F.when(is_count, F.lit(count_unit)).when(included, F.lit(mass_unit)),
        }
    )
