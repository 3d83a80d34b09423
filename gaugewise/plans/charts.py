"""Chart-ready rows for every station and variable, one distributed job per chart type.

Nothing is drawn and no station is looped over: each function returns the rows of one chart type for all
stations at once, with an `output_key` that names the chart a row belongs to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugewise.fixed_values import (
    CONCENTRATION_PANELS,
    COUNT_VARIABLE,
    CUTOFF_YEAR,
    DETECTION_CONDITIONS,
    DRAFT_FLUX_VARIABLES,
    FLOW_PANEL,
    FLUX_PANELS,
    LINEAR_ONLY_VARIABLES,
    NON_FLUX_PANELS,
    PANEL_FIRST_DATE,
    SEASON_ORDER,
    TITLE_WITHOUT_UNIT,
    UNAVAILABLE,
)
from gaugewise.functions.calendar import year_start
from gaugewise.functions.rules import n_unique_few
from gaugewise.functions.scale import log10_or_null, scaled_value
from gaugewise.functions.text import output_key, panel_title
from gaugewise.operators.boxes import layers_of_counts, log10_counts, log_box_stats
from gaugewise.operators.conform import union_all
from gaugewise.operators.coverage import flow_series, missing_panels, period, stations_with_flow, task_grid, variables
from gaugewise.operators.distribution import KEY, regrouped, value_counts
from gaugewise.operators.flow import fill_days
from gaugewise.operators.flux import daily_flux, flux, has_flux
from gaugewise.operators.guidelines import guideline_bounds, overlay
from gaugewise.operators.lookups import join_same
from gaugewise.operators.ordering import category_rank
from gaugewise.operators.pairing import with_every
from gaugewise.operators.ranking import attach_ranks, ranks_of_counts, year_ranks

GROUP = ("station_name", "variable_name")


def year_window(obs: DataFrame) -> tuple[Column, Column]:
    """The year axis: one year beyond the data on either side, as scalar subqueries."""
    bounds = period(obs)
    return bounds.select(F.col("min_year") - 1).scalar(), bounds.select(F.col("max_year") + 1).scalar()


def ranked_rows(view: DataFrame, cutoff_year: int = CUTOFF_YEAR) -> DataFrame:
    """Rows with the rank and category of their year, per station and variable."""
    return attach_ranks(view, year_ranks(view, GROUP, cutoff_year=cutoff_year), GROUP)


def concentration_rows(
    view: DataFrame, cutoff_year: int = CUTOFF_YEAR, log10: bool = True,
    linear_only: Sequence[str] = LINEAR_ONLY_VARIABLES,
) -> DataFrame:
    """Results by year with rank category and the value on the chart's scale."""
    shown = scaled_value("measurement_value", "variable_name", linear_only) if log10 else F.col("measurement_value")
    suffix = "log_conc" if log10 else "conc"
    return ranked_rows(view, cutoff_year).withColumns(
        {"plotted_value": shown, "output_key": output_key("station_name", "variable_name", F.lit(suffix))}
    )


def yearly_layers(
    rows: DataFrame, cutoff_year: int = CUTOFF_YEAR, log10: bool = True,
    linear_only: Sequence[str] = LINEAR_ONLY_VARIABLES,
) -> DataFrame:
    """Box and outlier layers of the charts by year, filled by the year's rank.

    Ranks and boxes come from one count of the values by station, variable and year. On the log10 scale boxes are
    those of the logarithms; values that have none stay out of them, but not out of the ranks.
    """
    counts = value_counts(rows, [*GROUP, "year"], "measurement_value")
    listed = ", ".join("'" + name.replace("'", "\\'") + "'" for name in linear_only)
    linear = f"coalesce({KEY}.variable_name in ({listed}), false)" if listed else None
    scaled = log10_counts(counts, linear) if log10 else counts
    ranks = ranks_of_counts(counts, GROUP, cutoff_year=cutoff_year)
    layers = attach_ranks(layers_of_counts(scaled), ranks, GROUP).drop("median")
    of_box = F.col("layer") == "box"
    return layers.withColumns({c: F.when(of_box, F.col(c)) for c in ("perc_bin", "percentile")})


def concentration_layers(
    view: DataFrame, guidelines: DataFrame, cutoff_year: int = CUTOFF_YEAR,
    linear_only: Sequence[str] = LINEAR_ONLY_VARIABLES, log10: bool = True,
) -> DataFrame:
    """Box, outlier and guideline layers of the concentration charts in one table with a `layer` column."""
    units = view.select(*GROUP, "unit_code").distinct()
    lines = overlay(units, guideline_bounds(guidelines)).where("guideline_value is not null")
    return union_all(
        yearly_layers(view, cutoff_year, log10, linear_only),
        lines.select(*GROUP, "bound", F.col("guideline_value").alias("middle"), F.lit("guideline").alias("layer")),
    )


def flux_rows(view: DataFrame, cutoff_year: int = CUTOFF_YEAR, log10: bool = True) -> DataFrame:
    """Flux by year with the rank category of the year's flux, on the log10 or the linear scale."""
    shown = log10_or_null("measurement_value") if log10 else F.col("measurement_value")
    suffix = "log_flux" if log10 else "flux"
    return ranked_rows(flux(view), cutoff_year).withColumns(
        {"plotted_value": shown, "output_key": output_key("station_name", "variable_name", F.lit(suffix))}
    )


def flux_layers(view: DataFrame, cutoff_year: int = CUTOFF_YEAR, log10: bool = True) -> DataFrame:
    """Box and outlier layers of the flux charts, boxes with the rank category of their year."""
    return yearly_layers(flux(view), cutoff_year, log10, ())


def flux_boxes(view: DataFrame) -> DataFrame:
    return log_box_stats(flux(view), [*GROUP, "year"], "measurement_value")


def scatter_rows(view: DataFrame) -> DataFrame:
    """Single results with detection condition and season, in the order of their categories."""
    return view.select(
        *GROUP,
        "sample_date",
        "measurement_value",
        "detection_condition",
        category_rank("detection_condition", DETECTION_CONDITIONS).alias("detection_rank"),
        "season",
        category_rank("season", SEASON_ORDER).alias("season_rank"),
        F.concat("variable_name", F.lit(" ("), F.col("unit_code"), F.lit(")")).alias("axis_title"),
        output_key("station_name", "variable_name", F.lit("scatter")).alias("output_key"),
    )


def flow_rows(flow: DataFrame, obs: DataFrame) -> DataFrame:
    """Daily flow of the sampled stations with missing days as NULL, cut to the year axis of the observations."""
    first, last = year_window(obs)
    sampled = flow.join(stations_with_flow(obs, flow), "station_name", "left_semi")
    filled = fill_days(flow_series(sampled), ["station_name"], "sample_date")
    return filled.where(
        (F.col("sample_date") >= year_start(first)) & (F.col("sample_date") <= year_start(last))
    ).withColumn("output_key", output_key("station_name", F.lit("FLOW")))


def _panel_flow(flow: DataFrame, stations: DataFrame, last: Column) -> DataFrame:
    """The flow panel: every day of the common axis; days beyond it are not shown."""
    first = F.lit(PANEL_FIRST_DATE).cast("date")
    series = flow_series(flow).where(F.col("sample_date").between(first, last))
    days = stations.select(
        "station_name", F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("sample_date")
    )
    return join_same(days, series, ["station_name", "sample_date"]).withColumns(
        {"facet_title": F.lit(FLOW_PANEL), "year": F.year("sample_date")}
    )


def _panels(
    rows: DataFrame, flow: DataFrame, obs: DataFrame, panels: Sequence[str], non_flux: Sequence[str],
    one_year_keeps_dates: bool, cutoff_year: int, ending: str, bare_titles: Sequence[str],
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Layers result, box, outlier, flow, label and guideline of all panels.

    One count of the values by station, variable, panel and year gives the ranks, the boxes and outliers on the log10
    scale of the panels, the panels that exist and the years of a station; the rows are read once more for the results.
    """
    rows = rows.withColumn("facet_title", panel_title("variable_name", "unit_code", bare_titles))
    counts = value_counts(rows, [*GROUP, "facet_title", "year"], "measurement_value")
    ranks = ranks_of_counts(regrouped(counts, [*GROUP, "year"]), GROUP, cutoff_year=cutoff_year)
    first_day, last_day = F.lit(PANEL_FIRST_DATE).cast("date"), year_start(period(obs).select(F.col("max_year") + 1).scalar())
    results = rows.withColumn("layer", F.lit("result"))
    if one_year_keeps_dates:
        years = counts.groupBy(F.expr(f"{KEY}.station_name").alias("station_name"))
        years = years.agg(n_unique_few(F.expr(f"{KEY}.year")).alias("_years"))
        at_year = F.when(F.col("_years") > 1, year_start("year")).otherwise(F.col("sample_date"))
        results = join_same(results, years, ["station_name"]).withColumn("sample_date", at_year)
    else:
        results = results.withColumn("sample_date", year_start("year"))
    results = results.select(*GROUP, "facet_title", "year", "sample_date", "measurement_value", "layer")
    drawn = layers_of_counts(log10_counts(counts)).withColumn("sample_date", year_start("year"))
    shown = union_all(results, drawn).where(F.col("sample_date").between(first_day, last_day))
    ranked = F.col("layer") != "outlier"
    shown = attach_ranks(shown, ranks, GROUP).drop("median", "variable_name")
    shown = shown.withColumns({c: F.when(ranked, F.col(c)) for c in ("perc_bin", "percentile")})
    titles = counts.select(f"{KEY}.station_name", f"{KEY}.facet_title").distinct()
    stations = titles.select("station_name").distinct()
    daily = _panel_flow(flow, stations, last_day).select(
        "station_name", "facet_title", "sample_date", F.col("daily_flow_cms").alias("measurement_value"), "year",
        F.lit("flow").alias("layer"),
    )
    labels = missing_panels(titles, flow_series(flow), panels, non_flux).select(
        "station_name", "facet_title", "text", F.lit("label").alias("layer")
    )
    layers = [shown, daily, labels]
    if bounds is not None:
        lines = bounds.where(F.col("facet_title").isin(list(panels))).select(
            "facet_title", F.col("guideline_value").alias("measurement_value"), "bound", F.lit("guideline").alias("layer")
        )
        layers.append(with_every(stations, lines))  # every bound in every station's panels
    return union_all(*layers).withColumns(
        {
            "plotted_value": log10_or_null("measurement_value"),
            "facet_rank": category_rank("facet_title", panels),
            "output_key": output_key("station_name", F.lit(ending)),
        }
    )


def concentration_panels(
    view: DataFrame, flow: DataFrame, obs: DataFrame, guidelines: DataFrame,
    panels: Sequence[str] = CONCENTRATION_PANELS, cutoff_year: int = CUTOFF_YEAR,
    bare_titles: Sequence[str] = TITLE_WITHOUT_UNIT,
) -> DataFrame:
    """All panels of a station: results by year, daily flow, guideline lines, labels where data is missing.

    A station with results of a single year keeps their dates.
    """
    bounds = guideline_bounds(guidelines, bare_titles)
    return _panels(view, flow, obs, panels, (), True, cutoff_year, "log_conc", bare_titles, bounds)


def flux_panels(
    view: DataFrame, flow: DataFrame, obs: DataFrame, panels: Sequence[str] = FLUX_PANELS,
    non_flux: Sequence[str] = NON_FLUX_PANELS, cutoff_year: int = CUTOFF_YEAR,
    bare_titles: Sequence[str] = TITLE_WITHOUT_UNIT,
) -> DataFrame:
    rows = flux(view).where("measurement_value is not null")
    return _panels(rows, flow, obs, panels, non_flux, False, cutoff_year, "log_flux", bare_titles)


def chart_tasks(obs: DataFrame, view: DataFrame) -> DataFrame:
    """Every station with every variable: rows available for its chart, and the label where there are none."""
    counted = view.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n_results"), F.count("daily_flow_cms").alias("n_with_flow"), F.count_if(has_flux()).alias("n_flux")
    )
    return join_same(task_grid(obs), counted, list(GROUP)).select(
        *GROUP,
        F.coalesce("n_results", F.lit(0).cast("long")).alias("n_results"),
        F.coalesce("n_with_flow", F.lit(0).cast("long")).alias("n_with_flow"),
        F.when(F.col("n_results").isNull(), F.lit(UNAVAILABLE)).alias("concentration_label"),
        F.when(F.coalesce("n_flux", F.lit(0)) == 0, F.lit(UNAVAILABLE)).alias("flux_label"),
    )


def flux_tasks(obs: DataFrame, flow: DataFrame, view: DataFrame, count_variable: str = COUNT_VARIABLE) -> DataFrame:
    """Flux charts: stations that have flow and samples, with every variable measured as a concentration or counted.

    `n_flux` results make the chart; without any it shows the label.
    """
    pairs = with_every(
        stations_with_flow(obs, flow),
        variables(obs, only_concentrations=True, count_variable=count_variable).where("variable_name is not null"),
    )
    counted = view.where(has_flux()).groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n_flux"))
    return join_same(pairs, counted, list(GROUP)).select(
        *GROUP,
        F.coalesce("n_flux", F.lit(0).cast("long")).alias("n_flux"),
        F.when(F.col("n_flux").isNull(), F.lit(UNAVAILABLE)).alias("flux_label"),
        output_key("station_name", "variable_name", F.lit("log_flux")).alias("output_key"),
    )


def draft_rows(obs: DataFrame, value: str, ranks: DataFrame, cutoff_year: int = CUTOFF_YEAR) -> DataFrame:
    """Earlier chart form: results at the start of their month, without the cutoff year."""
    kept = obs.where(F.col("year") != cutoff_year)
    return attach_ranks(kept, ranks, GROUP).select(
        *GROUP, F.trunc("sample_date", "MM").alias("month_year"), "year", F.col(value).alias("plotted_value"),
        "perc_bin", "percentile",
    )


def draft_flow_line(obs: DataFrame, stations: DataFrame | None = None, station: str = "station_name") -> DataFrame:
    """Earlier flow chart: a line through the flow of the sampled days, at the start of their months.

    One point for each sample with its flow, whatever was measured; only `stations`, where they are given.
    """
    if stations is not None:
        obs = join_same(obs, stations.select(station).distinct(), [station], "left_semi")
    return obs.select(
        station, F.trunc("sample_date", "MM").alias("month_year"), "daily_flow_cms",
        output_key(station, F.lit("flow")).alias("output_key"),
    )


def draft_flux_rows(
    obs: DataFrame, ranks: DataFrame, stations: DataFrame, variables: Sequence[str] = DRAFT_FLUX_VARIABLES,
    cutoff_year: int = CUTOFF_YEAR, definition: str = "kg_per_day", count_variable: str = COUNT_VARIABLE,
) -> DataFrame:
    """Earlier flux chart: daily flux of the listed variables at stations with flow, without the cutoff year."""
    listed = obs.where(F.col("variable_name").isin(list(variables)))
    listed = join_same(listed, stations.select("station_name").distinct(), ["station_name"], "left_semi")
    return draft_rows(daily_flux(listed, variables, definition, count_variable), "flux", ranks, cutoff_year)


def draft_panels(
    obs: DataFrame, ranks: DataFrame, lines: DataFrame, excluded_unit: str | None = None,
    value: str = "measurement_value",
) -> DataFrame:
    """Earlier panels of a station: ranked results by year on the log10 scale, and its guideline lines in every panel.

    Panels are named variable (unit); rows in `excluded_unit`, or without a unit, are left out. `lines` holds a value
    for each exposure (`variable_name_unit`, `exposure`, `guideline_value`); the draws put every line into every panel,
    so a line's own variable is kept beside it.
    """
    known = obs.where("unit_code is not null" if excluded_unit is None else F.col("unit_code") != excluded_unit)
    title = F.concat("variable_name", F.lit(" ("), F.col("unit_code"), F.lit(")"))
    results = attach_ranks(known, ranks, GROUP).select(
        "station_name", title.alias("panel"), "year", F.col(value).alias("measurement_value"),
        log10_or_null(value).alias("plotted_value"), "perc_bin", "percentile", F.lit("result").alias("layer"),
    )
    panels = results.select("station_name", "panel").distinct()
    every = with_every(panels, lines.select("variable_name_unit", "exposure", "guideline_value")).select(
        "station_name", "panel", F.col("guideline_value").alias("measurement_value"),
        log10_or_null("guideline_value").alias("plotted_value"), "variable_name_unit", "exposure", F.lit("guideline").alias("layer"),
    )
    return union_all(results, every)
