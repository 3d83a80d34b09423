"""Explicit schemas of the inputs and the column order of the conformed tables."""

from __future__ import annotations

# the template every agency table is brought to
TEMPLATE_COLUMNS = (
    "agency", "range", "station", "sample_date", "variable_name",
    "measurement_value", "measurement_flag", "unit_code",
)
CONFORMED_COLUMNS = (*TEMPLATE_COLUMNS, "detection_limit", "flow_cms")

# the finished observation table
OBSERVATION_COLUMNS = (
    *CONFORMED_COLUMNS,
    "sample_datetime", "cen_logic", "measurement_flag2", "measurement_max_dl_sub",
    "flow_station_number", "flow_station_name", "station_name", "daily_flow_cms",
    "station_name_wq", "year", "month_year", "season", "month_abb",
)

# raw inputs; values that may hold text marks are read as text
CITY_SAMPLES = (
    "id string, sample_site string, sample_date string, parameter string, numeric_result double, "
    "result_qualifier string, formatted_result string, result_units string"
)
PROVINCIAL_SAMPLES = (
    "station string, sample_date_time string, variable_name string, measurement_value string, "
    "measurement_flag string, unit_code string"
)
FEDERAL_SAMPLES = "site_no string, date_time string, variable string, value string, flag string, unit string"
PROVINCIAL_SUPPLIED = (
    "Station string, VariableName string, SampleDateTime string, SampleDate string, "
    "MeasurementValue string, MeasurementFlag string, UnitCode string"
)
LIMITS = "agency string, variable_name string, max_dl double"
LIMIT_DETAILS = (
    "agency string, variable_name string, measurement_value double, n long, min_date date, max_date date"
)
GUIDELINES = (
    "source string, variable_name string, lower_value double, upper_value double, unit_code string, "
    "exposure_duration string"
)
DAILY_FLOW = "date date, station_number string, parameter string, value double"
FLOW_STATIONS = "station_number string, station_name string, drainage_area_gross double"
GAUGE_READINGS = "date string, site string, flow_cms double"
STATION_LOOKUP = (
    "station_name_wq string, flow_station_number string, flow_station_name string, station_name string"
)
