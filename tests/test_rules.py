"""NULL rules, text, calendar, categories and operators on hand-written cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugewise import fixed_values as fixed
from gaugewise.functions import calendar, rules, scale, text
from gaugewise.operators import boxes, censoring, components, conform, coverage, flow, linkage, quality, ranking
from gaugewise.operators.flux import daily_flux, flux
from gaugewise.operators.guidelines import guideline_bounds
from gaugewise.operators.lookups import join_same, literal_table
from gaugewise.operators.ranking import percentile_category
from gaugewise.operators.summary import overview
from gaugewise.plans import charts
from gaugewise.schema import GUIDELINES, LIMIT_DETAILS, LIMITS

D = dt.date


def one(spark, schema, row, *columns):
    return spark.createDataFrame([row], schema).select(*columns).first()


def test_null_rules(spark):
    df = spark.createDataFrame([("L", 1.0), (None, None), ("x", 3.0)], "f string, v double")
    r = df.agg(
        F.count_if(rules.is_member("f", ["L"])).alias("members"),
        F.count_if(~rules.is_member("f", ["L"])).alias("others"),
        rules.strict(F.avg, "v").alias("strict"),
        rules.n_unique("f").alias("n"),
        rules.n_unique_few("f").alias("few"),
        rules.count_missing("v").alias("missing"),
        rules.percent(F.lit(1), F.lit(0)).alias("none"),
        rules.percent(F.lit(1), F.lit(800), 1).alias("half"),
    ).first()
    assert (r.members, r.others, r.strict, r.n, r.few, r.missing) == (1, 2, None, 3, 3, 1)
    assert r.none is None and r.half == 0.1
    r = one(spark, "b boolean", (None,), rules.if_else(F.col("b"), F.lit(1), F.lit(2)).alias("x"))
    assert r.x is None


@pytest.mark.parametrize(
    ("given", "number", "plain", "flag"),
    [("<0.05", 0.05, None, "<"), ("NR", None, None, None), ("1e-3", 0.001, 0.001, None), (None, None, None, None)],
)
def test_censored_text(spark, given, number, plain, flag):
    r = one(
        spark, "t string", (given,), text.censored_number("t").alias("n"), text.to_number("t").alias("p"),
        text.censored_flag("t").alias("f"),
    )
    assert (r.n, r.p, r.f) == (number, plain, flag)


def test_titles_and_keys(spark):
    r = one(
        spark, "v string, u string", ("TURBIDITY", "NTU"),
        text.panel_title("v", "u").alias("t"), text.panel_title(F.lit("PH"), "u").alias("bare"),
        text.output_key(F.lit("Ghost u/s mouth"), "v", F.lit("FLOW")).alias("k"),
    )
    assert (r.t, r.bare, r.k) == ("TURBIDITY (NTU)", "PH", "Ghost upstream mouth_TURBIDITY_FLOW")


def test_snake_case():
    names = ["Sample Site", "WQual_StationNumber", "Q (m3/s)", "Basin ID", "05BN012", "VariableName"]
    assert [text.snake_case(n) for n in names] == [
        "sample_site", "wqual_station_number", "q_m3_s", "basin_id", "x05bn012", "variable_name",
    ]


@pytest.mark.parametrize(
    ("date", "wy", "wm", "water", "ice", "flow_season"),
    [
        (D(2020, 10, 31), 2020, 1, "open water", "Open", "OpenWater"),
        (D(2020, 11, 1), 2021, 2, "under ice", "Ice", "OpenWater"),
        (D(2021, 5, 1), 2021, 8, "high flow", "Open", "OpenWater"),
        (D(2021, 12, 1), 2022, 3, "under ice", "Ice", "Winter"),
    ],
)
def test_calendar(spark, date, wy, wm, water, ice, flow_season):
    r = one(
        spark, "d date", (date,), calendar.water_year("d").alias("wy"), calendar.water_month("d", F.lit(1)).alias("wm"),
        calendar.water_month("d", F.lit(None)).alias("none"),
        *[calendar.season("d", s).alias(s) for s in ("water", "ice", "flow")],
    )
    assert (r.wy, r.wm, r.none, r.water, r.ice, r["flow"]) == (wy, wm, None, water, ice, flow_season)


def test_times(spark):
    r = one(
        spark, "a string, b string, c string", ("1/2/2020 3:04", "12/31/2020 13:04:05", "2020-1-2 3:04"),
        calendar.parse_time("a", fixed.CITY_TIME).alias("a"),
        calendar.parse_time("b", fixed.PROVINCIAL_SUPPLEMENT_TIME).alias("b"),
        calendar.parse_date("c", fixed.FEDERAL_TIME).alias("c"),
        calendar.parse_date("c", fixed.CITY_TIME).alias("bad"),
    )
    assert r.a == dt.datetime(2020, 1, 2, 3, 4) and r.b == dt.datetime(2020, 12, 31, 13, 4, 5)
    assert r.c == D(2020, 1, 2) and r.bad is None


@pytest.mark.parametrize(
    ("rank", "label"),
    [
        (0.1, "<10th"), (0.25, "10th - 24th"), (0.75, "25th - 75th"), (0.9, "76th - 90th"), (1.0, ">90th"),
        (0.0, "Not ranked"), (None, "Not ranked"), (float("nan"), "Not ranked"), (0.10001, "10th - 24th"),
    ],
)
def test_percentile_category(spark, rank, label):
    assert one(spark, "r double", (rank,), percentile_category("r").alias("x")).x == label


def test_scaled_values(spark):
    df = spark.createDataFrame([("A", 100.0), ("A", 0.0), ("A", -1.0), ("PH", 7.0)], "variable_name string, v double")
    assert [r[0] for r in df.select(scale.scaled_value("v", "variable_name")).collect()] == [2.0, None, None, 7.0]


def observations(spark, rows):
    return spark.createDataFrame(
        rows, "agency string, variable_name string, measurement_value double, measurement_flag string"
    )


def test_limit_substitution(spark):
    obs = observations(
        spark,
        [
            ("a", "low", 1.0, None), ("a", "low", 2.0, None), ("a", "low", 3.0, "<"), ("a", "low", 4.0, None),
            ("a", "low", None, "<"), ("a", "free", None, "L"), ("a", "free", 5.0, "L"), ("b", "low", 1.0, None),
        ],
    )
    limits = literal_table(spark, [("a", "low", 2.0)], LIMITS)
    got = censoring.substitute_limits(censoring.flag_censored(obs), limits)
    rows = [(r.variable_name, r.measurement_value, r.measurement_flag2, r.measurement_max_dl_sub) for r in got.collect()]
    assert rows == [
        ("low", 1.0, True, 2.0), ("low", 2.0, True, 2.0), ("low", 3.0, True, 3.0), ("low", 4.0, False, 4.0),
        ("low", None, None, None), ("free", None, True, None), ("free", 5.0, True, 5.0), ("low", 1.0, False, 1.0),
    ]
    assert censoring.rows_without_limit(obs, limits).count() == 3
    summary = {r.agency: r for r in censoring.censoring_before_after(got, ["agency"]).collect()}
    assert summary["a"].censored_after is None and summary["b"].censored_after == 0


def test_highest_limits_and_differences(spark):
    # reported limits of one variable and the limit chosen for it
    details = spark.createDataFrame(
        [("p", "TOC", v, n, None, None) for v, n in ((0.2, 1), (0.5, 129), (1.0, 1), (2.5, 1))]
        + [("p", "TSS", 3.0, 4, None, None), ("p", "P", 0.003, 9, None, None), ("p", "bad", None, 1, None, None),
           ("p", "bad", 1.0, 1, None, None)],
        LIMIT_DETAILS,
    )
    highest = censoring.highest_limits(details)
    assert {r.variable_name: r.max_dl for r in highest.collect()} == {"TOC": 2.5, "TSS": 3.0, "P": 0.003, "bad": None}
    chosen = literal_table(spark, [("p", "TOC", 0.5), ("p", "TSS", 1.0), ("p", "P", 0.003), ("c", "P", 1.0)], LIMITS)
    assert {r.variable_name for r in censoring.limit_differences(highest.where("variable_name <> 'bad'"), chosen).collect()} == {
        "TOC", "TSS", "P",
    }


def test_component_total(spark):
    rows = [
        ("s1", "A", "<0.1"), ("s1", "B", "2"), ("s2", "A", "<1"), ("s2", "B", "<1"), ("s3", "B", "4"),
        ("s4", "A", "1"), ("s4", "B", "2.5"),
    ]
    df = spark.createDataFrame(rows, "site string, parameter string, formatted_result string")
    total = components.component_total(df, ["site"], ["A", "B"], "T").where("parameter = 'T'")
    got = {r.site: (r.numeric_result, r.result_qualifier) for r in total.collect()}
    assert got == {"s1": (2.0, None), "s2": (None, None), "s3": (4.0, None), "s4": (3.5, None)}


def test_append_new_rows_compares_missing_values(spark):
    base = spark.createDataFrame([(1, "a", None), (2, "b", 1.0)], "id int, k string, v double")
    extra = spark.createDataFrame([("a", None), ("b", 2.0)], "k string, v double")
    assert sorted(components.append_new_rows(base, extra).collect(), key=str) == sorted(
        [(1, "a", None), (2, "b", 1.0), (None, "b", 2.0)], key=str
    )


def test_join_same_matches_missing_keys(spark):
    left = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    right = spark.createDataFrame([(None, 10), ("---", 20)], "k string, b int")
    assert sorted(map(tuple, join_same(left, right, ["k"]).collect()), key=str) == [("x", 2, None), (None, 1, 10)]


def test_literal_tables_are_bounded(spark):
    with pytest.raises(ValueError):
        literal_table(spark, [(i,) for i in range(30_000)], "k int")


def test_flux(spark):
    rows = [
        ("TSS", 2.0, "mg/L", 3.0), ("ESCHERICHIA COLI", 2.0, "No/100 mL", 3.0), ("TSS", 2.0, "mg/L", None),
        ("PH", 7.0, "pH units", 3.0), ("TSS", 2.0, "mg/L", -1.0),
    ]
    df = spark.createDataFrame(rows, "variable_name string, measurement_value double, unit_code string, daily_flow_cms double")
    got = [(r.measurement_value, r.unit_code, r.conc, r.conc_unit) for r in flux(df).collect()]
    assert got == [
        (6000.0, "mg/s", 2.0, "mg/L"), (60000.0, "No/s", 2.0, "No/100 mL"), (-2000.0, "mg/s", 2.0, "mg/L"),
    ]
    per_day = daily_flux(df.withColumn("measurement_max_dl_sub", F.col("measurement_value")), ["TSS"])
    assert per_day.count() == 5
    first = per_day.first()
    assert first.flux == pytest.approx(2 * 0.001 * 3 * 86400) and first.flux_unit == "kg/d"


def test_gauge_means_and_gaps(spark):
    rows = [("PC2A", "2020-01-01 00:00:00", 1.0), ("PC2A", "2020-01-01 12:00:00", 3.0), ("PC2A", "2020-01-02 00:00:00", None),
            ("PC2A", "2020-01-02 01:00:00", 9.0), ("PC2A", "2020-01-04 00:00:00", 5.0), ("N", "2020-01-01 00:00:00", 7.0)]
    readings = spark.createDataFrame(rows, "site string, t string, flow_cms double").withColumn(
        "reading_time", F.col("t").cast("timestamp_ntz")
    )
    daily = flow.gauge_daily_mean(readings)
    assert sorted(map(tuple, daily.collect())) == [
        ("N", D(2020, 1, 1), 7.0), ("PC2A", D(2020, 1, 1), 2.0), ("PC2A", D(2020, 1, 4), 5.0),
    ]
    assert {r.flow_station_number for r in flow.gauge_station_codes(daily).collect()} == {"PC", "NC"}
    filled = flow.fill_days(daily, ["site"])
    assert filled.count() == 5
    assert filled.where("value is null").select(F.countDistinct("date")).first()[0] == 2
    fixed_range = flow.fill_days(daily, ["site"], "date", "date'2020-01-02'", "date'2020-01-03'")
    assert fixed_range.count() == 3 + 4  # given rows stay, also before the range


def test_synthetic_station_and_statistics(spark):
    rows = [(D(2020, 1, 1), "A", 5.0), (D(2020, 1, 1), "B", 7.0), (D(2020, 1, 2), "A", 5.0), (D(2020, 12, 31), "A", None)]
    df = spark.createDataFrame(rows, "date date, flow_station_number string, value double")
    synthetic = flow.synthetic_station(df, "S", "A", "B")
    assert sorted((r.date, r.value) for r in synthetic.where("value is not null").collect()) == [(D(2020, 1, 1), -2.0)]
    assert flow.nonnegative(synthetic).where("value is not null").count() == 0
    stats = {r.flow_station_number: r for r in flow.annual_statistics(df).collect()}
    assert stats["A"].total_days == 2 and stats["A"].perc_missing == 0.0 and stats["A"].seasonal_flag == "Seasonal"
    assert stats["A"].count_na_flow == 1 and stats["B"].cv is None


def test_flow_grid_equals_wide_then_long(spark):
    rows = [(D(2020, 1, 1), "A", 5.0), (D(2020, 1, 2), "B", 7.0), (D(2020, 1, 3), "C", 1.0)]
    df = spark.createDataFrame(rows, "date date, flow_station_number string, value double")
    long = flow.flow_long(flow.flow_wide(df.where("flow_station_number <> 'C'"), ["A", "B"]), ["A", "B"])
    assert sorted(map(str, flow.flow_grid(df, ["A", "B"]).select(*long.columns).collect())) == sorted(map(str, long.collect()))


def test_unmatched_flow_station_stops(spark):
    named = spark.createDataFrame([("A", "x"), ("B", None)], "flow_station_number string, station_name_wq string")
    with pytest.raises(ValueError, match="1 flow station.*B"):
        linkage.require_matched(named)
    assert linkage.require_matched(named.where("station_name_wq is not null")).count() == 1


def test_missing_flow_keeps_one_grain(spark):
    rows = [("g", "2020-01-01", f"v{i % 7}", 2020, "Jan", None) for i in range(100)] + [("g", "2020-01-01", "v0", 2020, "Jan", 1.0)]
    df = spark.createDataFrame(rows, "station string, sample_date string, variable_name string, year int, month_abb string, daily_flow_cms double")
    by_year = linkage.missing_flow_by_year(df).collect()
    assert len(by_year) == 7 and sum(r.n_rows for r in by_year) == 100


def test_duplicates(spark):
    rows = [("a", 1, "x"), ("a", 1, "x"), ("a", 1, None), ("b", 2, "y"), (None, 3, "z"), (None, 3, "w")]
    df = spark.createDataFrame(rows, "k string, n int, note string")
    keys = ["k", "n"]
    assert quality.duplicate_rows(df, keys).count() == 5
    assert set(map(tuple, quality.keep_first(df, keys).collect())) == {("a", 1, None), ("b", 2, "y"), (None, 3, "w")}
    later = sorted(map(tuple, quality.later_rows(df, keys).collect()), key=str)
    assert later == sorted([("a", 1, "x"), ("a", 1, "x"), (None, 3, "z")], key=str)


def test_units(spark):
    df = spark.createDataFrame(
        [("A", "x"), ("A", "x"), ("B", "y"), ("B", "x"), ("C", None)], "variable_name string, unit_code string"
    )
    report = {r.variable_name: (r.n_units, r.units, r.has_missing_unit) for r in quality.unit_report(df).collect()}
    assert report == {"A": (1, "x", False), "B": (2, "x, y", False), "C": (0, "", True)}
    assert quality.unit_of(df, "A") == "x"
    for bad in ("B", "Z"):
        with pytest.raises(ValueError):
            quality.unit_of(df, bad)
    rules_ = [("B", "y", "x")]
    assert quality.unit_of(conform.repair_units(df, rules_), "B") == "x"


def test_guidelines(spark):
    bounds = guideline_bounds(literal_table(spark, fixed.GUIDELINES, GUIDELINES)).collect()
    assert len(bounds) == 9
    assert {(r.bound, r.guideline_value) for r in bounds if r.variable_name == "PH"} == {
        ("Lower chronic", 6.5), ("Upper chronic", 9.0),
    }
    assert {r.bound: r.bound_rank for r in bounds} == {"Upper acute": 1, "Upper chronic": 2, "Lower chronic": 3}


def test_box_statistics(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0, 100.0]
    df = spark.createDataFrame([("g", v) for v in values], "k string, v double")
    r = boxes.box_stats(df.where("v < 100").unionAll(df.where("v = 100").limit(1)), ["k"], "v").first()
    assert (r.lower, r.middle, r.upper, r.ymin, r.ymax, r.n_outliers) == (2.0, 3.0, 4.0, 1.0, 4.0, 1)
    many = spark.createDataFrame([("g", float(v)) for v in range(20)] + [("g", 500.0)] * 2, "k string, v double")
    assert [tuple(x) for x in boxes.box_outliers(many, ["k"], "v").collect()] == [("g", 500.0, 2)]
    logs = spark.createDataFrame([("g", "A", v) for v in (0.0, 1.0, 10.0, 100.0)], "k string, variable_name string, v double")
    r = boxes.log_box_stats(logs, ["k"], "v").first()
    assert (r.n_nonpositive, r.n, r.middle) == (1, 3, 1.0)


def test_coverage(spark):
    obs = spark.createDataFrame(
        [("s1", "A"), ("s1", "B"), ("s2", "A"), (None, "C")], "station_name string, variable_name string"
    )
    assert coverage.task_grid(obs).count() == 2 * 3
    counts = coverage.combination_counts(obs, "station_name")
    assert counts.count() == 9 and counts.where("n is null").count() == 5
    present = spark.createDataFrame([("s1", "A"), ("s2", "B")], "station_name string, facet_title string")
    flows = spark.createDataFrame([("s1", 1.0), ("s2", None)], "station_name string, daily_flow_cms double")
    missing = coverage.missing_panels(present, flows, ["FLOW (cms)", "A", "B"], ["B"])
    assert {(r.station_name, r.facet_title, r.facet_rank, r.text) for r in missing.collect()} == {
        ("s1", "B", 2, "Not a flux parameter"), ("s2", "A", 1, "Unavailable"), ("s2", "FLOW (cms)", 0, "Unavailable"),
    }


def test_overview_of_missing_values(spark):
    rows = [("A", D(2020, 1, 1), 1.0, "<", True), ("A", None, None, None, None)]
    df = spark.createDataFrame(
        rows, "variable_name string, sample_date date, measurement_value double, measurement_flag string, measurement_flag2 boolean"
    ).withColumn("measurement_max_dl_sub", F.col("measurement_value"))
    r = overview(df, ["variable_name"], "measurement_max_dl_sub", substituted=True).first()
    assert r.min_date is None and r.count_years == 2 and r.count_lflag2 is None and r.st_dev is None
    assert (r.count_samples, r.count_values, r.count_lflag, r.list_dls, r.median) == (2, 1, 1, [1.0], 1.0)


def test_missing_keys_match_in_full_joins(spark):
    ranks = spark.createDataFrame([(None, "a", 2000, 1.0, 0.5), ("s", "b", 2001, 2.0, 0.95)], "station string, variable_name string, year int, median double, perc_bin double")
    rows = spark.createDataFrame([(None, "a", 2000, 7.0), ("t", "c", 2002, 8.0)], "station string, variable_name string, year int, v double")
    got = {(r.station, r.variable_name, r.year, r.v, r.percentile) for r in ranking.attach_ranks(rows, ranks, how="full").collect()}
    assert got == {
        (None, "a", 2000, 7.0, "25th - 75th"), ("s", "b", 2001, None, ">90th"), ("t", "c", 2002, 8.0, "Not ranked"),
    }
    schema = "agency string, variable_name string, max_dl double"
    computed = spark.createDataFrame([(None, "a", 1.0), ("x", "a", 2.0)], schema)
    chosen = spark.createDataFrame([(None, "a", 1.0), ("y", "a", 3.0)], schema)
    assert {(r.agency, r.computed_max_dl, r.chosen_max_dl) for r in censoring.limit_differences(computed, chosen).collect()} == {
        ("x", 2.0, None), ("y", None, 3.0),
    }


def test_group_with_a_missing_limit_has_no_value(spark):
    rows = spark.createDataFrame(
        [("x", "a", 5.0, None), ("x", "b", 5.0, "<")], "agency string, variable_name string, measurement_value double, measurement_flag string"
    )
    limits = spark.createDataFrame([("x", "a", None), ("x", "b", 9.0)], "agency string, variable_name string, max_dl double")
    got = censoring.substitute_limits(censoring.flag_censored(rows), limits).orderBy("variable_name").collect()
    assert [(r.measurement_flag2, r.measurement_max_dl_sub) for r in got] == [(None, None), (True, 9.0)]


def test_flux_label_needs_a_unit_that_allows_flux(spark):
    view = spark.createDataFrame(
        [("s", "PH", 7.0, 1.0, "pH units"), ("s", "N", 7.0, 1.0, "mg/L")],
        "station_name string, variable_name string, measurement_value double, daily_flow_cms double, unit_code string",
    )
    got = {r.variable_name: (r.n_with_flow, r.flux_label) for r in charts.chart_tasks(view, view).collect()}
    assert got["N"] == (1, None) and got["PH"][0] == 1 and got["PH"][1] is not None
