"""Exact quantiles and distributions against brute force, with hot groups, ties and odd values."""

import datetime
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugewise.operators import distribution
from gaugewise.operators.boxes import box_stats
from gaugewise.operators.distribution import (
    KEY,
    grouped_quantiles,
    quantiles_of_columns,
    quantiles_of_counts,
    regrouped,
    share_at_or_below,
    value_counts,
    value_digits,
)
from gaugewise.operators.ranking import year_ranks

PROBS = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}


def sample(seed):
    rnd = random.Random(seed)
    rows = [("hot", rnd.gauss(0, 1e3)) for _ in range(3000)]  # one group holds most rows
    rows += [("copies", 7.5)] * 1000  # one value holds a whole group
    rows += [(None, round(rnd.expovariate(1), 1)) for _ in range(40)]
    rows += [(f"g{i % 20}", rnd.choice([0.0, -0.0, 1e-12, -3.5, 1e300, rnd.random()])) for i in range(300)]
    rows += [("one", 4.0), ("gaps", None), ("gaps", 2.0), ("empty", None), ("nan", float("nan")), ("nan", 1.0)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_match_numpy(spark, seed):
    rows = sample(seed)
    groups = {}
    for k, v in rows:
        if v is not None and not math.isnan(v):
            groups.setdefault(k, []).append(v)
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    got = {r["k"]: r for r in grouped_quantiles(df, ["k"], "v", PROBS).collect()}
    assert set(got) == set(groups)
    for k, values in groups.items():
        for name, p in PROBS.items():
            assert got[k][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12), (k, name)


def test_several_columns_in_one_pass(spark):
    rows = [("a", float(i), float(i * i) if i % 3 else None) for i in range(50)] + [("b", 1.0, None)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    got = {
        r["k"]: r.asDict()
        for r in quantiles_of_columns(df, ["k"], {"x": {"x50": 0.5, "x90": 0.9}, "y": {"y50": 0.5}}).collect()
    }
    ys = [i * i for i in range(50) if i % 3]
    assert got["a"]["x50"] == 24.5
    assert got["a"]["x90"] == pytest.approx(np.quantile(range(50), 0.9))
    assert got["a"]["y50"] == pytest.approx(np.median(ys))
    assert got["b"] == {"k": "b", "x50": 1.0, "x90": 1.0, "y50": None}


ODD = [0.0, -0.0, 5e-324, -5e-324, 1e-310, 2.0**-1022, 1e308, -1e308, 1.7976931348623157e308, float("inf"), float("-inf"),
       1.0, 1.0 + 2**-52, 1.0 - 2**-53, 2.0, 2.0 - 2**-52, -1.0, -1.0 - 2**-52, 1023.9999999999999, 1024.0]


def test_digits_never_decrease(spark):
    rnd = random.Random(5)
    values = [rnd.uniform(-1e6, 1e6) for _ in range(400)] + [math.ldexp(rnd.random(), rnd.randint(-1080, 1024)) for _ in range(400)]
    values = sorted(values + [2.0**e for e in range(-60, 60)] + [-(2.0**e) for e in range(-9, 9)] + ODD)
    coarse, fine = value_digits("v")
    df = spark.createDataFrame([(float(v),) for v in values], "v double").selectExpr("v", f"{coarse} as c", f"{fine} as f")
    digits = {math.copysign(r["v"], r["v"]): (r["c"], r["f"]) for r in df.collect()}
    order = [digits[v] for v in values]
    assert order == sorted(order)
    assert all(0 <= f < 1 << 23 for _, f in order)
    assert len(set(order)) > len(set(values)) * 0.9  # only neighbours share a node


@pytest.mark.parametrize("node_values", [0, 40])
def test_crowded_groups_match_numpy(spark, monkeypatch, node_values):
    """Every group split into nodes, also where all its values agree in their leading digits."""
    monkeypatch.setattr(distribution, "NODE_VALUES", node_values)
    rows = sample(4) + [("near", 1e6 + k * 2.0**-33) for k in range(300)] + [("odd", v) for v in ODD if math.isfinite(v)]
    groups = {}
    for k, v in rows:
        if v is not None and not math.isnan(v):
            groups.setdefault(k, []).append(v)
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    got = {r["k"]: r for r in grouped_quantiles(df, ["k"], "v", PROBS).collect()}
    for k, values in groups.items():
        for name, p in PROBS.items():
            assert got[k][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-300), (k, name)
    counts = value_counts(df, ["k"], "v")
    probes = [(k, v) for k, values in groups.items() for v in (min(values), max(values), values[0], 0.5, -1e9, 1e6 + 2.0**-30)]
    asked = spark.createDataFrame(probes, "k string, x double").select(F.struct("k").alias(KEY), "x")
    shares = {(r[0]["k"], r["x"]): (r["_share"], r["_total"]) for r in share_at_or_below(counts, asked, "x").collect()}
    for k, x in probes:
        assert shares[(k, x)] == (sum(v <= x for v in groups[k]) / len(groups[k]), len(groups[k]))


@pytest.mark.parametrize("node_values", [0, 5])
def test_crowded_ranks_and_boxes(spark, monkeypatch, node_values):
    rnd = random.Random(9)
    rows = [(rnd.choice("ab"), "v", 2000 + rnd.randrange(25), round(rnd.gauss(5, 2), 2)) for _ in range(900)]
    df = spark.createDataFrame(rows, "station string, variable_name string, year int, measurement_value double")
    want = year_ranks(df, cutoff_year=2022).collect()
    boxes = box_stats(df, ["station"], "measurement_value").collect()
    monkeypatch.setattr(distribution, "NODE_VALUES", node_values)
    assert sorted(map(repr, year_ranks(df, cutoff_year=2022).collect())) == sorted(map(repr, want))
    assert sorted(map(repr, box_stats(df, ["station"], "measurement_value").collect())) == sorted(map(repr, boxes))


def test_values_in_several_rows(spark):
    counts = value_counts(spark.createDataFrame([("a", y, float(v)) for y in (1, 2, 3) for v in range(7)], "k string, y int, v double"), ["k", "y"], "v")
    got = quantiles_of_counts(regrouped(counts, ["k"]), PROBS).first()
    assert [got[name] for name in PROBS] == pytest.approx(list(np.quantile(list(range(7)) * 3, list(PROBS.values()))))


def test_one_scan_and_no_window_over_a_group(spark, tmp_path):
    """Without crowded groups the running plan has no prefix sums left, and the source is read once."""
    rows = [(f"s{k % 9}", "v", 2000 + k % 23, float(k % 101)) for k in range(4000)]
    spark.createDataFrame(rows, "station string, variable_name string, year int, measurement_value double").write.parquet(str(tmp_path / "t"))
    ranks = year_ranks(spark.read.parquet(str(tmp_path / "t")), cutoff_year=2022)
    ranks.collect()
    plan = ranks._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan") : plan.index("Initial Plan")]
    assert final.count("FileScan") == 1
    windows = [line for line in final.splitlines() if "Window [" in line]
    assert windows and all("_coarse" in line and "_fine" in line for line in windows)


def test_shares_match_brute_force(spark):
    rnd = random.Random(3)
    values = [("a", float(rnd.randint(0, 20))) for _ in range(200)] + [("b", 1.0)]
    probes = [("a", x) for x in (-1.0, 0.0, 7.0, 7.5, 20.0, 99.0)] + [("b", 1.0), ("b", 0.5), ("none", 3.0)]
    counts = value_counts(spark.createDataFrame(values, "k string, v double"), ["k"], "v")
    asked = spark.createDataFrame(probes, "k string, x double").select(F.struct("k").alias(KEY), "x")
    got = {(r[0]["k"], r["x"]): r["_share"] for r in share_at_or_below(counts, asked, "x").collect()}
    for k, x in probes:
        own = [v for g, v in values if g == k]
        want = sum(v <= x for v in own) / len(own) if own else None
        assert got[(k, x)] == want


def ranks(spark, rows, **options):
    df = spark.createDataFrame(rows, "station string, variable_name string, year int, measurement_value double")
    return {(r["station"], r["year"]): r["perc_bin"] for r in year_ranks(df, cutoff_year=2022, **options).collect()}


def test_year_ranks_rules(spark):
    def of(station, *pairs):
        return [(station, "v", y, v) for y, v in pairs]

    rows = (
        of("ties", (2000, 1.0), (2000, 3.0), (2001, 3.0), (2001, 5.0), (2022, 3.0), (2023, 2.0))
        + of("below", (2000, 2.0), (2001, 4.0), (2022, 0.5))
        + of("empty", (2022, 1.0), (2023, 2.0))
        + of("zeros", (2000, 0.0), (2001, 0.0), (2022, 5.0))
        + of("one", (2000, 4.0), (2022, 4.0), (2023, 3.0))
        + of(None, (2000, 1.0), (2022, 2.0))
    )
    got = ranks(spark, rows)
    assert got[("ties", 2022)] == 0.75 and got[("ties", 2023)] == 0.25 and got[("ties", 2001)] == 0.75
    assert got[("below", 2022)] == 0.01
    assert got[("empty", 2022)] is None and got[("empty", 2023)] is None
    assert got[("zeros", 2000)] is None and got[("zeros", 2022)] is None
    assert got[("one", 2022)] == 1.0 and got[("one", 2023)] == 0.01
    assert got[(None, 2022)] == 1.0
    assert all(v is None or 0.01 <= v <= 1 for v in got.values())


def test_year_ranks_draft_rules(spark):
    rows = [("a", "v", 2000, 1.0), ("a", "v", 2022, 9.0), ("a", "v", 2023, 5.0), ("a", "v", 2023, None), ("a", "v", 2024, 0.0)]
    options = dict(history="not_equal", floor=None, zero_history_is_missing=False)
    got = ranks(spark, rows, rank_cutoff_year=False, **options)
    assert got == {("a", 2000): 2 / 3, ("a", 2023): 1.0, ("a", 2024): 1 / 3}
    strict = ranks(spark, rows, strict_median=True, **options)
    assert strict[("a", 2023)] is None and strict[("a", 2022)] == 1.0


def test_overview_of_small_and_large_groups(spark, monkeypatch):
    from gaugewise.operators import summary

    rng = random.Random(5)
    rows = []
    for name, n in [("a", 1), ("b", 4), (None, 6), ("c", 0), ("d", 300), ("e", 700)]:
        for _ in range(n):
            value = rng.choice([None, math.nan, -0.0, 0.0, 1.5, 2.0, round(rng.random() * 9, 2), math.inf])
            flow = rng.choice([None, round(rng.random(), 3), -3.25])
            day = None if rng.random() < 0.002 else datetime.date(2000 + rng.randint(0, 3), rng.randint(1, 12), 1)
            rows.append((name, day, value, rng.choice([None, "<", "L", "G"]), rng.choice([True, False]), flow))
    rows += [("f", datetime.date(2001, 1, 1), None, None, None, None)] * 3
    ddl = "name string, sample_date date, measurement_value double, measurement_flag string, measurement_flag2 boolean, daily_flow_cms double"
    df = spark.createDataFrame(rows, ddl).repartition(3)

    def found(small):
        monkeypatch.setattr(summary, "SMALL_ROWS", small)
        out = summary.overview(df, ["name"], substituted=True, flow=True, flux="daily_flow_cms")

        def plain(x):  # of equal zeros any may be the least
            return [plain(y) for y in x] if isinstance(x, list) else float(f"{x:.9g}") + 0.0 if isinstance(x, float) else x

        return out.columns, out.schema.simpleString(), {r.name: repr([plain(x) for x in r]) for r in out.collect()}, out

    large, mixed, small = found(0), found(100), found(10**6)
    assert large[:3] == mixed[:3] == small[:3] and len(small[2]) == 6
    # rows of small groups are shuffled once; the other exchange is the test's own
    plan = small[3]._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
