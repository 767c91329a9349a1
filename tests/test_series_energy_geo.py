import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sectorlens.operators import energy, geo, seasonal, series
from sectorlens.plans import maps


def month(i, start=2016):
    return dt.date(start + i // 12, i % 12 + 1, 1)


def facts(spark, rows):
    return spark.createDataFrame(rows, "geo string, label string, ref_date date, value double")


def test_monthly_series_edges(spark):
    df = facts(spark, [("a", "x", dt.date(2016, 1, 1), 1.0), ("a", "x", dt.date(2016, 1, 31), 2.0),
                       ("a", "x", dt.date(2016, 3, 5), None), ("a", "x", dt.date(2023, 10, 31), 4.0),
                       ("a", "x", dt.date(2023, 11, 1), 8.0), ("a", "x", dt.date(2015, 12, 31), 8.0),
                       (None, "x", dt.date(2016, 1, 1), 8.0)])
    got = [(r.ref_date, r.value) for r in series.monthly_series(df, ["geo", "label"]).orderBy("ref_date").collect()]
    assert got == [(dt.date(2016, 1, 31), 3.0), (dt.date(2016, 3, 31), 0.0), (dt.date(2023, 10, 31), 4.0)]


def test_forecast_needs_24_months(spark):
    df = facts(spark, [("a", "x", month(i), 1.0) for i in range(23)] + [("b", "x", month(i), 5.0) for i in range(24)])
    months = series.monthly_series(df, ["geo", "label"])
    assert {r.geo for r in series.forecastable(months, ["geo", "label"]).collect()} == {"b"}
    ahead = series.seasonal_drift(months, ["geo", "label"]).orderBy("ref_date").collect()
    assert [(r.geo, r.ref_date, round(r.value, 6)) for r in ahead] == [
        ("b", dt.date(2018, 1, 1), 5.0), ("b", dt.date(2018, 2, 1), 5.0)]


def test_drift_uses_last_season_or_mean(spark):
    gone = 25 - 12
    rows = [("a", "x", month(i), float(i)) for i in range(25) if i != gone]
    ahead = series.seasonal_drift(series.monthly_series(facts(spark, rows), ["geo", "label"]), ["geo", "label"])
    values = [r.value for r in ahead.orderBy("ref_date").collect()]
    mean = np.mean([i for i in range(25) if i != gone])
    assert abs(values[0] - mean) < 1e-9 and abs(values[1] - 26) < 1e-6


def test_seasonal_models(spark):
    wave = [100 + 10 * math.sin(2 * math.pi * i / 12) + i for i in range(60)]
    rows = [("a", "x", month(i), wave[i]) for i in range(60)] + [("b", "x", month(i), 3.0) for i in range(30)]
    rows += [("c", "x", month(i), float("nan") if i == 3 else 1.0 * i) for i in range(30)]
    months = series.monthly_series(facts(spark, rows), ["geo", "label"])
    out = series.seasonal_models(months, ["geo", "label"])
    got = {(r.geo, r.ref_date): r for r in out.collect()}
    assert len(got) == 6
    want = 100 + 10 * math.sin(2 * math.pi * 60 / 12) + 60
    assert abs(got["a", month(60)].value - want) < 2
    assert got["b", month(30)].value == 3.0 and got["b", month(30)].model == "constant"
    assert [r.geo for r in series.failed_series(out, ["geo", "label"]).collect()] == ["c"]


def fitted_by_hand(values):
    """The best subset of month before, month a year ago and time by least squares; two months ahead."""
    y, best = np.array(values), None
    rows = np.arange(12, len(y))
    inputs = {"lag": y[rows - 1], "season": y[rows - 12], "trend": rows * 1.0}
    for size in range(4):
        for chosen in [c for c in ((), ("lag",), ("season",), ("trend",), ("lag", "season"), ("lag", "trend"),
                                   ("season", "trend"), ("lag", "season", "trend")) if len(c) == size]:
            design = np.column_stack([np.ones(len(rows)), *[inputs[c] for c in chosen]])
            beta, *_ = np.linalg.lstsq(design, y[rows], rcond=None)
            spread = max(((y[rows] - design @ beta) ** 2).mean(), 1e-12)
            k = size + 2
            criterion = np.log(spread) + 2 * k / max(len(rows) - k - 1, 1)
            if best is None or criterion < best[0] - 1e-9:
                best = criterion, chosen, beta
    _, chosen, beta = best
    path = list(values)
    for _ in range(2):
        now = {"lag": path[-1], "season": path[-12], "trend": float(len(path))}
        path.append(float(beta @ np.array([1.0, *[now[c] for c in chosen]])))
    return "+".join(chosen) or "mean", path[-2:]


def test_seasonal_regression_equals_least_squares(spark):
    rng = np.random.default_rng(5)
    made = {"wave": [50 + 10 * math.sin(i * math.pi / 6) + 0.3 * i + rng.normal() for i in range(70)],
            "walk": np.cumsum(rng.normal(size=60)).tolist(), "noise": rng.normal(100, 5, size=48).tolist(),
            "line": [3.0 * i + rng.normal() for i in range(40)]}
    keys = ["geo", "label"]
    rows = [(g, "x", month(i), v) for g, values in made.items() for i, v in enumerate(values)]
    rows += [("flat", "x", month(i), 7.0) for i in range(30)] + [("short", "x", month(i), 1.0) for i in range(23)]
    rows += [("gap", "x", month(2 * i), 1.0 * i) for i in range(30)]
    rows += [("odd", "x", month(i), float("nan") if i == 3 else 1.0 * i) for i in range(40)]
    out = series.seasonal_regression(series.monthly_series(facts(spark, rows), keys), keys)
    got = {}
    for r in out.orderBy("ref_date").collect():
        got.setdefault(r.geo, []).append(r)
    assert set(got) == {*made, "flat", "gap", "odd"} and all(len(x) == 2 for x in got.values())
    for name, values in made.items():
        model, ahead = fitted_by_hand(values)
        assert [r.model for r in got[name]] == [model] * 2 and got[name][0].ref_date == month(len(values))
        assert np.allclose([r.value for r in got[name]], ahead, rtol=1e-6)
    assert [(r.value, r.model, r.error) for r in got["flat"]] == [(7.0, "mean", None)] * 2
    assert {r.model for r in got["gap"] + got["odd"]} == {"drift"}
    assert {r.geo for r in series.failed_series(out, keys).collect()} == {"gap", "odd"}


@pytest.mark.parametrize("d,sd", [(0, 0), (1, 0), (0, 1), (1, 1)])
def test_integration_undoes_differences(d, sd):
    values = np.random.default_rng(d + 2 * sd).normal(size=40).cumsum()
    steps = seasonal._difference(values, d, sd, 12)[-2:]
    assert np.allclose(seasonal._integrate(values[:-2], list(steps), d, sd, 12), values[-2:])


def test_actuals_survive_without_forecast(spark):
    df = facts(spark, [("a", "x", month(i), 1.0) for i in range(3)]).withColumn("note", F.lit("n"))
    assert series.prepare_and_predict(df, ["geo", "label"]).count() == 3
    many = facts(spark, [("a", "x", month(i, 2010), 1.0) for i in range(72 + 30)]).withColumn("note", F.lit("n"))
    out = series.prepare_and_predict(many, ["geo", "label"])
    assert out.count() == 104 and out.where("note is null").count() == 2


def energy_rows(spark, rows):
    return spark.createDataFrame(rows, "ref_date string, geo string, label string, uom string, value double")


def test_energy_balance(spark):
    df = energy_rows(spark, [("2020-01", "A", "Imports", "m3", 2.0), ("2020-01", "A", "Exports", "m3", 1.0),
                             ("2020-01", "A", "Other", "m3", 9.0), ("2020-01", "B", "Imports", "m3", None),
                             (None, "B", "Imports", "m3", 4.0)])
    got = {(r.geo, r.label): r.value for r in energy.energy_balance(df, "Gas").where("uom = 'MJ'").collect()}
    assert got == {("A", "Gas Input MJ"): 77800.0, ("A", "Gas Output MJ"): 38900.0,
                   ("B", "Gas Input MJ"): 0.0, ("B", "Gas Output MJ"): 0.0}
    assert energy.energy_balance(df, "Gas").count() == 9


def test_coal_has_two_factors(spark):
    df = energy_rows(spark, [("2020-01", "A", "Coal coke, received", "t", 1.0), ("2020-01", "A", "Coal, received", "t", 1.0),
                             ("2020-01", "A", "Coal, charged to ovens", "t", 2.0)])
    got = {r.label: r.value for r in energy.energy_balance(df, "Coal").where("uom = 'MJ'").collect()}
    assert got == {"Coal Input MJ": 54.0, "Coal Output MJ": 50.0}


def test_numbers_with_symbols(spark):
    df = spark.createDataFrame([("1.5",), ("..",), ("x",), (None,), ("NaN",)], "v string")
    assert [r[0] for r in df.select(energy.number(F.col("v"))).collect()] == [1.5, None, None, None, None]


def test_regions_are_centred_by_rows(spark):
    places = spark.createDataFrame([("Yukon", 60.0, -130.0), ("Nunavut", 70.0, -90.0), ("Ontario", 50.0, -85.0)],
                                   "geo string, latitude double, longitude double")
    df = spark.createDataFrame([("Yukon", 1), ("Yukon", 2), ("Nunavut", 3), ("Ontario", 4), ("Nowhere", 5)],
                               "geo string, id int")
    placed = geo.centre_regions(geo.add_region(geo.add_coordinates(df, places)))
    got = {r.id: (r.geo2, r.latitude and round(r.latitude, 4)) for r in placed.collect()}
    assert got == {1: ("Northern Territories", 63.3333), 2: ("Northern Territories", 63.3333),
                   3: ("Northern Territories", 63.3333), 4: ("Ontario", 50.0), 5: ("Nowhere", None)}


def test_offsets(spark):
    df = spark.createDataFrame([(1, "b", 0.0, 0.0), (2, "a", 0.0, 0.0), (3, None, 0.0, 0.0), (4, "b", 1.0, 1.0)],
                               "id long, label string, latitude double, longitude double")
    seen = {r.id: (round(r.latitude, 6), round(r.longitude, 6)) for r in geo.offset_observed(df, "id").collect()}
    assert seen == {1: (0.0, 2.0), 2: (0.0, -2.0), 3: (0.0, 0.0), 4: (1.0, 3.0)}
    fixed = {r.id: (round(r.latitude, 6), round(r.longitude, 6)) for r in
             geo.offset_fixed(df, labels=("x", "b", "y", "z")).collect()}
    assert fixed == {1: (2.0, 0.0), 2: (0.0, 0.0), 3: (0.0, 0.0), 4: (3.0, 1.0)}


def test_energy_flow_end_to_end(spark):
    def fuel(label, unit):
        return spark.createDataFrame([(month(i, 2018), "Alberta", label, unit, 1.0) for i in range(30)],
                                     "ref_date date, geo string, label string, uom string, value double")
    places = spark.createDataFrame([("Alberta", 55.0, -115.0), ("Ontario", 49.25, -85.0)],
                                   "geo string, latitude double, longitude double")
    out = maps.energy_tables(fuel("Imports", "Cubic metres"), fuel("Condensate", "Cubic metres"),
                             fuel("Coal, received", "Tonnes"), places)
    got = {(r.geo, r.label): r.n for r in out.groupBy("geo", "label").agg(F.count("*").alias("n")).collect()}
    assert got["Alberta", "Gas Imports"] == 32 and got["Ontario", "Coal Coal, received"] == 32
    assert got["Ontario", "Coal Input MJ"] == 32


def test_failures_stand_beside_the_forecasts(spark):
    df = facts(spark, [(g, "x", month(i, 2018), 1.0 + i % 12) for g in "ab" for i in range(48)])

    def forecaster(found, keys, ref_date, value):
        ahead = series.seasonal_drift(found, keys, ref_date=ref_date, value=value)
        return ahead.withColumns({"model": F.lit("m"), "error": F.when(F.col("geo") == "a", "no fit")})

    table, failures = series.predict_with_failures(df, ["geo", "label"], forecaster=forecaster)
    assert table.count() == 96 + 4
    assert [tuple(r) for r in failures.collect()] == [("a", "x", "no fit")]
    assert series.predict_with_failures(df, ["geo", "label"], forecaster=series.seasonal_drift)[1].count() == 0
