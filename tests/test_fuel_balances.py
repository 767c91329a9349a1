"""Balances of several fuels in one aggregation beside one fuel at a time."""

from datetime import date

from pyspark.sql import functions as F
from sectorlens.operators import energy, geo

FACTS = "ref_date date, geo string, label string, uom string, value double, fuel string"


def facts(spark):
    day = date(2020, 1, 1)
    return spark.createDataFrame([
        (day, "Alberta", "Imports", "m", 2.0, "Gas"), (day, "Alberta", "Imports", "m", None, "Gas"),
        (day, "Alberta", "Exports", "m", 3.0, "Gas"), (day, "Ontario", "Condensate", "m", 4.0, "Crude"),
        (None, "Ontario", "Coal, received", "t", 5.0, "Coal"), (day, None, "Coal, received", "t", 6.0, "Coal"),
        (day, "Ontario", "Coal, received", "t", 7.0, "Coal"), (day, "Ontario", "Imports", "m", 8.0, "Peat"),
        (day, "Ontario", "Coal, received", "t", 7.0, "Coal")], FACTS)


def test_all_fuels_at_once(spark):
    table = facts(spark)
    together, counts = energy.fuel_balances(table)
    apart = energy.union_fuels(*(energy.energy_balance(table.where(F.col("fuel") == fuel), fuel)
                                 for fuel in energy.FUELS))
    rows = [sorted(df.select(*energy.COLUMNS).collect(), key=repr) for df in (together, apart)]
    assert rows[0] == rows[1]
    per_place = {r.geo: r["count"] for r in apart.groupBy("geo").count().collect()}
    assert {r.geo: r.n for r in counts.collect()} == per_place


def test_region_means_weigh_rows(spark):
    places = spark.createDataFrame([("a", 0.0, 10.0), ("b", 4.0, 30.0), ("c", 1.0, 1.0), ("d", None, 50.0)],
                                   "geo string, latitude double, longitude double")
    table = spark.createDataFrame([(g,) for g in "aaabccddx"], "geo string")
    regions = {"a": "R", "b": "R", "d": "R", "x": "S"}
    placed = geo.add_region(geo.add_coordinates(table, places), regions)
    want = geo.centre_regions(placed, ["R", "S"])
    got = geo.centre_regions(placed, ["R", "S"], means=geo.region_means(
        table.groupBy("geo").agg(F.count(F.lit(1)).alias("n")), places, regions))
    assert sorted(want.collect(), key=repr) == sorted(got.collect(), key=repr)


def test_no_facts(spark):
    together, counts = energy.fuel_balances(facts(spark).limit(0))
    assert together.count() == 0 and counts.count() == 0
