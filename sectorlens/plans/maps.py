"""Statistics flow: balances and generation tables ready for the map."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import wordlists
from ..operators import energy, geo, series


def energy_map(facts: DataFrame, places: DataFrame, fuels: Mapping[str, Sequence[energy.Share]] = energy.FUELS,
               regions: Mapping[str, str] = wordlists.REGION_OF_GEO,
               labels: Sequence[str] = wordlists.BALANCE_LABELS,
               radius: float = geo.RADIUS) -> DataFrame:
    """Balance the facts of all fuels, add coordinates and regions, centre merged regions, spread the balances.

    ``facts`` has ``energy.COLUMNS`` and ``fuel`` and is evaluated once.
    """
    balanced, counts = energy.fuel_balances(facts, fuels)
    placed = geo.add_region(geo.add_coordinates(balanced, places), regions)
    centred = geo.centre_regions(placed, sorted(set(regions.values())),
                                 means=geo.region_means(counts, places, regions))
    return geo.offset_fixed(centred, labels=labels, radius=radius)


def generation_map(facts: DataFrame, places: DataFrame, order: str, label: str = "label",
                   regions: Mapping[str, str] = wordlists.REGION_OF_GEO,
                   radius: float = geo.RADIUS) -> DataFrame:
    """The same for generation by type, whose types are spread in order of appearance."""
    counts = facts.groupBy("geo").agg(F.count(F.lit(1)).alias("n"))
    placed = geo.add_region(geo.add_coordinates(facts, places), regions)
    centred = geo.centre_regions(placed, sorted(set(regions.values())),
                                 means=geo.region_means(counts, places, regions))
    return geo.offset_observed(centred, order, label, radius)


def energy_tables(gas: DataFrame, crude: DataFrame, coal: DataFrame, places: DataFrame,
                  unit: str = "Cubic metres", forecaster=series.seasonal_drift) -> DataFrame:
    """The whole flow for three fuels: forecasts, coal repeated for Ontario, balances, map.

    Tables have the columns of ``energy.COLUMNS``.  Gas and crude are limited to one unit.
    """
    keys = ["geo", "label"]
    predicted = {
        "Gas": series.prepare_and_predict(gas, keys, lambda df: df["uom"] == unit, forecaster=forecaster),
        "Crude": series.prepare_and_predict(crude, keys, lambda df: df["uom"] == unit, forecaster=forecaster),
        "Coal": energy.replicate_geo(series.prepare_and_predict(coal, keys, forecaster=forecaster)),
    }
    return energy_map(energy.union_fuels(*(
        t.select(*energy.COLUMNS, F.lit(fuel).alias("fuel")) for fuel, t in predicted.items())), places)
