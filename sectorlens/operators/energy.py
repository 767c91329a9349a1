"""Energy balances of monthly statistics: conditional sums times factors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, stored

INPUT, OUTPUT = "Input", "Output"


@dataclass(frozen=True)
class Share:
    """Labels that count in one direction with one conversion factor (MJ per unit)."""

    direction: str
    factor: float
    labels: tuple[str, ...]


# Labels and factors per fuel.  Gas is counted in thousand cubic
# metres.  The coal factors are MJ per kilogram although coal is counted in
# tonnes; they are kept as published, pass other shares to correct them.
GAS = (
    Share(INPUT, 38900, ("Gross withdrawals", "Marketable production", "Imports")),
    Share(OUTPUT, 38900, ("Commercial consumption", "Industrial consumption",
                          "Residential consumption", "Exports")),
)
CRUDE = (
    Share(INPUT, 35700, (
        "Heavy crude oil", "Light and medium crude oil",
        "Non-upgraded production of crude bitumen", "In-Situ crude bitumen production",
        "Mined crude bitumen production", "Crude bitumen sent for further processing",
        "Synthetic crude oil production", "Condensate", "Pentanes plus",
        "Imports of crude oil and equivalent products by refineries",
        "Imports of crude oil and equivalent products by other")),
    Share(OUTPUT, 35700, (
        "Light and medium crude oil used as an input in refineries",
        "Heavy crude oil used as an input in refineries",
        "Crude bitumen used as an input in refineries",
        "Synthetic crude oil used as an input in refineries",
        "Export to the United States by pipelines",
        "Export to the United States by other means", "Export to other countries")),
)
COAL = (
    Share(INPUT, 29, ("Coal coke, received", "Coal coke, production")),
    Share(OUTPUT, 29, ("Coal coke, used in blast furnaces", "Coal coke, sold for industrial use",
                       "Coal coke, used in associated works",
                       "Coal coke, all other sales and/or uses", "Coal coke, sold for export")),
    Share(INPUT, 25, ("Coal, received",)),
    Share(OUTPUT, 25, ("Coal, charged to ovens", "Coal, sold or used for other purposes")),
)
FUELS = {"Gas": GAS, "Crude": CRUDE, "Coal": COAL}

COLUMNS = ("ref_date", "geo", "label", "uom", "value")


def number(value: Column) -> Column:
    """Double of a raw statistics cell: symbols and NaN become null."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def balance_sum(shares: Sequence[Share], direction: str, fuel: str) -> Column:
    """Aggregate: energy in one direction.  A factor applies to the sum of its labels."""
    total = F.lit(0.0)
    for share in shares:
        if share.direction == direction:
            labels = [f"{fuel} {label}" for label in share.labels]
            total = total + F.coalesce(
                F.sum(F.when(F.col("label").isin(labels), F.col("value"))), F.lit(0.0)
            ) * F.lit(float(share.factor))
    return total


def energy_balance(facts: DataFrame, fuel: str, shares: Sequence[Share] | None = None) -> DataFrame:
    """Facts with prefixed labels and, per date and place, one input and one output row in MJ.

    ``facts`` has the columns of ``COLUMNS``.  Both directions come from a single
    aggregation with partial combine; facts without date or place are kept but
    belong to no balance.
    """
    shares = FUELS[fuel] if shares is None else shares
    base = facts.select(
        "ref_date", "geo", F.concat(F.lit(f"{fuel} "), "label").alias("label"), "uom",
        F.coalesce(F.col("value"), F.lit(0.0)).alias("value"))
    sums = base.where(F.col("ref_date").isNotNull() & F.col("geo").isNotNull()).groupBy(
        "ref_date", "geo").agg(balance_sum(shares, INPUT, fuel).alias("e_in"),
                               balance_sum(shares, OUTPUT, fuel).alias("e_out"))
    rows = sums.select("ref_date", "geo", F.stack(
        F.lit(2), F.lit(f"{fuel} Input MJ"), F.col("e_in"), F.lit(f"{fuel} Output MJ"), F.col("e_out")
    ).alias("label", "value")).withColumn("uom", F.lit("MJ"))
    return base.unionByName(rows.select(*COLUMNS))


def fuel_balances(facts: DataFrame, fuels: Mapping[str, Sequence[Share]] = FUELS) -> tuple[DataFrame, DataFrame]:
    """Balances of all fuels at once: the facts with the balance rows, and the rows per place.

    ``facts`` has ``COLUMNS`` and ``fuel``; other fuels are left out.  Facts are written once; one
    aggregation by fuel, date and place sums every share of every fuel and counts the rows.
    """
    base = stored(facts.where(F.col("fuel").isin(list(fuels))).select(
        "fuel", "ref_date", "geo", F.concat("fuel", F.lit(" "), "label").alias("label"), "uom",
        F.coalesce(F.col("value"), F.lit(0.0)).alias("value")))

    def total(direction: str) -> Column:
        result = F.lit(0.0)
        # Labels carry their fuel's name, so a share adds nothing to other fuels.
        for fuel, shares in fuels.items():
            result = result + balance_sum(shares, direction, fuel)
        return result

    sums = checkpointed(base.groupBy("fuel", "ref_date", "geo").agg(
        F.count(F.lit(1)).alias("n"), total(INPUT).alias("e_in"), total(OUTPUT).alias("e_out")))
    dated = F.col("ref_date").isNotNull() & F.col("geo").isNotNull()
    rows = sums.where(dated).select("ref_date", "geo", F.stack(
        F.lit(2), F.concat("fuel", F.lit(" Input MJ")), F.col("e_in"),
        F.concat("fuel", F.lit(" Output MJ")), F.col("e_out")).alias("label", "value")
    ).withColumn("uom", F.lit("MJ"))
    counts = sums.groupBy("geo").agg(F.sum(F.col("n") + F.when(dated, 2).otherwise(0)).alias("n"))
    return base.select(*COLUMNS).unionByName(rows.select(*COLUMNS)), counts


def union_fuels(*tables: DataFrame) -> DataFrame:
    """Balances of several fuels in one table."""
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result


def replicate_geo(facts: DataFrame, name: str = "Ontario", geo: str = "geo") -> DataFrame:
    """Every row twice, the second time under another place, from one scan."""
    return facts.withColumn(geo, F.explode(F.array(F.col(geo), F.lit(name))))
