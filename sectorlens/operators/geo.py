"""Coordinates, regions and map offsets."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import wordlists
from ..functions.numeric import circle_offset
from ..session import checkpointed
from .joins import lookup_join

# Fixed value: radius, in degrees, of the circle on which categories are drawn.
RADIUS = 2.0


def add_coordinates(facts: DataFrame, places: DataFrame, geo: str = "geo") -> DataFrame:
    """Left join of latitude and longitude by place."""
    return lookup_join(facts, places.select(geo, "latitude", "longitude"), [geo], "left")


def region_of(geo: Column, regions: Mapping[str, str] = wordlists.REGION_OF_GEO) -> Column:
    """Region of a place; a place outside the mapping is its own region."""
    result = geo
    for region in sorted(set(regions.values())):
        members = [g for g, r in regions.items() if r == region]
        result = F.when(geo.isin(members), F.lit(region)).otherwise(result)
    return result


def add_region(facts: DataFrame, regions: Mapping[str, str] = wordlists.REGION_OF_GEO,
               geo: str = "geo", name: str = "geo2") -> DataFrame:
    """Add the region column."""
    return facts.withColumn(name, region_of(F.col(geo), regions))


def region_means(counts: DataFrame, places: DataFrame,
                 regions: Mapping[str, str] = wordlists.REGION_OF_GEO) -> DataFrame:
    """Mean coordinates of each merged region from the rows per place, ``counts`` (geo, n).

    Every row counts, so a place weighs as much as it has rows with coordinates.
    """
    names = sorted(set(regions.values()))
    known = add_region(counts.join(places.select("geo", "latitude", "longitude"), "geo"), regions)

    def mean(column: str) -> Column:
        present = F.when(F.col(column).isNotNull(), F.col("n"))
        return F.sum(F.col(column) * F.col("n")) / F.sum(present)

    return known.where(F.col("geo2").isin(names)).groupBy("geo2").agg(
        mean("latitude").alias("mean_lat"), mean("longitude").alias("mean_lon"))


def centre_regions(facts: DataFrame, regions: Sequence[str] | None = None, region: str = "geo2",
                   means: DataFrame | None = None) -> DataFrame:
    """Move the rows of merged regions to the mean of their rows' coordinates.

    The mean counts every fact row, not every place.  ``means`` (``region_means``) spare the
    facts a second evaluation; without them they are aggregated from the facts.  There is one
    mean per listed region, so the joined side is as short as the list.
    """
    wanted = sorted(set(wordlists.REGION_OF_GEO.values())) if regions is None else list(regions)
    if means is None:
        means = facts.where(F.col(region).isin(wanted)).groupBy(region).agg(
            F.avg("latitude").alias("mean_lat"), F.avg("longitude").alias("mean_lon"))
    placed = facts.join(F.broadcast(means), region, "left")
    merged = F.col(region).isin(wanted)
    return placed.withColumn("latitude", F.when(merged, F.col("mean_lat")).otherwise(F.col("latitude"))) \
                 .withColumn("longitude", F.when(merged, F.col("mean_lon")).otherwise(F.col("longitude"))) \
                 .select(*facts.columns)


def offset_fixed(facts: DataFrame, label: str = "label",
                 labels: Sequence[str] = wordlists.BALANCE_LABELS,
                 radius: float = RADIUS) -> DataFrame:
    """Spread the listed labels evenly on a circle; other labels stay where they are."""
    north = east = F.lit(0.0)
    for at, name in enumerate(labels):
        angle = 2 * math.pi * at / len(labels)
        north = F.when(F.col(label) == name, F.lit(radius * math.sin(angle))).otherwise(north)
        east = F.when(F.col(label) == name, F.lit(radius * math.cos(angle))).otherwise(east)
    return facts.withColumn("latitude", F.col("latitude") + north) \
                .withColumn("longitude", F.col("longitude") + east)


def offset_observed(facts: DataFrame, order: str, label: str = "label",
                    radius: float = RADIUS) -> DataFrame:
    """Spread all occurring labels on a circle in order of first appearance.

    Only the distinct labels, after map-side combine, are ranked together.
    Rows without a label stay where they are.
    """
    seen = checkpointed(facts.where(F.col(label).isNotNull()).groupBy(label).agg(
        F.min(order).alias("first_seen"), F.count(F.lit(1)).alias("key_rows")))
    everything = Window.orderBy("first_seen", label)
    north, east = circle_offset(F.col("place"), F.col("places"), radius)
    angles = (seen.withColumn("place", F.row_number().over(everything) - 1)
                  .withColumn("places", F.count(F.lit(1)).over(Window.partitionBy()))
                  .select(label, north.alias("north"), east.alias("east")))
    placed = lookup_join(facts, angles, [label], "left", key_rows=seen.select(label, "key_rows"))
    return placed.withColumn("latitude", F.col("latitude") + F.coalesce("north", F.lit(0.0))) \
                 .withColumn("longitude", F.col("longitude") + F.coalesce("east", F.lit(0.0))) \
                 .select(*facts.columns)
