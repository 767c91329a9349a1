"""Queries on monthly statistics, and their SQL twins."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import energy, geo, series
from ..operators.energy import INPUT, OUTPUT, Share
from ..plans import maps
from . import sql
from .roles import REGIONS, order_facts, places, statistics

START, END = date(1996, 1, 1), date(2000, 12, 31)
SERIES = ["geo", "label"]

GAS = (Share(INPUT, 38900, ("A-F", "N-F")), Share(OUTPUT, 38900, ("R-F", "A-O")))
COAL = (Share(INPUT, 29, ("A-F", "N-F")), Share(INPUT, 25, ("R-F",)),
        Share(OUTPUT, 29, ("A-O",)), Share(OUTPUT, 25, ("N-O",)))
# One fuel per return flag, so that three fact tables can be united.
SLICES = {
    "Gas": ("A", (Share(INPUT, 38900, ("A-F",)), Share(OUTPUT, 38900, ("A-O",)))),
    "Crude": ("N", (Share(INPUT, 35700, ("N-F",)), Share(OUTPUT, 35700, ("N-O",)))),
    "Coal": ("R", (Share(INPUT, 29, ("R-F",)), Share(OUTPUT, 25, ("R-O",)))),
}


def _rounded(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.round(c, 4))
    return df


def unit_filter(spark, folder):
    facts = statistics(spark, folder)
    return series.filter_facts(facts, lambda df: df["uom"] == "Cubic metres").select(
        "seq", "ref_date", "geo", "label", "value")


def energy_io(spark, folder):
    return energy.energy_balance(statistics(spark, folder), "Gas", GAS)


def energy_io_two_factor(spark, folder):
    return energy.energy_balance(statistics(spark, folder), "Coal", COAL)


def _fuels(spark, folder):
    facts = statistics(spark, folder)
    return {fuel: energy.energy_balance(facts.where(F.col("l_returnflag") == flag), fuel, shares)
            for fuel, (flag, shares) in SLICES.items()}


def union_facts(spark, folder):
    return energy.union_fuels(*_fuels(spark, folder).values())


def replicate_geo(spark, folder):
    return energy.replicate_geo(statistics(spark, folder).select("seq", "ref_date", "geo", "label", "value"))


def region_rollup(spark, folder):
    return geo.add_region(statistics(spark, folder), REGIONS).groupBy("geo2").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("value"))


def _placed(spark, folder):
    facts = statistics(spark, folder).select("seq", "ref_date", "geo", "label", "value")
    return geo.add_coordinates(facts, places(spark, folder))


def geo_left_join(spark, folder):
    return _placed(spark, folder)


def region_centroids(spark, folder):
    placed = geo.add_region(_placed(spark, folder), REGIONS)
    return _rounded(geo.centre_regions(placed, list(REGIONS.values())), "latitude", "longitude")


LABELS = ("A-F", "A-O", "N-F", "N-O", "R-F")


def coord_offset_fixed(spark, folder):
    return _rounded(geo.offset_fixed(_placed(spark, folder), labels=LABELS), "latitude", "longitude")


def coord_offset_observed(spark, folder):
    return _rounded(geo.offset_observed(_placed(spark, folder), "seq"), "latitude", "longitude")


def map_ready(spark, folder):
    flags = F.create_map(*(F.lit(x) for fuel, (flag, _) in SLICES.items() for x in (flag, fuel)))
    facts = statistics(spark, folder).withColumn("fuel", flags[F.col("l_returnflag")])
    fuels = {fuel: shares for fuel, (_, shares) in SLICES.items()}
    mapped = maps.energy_map(facts, places(spark, folder), fuels, REGIONS)
    return _rounded(mapped, "latitude", "longitude")


def generation_map(spark, folder):
    facts = statistics(spark, folder).select("seq", "ref_date", "geo", "label", "value")
    mapped = maps.generation_map(facts, places(spark, folder), "seq", "label", REGIONS)
    return _rounded(mapped, "latitude", "longitude")


def monthly_series(spark, folder):
    return _rounded(series.monthly_series(order_facts(spark, folder), ["geo"], START, END), "value")


def forecastable_series(spark, folder):
    months = series.monthly_series(order_facts(spark, folder), SERIES, START, END)
    return _rounded(series.forecastable(months, SERIES, 48), "value")


def seasonal_forecast(spark, folder):
    months = series.monthly_series(order_facts(spark, folder), SERIES, START, END)
    return _rounded(series.seasonal_drift(months, SERIES), "value")


def seasonal_model_forecast(spark, folder):
    months = series.monthly_series(order_facts(spark, folder), SERIES, START, END)
    return _rounded(series.seasonal_regression(months, SERIES), "value")


def actuals_plus_forecast(spark, folder):
    done = series.prepare_and_predict(order_facts(spark, folder), SERIES,
                                      F.col("label") != "P", START, END)
    return _rounded(done, "value")


def _balance(relation: str, fuel: str, shares) -> str:
    def total(direction: str) -> str:
        return " + ".join(
            f"coalesce(sum(value) FILTER (WHERE label IN ({sql.quoted(s.labels)})), 0) * {s.factor}"
            for s in shares if s.direction == direction)

    io = f"""SELECT ref_date, geo, {total(INPUT)} AS i, {total(OUTPUT)} AS o
        FROM {relation} r WHERE ref_date IS NOT NULL AND geo IS NOT NULL GROUP BY ref_date, geo"""
    return f"""(SELECT ref_date, geo, '{fuel} ' || label AS label, uom, coalesce(value, 0) AS value
          FROM {relation} r
        UNION ALL SELECT ref_date, geo, '{fuel} Input MJ', 'MJ', i FROM ({io})
        UNION ALL SELECT ref_date, geo, '{fuel} Output MJ', 'MJ', o FROM ({io}))"""


def _union() -> str:
    return "(" + " UNION ALL ".join(
        "SELECT * FROM " + _balance(
            f"(SELECT * FROM {sql.STATISTICS} z WHERE l_returnflag = '{flag}')", fuel, shares) + " b"
        for fuel, (flag, shares) in SLICES.items()) + ")"


_FACTS = f"(SELECT seq, ref_date, geo, label, value FROM {sql.STATISTICS} s)"
_PLACED = f"(SELECT f.*, latitude, longitude FROM {_FACTS} f LEFT JOIN {sql.PLACES} p USING (geo))"


def _centred(relation: str) -> str:
    """Relation with geo, latitude, longitude: regions added and merged ones centred."""
    return f"""(SELECT * REPLACE (
          CASE WHEN geo2 IN ('North', 'East') THEN avg(latitude) OVER (PARTITION BY geo2)
            ELSE latitude END AS latitude,
          CASE WHEN geo2 IN ('North', 'East') THEN avg(longitude) OVER (PARTITION BY geo2)
            ELSE longitude END AS longitude)
        FROM (SELECT *, {sql.REGION} AS geo2 FROM {relation} r))"""


def _offset_fixed(relation: str, labels) -> str:
    at = f"(list_position([{sql.quoted(labels)}], label) - 1)"
    angle = f"2 * pi() * {at} / {len(labels)}"
    return f"""SELECT * REPLACE (round(latitude + coalesce(2 * sin({angle}), 0), 4) AS latitude,
          round(longitude + coalesce(2 * cos({angle}), 0), 4) AS longitude) FROM {relation} o"""


def _offset_observed(relation: str) -> str:
    return f"""WITH f AS MATERIALIZED (SELECT * FROM {relation} x),
        l AS (SELECT label, row_number() OVER (ORDER BY min(seq), label) - 1 AS k,
          count(*) OVER () AS n FROM f GROUP BY label)
        SELECT f.* REPLACE (round(latitude + 2 * sin(2 * pi() * k / n), 4) AS latitude,
          round(longitude + 2 * cos(2 * pi() * k / n), 4) AS longitude) FROM f JOIN l USING (label)"""


def _months(keys: str, where: str = "true") -> str:
    return f"""(SELECT {keys}, last_day(ref_date) AS ref_date, coalesce(sum(value), 0) AS value
        FROM {sql.ORDER_FACTS} o WHERE ref_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
        AND {where} GROUP BY {keys}, last_day(ref_date))"""


def _drift(months: str) -> str:
    return f"""(WITH m AS (SELECT geo, label, CAST(date_trunc('month', ref_date) AS DATE) AS d, value
          FROM {months} q),
        t AS (SELECT geo, label, count(*) AS n, max(d) AS last, avg(value) AS mean,
          regr_slope(value, year(d) * 12 + month(d)) AS slope FROM m GROUP BY geo, label),
        h AS (SELECT *, CAST(last + to_months(CAST(step AS INTEGER)) AS DATE) AS ref_date
          FROM t, range(1, 3) r(step) WHERE n >= 24)
        SELECT h.geo, h.label, h.ref_date, round(coalesce(m.value + slope * 12, mean), 4) AS value
        FROM h LEFT JOIN m ON h.geo = m.geo AND h.label = m.label
          AND m.d = CAST(h.ref_date - to_months(12) AS DATE))"""


def _regression(months: str) -> str:
    """Each subset of inputs solved by sweeping one input after the other out of the covariances."""
    two = "({0}{0} * {1}{1} - {0}{1} * {0}{1})"
    return f"""(WITH s AS (SELECT geo, label, year(ref_date) * 12 + month(ref_date) AS m,
            CAST(value AS DOUBLE) AS y FROM {months} q),
        l AS (SELECT s.*, a.y AS a, b.y AS b, CAST(s.m - min(s.m) OVER w AS DOUBLE) AS t,
            max(s.m) OVER w AS last, count(*) OVER w AS months, avg(s.y) OVER w AS overall
          FROM s LEFT JOIN s a ON a.geo = s.geo AND a.label = s.label AND a.m = s.m - 1
          LEFT JOIN s b ON b.geo = s.geo AND b.label = s.label AND b.m = s.m - 12
          WINDOW w AS (PARTITION BY s.geo, s.label)),
        g AS (SELECT geo, label, regr_slope(y, m) AS slope, max(t) AS newest, any_value(last) AS last,
            any_value(overall) AS overall, max_by(y, m) AS y_last FROM l WHERE months >= 24 GROUP BY geo, label),
        c AS (SELECT geo, label, count(*) AS n, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, avg(t) AS mt,
            var_pop(y) AS yy, var_pop(a) AS aa, var_pop(b) AS bb, var_pop(t) AS tt, covar_pop(a, b) AS ab,
            covar_pop(a, t) AS a_t, covar_pop(b, t) AS bt, covar_pop(a, y) AS ay, covar_pop(b, y) AS b_y,
            covar_pop(t, y) AS ty FROM l WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY geo, label),
        w AS (SELECT *, aa - a_t * a_t / tt AS aa2, bb - bt * bt / tt AS bb2, ab - a_t * bt / tt AS ab2,
            ay - ty * a_t / tt AS ay2, b_y - ty * bt / tt AS by2 FROM c),
        v AS (SELECT *, (ay2 * bb2 - by2 * ab2) / nullif(aa2 * bb2 - ab2 * ab2, 0) AS a3,
            (by2 * aa2 - ay2 * ab2) / nullif(aa2 * bb2 - ab2 * ab2, 0) AS b3 FROM w),
        f AS (
          SELECT *, 0 AS place, 'mean' AS model, 2 AS k, 0.0 AS ca, 0.0 AS cb, 0.0 AS ct FROM v
          UNION ALL SELECT *, 1, 'lag', 3, ay / aa, 0, 0 FROM v
          UNION ALL SELECT *, 2, 'season', 3, 0, b_y / bb, 0 FROM v
          UNION ALL SELECT *, 3, 'trend', 3, 0, 0, ty / tt FROM v
          UNION ALL SELECT *, 4, 'lag+season', 4, (ay * bb - b_y * ab) / {two.format('a', 'b')},
            (b_y * aa - ay * ab) / {two.format('a', 'b')}, 0 FROM v
          UNION ALL SELECT *, 5, 'lag+trend', 4, ay2 / aa2, 0, (ty - ay2 / aa2 * a_t) / tt FROM v
          UNION ALL SELECT *, 6, 'season+trend', 4, 0, by2 / bb2, (ty - by2 / bb2 * bt) / tt FROM v
          UNION ALL SELECT *, 7, 'lag+season+trend', 5, a3, b3, (ty - a3 * a_t - b3 * bt) / tt FROM v),
        o AS (SELECT *, round(ln(greatest(yy - ca * ay - cb * b_y - ct * ty, 1e-12))
            + 2 * k / CAST(greatest(n - k - 1, 1) AS DOUBLE), 9) AS criterion FROM f WHERE n > k),
        best AS (SELECT * FROM o WHERE criterion IS NOT NULL QUALIFY row_number() OVER (
            PARTITION BY geo, label ORDER BY criterion, place) = 1),
        p AS (SELECT g.*, model, my - ca * ma - cb * mb - ct * mt AS c0, ca, cb, ct, x.y AS ago1, z.y AS ago2
          FROM g LEFT JOIN best USING (geo, label)
          LEFT JOIN s x ON x.geo = g.geo AND x.label = g.label AND x.m = g.last - 11
          LEFT JOIN s z ON z.geo = g.geo AND z.label = g.label AND z.m = g.last - 10),
        f1 AS (SELECT *, c0 + ca * y_last + CASE WHEN cb = 0 THEN 0 ELSE cb * ago1 END + ct * (newest + 1) AS v1 FROM p),
        f2 AS (SELECT *, c0 + ca * v1 + CASE WHEN cb = 0 THEN 0 ELSE cb * ago2 END + ct * (newest + 2) AS v2 FROM f1),
        e AS (SELECT *, CASE WHEN model IS NULL THEN 'no inputs can be fitted'
            WHEN v1 IS NULL OR v2 IS NULL THEN 'a month that the model needs is missing' END AS error FROM f2)
        SELECT geo, label, make_date(CAST((last + step - 1) // 12 AS INTEGER), CAST((last + step - 1) % 12 + 1 AS INTEGER), 1)
            AS ref_date, round(CASE WHEN error IS NOT NULL THEN coalesce(if(step = 1, ago1, ago2) + slope * 12, overall)
            WHEN step = 1 THEN v1 ELSE v2 END, 4) AS value,
          CASE WHEN error IS NULL THEN model ELSE 'drift' END AS model, error FROM e, range(1, 3) r(step))"""


ORACLES = {
    "seasonal_model_forecast": f"SELECT * FROM {_regression(_months('geo, label'))} f",
    "unit_filter": f"""SELECT seq, ref_date, geo, label, value FROM {sql.STATISTICS} s
        WHERE uom = 'Cubic metres'""",
    "energy_io": f"SELECT * FROM {_balance(sql.STATISTICS, 'Gas', [Share(s.direction, s.factor, s.labels) for s in GAS])} b",
    "energy_io_two_factor": f"SELECT * FROM {_balance(sql.STATISTICS, 'Coal', COAL)} b",
    "union_facts": f"SELECT * FROM {_union()} u",
    "replicate_geo": f"""SELECT * FROM {_FACTS} f UNION ALL
        SELECT * REPLACE ('Ontario' AS geo) FROM {_FACTS} f""",
    "region_rollup": f"""SELECT geo2, count(*) AS n_rows, sum(value) AS value
        FROM (SELECT *, {sql.REGION} AS geo2 FROM {_FACTS} f) GROUP BY geo2""",
    "geo_left_join": f"SELECT * FROM {_PLACED} p",
    "region_centroids": f"""SELECT * REPLACE (round(latitude, 4) AS latitude, round(longitude, 4)
        AS longitude) FROM {_centred(_PLACED)} c""",
    "coord_offset_fixed": _offset_fixed(_PLACED, LABELS),
    "coord_offset_observed": _offset_observed(_PLACED),
    "map_ready": _offset_fixed(_centred(
        f"(SELECT u.*, latitude, longitude FROM {_union()} u LEFT JOIN {sql.PLACES} p USING (geo))"),
        ("Gas Input MJ", "Gas Output MJ", "Crude Input MJ", "Crude Output MJ", "Coal Input MJ",
         "Coal Output MJ")),
    "generation_map": _offset_observed(_centred(_PLACED)),
    "monthly_series": f"SELECT geo, ref_date, round(value, 4) AS value FROM {_months('geo')} m",
    "forecastable_series": f"""SELECT geo, label, ref_date, round(value, 4) AS value,
          count(*) OVER (PARTITION BY geo, label) AS n_months
        FROM {_months('geo, label')} m QUALIFY n_months >= 48""",
    "seasonal_forecast": f"SELECT * FROM {_drift(_months('geo, label'))} f",
    "actuals_plus_forecast": f"""SELECT order_id, ref_date, geo, label, round(value, 4) AS value
          FROM {sql.ORDER_FACTS} o WHERE label <> 'P'
        UNION ALL SELECT NULL, ref_date, geo, label, value
          FROM {_drift(_months('geo, label', "label <> 'P'"))} f""",
}

QUERIES = {f.__name__: f for f in (
    energy_io, energy_io_two_factor, unit_filter, union_facts, replicate_geo, region_rollup,
    geo_left_join, region_centroids, coord_offset_fixed, coord_offset_observed, map_ready,
    generation_map, monthly_series, forecastable_series, seasonal_forecast,
    seasonal_model_forecast, actuals_plus_forecast)}
