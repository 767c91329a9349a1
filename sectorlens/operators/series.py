"""Monthly series and their forecasts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed
from . import seasonal

# Months a series needs, season length and months forecast.
LEAST_MONTHS, SEASON, HORIZON = 24, 12, 2
# Default date range of the modelled months, both ends included.
START, END = date(2016, 1, 1), date(2023, 10, 31)


def filter_facts(facts: DataFrame, condition: Callable[[DataFrame], Column] | Column | None) -> DataFrame:
    """Apply the caller's predicate, e.g. on a unit column; none keeps all rows."""
    if condition is None:
        return facts
    return facts.where(condition(facts) if callable(condition) else condition)


def monthly_series(facts: DataFrame, keys: Sequence[str], start: date = START, end: date = END,
                   ref_date: str = "ref_date", value: str = "value") -> DataFrame:
    """Sum per series and month, labelled by the month's last day.

    Only months that occur appear; a month of nulls sums to 0; rows with a null
    key belong to no series.
    """
    chosen = facts.where(F.col(ref_date).between(F.lit(start), F.lit(end)))
    for key in keys:
        chosen = chosen.where(F.col(key).isNotNull())
    return chosen.groupBy(*keys, F.last_day(ref_date).alias(ref_date)).agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias(value))


def forecastable(series: DataFrame, keys: Sequence[str], least: int = LEAST_MONTHS) -> DataFrame:
    """Rows of the series that have enough months, with their count ``n_months``.

    A series has at most one row per month of the date range, which bounds the window.
    """
    counted = series.withColumn("n_months", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    return counted.where(F.col("n_months") >= least)


def seasonal_drift(series: DataFrame, keys: Sequence[str], horizon: int = HORIZON,
                   season: int = SEASON, least: int = LEAST_MONTHS, ref_date: str = "ref_date",
                   value: str = "value") -> DataFrame:
    """Forecast: value one season ago plus one season of linear trend.

    The trend is the least-squares slope over the month number.  Without a value
    one season ago the mean of the series takes its place.  One row per forecast
    month, dated by its first day; all in one aggregation per series, whose
    month map holds at most one entry per month.
    """
    month = F.months_between(F.trunc(ref_date, "MM"), F.lit(date(1970, 1, 1)))
    fitted = series.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope(F.col(value), month).alias("slope"),
        F.avg(value).alias("mean"),
        F.max(F.trunc(ref_date, "MM")).alias("last"),
        F.map_from_entries(F.collect_list(F.struct(F.trunc(ref_date, "MM"), value))).alias("past"),
    ).where(F.col("n") >= least)
    ahead = fitted.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    target = F.add_months("last", F.col("step"))
    season_ago = F.try_element_at("past", F.add_months(target, -season))
    return ahead.select(
        *keys, target.alias(ref_date),
        F.coalesce(season_ago + F.col("slope") * season, F.col("mean")).alias(value))


def seasonal_models(series: DataFrame, keys: Sequence[str], horizon: int = HORIZON,
                    season: int = SEASON, least: int = LEAST_MONTHS, ref_date: str = "ref_date",
                    value: str = "value") -> DataFrame:
    """Forecast every series with its own seasonal autoregressive model.

    Orders are chosen by corrected information criterion.  A series that cannot
    be modelled falls back to season-ago-plus-trend and says so in ``error``;
    ``model`` names what was used.  Spark distributes the series; one series, a
    few hundred months at most, is fitted per call.
    """
    keys = list(keys)
    fields = [series.schema[k] for k in keys]
    schema = T.StructType([*fields, T.StructField(ref_date, T.DateType()),
                           T.StructField(value, T.DoubleType()), T.StructField("model", T.StringType()),
                           T.StructField("error", T.StringType())])
    dated = series.select(*keys, F.trunc(ref_date, "MM").alias(ref_date), value)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(ref_date)
        if len(group) < least:
            return pd.DataFrame(columns=[f.name for f in schema])
        values = group[value].to_numpy(dtype=float)
        last = pd.Timestamp(group[ref_date].iloc[-1])
        try:
            ahead, model = seasonal.forecast(values, horizon, season)
            error = None
        except (ValueError, np.linalg.LinAlgError) as failure:
            months = np.array([d.year * 12 + d.month for d in pd.to_datetime(group[ref_date])])
            ahead, model = seasonal.drift(values, months, horizon, season), "drift"
            error = f"{type(failure).__name__}: {failure}"
        dates = [(last + pd.DateOffset(months=s)).date() for s in range(1, horizon + 1)]
        rows = {k: [group[k].iloc[0]] * horizon for k in keys}
        return pd.DataFrame({**rows, ref_date: dates, value: ahead, "model": model, "error": error})

    return dated.groupBy(*keys).applyInPandas(fit, schema)


#: What a month's value may depend on: the month before, the same month a year ago, and the month's number.
_INPUTS = ("lag", "season", "trend")


def _solved(names: Sequence[str]) -> tuple[list[Column], Column]:
    """Coefficients of a least-squares fit on these inputs from covariances, and the variance it explains.

    Cramer's rule on at most three inputs.  Null where the inputs depend on each other.
    """
    def cov(a: str, b: str) -> Column:
        return F.col("_".join(["c", *sorted((a, b))]))

    def determinant(rows: list[list[Column]]) -> Column:
        if len(rows) == 1:
            return rows[0][0]
        terms = [rows[0][j] * determinant([[x for k, x in enumerate(row) if k != j] for row in rows[1:]])
                 for j in range(len(rows))]
        total = terms[0]
        for j, term in enumerate(terms[1:], 1):
            total = total - term if j % 2 else total + term
        return total

    if not names:
        return [], F.lit(0.0)
    square = [[cov(a, b) for b in names] for a in names]
    scale = cov(names[0], names[0])
    for name in names[1:]:
        scale = scale * cov(name, name)
    whole = determinant(square)
    # The share of the inputs' spread that is their own.
    usable = F.when((scale > 0) & (whole > 1e-9 * scale), whole)
    found = [determinant([[cov(a, "y") if b == name else cov(a, b) for b in names] for a in names]) / usable
             for name in names]
    explained = found[0] * cov(names[0], "y")
    for name, value in zip(names[1:], found[1:]):
        explained = explained + value * cov(name, "y")
    return found, explained


def seasonal_regression(series: DataFrame, keys: Sequence[str], horizon: int = HORIZON, season: int = SEASON,
                        least: int = LEAST_MONTHS, ref_date: str = "ref_date", value: str = "value") -> DataFrame:
    """Forecast every series by a regression on the month before, the month a season ago and time.

    One aggregation sums the cross products of a series' months; each of the eight subsets of inputs
    is solved from them in column expressions, and the one of least corrected information
    criterion, on equal ones that of fewest inputs, is taken.  No task holds a series' rows beyond
    one window frame.  Result: keys, ``ref_date``, ``value``, ``model`` (the inputs, or ``mean``) and
    ``error``: a series that cannot be fitted falls back to season-ago-plus-trend and says why.
    """
    keys = list(keys)
    month = F.months_between(F.trunc(ref_date, "MM"), F.lit(date(1970, 1, 1))).cast("long")
    rows = series.select(*keys, month.alias("m"), F.col(value).cast("double").alias("v"))
    inside = Window.partitionBy(*keys).orderBy("m")
    past = {"lag": F.sum("v").over(inside.rangeBetween(-1, -1)),
            "season": F.sum("v").over(inside.rangeBetween(-season, -season)),
            "trend": (F.col("m") - F.min("m").over(Window.partitionBy(*keys))).cast("double")}
    placed = rows.withColumns(past).withColumn("y", F.col("v"))
    complete = F.col("lag").isNotNull() & F.col("season").isNotNull() & F.col("y").isNotNull()
    names = (*_INPUTS, "y")
    pairs = [tuple(sorted((a, b))) for i, a in enumerate(names) for b in names[i:]]
    sums = placed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("months"), F.count(F.when(complete, 1)).alias("n"), F.max("m").alias("last"),
        F.max("trend").alias("now"), F.avg("v").alias("overall"), F.regr_slope("v", "m").alias("slope"),
        F.map_from_entries(F.collect_list(F.struct("m", "v"))).alias("past"),
        *[F.avg(F.when(complete, F.col(c))).alias(f"mean_{c}") for c in names],
        *[F.covar_pop(F.when(complete, F.col(a)), F.when(complete, F.col(b))).alias(f"c_{a}_{b}") for a, b in pairs],
    ).where(F.col("months") >= least)
    models = [tuple(c for i, c in enumerate(_INPUTS) if code >> i & 1) for code in range(1 << len(_INPUTS))]
    options = []
    for chosen in sorted(models, key=len):
        found, explained = _solved(chosen)
        size = len(chosen) + 2
        spread = F.greatest(F.col("c_y_y") - explained, F.lit(1e-12))
        criterion = F.log(spread) + 2 * size / F.greatest(F.col("n") - size - 1, F.lit(1))
        options.append(F.when((F.col("n") > size) & explained.isNotNull() & ~F.isnan(criterion), F.struct(
            F.round(criterion, 9).alias("criterion"), F.lit(len(options)).alias("order"),
            F.lit("+".join(chosen) or "mean").alias("model"),
            *[(found[chosen.index(c)] if c in chosen else F.lit(0.0)).cast("double").alias(c) for c in _INPUTS])))
    best = sums.withColumn("best", F.array_min(F.filter(F.array(*options), lambda o: o.isNotNull())))
    # The coefficients become columns of their own, so that no step repeats the solution.
    ready = best.withColumns({f"b_{c}": F.col(f"best.{c}") for c in _INPUTS})
    constant = F.col("mean_y")
    for c in _INPUTS:
        constant = constant - F.col(f"b_{c}") * F.col(f"mean_{c}")
    ready = ready.withColumn("f0", F.try_element_at("past", F.col("last"))).withColumn("constant", constant)
    for step in range(1, horizon + 1):
        ago = F.col(f"f{step - season}") if step > season else F.try_element_at("past", F.col("last") + (step - season))
        seasonal_part = F.when(F.col("b_season") == 0, 0.0).otherwise(F.col("b_season") * ago)
        ready = ready.withColumn(f"ago{step}", ago).withColumn(f"f{step}", F.col("constant") + seasonal_part
                                 + F.col("b_lag") * F.col(f"f{step - 1}") + F.col("b_trend") * (F.col("now") + step))
    steps = [F.struct(F.lit(step).alias("step"), F.col(f"f{step}").alias("fitted"), F.col(f"ago{step}").alias("ago"))
             for step in range(1, horizon + 1)]
    complete_path = F.lit(True)
    for step in range(1, horizon + 1):
        complete_path = complete_path & F.col(f"f{step}").isNotNull() & ~F.isnan(f"f{step}")
    error = F.when(F.col("best").isNull(), "no inputs can be fitted").when(
        ~complete_path, "a month that the model needs is missing")
    ahead = ready.withColumn("error", error).select(
        *keys, "last", "slope", "overall", "best", "error", F.explode(F.array(*steps)).alias("s"))
    drift = F.coalesce(F.col("s.ago") + F.col("slope") * season, F.col("overall"))
    first = F.lit(date(1970, 1, 1))
    return ahead.select(
        *keys, F.add_months(first, (F.col("last") + F.col("s.step")).cast("int")).alias(ref_date),
        F.when(F.col("error").isNull(), F.col("s.fitted")).otherwise(drift).alias(value),
        F.when(F.col("error").isNull(), F.col("best.model")).otherwise("drift").alias("model"), "error")


def failed_series(forecasts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Side table of series whose model failed."""
    return forecasts.where(F.col("error").isNotNull()).select(*keys, "error").distinct()


def actuals_and_forecasts(facts: DataFrame, forecasts: DataFrame, keys: Sequence[str],
                          ref_date: str = "ref_date", value: str = "value") -> DataFrame:
    """Filtered facts, of all dates, followed by the forecasts; other columns are null there."""
    return facts.unionByName(forecasts.select(*keys, ref_date, value), allowMissingColumns=True)


def prepare_and_predict(facts: DataFrame, keys: Sequence[str],
                        condition: Callable[[DataFrame], Column] | Column | None = None,
                        start: date = START, end: date = END, ref_date: str = "ref_date",
                        value: str = "value", forecaster=seasonal_drift) -> DataFrame:
    """Filter, aggregate by month, forecast and append: the whole series stage.

    The facts are returned even when no series is long enough to forecast.
    """
    chosen = filter_facts(facts, condition)
    series = monthly_series(chosen, keys, start, end, ref_date, value)
    return actuals_and_forecasts(chosen, forecaster(series, keys, ref_date=ref_date, value=value),
                                 keys, ref_date, value)


def predict_with_failures(facts: DataFrame, keys: Sequence[str],
                          condition: Callable[[DataFrame], Column] | Column | None = None,
                          start: date = START, end: date = END, ref_date: str = "ref_date",
                          value: str = "value", forecaster=seasonal_models) -> tuple[DataFrame, DataFrame]:
    """The table of :func:`prepare_and_predict`, and the series whose model failed with the error.

    The forecasts are written down, so that no series is fitted for each of the two.  A forecaster
    without an ``error`` column has no failures.
    """
    chosen = filter_facts(facts, condition)
    series = monthly_series(chosen, keys, start, end, ref_date, value)
    forecasts = forecaster(series, keys, ref_date=ref_date, value=value)
    if "error" not in forecasts.columns:
        forecasts = forecasts.withColumn("error", F.lit(None).cast("string"))
    forecasts = checkpointed(forecasts)
    return (actuals_and_forecasts(chosen, forecasts, keys, ref_date, value),
            failed_series(forecasts, keys))
