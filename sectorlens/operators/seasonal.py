"""Seasonal autoregressive models of one short series, by least squares."""

from __future__ import annotations

import itertools

import numpy as np


def drift(values: np.ndarray, months: np.ndarray, horizon: int, season: int) -> list[float]:
    """Value one season before the target month plus one season of linear trend."""
    slope = np.polyfit(months, values, 1)[0] if len(values) > 1 else 0.0
    by_month = dict(zip(months.tolist(), values.tolist()))
    last = int(months[-1])
    return [by_month[m - season] + slope * season if m - season in by_month
            else float(values.mean()) for m in range(last + 1, last + horizon + 1)]


def _difference(values: np.ndarray, d: int, seasonal: int, season: int) -> np.ndarray:
    for _ in range(d):
        values = np.diff(values)
    for _ in range(seasonal):
        values = values[season:] - values[:-season]
    return values


def _design(y: np.ndarray, e: np.ndarray, ar: list[int], ma: list[int], first: int) -> np.ndarray:
    rows = np.arange(first, len(y))
    columns = [np.ones(len(rows))] + [y[rows - k] for k in ar] + [e[rows - k] for k in ma]
    return np.column_stack(columns)


def _fit(y: np.ndarray, ar: list[int], ma: list[int]) -> tuple[np.ndarray, np.ndarray, float]:
    """Two-stage least squares: residuals of a long autoregression stand for the shocks."""
    shocks = np.zeros(len(y))
    long = min(13, len(y) // 3) if ma else 0
    if ma:
        design = _design(y, shocks, list(range(1, long + 1)), [], long)
        beta, *_ = np.linalg.lstsq(design, y[long:], rcond=None)
        shocks[long:] = y[long:] - design @ beta
    first = max([0, *ar, *[long + k for k in ma]])
    design = _design(y, shocks, ar, ma, first)
    if len(design) <= design.shape[1] + 2:
        raise ValueError("too few months for this order")
    beta, *_ = np.linalg.lstsq(design, y[first:], rcond=None)
    residual = y[first:] - design @ beta
    shocks[first:] = residual
    n, k = len(residual), design.shape[1] + 1
    variance = max(float(residual @ residual) / n, 1e-12)
    # Per-observation criterion, so that orders that lose more rows stay comparable.
    return beta, shocks, np.log(variance) + 2 * k / max(n - k - 1, 1)


def forecast(values: np.ndarray, horizon: int, season: int) -> tuple[list[float], str]:
    """Forecast with the best order of the grid; returns values and the model's name.

    Grid: up to two autoregressive and two moving-average lags, one seasonal lag
    of each kind, zero or one plain and seasonal difference.
    """
    if not np.isfinite(values).all():
        raise ValueError("series holds values that are no numbers")
    if np.ptp(values) == 0:
        return [float(values[-1])] * horizon, "constant"
    best = None
    for d, sd in itertools.product((0, 1), (0, 1)):
        y = _difference(values, d, sd, season)
        for p, q, sp, sq in itertools.product((0, 1, 2), (0, 1, 2), (0, 1), (0, 1)):
            ar = list(range(1, p + 1)) + [season] * sp
            ma = list(range(1, q + 1)) + [season] * sq
            if len(y) <= 2 * season and (sp or sq):
                continue
            try:
                beta, shocks, criterion = _fit(y, ar, ma)
            except ValueError:
                continue
            if best is None or criterion < best[0] - 1e-9:
                best = (criterion, (p, d, q), (sp, sd, sq), ar, ma, beta, shocks, y)
    if best is None:
        raise ValueError("no order of the grid fits")
    _, order, seasonal, ar, ma, beta, shocks, y = best
    path, noise = y.tolist(), shocks.tolist()
    for _ in range(horizon):
        terms = [1.0, *[path[-k] for k in ar], *[noise[-k] for k in ma]]
        path.append(float(np.dot(beta, terms)))
        noise.append(0.0)
    ahead = _integrate(values, path[-horizon:], order[1], seasonal[1], season)
    if not np.isfinite(ahead).all():
        raise ValueError("forecast is not finite")
    return ahead, f"{order}{seasonal}[{season}]"


def _integrate(values: np.ndarray, steps: list[float], d: int, sd: int, season: int) -> list[float]:
    """Undo the differences for the forecast steps."""
    base = values
    for _ in range(d):
        base = np.diff(base)
    if sd:
        known = base.tolist()
        for step in steps:
            known.append(step + known[-season])
        steps = known[-len(steps):]
    if d:
        steps = (values[-1] + np.cumsum(steps)).tolist()
    return [float(s) for s in steps]
