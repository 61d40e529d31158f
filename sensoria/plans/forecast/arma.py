"""Seasonal ARMA of one daily series, in numpy: two-stage estimation and forecast.

With y the daily series and w = (1 - B)(1 - B^7) y the model is

    (1 - a B)(1 - A B^7) w[t] = (1 + m B)(1 + M B^7) e[t].

A long autoregression gives first residuals; regressing w on its own and the residuals' lags
gives the four coefficients.  The residuals are then taken from the model itself and the
regression repeated.  Days without a reading leave out the rows that need them.
"""

from __future__ import annotations

import numpy as np

WEEK = 7
LONG_ORDER = 3 * WEEK + 1
LIMIT = 0.99
REPEATS = 8
STEPS = 15


def differenced(y: np.ndarray) -> np.ndarray:
    """(1 - B)(1 - B^7) y, as long as y; NaN where a day is missing."""
    w = np.full(len(y), np.nan)
    if len(y) > WEEK + 1:
        w[WEEK + 1 :] = y[WEEK + 1 :] - y[WEEK:-1] - y[1:-WEEK] + y[: -WEEK - 1]
    return w


def _lags(x: np.ndarray, orders) -> np.ndarray:
    """Column per order, holding the value that many days before."""
    table = np.full((len(x), len(orders)), np.nan)
    for column, order in enumerate(orders):
        if order < len(x):
            table[order:, column] = x[: len(x) - order]
    return table


def _long_residuals(w: np.ndarray) -> np.ndarray | None:
    """Residuals of an autoregression of high order, or None for too short a series."""
    past = _lags(w, range(1, LONG_ORDER + 1))
    usable = np.isfinite(w) & np.isfinite(past).all(axis=1)
    if usable.sum() < 3 * LONG_ORDER:
        return None
    weights = np.linalg.lstsq(past[usable], w[usable], rcond=None)[0]
    residuals = np.full(len(w), np.nan)
    residuals[usable] = w[usable] - past[usable] @ weights
    return residuals


def _signs(p: np.ndarray) -> np.ndarray:
    """Weights of w[t-1], w[t-7], w[t-8], e[t-1], e[t-7], e[t-8]."""
    a, seasonal_a, m, seasonal_m = p
    return np.array([a, seasonal_a, -a * seasonal_a, m, seasonal_m, m * seasonal_m])


def _regress(w: np.ndarray, e: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Gauss-Newton steps on the four coefficients, the residuals' lags held fixed."""
    near = (1, WEEK, WEEK + 1)
    past = np.hstack([_lags(w, near), _lags(e, near)])
    usable = np.isfinite(w) & np.isfinite(past).all(axis=1)
    if usable.sum() < 3 * LONG_ORDER:
        return p
    x, target = past[usable], w[usable]
    for _ in range(STEPS):
        a, seasonal_a, m, seasonal_m = p
        slopes = np.column_stack(
            [
                x[:, 0] - seasonal_a * x[:, 2],
                x[:, 1] - a * x[:, 2],
                x[:, 3] + seasonal_m * x[:, 5],
                x[:, 4] + m * x[:, 5],
            ]
        )
        step = np.linalg.lstsq(slopes, target - x @ _signs(p), rcond=1e-8)[0]
        moved = np.clip(p + step, -LIMIT, LIMIT)
        if np.abs(moved - p).max() < 1e-8:
            return moved
        p = moved
    return p


def model_residuals(w: np.ndarray, p: np.ndarray) -> np.ndarray:
    """One-step errors of the model; zero before its start and at missing days."""
    weights = _signs(p)
    w0 = np.nan_to_num(w)
    explained = np.nan_to_num(_lags(w0, (1, WEEK, WEEK + 1))) @ weights[:3]
    known = np.isfinite(w)
    e = np.zeros(len(w) + WEEK + 1)
    for t in range(len(w)):
        if known[t]:
            at = t + WEEK + 1
            e[at] = (
                w0[t] - explained[t]
                - weights[3] * e[at - 1] - weights[4] * e[at - WEEK] - weights[5] * e[at - WEEK - 1]
            )
    return e[WEEK + 1 :]


def fit(w: np.ndarray) -> np.ndarray:
    """Coefficients (a, A, m, M); zeros when the series is too short for the first stage."""
    p = np.zeros(4)
    e = _long_residuals(w)
    if e is None:
        return p
    p = _regress(w, e, p)
    best, least = p, np.inf
    for _ in range(REPEATS):
        e = model_residuals(w, p)
        spread = float(np.square(e).sum())
        if not np.isfinite(spread):
            break
        if spread < least:
            best, least = p, spread
        e[~np.isfinite(w)] = np.nan
        moved = _regress(w, e, p)
        if np.abs(moved - p).max() < 1e-6:
            break
        p = moved
    return best


def path(y: np.ndarray, days: int) -> np.ndarray:
    """Levels for the days after the series; NaN when it is shorter than the differences need."""
    known = y.copy()
    for t in range(1, len(known)):
        if not np.isfinite(known[t]):
            known[t] = known[t - 1]
    if len(known) <= 2 * (WEEK + 1):
        return np.full(days, np.nan)
    w = differenced(y)
    p = fit(w)
    weights = _signs(p)
    e = np.concatenate([model_residuals(w, p), np.zeros(days)])
    moves = np.concatenate([np.nan_to_num(differenced(known)), np.zeros(days)])
    levels = np.concatenate([known, np.zeros(days)])
    for t in range(len(y), len(levels)):
        moves[t] = (
            weights[0] * moves[t - 1] + weights[1] * moves[t - WEEK]
            + weights[2] * moves[t - WEEK - 1] + weights[3] * e[t - 1]
            + weights[4] * e[t - WEEK] + weights[5] * e[t - WEEK - 1]
        )
        levels[t] = moves[t] + levels[t - 1] + levels[t - WEEK] - levels[t - WEEK - 1]
    return levels[len(y) :]


def predict(known_days, values, wanted_days, least: int, ceiling: float) -> np.ndarray:
    """Forecast for the wanted days of a series given by day; NaN where there is none.

    Series of fewer than ``least`` readings forecast their mean, forecasts stay between zero
    and ``ceiling`` times the series' maximum; days up to the last reading have no forecast.
    """
    wanted = np.asarray(wanted_days, dtype="datetime64[D]")
    values = np.asarray(values, dtype=float)
    days = np.asarray(known_days, dtype="datetime64[D]")[np.isfinite(values)]
    values = values[np.isfinite(values)]
    result = np.full(len(wanted), np.nan)
    if not len(values) or not len(wanted):
        return result
    if len(values) < least:
        return np.full(len(wanted), values.mean())
    first, last = days.min(), days.max()
    y = np.full(int((last - first).astype(int)) + 1, np.nan)
    y[(days - first).astype(int)] = values
    ahead = (wanted - last).astype(int)
    later = ahead > 0
    if later.any():
        levels = path(y, int(ahead.max()))
        result[later] = np.clip(levels[ahead[later] - 1], 0.0, ceiling * values.max())
    return result
