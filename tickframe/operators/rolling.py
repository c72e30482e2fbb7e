"""Rolling regression and short means as SQL over columns of lagged values.

The caller computes the lags of a stage in one ``selectExpr``, so that Spark
evaluates them in a single ``Window`` operator (or takes them from a stored
carry, see ``plans/carry.py``); the formulas here read one row each.
"""

from __future__ import annotations

from ..functions import sqlexpr as X


def lag_name(metric: str, k: int) -> str:
    return f"_lag{k}_{metric}"


def fit_name(metric: str, n: int, part: str) -> str:
    return f"_{part}_{metric}_{n}"


def _window_names(metric: str, n: int) -> list[str]:
    return [lag_name(metric, n - 1 - j) if j < n - 1 else metric for j in range(n)]


def trend_parts_sql(metric: str, n: int) -> list[str]:
    """First half of the fit as SQL: window mean and ``Sxy`` (shared by later terms)."""
    values = _window_names(metric, n)
    sxy = X.total([f"({v} * {X.num(j - (n - 1) / 2.0)})" for j, v in enumerate(values)])
    mean = f"({X.total(values)} / {X.num(float(n))})"
    return [f"{mean} AS {fit_name(metric, n, 'mean')}", f"{sxy} AS {fit_name(metric, n, 'sxy')}"]


def trend_fit_sql(metric: str, n: int, flat: float = 1e-8) -> tuple[str, str]:
    """Least-squares slope and r2 of the last ``n`` values of ``metric`` against the row index.

    Closed form over the centred index ``x_j = j - (n-1)/2``:
    ``slope = Sxy / Sxx`` with ``Sxx = n(n^2-1)/12``; ``r2 = Sxy^2 / (Sxx * Syy)``,
    and ``r2 = 0`` when the sample std is below ``flat`` (a flat line).  Any
    NULL in the window (including rows before the window is full) gives NULL.
    Sums run oldest to newest, so the result does not depend on the engine.
    Needs the columns named by ``lag_name`` and those of ``trend_parts_sql``.
    """
    values = _window_names(metric, n)
    mean, sxy = fit_name(metric, n, "mean"), fit_name(metric, n, "sxy")
    sxx = X.num(n * (n * n - 1) / 12.0)
    syy = X.total([f"(({v} - {mean}) * ({v} - {mean}))" for v in values])
    slope = f"({sxy} / {sxx})"
    std = f"sqrt({syy} / {X.num(float(n - 1))})"
    r2 = f"CASE WHEN {std} < {X.num(flat)} THEN {X.num(0.0)} ELSE {sxy} * {sxy} / ({sxx} * {syy}) END"
    return slope, r2


def mean_present_sql(names: list[str]) -> str:
    """Mean of the non-null values (NULL when none), summed oldest to newest."""
    zero, one = X.num(0.0), X.num(1.0)
    tot = X.total([f"coalesce({c}, {zero})" for c in names])
    cnt = X.total([f"CASE WHEN {c} IS NOT NULL THEN {one} ELSE {zero} END" for c in names])
    return f"CASE WHEN {cnt} > 0 THEN {tot} / {cnt} END"
