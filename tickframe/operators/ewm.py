"""Exponentially weighted mean (``adjust=False``) per ticker, as a blocked scan with carries.

Semantics, per ticker in date order, with weight ``a``::

    w = null; old = 1; n = 0
    for each row with value c (may be null):
        n += (c is not null)
        if w is not null:
            old *= (1 - a)                    # decays on null rows too
            if c is not null: w = (old*w + a*c) / (old + a); old = 1
        elif c is not null: w = c             # first observation seeds
        emit w if n >= max(min_periods, 1) else null

Every row is an affine map ``y_i = A_i * y_(i-1) + B_i`` of the state, which is 0 before the first row:

* null row:                 ``A = 1, B = 0``
* first observation:        ``A = 1, B = c``
* observation ``g`` rows after the previous one, ``d = (1-a)^g``:
  ``A = d / (d + a), B = a*c / (d + a)``

Within a block of rows, ``y_i = P_i * (carry + sum of B_j / P_j)``, where ``P`` is the running product of the ``A`` and
``carry`` the state at the end of the block before: two running aggregates, so the work is in proportion to the rows.
Blocks are the eras of a ticker (``functions/windows.py``): so many days that ``P`` stays far inside the range of a
double (an ``A`` that a long gap made smaller than ``LEAST`` counts as ``LEAST``: what lies before is then below the
precision of a double).  The terms of the sum grow like ``1/P``, so each prefix is as exact as the recursion.  States go
from block to block by one running ``last`` for each block that the longest history has beyond the first: one up to some
four years, eight for thirty.  As long as all observations are equal the mean is exactly that value, as in the recursion, so
that rounding decides ties alike, and each row's last step is taken as the recursion takes it.  Every step is a ``Window`` operator over the same partitioning and order as the rest of
the job: no shuffle, no sort, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sqlexpr as X
from ..functions import windows as W


@dataclass(frozen=True)
class Ewm:
    """One output series: ``name`` = EWM of ``source`` with weight ``alpha``.

    ``seen`` names a column that is null where ``source`` is; series of one ``seen`` share counts, gaps and products.
    """

    name: str
    source: str
    alpha: float
    min_periods: int = 0
    seen: str = ""

    @staticmethod
    def span(name: str, source: str, span: float, min_periods: int = 0) -> "Ewm":
        return Ewm(name, source, _pandas_alpha(com=(span - 1) / 2.0), min_periods, source)

    @staticmethod
    def weight(name: str, source: str, alpha: float, min_periods: int = 0, seen: str = "") -> "Ewm":
        return Ewm(name, source, _pandas_alpha(com=1.0 / alpha - 1.0), min_periods, seen or source)


def _pandas_alpha(com: float) -> float:
    # pandas turns span/alpha into a centre of mass and back; keep the same double.
    return 1.0 / (1.0 + com)


LEAST = 1e-40


def era_bounds(df: DataFrame) -> tuple[int, int]:
    """Eras that the dates of ``df`` span, and its rows: one narrow aggregate of one row."""
    row = df.agg(F.expr(f"max({W.era_sql()}) - min({W.era_sql()}) + 1").alias("eras"), F.count(F.lit(1)).alias("n")).first()
    return int(row["eras"] or 1), int(row["n"])


def eras_of_days(days: int) -> int:
    """Eras that a stretch of so many calendar days can touch."""
    return -(-max(days - 1, 0) // W.ERA_DAYS) + 1


def ewm_columns(df: DataFrame, specs: list[Ewm], eras: int, rn: str = "rn",
                extra: list[str] | tuple = ()) -> DataFrame:
    """Add one column per spec (unrounded EWM, NULL before ``min_periods`` observations).

    ``df`` must carry ``ticker``, ``era``, ``market_date`` and the 0-based row ordinal ``rn``; a row more than ``eras``
    eras after its ticker's first fails the job.  ``extra`` (SQL ``expr AS name``) window columns are computed in the
    first pass.  Weights may be 1/3 at most, with eras of 1,400 days: a faster decay would leave the range of a double.
    """
    if fast := [s.name for s in specs if (1.0 - s.alpha) ** W.ERA_DAYS < 1e-250]:
        raise ValueError(f"weights of {fast} decay too fast for eras of {W.ERA_DAYS} days")
    one, zero = X.num(1.0), X.num(0.0)

    # Previous observation and observation count, once per pattern of nulls.
    patterns = list(dict.fromkeys(s.seen for s in specs))
    prep = [f"min({W.ERA}) {X.RUNNING} AS _first_era"]
    for c in patterns:
        prep.append(f"last(CASE WHEN {c} IS NOT NULL THEN {rn} END, true) {X.BEFORE} AS _p_{c}")
        prep.append(f"count({c}) {X.RUNNING} AS _n_{c}")
    sources = list(dict.fromkeys(s.source for s in specs))
    prep += [f"{fn}({c}) {X.RUNNING} AS _{fn}_{c}" for c in sources for fn in ("min", "max")]
    df = df.selectExpr("*", *prep, *extra)

    # The affine maps; A once per pattern of nulls and weight.
    weights = list(dict.fromkeys((s.seen, s.alpha) for s in specs))
    product = {key: f"_q{i}" for i, key in enumerate(weights)}
    maps = []
    for (c, alpha), name in product.items():
        d, a = f"pow({X.num(1.0 - alpha)}, CAST({rn} - _p_{c} AS DOUBLE))", X.num(alpha)
        maps.append(f"CASE WHEN {c} IS NULL OR _p_{c} IS NULL THEN {one} ELSE greatest({d} / ({d} + {a}), {X.num(LEAST)}) END AS _a{name}")
    for s in specs:
        c, d, a = s.seen, f"pow({X.num(1.0 - s.alpha)}, CAST({rn} - _p_{s.seen} AS DOUBLE))", X.num(s.alpha)
        maps.append(f"CASE WHEN {s.source} IS NULL THEN {zero} WHEN _p_{c} IS NULL THEN {s.source} "
                    f"ELSE {a} * {s.source} / ({d} + {a}) END AS _b_{s.name}")
    df = df.selectExpr("*", *maps)

    # Running products and sums of an era; `product` has no SQL name.
    of_era = (Window.partitionBy(W.PARTITION, W.ERA).orderBy("market_date")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    df = df.withColumns({name: F.product(F.col(f"_a{name}")).over(of_era) for name in product.values()})
    sums = [f"{product[s.seen, s.alpha]} * sum(_b_{s.name} / {product[s.seen, s.alpha]}) {X.RUNNING_ERA} AS _y_{s.name}" for s in specs]
    gone = {f"_a{name}" for name in product.values()} | {f"_b_{s.name}" for s in specs}
    df = df.selectExpr(*[X.q(c) for c in df.columns if c not in gone], f"lead({rn}) {X.OVER_ERA} IS NULL AS _ends", *sums)

    # States at the ends of eras: round k makes the first k + 1 eras of each ticker right.
    for k in range(eras - 1):
        state = "_y" if k == 0 else "_z"
        ends = {s.name: f"coalesce(last(CASE WHEN _ends THEN {state}_{s.name} END, true) {X.BEFORE}, {zero})" for s in specs}
        kept = [X.q(c) for c in df.columns if not c.startswith("_z_")]
        df = df.selectExpr(*kept, *[f"_y_{s.name} + {product[s.seen, s.alpha]} * {ends[s.name]} AS _z_{s.name}" for s in specs])

    # The last step again as the recursion does it, from the state of the row before: its rounding, where that is exact.
    state = "_z" if eras > 1 else "_y"
    gone = {"_ends", *product.values(), *(f"_{fn}_{c}" for c in sources for fn in ("min", "max")),
            *(f"{y}_{s.name}" for s in specs for y in ("_y", "_z"))}
    df = df.selectExpr(*[X.q(c) for c in df.columns if c not in gone], *[
        f"CASE WHEN _min_{s.source} = _max_{s.source} THEN _min_{s.source} ELSE {state}_{s.name} END AS _w_{s.name}" for s in specs])
    df = df.selectExpr("*", *[f"{X.lag(f'_w_{s.name}')} AS _l_{s.name}" for s in specs])
    final = []
    for s in specs:
        c, x, a, last = s.seen, s.source, X.num(s.alpha), f"_l_{s.name}"
        d = f"CASE WHEN {rn} - _p_{c} = 1 THEN {X.num(1.0 - s.alpha)} ELSE pow({X.num(1.0 - s.alpha)}, CAST({rn} - _p_{c} AS DOUBLE)) END"
        step = (f"CASE WHEN {x} IS NULL OR _p_{c} IS NULL THEN _w_{s.name} WHEN {last} = {x} THEN {x} "
                f"ELSE ({d} * {last} + {a} * {x}) / ({d} + {a}) END")
        final.append(f"CASE WHEN {W.ERA} - _first_era >= {eras} THEN CAST(raise_error('series longer than the scan reaches') AS DOUBLE) "
                     f"WHEN _n_{c} >= {max(s.min_periods, 1)} THEN {step} END AS {s.name}")
    gone = {"_first_era", *(f"_{k}_{c}" for c in patterns for k in ("n", "p")), *(f"_{k}_{s.name}" for s in specs for k in ("w", "l"))}
    return df.selectExpr(*[X.q(c) for c in df.columns if c not in gone], *final)


def ewm_reference(values, alpha: float, min_periods: int = 0):
    """Plain-Python fold of the semantics above; used by tests as the brute-force check."""
    out, w, old, n = [], None, 1.0, 0
    m = max(min_periods, 1)
    for c in values:
        obs = c is not None and c == c
        n += int(obs)
        if w is not None:
            old *= 1.0 - alpha
            if obs:
                if w != c:
                    w = (old * w + alpha * c) / (old + alpha)
                old = 1.0
        elif obs:
            w = c
        out.append(w if (w is not None and n >= m) else None)
    return out


__all__ = ["Ewm", "era_bounds", "eras_of_days", "ewm_columns", "ewm_reference"]
