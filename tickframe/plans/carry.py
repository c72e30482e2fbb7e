"""Daily build from a stored carry: one date of bars and one row of state per ticker, no history.

The state of a ticker after its last bar holds what the next bar's 96 columns
need: the state of each exponentially weighted mean with the observations so
far and the rows since the last one, the running OBV, the last bar, and the
last values of the series that windows look back on (199 closes, 59 volumes, 20
of each trend metric).  A new date is one affine step of each mean and the
formulas of the bulk build on one row per ticker, so its rows equal those of a
bulk build over all history (means to the last bits, before their rounding).
Bars and state meet in one join on ``ticker``; work and reads follow the number
of tickers, whatever the length of their histories.

A state is bounded by the windows: about 400 numbers a ticker.  It is stored
beside the table in folders of its own, and the newest takes effect when the
record that names it is replaced.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sqlexpr as X
from ..functions import windows as W
from ..operators.ewm import Ewm, era_bounds, ewm_columns
from ..operators.indicators import (DIFFERENCED, FIRST_LEVEL, SECOND_LEVEL, averages, drop_all_null, moves, signals,
                                    stage_moves, stage_wide_outputs, tasks_for)
from ..operators.rolling import lag_name
from ..schemas import BAR_INPUT, INDICATOR_COLUMNS, TRAJECTORY_METRICS, TRAJECTORY_WINDOWS
from ..session import shuffles_released
from ..sources import files

#: How many values before the current bar the windows of each series reach.
REACH = {"close": 199, "volume": 59, **{m: max(TRAJECTORY_WINDOWS) - 1 for m in TRAJECTORY_METRICS if m != "close"},
         "volume_dod_pct": 2, "rsi_14_dod_diff": 2, "rvol_ema_5": 1}
SPECS = [*FIRST_LEVEL, *SECOND_LEVEL]
SEEN = list(dict.fromkeys(s.seen for s in SPECS))
LAST = ["high", "low"]  # of the last bar; its close and volume end the arrays

STATE_COLUMNS = (["ticker", "last_date", "obv_sum", *(f"last_{c}" for c in LAST), *(f"n_{c}" for c in SEEN), *(f"gap_{c}" for c in SEEN)]
                 + [f"w{s.name}" for s in SPECS] + [f"past_{c}" for c in REACH])


def _gated(s: Ewm) -> str:
    return f"CASE WHEN n_{s.seen} >= {max(s.min_periods, 1)} THEN w{s.name} END AS {s.name}"


def carry_of(bars: DataFrame, partitions: int | None = None) -> DataFrame:
    """The state of each ticker after its last bar (``STATE_COLUMNS``), from all its bars."""
    bars = bars.select(*BAR_INPUT)
    eras, rows = era_bounds(bars)
    n = partitions or tasks_for(rows, bars.sparkSession.sparkContext.defaultParallelism)

    def observed(specs: list[Ewm]) -> list[str]:
        seen = list(dict.fromkeys(s.seen for s in specs))
        return ([f"count({c}) {X.RUNNING} AS n_{c}" for c in seen]
                + [f"rn - last(CASE WHEN {c} IS NOT NULL THEN rn END, true) {X.RUNNING} AS gap_{c}" for c in seen])

    def raw(specs: list[Ewm]) -> list[Ewm]:
        return [replace(s, name=f"w{s.name}", min_periods=0) for s in specs]

    sums = ["CASE WHEN obv_change IS NOT NULL THEN sum(obv_change) " + X.RUNNING + " END AS obv", f"sum(obv_change) {X.RUNNING} AS obv_sum"]
    kept = [f"{c} AS last_{c}" for c in LAST]
    s1 = stage_moves(bars.repartition(n, W.PARTITION))
    s2 = ewm_columns(s1, raw(FIRST_LEVEL), eras, extra=[*sums, *observed(FIRST_LEVEL)])
    s2 = averages(s2.selectExpr("*", *kept, *map(_gated, FIRST_LEVEL)))
    before = [f"{X.lag(c)} AS prev_{c}" for c in DIFFERENCED]
    s3 = ewm_columns(s2, raw(SECOND_LEVEL), eras, extra=[*before, *observed(SECOND_LEVEL)])
    s3 = signals(s3.selectExpr("*", *map(_gated, SECOND_LEVEL)))
    # the last rows of each ticker: the longest reach of the arrays
    s3 = s3.selectExpr("*", f"max(rn) OVER (PARTITION BY {W.PARTITION}) - rn AS back").where(F.col("back") < max(REACH.values()))
    scalars = [c for c in STATE_COLUMNS if c not in ("ticker", "last_date") and not c.startswith("past_")]
    last = F.max_by(F.struct(F.col("market_date").alias("last_date"), *scalars), "rn")
    rows_ = F.sort_array(F.collect_list(F.struct("rn", "back", *REACH)))
    state = s3.groupBy("ticker").agg(last.alias("last"), rows_.alias("rows"))
    past = [F.expr(f"transform(filter(rows, r -> r.back < {k}), r -> r.{c})").alias(f"past_{c}") for c, k in REACH.items()]
    return state.select("ticker", "last.*", *past).select(*STATE_COLUMNS)


def _stepped(s: Ewm) -> list[str]:
    """The mean's next state under the name that ``w`` + name has, from the row's observation."""
    a, d, w = X.num(s.alpha), f"pow({X.num(1.0 - s.alpha)}, CAST(gap_{s.seen} + 1 AS DOUBLE))", f"w{s.name}"
    return [f"CASE WHEN {s.source} IS NULL THEN {w} WHEN {w} IS NULL OR {w} = {s.source} THEN {s.source} "
            f"ELSE {d} / ({d} + {a}) * {w} + {a} * {s.source} / ({d} + {a}) END AS {w}"]


def _advanced(df: DataFrame, specs: list[Ewm], extra: list[str]) -> DataFrame:
    """Steps the means of one level, then their counts and gaps, and adds the gated outputs."""
    seen = list(dict.fromkeys(s.seen for s in specs))
    states = {f"w{s.name}" for s in specs}
    df = df.selectExpr(*[X.q(c) for c in df.columns if c not in states], *[e for s in specs for e in _stepped(s)], *extra)
    counters = {f"{kind}_{c}" for c in seen for kind in ("n", "gap")}
    counted = [f"coalesce(n_{c}, 0) + CAST({c} IS NOT NULL AS BIGINT) AS n_{c}" for c in seen]
    counted += [f"CASE WHEN {c} IS NOT NULL THEN 0 ELSE gap_{c} + 1 END AS gap_{c}" for c in seen]
    df = df.selectExpr(*[X.q(c) for c in df.columns if c not in counters], *counted)
    return df.selectExpr("*", *map(_gated, specs))


def _frames(sizes: dict[str, list[int]]) -> list[str]:
    """The last ``n`` values of a series as ``_last_<series>_<n>``, null unless all of them are there."""
    return [f"IF(size(all_{c}) >= {n} AND NOT exists(slice(all_{c}, greatest(size(all_{c}) - {n - 1}, 1), {n}), x -> x IS NULL), "
            f"slice(all_{c}, greatest(size(all_{c}) - {n - 1}, 1), {n}), NULL) AS _last_{c}_{n}" for c, ns in sizes.items() for n in ns]


def _total(values: str) -> str:
    return f"aggregate({values}, {X.num(0.0)}, (t, x) -> t + x)"


def _mean(series: str, n: int) -> str:
    """Mean of the last ``n`` values, summed in blocks as the bulk build does."""
    k = X.MEAN_BLOCK
    return f"{X.total([_total(f'slice(_last_{series}_{n}, {i + 1}, {k})') for i in range(0, n, k)])} / {X.num(float(n))}"


def _with_deviation(df: DataFrame, series: str, n: int, name: str) -> DataFrame:
    """Adds the sample deviation of the last ``n`` values, from the moments of blocks."""
    k, parts = X.MOMENT_BLOCK, range(n // X.MOMENT_BLOCK)
    block = {i: f"slice(_last_{series}_{n}, {i * k + 1}, {k})" for i in parts}
    df = df.selectExpr("*", *[f"{_total(block[i])} / {X.num(float(k))} AS _m{i}" for i in parts])
    df = df.selectExpr("*", f"{X.total([f'_m{i}' for i in parts])} / {X.num(float(len(parts)))} AS _centre")
    inner = X.total([_total(f"transform({block[i]}, x -> (x - _m{i}) * (x - _m{i}))") for i in parts])
    between = X.total([f"((_m{i} - _centre) * (_m{i} - _centre))" for i in parts])
    return df.selectExpr("*", f"sqrt(({inner} + {X.num(float(k))} * {between}) / {X.num(float(n - 1))}) AS {name}")


def next_day(state: DataFrame, bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of the indicator table, state after it) of one date: ``bars`` holds that date's bars, one per ticker.

    A ticker without a bar keeps its state; one without a state begins.  A bar that is not later than the state of its
    ticker fails the job, so that no date is applied twice.
    """
    # an empty array where there is no state yet; the windows then see no row before
    past = {c: f"coalesce(past_{c}, CAST(array() AS ARRAY<DOUBLE>))" for c in REACH}
    joined = bars.select(*BAR_INPUT).join(state, "ticker", "left").selectExpr(
        *[c for c in BAR_INPUT if c != "market_date"], "0 AS rn", "CAST(NULL AS DATE) AS prev_date",
        "CASE WHEN last_date >= market_date THEN CAST(raise_error(concat('duplicate key: ', ticker, ' is at ', last_date, ' already')) AS DATE) "
        "ELSE market_date END AS market_date",
        "try_element_at(past_close, -1) AS prev_close", "last_high AS prev_high", "last_low AS prev_low",
        "try_element_at(past_volume, -1) AS prev_volume",
        *[f"try_element_at(past_{c}, -1) AS prev_{c}" for c in DIFFERENCED], "obv_sum",
        *[f"n_{c}" for c in SEEN], *[f"coalesce(gap_{c}, 0) AS gap_{c}" for c in SEEN],
        *[f"w{s.name}" for s in SPECS], *[f"{e} AS past_{c}" for c, e in past.items()])
    s1 = moves(joined)
    total = "coalesce(obv_sum, 0D) + coalesce(obv_change, 0D)"
    s1 = s1.selectExpr(*[X.q(c) for c in s1.columns if c != "obv_sum"], f"CASE WHEN obv_change IS NOT NULL THEN {total} END AS obv",
                       f"CASE WHEN obv_sum IS NOT NULL OR obv_change IS NOT NULL THEN {total} END AS obv_sum",
                       *[f"{c} AS last_{c}" for c in LAST])
    s2 = averages(_advanced(s1, FIRST_LEVEL, []))
    s3 = signals(_advanced(s2, SECOND_LEVEL, []))
    after = {"last_date": "market_date", **{f"gap_{c}": f"CAST(gap_{c} AS INT)" for c in SEEN},
             **{f"past_{c}": f"IF(size(all_{c}) > {k}, slice(all_{c}, -{k}, {k}), all_{c})" for c, k in REACH.items()}}
    s3 = s3.selectExpr("*", *[f"concat(past_{c}, array({c})) AS all_{c}" for c in REACH])
    state_after = f"struct({', '.join(f'{after.get(c, c)} AS {c}' for c in STATE_COLUMNS)}) AS state_after"
    # the windows over the arrays, the current value last
    lags = [f"try_element_at(past_{m}, -{k}) AS {lag_name(m, k)}" for m in TRAJECTORY_METRICS for k in range(1, max(TRAJECTORY_WINDOWS))]
    framed = s3.selectExpr("*", state_after, *_frames({"close": [20, 50, 200], "volume": [10, 60]}))
    framed = _with_deviation(framed, "close", 20, "_std_20").selectExpr(
        "*", "try_element_at(past_close, -5) AS _close_l5", "try_element_at(past_close, -21) AS _close_l21",
        "try_element_at(past_volume, -5) AS _vol_l5", "try_element_at(past_volume, -21) AS _vol_l21",
        *[f"{_mean('close', n)} AS _sma_{n}" for n in (20, 50, 200)], *[f"{_mean('volume', n)} AS _vol_sma_{n}" for n in (10, 60)],
        *[f"try_element_at(past_volume_dod_pct, -{k}) AS _vdp_l{k}" for k in (1, 2)],
        *[f"try_element_at(past_rsi_14_dod_diff, -{k}) AS _rdd_l{k}" for k in (1, 2)], *lags)
    # one pass for both results
    done = stage_wide_outputs(framed).select(*INDICATOR_COLUMNS, "state_after").checkpoint(eager=True)
    waiting = state.join(bars.select("ticker"), "ticker", "left_anti").select(*STATE_COLUMNS)
    return drop_all_null(done.select(*INDICATOR_COLUMNS)), waiting.unionByName(done.select("state_after.*"))


def save(state: DataFrame, path: str, day: dt.date) -> DataFrame:
    """Stores the state after ``day`` and returns it as stored; the state before stays until its successor's successor."""
    spark = state.sparkSession
    before = files.read_text(spark, f"{path}/_current")
    name = f"state-{day.isoformat()}-{uuid.uuid4().hex}"
    with shuffles_released(spark):
        state.write.parquet(f"{path}/{name}")
    files.replace_text(spark, f"{path}/_current", json.dumps({"folder": name, "day": day.isoformat()}))
    keep = {name, json.loads(before)["folder"] if before else name}
    for old in files.child_names(spark, path):
        if old.startswith("state-") and old not in keep:
            files.remove(spark, f"{path}/{old}")
    return spark.read.schema(state.schema).parquet(f"{path}/{name}")


def stored(spark: SparkSession, path: str) -> tuple[DataFrame, dt.date] | None:
    """The stored state and the date it stands after; None if there is none."""
    text = files.read_text(spark, f"{path}/_current")
    if text is None:
        return None
    found = json.loads(text)
    return spark.read.parquet(f"{path}/{found['folder']}"), dt.date.fromisoformat(found["day"])
