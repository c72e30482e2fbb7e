"""The 96-column indicator table, as staged window passes over bars.

Physical shape: one hash exchange on ``ticker`` and one sort on
``(ticker, market_date)``; every stage after that is a ``Window`` operator
over the same partitioning and order, so the table is built without another
shuffle or sort.  The EWM scans run while rows are still narrow; the wide
outputs (rolling means, percent changes, the 40 regression columns) are
added last, in one window pass.

Stages (a later stage needs rounded outputs of an earlier one):

1. row ordinal, previous close/high/low/volume; true range, up/down moves,
   directional movement, OBV change, volume change;
2. 19 first-level EWMs (close x5, true range x4, volume x2, RSI x6, DM x2)
   with the running OBV, then the formulas on them (ATR, EMA, MACD,
   Keltner, RSI, DI, DX, volume baselines, RVOL);
3. 2 second-level EWMs (MACD signal on rounded MACD, ADX on DX) with the
   first differences of rounded RVOL, RSI and ATR;
4. lags 5/21, rolling means / std of close and volume, MACD histogram
   change, 3-row means, and the rolling regressions of five metrics; all
   windows first, then the formulas of one row each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sqlexpr as X
from ..functions import windows as W
from ..schemas import (ALL_NULL_SUBSET, BAR_INPUT, INDICATOR_COLUMNS, TRAJECTORY_METRICS,
                       TRAJECTORY_WINDOWS)
from .ewm import Ewm, era_bounds, ewm_columns
from .rolling import lag_name, mean_present_sql, trend_fit_sql, trend_parts_sql

# EWM weights, spans and minimum periods of the indicator set.
ATR_PERIODS = [14, 5, 21]
RSI_PERIODS = [14, 5, 21]
KELTNER_ATR_PERIOD = 10
EMA_SPANS = {"ema_9": 9, "ema_21": 21, "ema_12": 12, "ema_26": 26, "kc_mid": 20}
VOLUME_EMA_SPANS = {"vol_ema_5": 5, "vol_ema_21": 21}
MACD_SIGNAL_SPAN = 9
ADX_PERIOD = 14

FIRST_LEVEL = (
    [Ewm.span(f"_{name}", "close", span) for name, span in EMA_SPANS.items()]
    + [Ewm.weight(f"_atr_{n}", "true_range", 1.0 / n, n) for n in ATR_PERIODS + [KELTNER_ATR_PERIOD]]
    + [Ewm.span(f"_{name}", "volume", span) for name, span in VOLUME_EMA_SPANS.items()]
    + [Ewm.weight(f"_gain_{n}", "up_move", 1.0 / n, n) for n in RSI_PERIODS]
    + [Ewm.weight(f"_loss_{n}", "down_move", 1.0 / n, n, seen="up_move") for n in RSI_PERIODS]
    + [Ewm.weight("_pdm", "plus_dm", 1.0 / ADX_PERIOD, ADX_PERIOD),
       Ewm.weight("_mdm", "minus_dm", 1.0 / ADX_PERIOD, ADX_PERIOD, seen="plus_dm")]
)
#: Rounded outputs whose change from the bar before is an output too.
DIFFERENCED = ["rvol_ema_5", "rsi_14", "atr_14"]
SECOND_LEVEL = [
    Ewm.span("_macd_signal", "macd", MACD_SIGNAL_SPAN),
    Ewm.weight("_adx", "dx", 1.0 / ADX_PERIOD, ADX_PERIOD),
]


def _rsi(gain: str, loss: str) -> str:
    # A zero loss mean gives 100 (also for a flat series); NULL before min_periods.
    h, one = X.num(100.0), X.num(1.0)
    return X.rnd(f"CASE WHEN {loss} = 0 THEN {h} ELSE {h} - {h} / ({one} + {X.div(gain, loss)}) END", 2)


def stage_moves(bars: DataFrame) -> DataFrame:
    """Stage 1: the EWM inputs; one Window operator, then row-local formulas.

    A (ticker, market_date) that occurs twice fails the job here: the rows
    are sorted by it, so the check costs one lag and no pass of its own.
    """
    return moves(bars.selectExpr(*BAR_INPUT, f"{W.era_sql()} AS {W.ERA}").selectExpr(
        *BAR_INPUT, W.ERA,
        f"CAST(row_number() {X.OVER} - 1 AS INT) AS rn",
        f"{X.lag('market_date')} AS prev_date",
        f"{X.lag('close')} AS prev_close",
        f"{X.lag('high')} AS prev_high",
        f"{X.lag('low')} AS prev_low",
        f"{X.lag('volume')} AS prev_volume",
    ))


def moves(s: DataFrame) -> DataFrame:
    """Formulas of stage 1, from each bar and the values of the bar before."""
    zero = X.num(0.0)
    delta = "(close - prev_close)"
    up, down = "(high - prev_high)", "(prev_low - low)"
    replaced = {"rn", "prev_date", "prev_high", "prev_low", "prev_volume"}
    return s.selectExpr(
        *[X.q(c) for c in s.columns if c not in replaced],
        "CASE WHEN prev_date = market_date "
        "THEN CAST(raise_error(concat('duplicate key: ', ticker, ' ', market_date)) AS INT) ELSE rn END AS rn",
        "greatest(high - low, abs(high - prev_close), abs(low - prev_close)) AS true_range",
        f"CASE WHEN {delta} IS NOT NULL THEN greatest({delta}, {zero}) END AS up_move",
        f"CASE WHEN {delta} IS NOT NULL THEN -least({delta}, {zero}) END AS down_move",
        f"CASE WHEN ({up} > {down}) AND ({up} > 0) THEN {up} ELSE {zero} END AS plus_dm",
        f"CASE WHEN ({down} > {up}) AND ({down} > 0) THEN {down} ELSE {zero} END AS minus_dm",
        f"coalesce(signum({delta}), {zero}) * volume AS obv_change",
        f"{X.rnd(X.pct('volume', 'prev_volume'), 2)} AS volume_dod_pct",
    )


def stage_first_ewm(s1: DataFrame, eras: int) -> DataFrame:
    """Stage 2: first-level EWMs and running OBV, then the formulas built on them."""
    obv = f"CASE WHEN obv_change IS NOT NULL THEN sum(obv_change) {X.RUNNING} END AS obv"
    counts = [f"count(close) {X.RUNNING} AS n_close", f"count(volume) {X.RUNNING} AS n_volume",
              f"{X.block_sum('close')} AS s_close", f"{X.block_sum('volume')} AS s_volume",
              *X.block_moments("close", "m_close", "v_close")]
    return averages(ewm_columns(s1, FIRST_LEVEL, eras, extra=[obv, *counts]))


def averages(s2: DataFrame) -> DataFrame:
    """Formulas of stage 2, from the unrounded first-level EWMs."""
    h, two = X.num(100.0), X.num(2.0)
    atr = {n: X.rnd(f"_atr_{n}", 4) for n in ATR_PERIODS}
    ema_9, ema_21 = X.rnd("_ema_9", 4), X.rnd("_ema_21", 4)
    kc_mid = X.rnd("_kc_mid", 4)
    vol_ema_5, vol_ema_21 = X.rnd("_vol_ema_5", 2), X.rnd("_vol_ema_21", 2)
    rsi = {n: _rsi(f"_gain_{n}", f"_loss_{n}") for n in RSI_PERIODS}
    plus_di = X.rnd(X.div(f"{h} * _pdm", atr[14]), 2)
    minus_di = X.rnd(X.div(f"{h} * _mdm", atr[14]), 2)
    dx = f"{h} * {X.div(f'abs({plus_di} - {minus_di})', f'{plus_di} + {minus_di}')}"
    k_atr = f"_atr_{KELTNER_ATR_PERIOD}"
    used = {s.name for s in FIRST_LEVEL} | {"high", "low", "true_range", "up_move", "down_move", "plus_dm", "minus_dm", "obv_change"}
    return s2.selectExpr(
        *[X.q(c) for c in s2.columns if c not in used],
        f"{atr[14]} AS atr_14",
        f"{X.rnd(f'{X.div(atr[14], 'close')} * {h}', 4)} AS atr_14_pct",
        f"{atr[5]} AS atr_5",
        f"{atr[21]} AS atr_21",
        f"{X.rnd(X.pct(atr[5], atr[21]), 2)} AS atr_5_21_dist_pct",
        f"{ema_9} AS ema_9",
        f"{ema_21} AS ema_21",
        f"{X.rnd(X.pct(ema_9, ema_21), 2)} AS ema_9_21_dist_pct",
        f"{X.rnd('_ema_12 - _ema_26', 4)} AS macd",
        f"{kc_mid} AS kc_mid",
        f"{X.rnd(f'{kc_mid} + {two} * {k_atr}', 4)} AS kc_upper",
        f"{X.rnd(f'{kc_mid} - {two} * {k_atr}', 4)} AS kc_lower",
        f"{rsi[14]} AS rsi_14",
        f"{rsi[5]} AS rsi_5",
        f"{rsi[21]} AS rsi_21",
        f"{X.rnd(f'{rsi[5]} - {rsi[21]}', 2)} AS rsi_5_21_diff",
        f"{plus_di} AS plus_di",
        f"{minus_di} AS minus_di",
        f"{dx} AS dx",
        f"{vol_ema_5} AS vol_ema_5",
        f"{vol_ema_21} AS vol_ema_21",
        f"{X.rnd(X.pct(vol_ema_5, vol_ema_21), 2)} AS vol_5_21_dist_pct",
        f"{X.rnd(X.div('volume', vol_ema_5), 2)} AS rvol_ema_5",
        f"{X.rnd(X.div('volume', vol_ema_21), 2)} AS rvol_ema_21",
    )


def stage_second_ewm(s2: DataFrame, eras: int) -> DataFrame:
    """Stage 3: second-level EWMs and the first differences of rounded outputs."""
    before = [f"{X.lag(c)} AS prev_{c}" for c in DIFFERENCED]
    return signals(ewm_columns(s2, SECOND_LEVEL, eras, extra=before))


def signals(s3: DataFrame) -> DataFrame:
    """Formulas of stage 3, from the unrounded second-level EWMs and the values of the bar before."""
    macd_signal = X.rnd("_macd_signal", 4)
    used = {s.name for s in SECOND_LEVEL} | {"dx"} | {f"prev_{c}" for c in DIFFERENCED}
    return s3.selectExpr(
        *[X.q(c) for c in s3.columns if c not in used],
        f"{X.rnd('rvol_ema_5 - prev_rvol_ema_5', 2)} AS rvol_ema_5_dod_diff",
        f"{X.rnd('rsi_14 - prev_rsi_14', 2)} AS rsi_14_dod_diff",
        f"{X.rnd(X.pct('atr_14', 'prev_atr_14'), 2)} AS atr_14_dod_pct",
        f"{macd_signal} AS macd_signal",
        f"{X.rnd(f'macd - {macd_signal}', 4)} AS macd_hist",
        f"{X.rnd('_adx', 2)} AS adx_14",
    )


def stage_wide_windows(s3: DataFrame) -> DataFrame:
    """Stage 4, windows: the remaining lags and rolling windows."""
    widest = max(TRAJECTORY_WINDOWS)
    lags = [f"{X.lag(m, k)} AS {lag_name(m, k)}" for m in TRAJECTORY_METRICS for k in range(1, widest)]
    return s3.selectExpr(
        "*",
        f"{X.lag('close', 5)} AS _close_l5",
        f"{X.lag('close', 21)} AS _close_l21",
        f"{X.lag('volume', 5)} AS _vol_l5",
        f"{X.lag('volume', 21)} AS _vol_l21",
        f"{X.mean_by_blocks('s_close', 50, 'n_close')} AS _sma_50",
        f"{X.mean_by_blocks('s_close', 200, 'n_close')} AS _sma_200",
        f"{X.mean_by_blocks('s_close', 20, 'n_close')} AS _sma_20",
        f"{X.std_by_blocks('m_close', 'v_close', 20, 'n_close')} AS _std_20",
        f"{X.mean_by_blocks('s_volume', 10, 'n_volume')} AS _vol_sma_10",
        f"{X.mean_by_blocks('s_volume', 60, 'n_volume')} AS _vol_sma_60",
        f"{X.lag('volume_dod_pct', 1)} AS _vdp_l1",
        f"{X.lag('volume_dod_pct', 2)} AS _vdp_l2",
        f"{X.lag('rsi_14_dod_diff', 1)} AS _rdd_l1",
        f"{X.lag('rsi_14_dod_diff', 2)} AS _rdd_l2",
        *lags,
    )


def stage_wide_outputs(w: DataFrame) -> DataFrame:
    """Stage 4, outputs: formulas of one row each, so rows may be filtered before."""
    w = w.selectExpr("*", *[p for m in TRAJECTORY_METRICS for n in TRAJECTORY_WINDOWS for p in trend_parts_sql(m, n)])
    two = X.num(2.0)
    sma_50, sma_200 = X.rnd("_sma_50", 4), X.rnd("_sma_200", 4)
    vol_sma_10, vol_sma_60 = X.rnd("_vol_sma_10", 2), X.rnd("_vol_sma_60", 2)
    traj = []
    for m in TRAJECTORY_METRICS:
        for n in TRAJECTORY_WINDOWS:
            slope, r2 = trend_fit_sql(m, n)
            traj += [f"{X.rnd(slope, 4)} AS {m}_slope_{n}d", f"{X.rnd(r2, 4)} AS {m}_r2_{n}d"]
    return w.selectExpr(
        *[X.q(x) for x in w.columns if not x.startswith("_")],
        f"{X.rnd(X.pct('open', 'prev_close'), 4)} AS gap_pct",
        f"{X.rnd(X.pct('close', 'prev_close'), 4)} AS price_change_dod_pct",
        f"{X.rnd(X.pct('close', '_close_l5'), 4)} AS price_change_wow_pct",
        f"{X.rnd(X.pct('close', '_close_l21'), 4)} AS price_change_mom_pct",
        f"{X.rnd(X.pct('close', 'open'), 4)} AS open_to_close_pct",
        f"{sma_50} AS sma_50",
        f"{X.rnd(X.pct('close', sma_50), 2)} AS sma_50_dist_pct",
        f"{sma_200} AS sma_200",
        f"{X.rnd(X.pct('close', sma_200), 2)} AS sma_200_dist_pct",
        f"{X.rnd('_sma_20', 4)} AS bb_mid",
        f"{X.rnd(f'_sma_20 + {two} * _std_20', 4)} AS bb_upper",
        f"{X.rnd(f'_sma_20 - {two} * _std_20', 4)} AS bb_lower",
        f"{vol_sma_10} AS vol_sma_10",
        f"{vol_sma_60} AS vol_sma_60",
        f"{X.rnd(X.div('volume', vol_sma_10), 2)} AS rvol_sma_10",
        f"{X.rnd(X.div('volume', vol_sma_60), 2)} AS rvol_sma_60",
        f"{X.rnd(X.pct('volume', '_vol_l5'), 2)} AS volume_wow_pct",
        f"{X.rnd(X.pct('volume', '_vol_l21'), 2)} AS volume_mom_pct",
        f"{X.rnd(f'macd_hist - {lag_name('macd_hist', 1)}', 4)} AS macd_hist_dod_diff",
        f"{X.rnd(mean_present_sql(['_vdp_l2', '_vdp_l1', 'volume_dod_pct']), 2)} AS volume_dod_sma_3",
        f"{X.rnd(mean_present_sql(['_rdd_l2', '_rdd_l1', 'rsi_14_dod_diff']), 2)} AS rsi_velocity_3d",
        *traj,
    )


ROWS_PER_PARTITION = 2_000_000  # bars per task of the window stages (~1.6 GB of wide rows, streamed)


def tasks_for(rows: int, cores: int) -> int:
    """Tasks of at most ``ROWS_PER_PARTITION`` bars, as many for each core: full waves, where a last one of few leaves cores idle.

    Not more and shorter ones: each task compiles its windows, for which Spark's default code cache is too small.
    """
    return max(cores, 1) * max(1, -(-rows // (ROWS_PER_PARTITION * max(cores, 1))))


def windowed(bars: DataFrame, eras: int | None = None, partitions: int | None = None, clustered: bool = False) -> DataFrame:
    """Bars with all window columns of the 96 outputs; ``stage_wide_outputs`` finishes any subset of the rows.

    The number of EWM carries follows the eras that the dates span: ``eras``
    where the caller knows a bound (a longer series fails the job, see
    ``ewm_columns``), else measured.  ``partitions`` sets the one hash
    exchange on ``ticker``.  When either is omitted, one narrow aggregate over
    ``bars`` measures the eras and the row count; partitions are
    then as ``tasks_for`` has them.  The count is
    fixed explicitly because the shuffled bars are narrow while the rows the
    windows build are ~14x wider (AQE would size by the former), and it does
    not depend on a session-wide ``spark.sql.shuffle.partitions`` sized for
    other jobs.  Bars that are stored ``clustered`` by ticker
    (``sources/bucketed.py``) are taken as they lie, without an exchange.
    """
    spark = bars.sparkSession
    bars = bars.select(*BAR_INPUT)
    if eras is None or (partitions is None and not clustered):
        spanned, rows = era_bounds(bars)
        eras = eras or spanned
        partitions = partitions or tasks_for(rows, spark.sparkContext.defaultParallelism)
    if not clustered:
        bars = bars.repartition(partitions, W.PARTITION)
    return stage_wide_windows(stage_second_ewm(stage_first_ewm(stage_moves(bars), eras), eras))


def indicators(bars: DataFrame, partitions: int | None = None, eras: int | None = None,
               keep_rn: bool = False, clustered: bool = False) -> DataFrame:
    """All 96 indicator columns for every bar (no row filter applied); see ``windowed`` for the arguments."""
    cols = INDICATOR_COLUMNS + (["rn"] if keep_rn else [])
    return stage_wide_outputs(windowed(bars, eras, partitions, clustered)).select(*cols)


def drop_all_null(ind: DataFrame) -> DataFrame:
    """Keep a row unless all of the five headline indicators are NULL."""
    return ind.na.drop(how="all", subset=ALL_NULL_SUBSET)
