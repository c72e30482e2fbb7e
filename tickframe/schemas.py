"""Table schemas and the fixed output column order of the indicator table."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = ["ticker", "market_date"]

# Raw bar table: one row per (ticker, market_date).
BARS = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("market_date", T.DateType(), False),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("vwap", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("transactions", T.DoubleType()),
    T.StructField("datetime", T.TimestampNTZType()),
])

# One landed payload object per instrument for one date (before cleaning).
PAYLOAD = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("vwap", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("transactions", T.DoubleType()),
])

# Columns the indicator job reads from the bar table.
BAR_INPUT = ["ticker", "market_date", "open", "high", "low", "close", "volume"]

# Instrument dimension; no types are declared for it, all are strings.
INSTRUMENT_COLUMNS = [
    "ticker", "name", "asset_class", "sector", "industry_group", "industry",
    "exchange", "market", "country", "currency", "market_cap", "summary",
]
INSTRUMENTS = T.StructType([T.StructField(c, T.StringType()) for c in INSTRUMENT_COLUMNS])

# ---------------------------------------------------------------------------
# Output column order of the indicator table, the trajectory
# metrics and windows, and the subset used by the drop-if-all-null rule.
# ---------------------------------------------------------------------------
BASE_INDICATOR_COLUMNS = [
    "ticker", "market_date", "close", "prev_close",
    "gap_pct", "price_change_dod_pct", "price_change_wow_pct", "price_change_mom_pct",
    "open_to_close_pct",
    "atr_14", "atr_14_pct", "atr_5", "atr_21", "atr_5_21_dist_pct",
    "sma_50", "sma_50_dist_pct", "sma_200", "sma_200_dist_pct",
    "ema_9", "ema_21", "ema_9_21_dist_pct",
    "macd", "macd_signal", "macd_hist",
    "bb_mid", "bb_upper", "bb_lower",
    "kc_mid", "kc_upper", "kc_lower",
    "rsi_14", "rsi_5", "rsi_21", "rsi_5_21_diff",
    "adx_14", "plus_di", "minus_di",
    "obv",
    "vol_ema_5", "vol_sma_10", "vol_ema_21", "vol_sma_60", "vol_5_21_dist_pct",
    "rvol_ema_5", "rvol_sma_10", "rvol_ema_21", "rvol_sma_60",
    "rvol_ema_5_dod_diff", "volume_dod_pct", "volume_wow_pct", "volume_mom_pct",
    "rsi_14_dod_diff", "macd_hist_dod_diff", "atr_14_dod_pct",
    "volume_dod_sma_3", "rsi_velocity_3d",
]
TRAJECTORY_METRICS = ["close", "rsi_14", "obv", "macd_hist", "atr_14"]
TRAJECTORY_WINDOWS = [3, 5, 10, 21]
ALL_NULL_SUBSET = ["atr_14", "sma_50", "sma_200", "rvol_ema_5", "rsi_14"]


def trajectory_columns() -> list[str]:
    """``{metric}_slope_{w}d`` and ``{metric}_r2_{w}d``, metric-major, window-minor."""
    out = []
    for m in TRAJECTORY_METRICS:
        for w in TRAJECTORY_WINDOWS:
            out += [f"{m}_slope_{w}d", f"{m}_r2_{w}d"]
    return out


INDICATOR_COLUMNS = BASE_INDICATOR_COLUMNS + trajectory_columns()

INDICATORS = T.StructType(
    [T.StructField("ticker", T.StringType(), False), T.StructField("market_date", T.DateType(), False)]
    + [T.StructField(c, T.DoubleType()) for c in INDICATOR_COLUMNS[2:]]
)

assert len(INDICATOR_COLUMNS) == 96
