"""Hand-made series through the full indicator job (warm-up lengths, flat and
monotone series, zero divisors, ticker boundaries, rounding ties)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickframe.functions.numeric import rnd
from tickframe.operators.indicators import drop_all_null, indicators
from tickframe.schemas import INDICATOR_COLUMNS


def bars(spark, series: dict[str, list[tuple]]):
    """series: ticker -> list of (open, high, low, close, volume)."""
    rows = []
    for t, vals in series.items():
        for i, (o, h, lo, c, v) in enumerate(vals):
            rows.append((t, dt.date(2001, 1, 1) + dt.timedelta(days=i), o, h, lo, c, v))
    return spark.createDataFrame(
        rows, "ticker string, market_date date, open double, high double, low double, close double, volume double")


def ohlc(closes, volume=1000.0):
    return [(c, c + 1.0, c - 1.0, c, volume) for c in closes]


def run(spark, series):
    out = indicators(bars(spark, series), partitions=2).orderBy("ticker", "market_date").collect()
    res = {}
    for r in out:
        res.setdefault(r["ticker"], []).append(r.asDict())
    return res


def first_index(rows, col):
    return next((i for i, r in enumerate(rows) if r[col] is not None), None)


def test_output_columns(spark):
    df = indicators(bars(spark, {"a": ohlc([10.0, 11.0])}))
    assert df.columns == INDICATOR_COLUMNS


def test_warm_up_lengths(spark):
    closes = [100 + ((i * 7) % 11) - 5 + i * 0.1 for i in range(60)]
    rows = run(spark, {"a": ohlc(closes)})["a"]
    assert first_index(rows, "atr_14") == 13      # 14th bar
    assert first_index(rows, "atr_5") == 4
    assert first_index(rows, "atr_21") == 20
    assert first_index(rows, "rsi_14") == 14      # 15th bar: first move is on the 2nd bar
    assert first_index(rows, "rsi_5") == 5
    assert first_index(rows, "adx_14") == 26      # 27th bar
    assert first_index(rows, "sma_50") == 49
    assert first_index(rows, "bb_mid") == 19
    assert first_index(rows, "kc_upper") == 9
    assert first_index(rows, "vol_sma_60") == 59
    assert first_index(rows, "price_change_mom_pct") == 21
    assert first_index(rows, "close_slope_21d") == 20
    assert first_index(rows, "ema_9") == 0 and rows[0]["ema_9"] == rows[0]["close"]


def test_single_bar(spark):
    r = run(spark, {"a": [(10.0, 12.0, 9.0, 11.0, 500.0)]})["a"][0]
    assert r["prev_close"] is None and r["gap_pct"] is None
    assert r["ema_9"] == 11.0 and r["kc_mid"] == 11.0 and r["macd"] == 0.0
    assert r["sma_50"] is None and r["atr_14"] is None
    assert r["rvol_ema_5"] == 1.0 and r["obv"] == 0.0
    assert r["open_to_close_pct"] == 10.0


def test_flat_series(spark):
    rows = run(spark, {"a": ohlc([50.0] * 40)})["a"]
    last = rows[-1]
    assert last["rsi_14"] == 100.0          # zero loss mean
    assert last["close_slope_10d"] == 0.0 and last["close_r2_10d"] == 0.0
    assert last["bb_upper"] == last["bb_mid"] == last["bb_lower"] == 50.0
    assert last["obv"] == 0.0


def test_monotone_series(spark):
    up = run(spark, {"u": ohlc([10.0 + i for i in range(30)])})["u"][-1]
    down = run(spark, {"d": ohlc([100.0 - i for i in range(30)])})["d"][-1]
    assert up["rsi_14"] == 100.0 and down["rsi_14"] == 0.0
    assert up["close_r2_21d"] == 1.0 and up["close_slope_21d"] == 1.0
    assert down["close_slope_5d"] == -1.0
    assert up["obv"] == 29 * 1000.0 and down["obv"] == -29 * 1000.0


def test_zero_divisors_give_null(spark):
    rows = run(spark, {"z": [(0.0, 1.0, 0.0, 0.0, 0.0), (0.0, 1.0, 0.0, 1.0, 0.0), (1.0, 2.0, 1.0, 2.0, 5.0)]})["z"]
    assert rows[0]["open_to_close_pct"] is None       # open 0
    assert rows[1]["gap_pct"] is None                 # previous close 0
    assert rows[1]["volume_dod_pct"] is None          # previous volume 0
    assert rows[0]["rvol_ema_5"] is None              # volume baseline 0


def test_tickers_do_not_leak(spark):
    res = run(spark, {"a": ohlc([10.0] * 25), "b": ohlc([1000.0 + i for i in range(25)])})
    b0 = res["b"][0]
    assert b0["prev_close"] is None and b0["ema_21"] == 1000.0
    assert res["a"][-1]["ema_21"] == 10.0


def test_drop_all_null_keeps_rows_with_any_headline(spark):
    df = indicators(bars(spark, {"a": ohlc([10.0, 11.0, 12.0])}))
    assert drop_all_null(df).count() == 3  # rvol_ema_5 exists from the first bar


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.12345,), (1.005,), (2.675,), (-0.125,), (0.375,)], "x double")
    got = [r[0] for r in df.select(rnd("x", 4).alias("a")).collect()]
    assert got[0] == 0.1234
    got2 = [r[0] for r in df.select(rnd("x", 2)).collect()]
    assert got2[3] == -0.12 and got2[4] == 0.38
