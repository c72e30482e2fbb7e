"""Closed-form rolling regression, means and deviations merged from blocks, and the 3-row mean."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import types as T

from tickframe.functions import sqlexpr as X
from tickframe.functions import windows as W
from tickframe.operators.rolling import lag_name, mean_present_sql, trend_fit_sql, trend_parts_sql

SCHEMA = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("market_date", T.DateType()),
                       T.StructField("y", T.DoubleType())])


def frame(spark, vals, ticker="t"):
    rows = [(ticker, dt.date(2000, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", f"{W.era_sql()} AS era")


def fitted(df, n):
    lags = df.selectExpr("*", *[f"{X.lag('y', k)} AS {lag_name('y', k)}" for k in range(1, n)])
    slope, r2 = trend_fit_sql("y", n)
    return lags.selectExpr("*", *trend_parts_sql("y", n)).selectExpr("market_date", f"{slope} AS s", f"{r2} AS r2").orderBy("market_date")


@pytest.mark.parametrize("n", [3, 5, 10, 21])
def test_trend_fit_matches_numpy(spark, n):
    rng = np.random.default_rng(n)
    vals = [float(v) for v in rng.normal(100, 5, 60)]
    vals[30] = None
    rows = fitted(frame(spark, vals), n).collect()
    for i, r in enumerate(rows):
        win = vals[max(0, i - n + 1): i + 1]
        if i < n - 1 or any(v is None for v in win):
            assert r["s"] is None and r["r2"] is None
            continue
        x = np.arange(n)
        b, _ = np.polyfit(x, win, 1)
        c = np.corrcoef(x, win)[0, 1] ** 2
        assert abs(r["s"] - b) < 1e-9 and abs(r["r2"] - c) < 1e-9


def test_flat_window_has_zero_r2(spark):
    last = fitted(frame(spark, [5.0] * 10), 5).collect()[-1]
    assert last["s"] == 0.0 and last["r2"] == 0.0


@pytest.mark.parametrize("n", [10, 20, 50, 60])
def test_blocks_equal_frames_with_nulls_and_outliers(spark, n):
    rng = np.random.default_rng(n)
    vals = [float(v) for v in rng.normal(10, 1, 260)]
    vals[20], vals[90], vals[120:190] = 1e12, None, [7.25] * 70
    df = frame(spark, vals).selectExpr("*", f"count(y) {X.RUNNING} AS n_y", f"{X.block_sum('y')} AS s_y", *X.block_moments("y", "m_y", "v_y"))
    rows = df.selectExpr("market_date", f"{X.mean_by_blocks('s_y', n, 'n_y')} AS m",
                         f"{X.std_by_blocks('m_y', 'v_y', n, 'n_y')} AS s").orderBy("market_date").collect()
    for i, r in enumerate(rows):
        win = vals[max(0, i - n + 1): i + 1]
        if len(win) < n or None in win:
            assert r["m"] is None and r["s"] is None
        else:
            assert r["m"] == pytest.approx(np.mean(win), rel=1e-12)
            # an outlier leaves the deviation with its row, and a flat frame has exactly none
            assert r["s"] == (0.0 if len(set(win)) == 1 else pytest.approx(np.std(win, ddof=1), rel=1e-12))


def test_mean_present(spark):
    df = spark.createDataFrame([(None, None, 3.0), (1.0, None, 2.0), (None, None, None)], "a double, b double, c double")
    out = [r[0] for r in df.selectExpr(mean_present_sql(["a", "b", "c"])).collect()]
    assert out == [3.0, 1.5, None]
