"""EWM blocked scan against the sequential definition and against pandas."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.functions import windows as W
from tickframe.operators.ewm import Ewm, era_bounds, eras_of_days, ewm_columns, ewm_reference

SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("market_date", T.DateType()),
    T.StructField("rn", T.IntegerType()),
    T.StructField("x", T.DoubleType()),
])


def frame(spark, series: dict[str, list]):
    import datetime as dt
    rows = []
    for t, vals in series.items():
        for i, v in enumerate(vals):
            rows.append((t, dt.date(1990, 1, 1) + dt.timedelta(days=i), i, v))
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", f"{W.era_sql()} AS era")


def close(a, b, tol=1e-9):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= tol * max(1.0, abs(b))


def random_series(rng, n, null_rate):
    out = []
    for _ in range(n):
        out.append(None if rng.random() < null_rate else rng.uniform(-50, 150))
    return out


@pytest.mark.parametrize("era_days", [16, 100, 1400])
def test_scan_matches_sequential_fold(spark, monkeypatch, era_days):
    monkeypatch.setattr(W, "ERA_DAYS", era_days)
    rng = random.Random(7)
    lengths = [1, 2, 13, 14, 15, 255, 256, 257, 700]
    series = {f"t{i}": random_series(rng, n, [0.0, 0.1, 0.6][i % 3]) for i, n in enumerate(lengths)}
    series["lead"] = [None] * 30 + random_series(rng, 50, 0.0)
    series["trail"] = random_series(rng, 50, 0.0) + [None] * 30
    series["gap"] = random_series(rng, 20, 0.0) + [None] * 600 + random_series(rng, 20, 0.0)
    specs = [Ewm.weight("w14", "x", 1 / 14, 14), Ewm.span("s5", "x", 5), Ewm.weight("w21", "x", 1 / 21, 21),
             Ewm.span("s26", "x", 26, 3)]
    df = frame(spark, series)
    eras, rows = era_bounds(df)
    assert rows == sum(map(len, series.values())) and eras <= eras_of_days(max(map(len, series.values())))
    out = ewm_columns(df, specs, eras).orderBy("ticker", "rn").collect()
    got = {}
    for r in out:
        got.setdefault(r["ticker"], []).append(r)
    for t, vals in series.items():
        for s in specs:
            want = ewm_reference(vals, s.alpha, s.min_periods)
            have = [r[s.name] for r in got[t]]
            bad = [(i, a, b) for i, (a, b) in enumerate(zip(have, want)) if not close(a, b)]
            assert not bad, (t, s.name, bad[:3])


def test_reference_fold_matches_pandas():
    rng = random.Random(3)
    for trial in range(60):
        n = rng.randint(1, 300)
        vals = random_series(rng, n, rng.choice([0.0, 0.2, 0.6]))
        alpha = rng.choice([1 / 14, 1 / 5, 2 / 6, 2 / 27, 0.5])
        minp = rng.choice([0, 1, 5, 14])
        want = pd.Series([math.nan if v is None else v for v in vals]).ewm(
            alpha=alpha, min_periods=minp, adjust=False).mean().tolist()
        have = ewm_reference(vals, alpha, minp)
        for a, b in zip(have, want):
            assert (a is None and math.isnan(b)) or (a is not None and abs(a - b) <= 1e-9 * max(1, abs(b)))


def test_constant_series_is_flat(spark):
    out = ewm_columns(frame(spark, {"c": [10.0] * 40}), [Ewm.span("e", "x", 9)], 1)
    assert all(r["e"] == 10.0 for r in out.collect())
    flat = [77.16125, None, 77.16125, 77.16125, 0.1]  # exactly flat until another value comes
    out = ewm_columns(frame(spark, {"c": flat}), [Ewm.weight("e", "x", 1 / 11)], 1).orderBy("rn").collect()
    assert [r["e"] for r in out[:4]] == [77.16125] * 4 and close(out[4]["e"], ewm_reference(flat, Ewm.weight("e", "x", 1 / 11).alpha)[4])


def test_no_leak_between_tickers(spark):
    df = frame(spark, {"a": [1.0] * 10, "b": [100.0] * 10})
    out = ewm_columns(df, [Ewm.span("e", "x", 5)], 1).where(F.col("ticker") == "b").collect()
    assert all(abs(r["e"] - 100.0) < 1e-12 for r in out)


def test_extremes_of_an_era(spark):
    """A full era of rows at the fastest decay, values of all sizes, a gap before and behind."""
    rng = random.Random(1)
    vals = [10.0 ** rng.uniform(-6, 12) for _ in range(1300)] + [None] * 1200 + [5.0, None, 1e-9] + [0.0] * 1400 + [1e9] * 3
    specs = [Ewm.span("s5", "x", 5), Ewm.weight("w21", "x", 1 / 21)]
    df = frame(spark, {"t": vals})
    rows = ewm_columns(df, specs, era_bounds(df)[0]).orderBy("rn").collect()
    for s in specs:
        for r, want in zip(rows, ewm_reference(vals, s.alpha), strict=True):
            assert close(r[s.name], want, 1e-12) or abs(r[s.name] - want) < 1e-9 * abs(want) + 1e-150, (r["rn"], r[s.name], want)


def test_series_of_one_null_pattern_share_their_products(spark):
    df = frame(spark, {"t": random_series(random.Random(2), 30, 0.3)}).selectExpr("*", "-2 * x AS y")
    out = ewm_columns(df, [Ewm.weight("a", "x", 0.1), Ewm.weight("b", "y", 0.1, seen="x")], 1)
    assert out._jdf.queryExecution().analyzed().toString().count("product(") == 1
    assert all(close(r["b"], None if r["a"] is None else -2 * r["a"]) for r in out.collect())


def test_a_longer_history_than_announced_fails(spark):
    df = frame(spark, {"t": [1.0] * 1500})
    with pytest.raises(ValueError, match="too fast"):
        ewm_columns(df, [Ewm.span("e", "x", 3)], 2)
    with pytest.raises(Exception, match="longer than the scan"):
        ewm_columns(df, [Ewm.span("e", "x", 5)], 1).collect()
