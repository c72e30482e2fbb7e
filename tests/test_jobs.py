"""Ingest, sinks, daily build and the streaming loader on the small fixture."""

import datetime as dt
import math
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickframe.operators.indicators import indicators
from tickframe.plans import jobs
from tickframe.schemas import BARS, INDICATOR_COLUMNS, INDICATORS, KEY, PAYLOAD
from tickframe.sources import fixtures, ingest, sink
from tickframe.streaming import landed_days


def payload_df(spark, rows):
    schema = "market_date date, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PAYLOAD.fields)
    return spark.createDataFrame(rows, schema)


def obj(day, ticker, volume, close=1.0, ts=0):
    return (day, ticker, close, close, close, close, volume, close, ts, 1.0)


def test_clean_keeps_highest_volume_and_drops_missing_tickers(spark):
    d = dt.date(2024, 1, 2)
    rows = [obj(d, "A", 10.0, 1.0), obj(d, "A", 30.0, 3.0), obj(d, "A", None, 9.0), obj(d, "A", math.nan, 8.0),
            obj(d, None, 99.0), obj(d, "B", None, 5.0), obj(dt.date(2024, 1, 3), "A", 1.0, 7.0)]
    out = {(r["market_date"], r["ticker"]): r for r in ingest.clean_payload(payload_df(spark, rows)).collect()}
    assert set(out) == {(d, "A"), (d, "B"), (dt.date(2024, 1, 3), "A")}
    assert out[(d, "A")]["volume"] == 30.0 and out[(d, "A")]["close"] == 3.0
    assert out[(d, "B")]["volume"] is None
    assert out[(d, "A")]["datetime"] == dt.datetime(1970, 1, 1)


def test_replace_days_is_idempotent_and_keeps_other_days(spark):
    path = tempfile.mkdtemp(prefix="tf-bars-") + "/bars"
    d1, d2 = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    sink.replace_days(ingest.clean_payload(payload_df(spark, [obj(d1, "A", 1.0), obj(d2, "A", 2.0)])), path)
    sink.replace_days(ingest.clean_payload(payload_df(spark, [obj(d2, "B", 5.0)])), path)
    sink.replace_days(ingest.clean_payload(payload_df(spark, [obj(d2, "B", 5.0)])), path)
    got = sorted((r["market_date"], r["ticker"]) for r in ingest.read_bars(spark, path).collect())
    assert got == [(d1, "A"), (d2, "B")]
    sink.replace_days(ingest.read_bars(spark, path).limit(0), path)  # empty: nothing changes
    assert ingest.read_bars(spark, path).count() == 2
    sink.assert_unique(ingest.read_bars(spark, path))


def test_replace_table_skips_empty(spark):
    path = tempfile.mkdtemp(prefix="tf-ind-") + "/t"
    bars = fixtures.bars_from_lineitem(spark, SF_SMALL).limit(0)
    assert sink.replace_table(bars, path) is False


def test_missing_business_days(spark):
    rows = [obj(dt.date(2024, 1, d), "A", 1.0) for d in (1, 2, 5, 8)]  # Mon, Tue, Fri, Mon
    bars = ingest.clean_payload(payload_df(spark, rows))
    gaps = sorted(r[0] for r in ingest.missing_business_days(spark, bars).collect())
    assert gaps == [dt.date(2024, 1, 3), dt.date(2024, 1, 4)]


def test_daily_full_history_equals_bulk(spark):
    bars = fixtures.bars_from_lineitem(spark, SF_SMALL).cache()
    bulk = jobs.bulk_indicators(bars, partitions=2).cache()
    day = bars.agg(F.max("market_date")).first()[0]
    daily = jobs.daily_indicators(bars, bulk, day, lookback_days=100000, partitions=2)
    want = {r["ticker"]: r for r in bulk.where(F.col("market_date") == day).collect()}
    got = {r["ticker"]: r for r in daily.collect()}
    assert set(got) == set(want) and got
    for t, r in got.items():
        for c in INDICATOR_COLUMNS:
            assert r[c] == want[t][c], (t, c)


def test_daily_obv_is_anchored(spark):
    bars = fixtures.bars_from_lineitem(spark, SF_SMALL).cache()
    bulk = jobs.bulk_indicators(bars, partitions=2).cache()
    day = bars.agg(F.max("market_date")).first()[0]
    daily = jobs.daily_indicators(bars, bulk, day, lookback_days=400, partitions=2)
    bulk_rows = {r["ticker"]: r for r in bulk.where(F.col("market_date") == day).collect()}
    daily_rows = {r["ticker"]: r for r in daily.collect()}
    # the short slice restarts the running sum; the anchor restores it
    assert {t: r["obv"] for t, r in daily_rows.items()} == {t: r["obv"] for t, r in bulk_rows.items()}
    # row-window columns whose window fits in the slice equal the bulk build
    covered = ["prev_close", "gap_pct", "price_change_mom_pct", "sma_50", "sma_50_dist_pct", "bb_mid",
               "bb_upper", "vol_sma_60", "volume_mom_pct", "close_slope_21d", "close_r2_21d",
               "obv_slope_10d", "obv_r2_10d"]
    for t, r in daily_rows.items():
        for c in covered:
            assert r[c] == bulk_rows[t][c], (t, c)
    # suppliers have some 85 bars in 400 days; the return flags have more than 200, and then the mean is that of the bulk build
    assert {t: r["sma_200"] for t, r in daily_rows.items()} == {
        t: bulk_rows[t]["sma_200"] if t in ("A", "N", "R") and bars.where(F.col("ticker") == t).where(
            F.col("market_date") > F.date_sub(F.lit(day), 401)).count() >= 200 else None for t in daily_rows}


def test_stream_loader_merges_batches(spark):
    root = tempfile.mkdtemp(prefix="tf-stream-")
    land, bars_path, ckpt = f"{root}/landing", f"{root}/bars", f"{root}/ckpt"
    d1, d2 = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    landed_days.land(payload_df(spark, [obj(d1, "A", 1.0), obj(d1, "B", 2.0)]), land)
    landed_days.start(spark, land, bars_path, ckpt).awaitTermination()
    landed_days.land(payload_df(spark, [obj(d1, "A", 9.0, 4.0), obj(d2, "A", 3.0)]), land)
    landed_days.start(spark, land, bars_path, ckpt).awaitTermination()
    got = {(r["market_date"], r["ticker"]): r["volume"] for r in ingest.read_bars(spark, bars_path).collect()}
    assert got == {(d1, "A"): 9.0, (d1, "B"): 2.0, (d2, "A"): 3.0}


def test_backfill_then_daily_refresh_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="tf-backfill-")
    land, bars_path, ind_path = f"{root}/landing", f"{root}/bars", f"{root}/indicators"
    payload = fixtures.payload_from_lineitem(spark, SF_SMALL)
    landed_days.land(payload, land)
    assert jobs.backfill(spark, land, bars_path, ind_path) is True
    bars = ingest.read_bars(spark, bars_path)
    sink.assert_unique(bars)
    want_bars = ingest.clean_payload(payload).count()
    assert bars.count() == want_bars
    n_ind = sink.stored_table(spark, ind_path, INDICATORS).count()
    assert n_ind == jobs.bulk_indicators(bars).count()
    day = bars.agg(F.max("market_date")).first()[0]
    jobs.refresh_day(spark, bars_path, ind_path, day)
    first = sorted(tuple(r) for r in sink.stored_table(spark, ind_path, INDICATORS).where(F.col("market_date") == day)
                   .select("ticker", "obv", "sma_50", "rsi_14").collect())
    jobs.refresh_day(spark, bars_path, ind_path, day)
    again = sorted(tuple(r) for r in sink.stored_table(spark, ind_path, INDICATORS).where(F.col("market_date") == day)
                   .select("ticker", "obv", "sma_50", "rsi_14").collect())
    assert first == again and first
    assert sink.stored_table(spark, ind_path, INDICATORS).count() == n_ind


def test_register_views_runs_sql(spark):
    from tickframe.plans.views import register_views
    bars = fixtures.bars_from_lineitem(spark, SF_SMALL)
    register_views(spark, bars, jobs.bulk_indicators(bars, partitions=2),
                   fixtures.instruments_from_supplier(spark, SF_SMALL))
    n = spark.sql("""SELECT count(*) FROM daily_indicators di JOIN financedatabase fd ON di.ticker = fd.ticker
                     WHERE di.market_date = (SELECT max(market_date) FROM daily_market_data)""").first()[0]
    assert n > 0


def test_command_line_modes(spark, capsys):
    from tickframe.__main__ import main
    root = tempfile.mkdtemp(prefix="tf-cli-")
    land, bars_path, ind_path = f"{root}/landing", f"{root}/bars", f"{root}/indicators"
    payload = fixtures.payload_from_lineitem(spark, SF_SMALL)
    days = [r[0] for r in payload.select("market_date").distinct().orderBy("market_date").collect()]
    landed_days.land(payload.where(F.col("market_date") < days[-1]), land)
    assert main(["backfill", "--landing", land, "--bars", bars_path, "--indicators", ind_path]) == 0
    before = sink.stored_table(spark, ind_path, INDICATORS).count()
    landed_days.land(payload.where(F.col("market_date") == days[-1]), land)
    assert main(["daily", "--landing", land, "--bars", bars_path, "--indicators", ind_path]) == 0
    after = sink.stored_table(spark, ind_path, INDICATORS)
    assert after.where(F.col("market_date") == days[-1]).count() > 0
    assert after.count() > before
    assert main(["recalculate", "--bars", bars_path, "--indicators", ind_path]) == 0
    out = capsys.readouterr().out
    assert "business days without bars" in out and f"refreshed {days[-1]}" in out


def test_full_refresh_keeps_no_other_date(spark):
    path = tempfile.mkdtemp(prefix="tf-full-") + "/t"
    d1, d2 = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    both = ingest.clean_payload(payload_df(spark, [obj(d1, "A", 1.0), obj(d2, "A", 2.0)]))
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    for mode in ("static", "dynamic"):
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        try:
            sink.replace_table(both, path)
            sink.replace_table(both.where(F.col("market_date") == d1), path)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
        assert [r["market_date"] for r in ingest.read_bars(spark, path).collect()] == [d1]


def test_reset_empties_both_tables_and_days_can_follow(spark):
    root = tempfile.mkdtemp(prefix="tf-reset-")
    bars_path, ind_path = f"{root}/bars", f"{root}/ind"
    day = dt.date(2024, 1, 2)
    bars = ingest.clean_payload(payload_df(spark, [obj(day, "A", 1.0)]))
    sink.replace_days(bars, bars_path)
    sink.reset_all(spark, bars_path, ind_path)
    assert ingest.read_bars(spark, bars_path).count() == 0 and sink.latest_date(spark, bars_path) is None
    sink.replace_days(bars, bars_path)
    assert [r["ticker"] for r in ingest.read_bars(spark, bars_path).collect()] == ["A"]
    jobs.refresh_day(spark, bars_path, ind_path, day)  # the indicator table is empty, not missing


def test_backfill_with_reset_keeps_only_landed_dates(spark):
    root = tempfile.mkdtemp(prefix="tf-back-")
    d1, d2 = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    sink.replace_days(ingest.clean_payload(payload_df(spark, [obj(d1, "A", 1.0)])), f"{root}/bars")
    landed_days.land(payload_df(spark, [obj(d2, "A", 1.0)]), f"{root}/land")
    jobs.backfill(spark, f"{root}/land", f"{root}/bars", f"{root}/ind", reset=True)
    assert [r["market_date"] for r in ingest.read_bars(spark, f"{root}/bars").collect()] == [d2]


def test_duplicate_bars_and_short_scans_fail_the_job(spark):
    day = dt.date(2024, 1, 2)
    bars = ingest.clean_payload(payload_df(spark, [obj(day + dt.timedelta(days=i), "A", 1.0) for i in range(20)]))
    with pytest.raises(Exception, match="duplicate key: A 2024-01-02"):
        jobs.bulk_indicators(bars.union(bars.limit(1)), partitions=1).collect()
    with pytest.raises(Exception, match="longer than the scan"):
        indicators(bars.union(bars.withColumn("market_date", F.date_add("market_date", 2800))), partitions=1, eras=2).collect()


def test_only_a_missing_table_counts_as_none(spark):
    root = tempfile.mkdtemp(prefix="tf-none-")
    assert sink.stored_table(spark, f"{root}/none", BARS) is None
    with pytest.raises(Exception):
        sink.stored_table(spark, "nosuchscheme://x/t", BARS)


def test_infinities_are_no_observations(spark):
    day = dt.date(2024, 1, 2)
    r = ingest.clean_payload(payload_df(spark, [obj(day, "A", 1.0, math.inf)])).first()
    assert r["close"] is None and r["volume"] == 1.0
