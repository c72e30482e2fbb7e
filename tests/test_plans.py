"""Physical plan shape: one shuffle for the indicator job, pushdown and pruning."""

import datetime as dt
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickframe.operators import asof, screens
from tickframe.operators.indicators import ROWS_PER_PARTITION, indicators
from tickframe.plans import catalog, jobs, quality
from tickframe.schemas import BARS, INDICATORS
from tickframe.sources import bucketed, fixtures, ingest, sink
from tickframe.streaming import landed_days


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_indicator_job_shuffles_once(spark):
    path = tempfile.mkdtemp(prefix="tf-plan-") + "/bars"
    sink.replace_days(fixtures.bars_from_lineitem(spark, SF_SMALL), path)
    bars = ingest.read_bars(spark, path)
    p = plan(indicators(bars, partitions=2, eras=2))
    assert p.count("Exchange hashpartitioning(ticker") == 1
    assert p.count("Exchange") == 1
    assert p.count("Sort [") == 1                    # one sort serves every window stage
    assert "ReadSchema: struct<ticker:string,market_date:date,open:double,high:double,low:double,close:double,volume:double>" in p


def test_daily_slice_prunes_partitions(spark):
    path = tempfile.mkdtemp(prefix="tf-plan-") + "/bars"
    sink.replace_table(fixtures.bars_from_lineitem(spark, SF_SMALL), path)
    bars = ingest.read_bars(spark, path)
    df = ingest.scan_bars(bars, F.lit("2001-11-04").cast("date"), 400)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    part = text[text.index("PartitionFilters: ["):]
    part = part[:part.index("]")]
    assert "market_month" in part and "<= 2001-11-01" in part and ">= 2000-09-01" in part
    pushed = text[text.index("PushedFilters: ["):]
    assert "LessThanOrEqual(market_date,2001-11-04), GreaterThanOrEqual(market_date," in pushed  # the text is cut off there


def test_latest_screen_uses_scalar_subquery_and_topk(spark):
    ind = jobs.bulk_indicators(fixtures.bars_from_lineitem(spark, SF_SMALL))
    p = plan(screens.attention_score(ind))
    assert "Subquery" in p and "TakeOrderedAndProject" in p


def test_exchange_sized_from_data_not_session_default(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        p = plan(indicators(fixtures.bars_from_lineitem(spark, SF_SMALL)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    n = spark.sparkContext.defaultParallelism
    assert f"hashpartitioning(ticker#" in p and f", {n}), REPARTITION_BY_NUM" in p


def test_latest_screen_reads_one_folder_of_the_record(spark):
    path = tempfile.mkdtemp(prefix="tf-plan-") + "/bars"
    bars = fixtures.bars_from_lineitem(spark, SF_SMALL)
    sink.replace_table(bars, path)
    day = sink.latest_date(spark, path)
    assert day == bars.agg(F.max("market_date")).first()[0]
    listed = sink.stored_table(spark, path, BARS, day, day)
    assert len(listed.inputFiles()) == 1
    for table in (listed, sink.stored_table(spark, path, BARS)):
        text = plan(screens.as_of_dates(table, day))
        assert text.count("FileScan") == 1 and "Subquery" not in text
        assert f"= {day.replace(day=1)}" in text[text.index("PartitionFilters"):] and f"EqualTo(market_date,{day})" in text


def test_build_from_buckets_has_no_exchange(spark):
    path = tempfile.mkdtemp(prefix="tf-buckets-") + "/bars"
    bars = fixtures.bars_from_lineitem(spark, SF_SMALL)
    bucketed.write(bars, path, buckets=3)
    spark.sql(f"DROP TABLE {bucketed._name(path)}")  # as another session finds it
    p = plan(jobs.bulk_indicators(bucketed.read(spark, path), clustered=True))
    assert "Exchange" not in p and p.count("Sort [") == 1 and "SelectedBucketsCount: 3 out of 3" in p
    with pytest.raises(FileExistsError):
        bucketed.write(bars, path, buckets=3)


def test_as_of_join_sorts_once(spark):
    bars = fixtures.bars_from_lineitem(spark, SF_SMALL)
    p = plan(asof.latest_before(bars.select("ticker", "market_date"), bars, {"close": "last_close"}).where("ticker <> 'A'"))
    top = p[:p.index("Union")]
    assert top.count("Exchange") == 1 and top.count("Sort [") == 1 and "Join" not in top


def test_daily_formulas_run_behind_the_date_filter(spark):
    bars = fixtures.bars_from_lineitem(spark, SF_SMALL)
    text = plan(jobs.daily_indicators(bars, None, "1998-08-01", partitions=2))
    # the windows are below the filter on the date, the formulas of one row above it
    assert re.search(r"Filter .*= 1998-08-01\)", text).start() < text.index("Window [")
    assert "SortAggregate" not in plan(jobs.obv_anchor(jobs.bulk_indicators(bars, partitions=2), "1998-08-01")).split("Window [")[0]


def test_one_day_load_reads_one_folder(spark):
    root = tempfile.mkdtemp(prefix="tf-land-")
    landed_days.land(fixtures.payload_from_lineitem(spark, SF_SMALL).withColumn(
        "market_date", F.trunc("market_date", "year")), root)
    df = ingest.read_payload(spark, root, day="1995-01-01")
    text = plan(df)
    assert "PartitionFilters: [isnotnull(market_date" in text and "1995-01-01" in text
    assert {str(r[0]) for r in df.select("market_date").distinct().collect()} == {"1995-01-01"}


def test_family_query_builds_its_own_columns_alone(spark):
    bars = catalog.bars(spark, SF_SMALL)
    text = plan(catalog.spark_queries()["ind_obv"](spark, SF_SMALL))
    assert "Window [" in text and not re.search(r"close_slope|macd|vol_sma", text)
    assert text.count("Window [") < plan(jobs.bulk_indicators(bars)).count("Window [")


def test_daily_build_sends_no_wide_history_through_an_exchange(spark):
    bars = catalog.bars(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(jobs.daily_indicators(bars, bars.withColumn("obv", F.lit(0.0)), "2001-11-04", 100000, partitions=3))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for below in re.split("Exchange hashpartitioning", text)[1:]:
        # what an exchange takes from all the windows is one date
        assert below.count("Window [") < 5 or "= 2001-11-04)" in below[:below.index("Window [")]


def test_window_tasks_fill_their_waves():
    for cores in (1, 12, 24):
        for rows in (0, 500_000, 36_000_000, 200_000_000):
            tasks = bucketed.buckets_for(rows, cores)
            assert tasks % cores == 0 and tasks >= cores and rows <= tasks * ROWS_PER_PARTITION


def test_lines_are_dealt_out_to_tasks_of_bounded_number(spark, monkeypatch):
    before = sorted(map(str, fixtures.bars_from_lineitem(spark, SF_SMALL).collect()))
    assert "REPARTITION_BY_NUM" not in plan(fixtures.bars_from_lineitem(spark, SF_SMALL))
    monkeypatch.setattr(fixtures, "LINES_PER_TASK", 100)
    dealt = fixtures.bars_from_lineitem(spark, SF_SMALL)
    assert re.search(r"hashpartitioning\(l_orderkey#\d+L?, l_linenumber#\d+, 6\d\), REPARTITION_BY_NUM", plan(dealt))
    assert sorted(map(str, dealt.collect())) == before


def test_landed_objects_are_compressed(spark):
    root = tempfile.mkdtemp(prefix="tf-land-")
    payload = fixtures.payload_from_lineitem(spark, SF_SMALL).withColumn("market_date", F.trunc("market_date", "year"))
    landed_days.land(payload, root)
    landed = ingest.read_payload(spark, root)
    assert all(f.endswith(".json.gz") for f in landed.inputFiles())
    assert sorted(map(str, landed.select(*payload.columns).collect())) == sorted(map(str, payload.collect()))


def test_invariant_rules_are_evaluated_once_over_the_formulas(spark):
    found = quality.invariant_violations(jobs.bulk_indicators(fixtures.bars_from_lineitem(spark, SF_SMALL), partitions=2))
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("bands_ordered") == 1  # no copy in a filter below, with the formulas of the columns in it


def test_broken_invariants_are_found(spark):
    day = dt.date(2024, 1, 2)
    good = {"bb_lower": 1.0, "bb_mid": 2.0, "bb_upper": 3.0, "rsi_14": 50.0, "close_r2_3d": 1.0, "atr_14": 0.0}
    planted = {"ok": good, "nulls": {}, "bands": good | {"bb_lower": 2.5}, "two": good | {"rsi_14": 101.0, "close_r2_3d": -0.1}}
    rows = [(t, day, *[values.get(c) for c in INDICATORS.fieldNames()[2:]]) for t, values in planted.items()]
    found = quality.invariant_violations(spark.createDataFrame(rows, INDICATORS))
    assert sorted(map(tuple, found.collect())) == [("bands", day, "bands_ordered"), ("two", day, "close_r2_3d_in_range"), ("two", day, "rsi_14_in_range")]
