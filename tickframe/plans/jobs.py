"""End-to-end jobs: bulk build, daily build, daily load, backfill.

* Q-9 bulk: whole bar history -> 96 columns -> drop-if-all-null -> full refresh.
* Q-10 daily: ``lookback_days`` of bars -> 96 columns, OBV anchored to the
  stored table -> one date -> replace that date.
  Or, from a stored state of each ticker: one date of bars -> that date, equal to the bulk build (``carry.py``).
* Q-11 daily load: landed payload of one date -> clean -> replace that date.
* Q-12 backfill: every landed date at once (one cleaning job, no per-day
  loop), then the bulk build; on request into tables that are reset first.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..operators.ewm import eras_of_days
from ..operators.indicators import drop_all_null, indicators, stage_wide_outputs, windowed
from ..schemas import BARS, INDICATOR_COLUMNS, INDICATORS
from ..sources import ingest, sink
from . import carry

DAILY_LOOKBACK_DAYS = 400  # fixed value: calendar days of history read by the daily build
#: Bars from which a bulk build is written by the tasks that compute it: an exchange of so many wide rows holds some 5 GB,
#: and a task has enough rows of a month for a file of some MB.
WRITTEN_BY_TICKER_FROM = 10_000_000


def _date(d: dt.date | str | Column) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(d).cast("date")


def bulk_indicators(bars: DataFrame, partitions: int | None = None, clustered: bool = False) -> DataFrame:
    """Q-9: the indicator table over the full history (I-11, F-1, F-3); a duplicate bar fails the job (I-8).

    ``clustered``: the bars are stored by ticker (``sources/bucketed.py``) and need no exchange.
    """
    return drop_all_null(indicators(ingest.scan_bars(bars), partitions=partitions, clustered=clustered))


def written_by_ticker(bars: DataFrame) -> bool:
    """Whether the build over these bars is stored without an exchange of its wide rows (``versions.publish``)."""
    return bars.count() >= WRITTEN_BY_TICKER_FROM


def obv_anchor(stored: DataFrame, day: dt.date | str | Column, since: Column | None = None) -> DataFrame:
    """J-4: per ticker, the latest stored OBV strictly before ``day`` (and not before ``since``).

    Fixed-width aggregates (``max``, ``max_by``), so a hash table keeps one
    candidate per ticker in each input partition before the shuffle, without
    a sort; both date bounds prune partitions.
    """
    cond = dates.before(stored, _date(day))
    if since is not None:
        cond = cond & dates.since(stored, since)
    return stored.where(cond).groupBy("ticker").agg(
        F.max("market_date").alias("anchor_date"), F.max_by("obv", "market_date").alias("anchor_obv"))


def daily_indicators(bars: DataFrame, stored: DataFrame | None, day: dt.date | str | Column,
                     lookback_days: int = DAILY_LOOKBACK_DAYS, partitions: int | None = None) -> DataFrame:
    """Q-10: indicators of one date from a bounded slice of history.

    Row-window outputs equal the bulk build when the slice covers their
    window; EWMs restart at the slice start.  OBV is re-anchored: the naive
    running sum over the slice plus, per ticker, the stored OBV minus the
    naive sum at the latest stored date inside the slice (J-6; 0 when that
    date is outside the slice, J-5).  Slopes and r2 do not depend on the
    offset, so the offset is applied to the selected date only.

    ``day`` is a date (or a date literal); a scalar-subquery Column works but
    is evaluated once per filter that uses it.

    After its windows only the target rows go on, so the formulas of the 96
    outputs run for one date.  The naive OBV at the anchors comes from a pass
    of its own, which has the windows of OBV alone: a join of the wide rows
    would send the whole slice through another exchange.  The EWM carries
    follow the slice bound (a duplicate bar fails the job); without
    ``partitions`` one narrow aggregate sizes the exchange.
    """
    d = _date(day)
    since = F.date_sub(d, lookback_days)
    eras = eras_of_days(lookback_days + 1)
    ind = windowed(ingest.scan_bars(bars, d, lookback_days), eras if eras <= 2 else None, partitions)
    if stored is None:
        return drop_all_null(stage_wide_outputs(ind.where(F.col("market_date") == d)).select(*INDICATOR_COLUMNS))
    naive = ind.select("ticker", F.col("market_date").alias("anchor_date"), "obv")
    offset = naive.join(obv_anchor(stored, d, since), ["ticker", "anchor_date"]).select(
        "ticker", (F.col("anchor_obv") - F.col("obv")).alias("anchor_offset"))
    today = ind.where(F.col("market_date") == d).join(offset, "ticker", "left")
    moved = F.col("obv") + F.coalesce(F.col("anchor_offset"), F.lit(0.0))
    return drop_all_null(stage_wide_outputs(today).withColumn("obv", moved).select(*INDICATOR_COLUMNS))


def load_days(spark: SparkSession, payload_path: str, bars_path: str, fmt: str = "json",
              day: dt.date | str | None = None) -> DataFrame:
    """Q-11 (one ``day``: its landing folder alone is read) / Q-12 phase 1 (every landed date).

    The cleaned dates replace those dates in the bar table; other dates stay as they are.
    """
    bars = ingest.clean_payload(ingest.read_payload(spark, payload_path, fmt, day))
    sink.replace_days(bars, bars_path, BARS)
    return ingest.read_bars(spark, bars_path)


def refresh_day(spark: SparkSession, bars_path: str, indicators_path: str,
                day: dt.date | str, lookback_days: int = DAILY_LOOKBACK_DAYS) -> None:
    """Daily mode after the load: build one date and replace it in the indicator table."""
    bars = ingest.read_bars(spark, bars_path)
    stored = sink.stored_table(spark, indicators_path, INDICATORS)  # first run: none, OBV offset 0
    sink.replace_days(daily_indicators(bars, stored, day, lookback_days), indicators_path, INDICATORS)


def carry_history(spark: SparkSession, bars_path: str, carry_path: str) -> dt.date | None:
    """Stores the state of each ticker after its last bar (``plans/carry.py``); returns the last date, None without bars."""
    day = sink.latest_date(spark, bars_path)
    if day is not None:
        carry.save(carry.carry_of(ingest.read_bars(spark, bars_path)), carry_path, day)
    return day


def refresh_day_carried(spark: SparkSession, bars_path: str, indicators_path: str, carry_path: str, day: dt.date) -> None:
    """Daily mode from the stored state: reads the bars of ``day`` and one row a ticker, whatever the length of the history.

    ``day`` must be later than the state's date.  The indicator rows are stored first: a job that fails between the two
    writes is repeated from the old state and replaces the same date.
    """
    found = carry.stored(spark, carry_path)
    if found is None or found[1] >= day:
        raise ValueError(f"the carry at {carry_path} does not end before {day}: build it anew (carry_history)")
    bars = ingest.read_bars(spark, bars_path, day, day).where(F.col("market_date") == F.lit(day))
    rows, state = carry.next_day(found[0], bars)
    sink.replace_days(rows, indicators_path, INDICATORS)
    carry.save(state, carry_path, day)


def backfill(spark: SparkSession, payload_path: str, bars_path: str, indicators_path: str,
             fmt: str = "json", reset: bool = False) -> bool:
    """Q-12: load all landed dates in one job, then rebuild the indicator table.

    With ``reset`` both tables are emptied first (I-9), so that only landed dates remain.
    """
    if reset:
        sink.reset_all(spark, bars_path, indicators_path)
    bars = load_days(spark, payload_path, bars_path, fmt)
    return sink.replace_table(bulk_indicators(bars), indicators_path, source=bars, by_ticker=written_by_ticker(bars))
