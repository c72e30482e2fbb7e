"""Command line for the batch modes: backfill, recalculate, daily.

    python -m tickframe backfill    --landing L --bars B --indicators I [--format json] [--reset] [--days 730]
    python -m tickframe recalculate --bars B --indicators I
    python -m tickframe daily       --landing L --bars B --indicators I [--date YYYY-MM-DD] [--lookback 400]

``backfill`` cleans every landed date in one job, replaces those dates in
the bar table, rebuilds the indicator table and counts the business days of
the last ``--days`` calendar days, up to ``--date`` (default: today), that
have no bars; with ``--reset`` both tables are emptied first.
``recalculate`` rebuilds the indicator table from the stored bars.
``daily`` loads the landing folder of one date (default: the latest one),
then rebuilds that date from ``--lookback`` days of history with the OBV
anchor.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans import jobs
from .session import configure
from .sources import ingest, sink


BACKFILL_DAYS = 730  # fixed value: calendar days that a backfill is expected to cover


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tickframe")
    p.add_argument("mode", choices=["backfill", "recalculate", "daily"])
    p.add_argument("--landing")
    p.add_argument("--bars", required=True)
    p.add_argument("--indicators", required=True)
    p.add_argument("--format", default="json")
    p.add_argument("--date", type=dt.date.fromisoformat)
    p.add_argument("--days", type=int, default=BACKFILL_DAYS)
    p.add_argument("--reset", action="store_true")
    p.add_argument("--lookback", type=int, default=jobs.DAILY_LOOKBACK_DAYS)
    a = p.parse_args(argv)
    spark = configure(SparkSession.builder.getOrCreate())

    if a.mode == "backfill":
        if not jobs.backfill(spark, a.landing, a.bars, a.indicators, a.format, a.reset):
            print("no bars: indicator table left unchanged")
        end = a.date or dt.date.today()
        gaps = ingest.missing_business_days(spark, ingest.read_bars(spark, a.bars),
                                            F.lit(end - dt.timedelta(days=a.days)), F.lit(end))
        print(f"business days without bars: {gaps.count()}")
    elif a.mode == "recalculate":
        bars = ingest.read_bars(spark, a.bars)
        if not sink.replace_table(jobs.bulk_indicators(bars), a.indicators, source=bars, by_ticker=jobs.written_by_ticker(bars)):
            print("no bars: indicator table left unchanged")
    else:
        day = a.date or sink.latest_date(spark, a.landing or a.bars)
        if day is None:
            print("no bars: nothing to refresh")
            return 0
        if a.landing:
            jobs.load_days(spark, a.landing, a.bars, a.format, day)
        jobs.refresh_day(spark, a.bars, a.indicators, day, a.lookback)
        print(f"refreshed {day}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
