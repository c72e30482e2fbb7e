"""Landed daily payloads to clean bars, bar-table scans and the business-day spine.

The grouped-daily feed is re-aimed as landed files: one folder per delivery
date (``market_date=YYYY-MM-DD``) holding one object per instrument.  All
days are cleaned in one job; nothing loops over days on the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates
from ..functions.numeric import finite_or_null
from ..schemas import BAR_INPUT, BARS, PAYLOAD
from . import sink

DOUBLE_FIELDS = [f.name for f in PAYLOAD.fields if isinstance(f.dataType, T.DoubleType)]
# Preference order among duplicate objects of one (market_date, ticker):
# highest volume first, then the other fields so that the pick is deterministic.
DEDUP_ORDER = ["volume", "transactions", "vwap", "close", "open", "high", "low", "timestamp"]


def read_payload(spark: SparkSession, path: str, fmt: str = "json", day: dt.date | str | None = None) -> DataFrame:
    """I-1: landed payload objects with an explicit schema (no inference).

    With ``day`` only the folder of that date is read (a partition filter).
    """
    schema = T.StructType(PAYLOAD.fields + [T.StructField("market_date", T.DateType())])
    payload = spark.read.schema(schema).format(fmt).load(path)
    return payload if day is None else payload.where(F.col("market_date") == F.lit(day).cast("date"))


def clean_payload(payload: DataFrame) -> DataFrame:
    """I-2, I-3: one bar per (market_date, ticker) from raw objects.

    Objects without a ticker are dropped; NaN and infinities become NULL; among duplicates
    the highest volume wins (NULL volume last, then the remaining fields).
    The pick is an aggregate, not a window, so it is combined map-side:
    a ticker repeated many times on a day is reduced in each input partition
    before the shuffle and never gathered into one task.
    """
    clean = payload.where(F.col("ticker").isNotNull()).select(
        "market_date", "ticker",
        *[finite_or_null(c).alias(c) if c in DOUBLE_FIELDS else F.col(c) for c in PAYLOAD.fieldNames()
          if c != "ticker"])
    # max_by over a struct: a present value beats NULL, then the larger value.
    key = F.struct(*[x for c in DEDUP_ORDER for x in (F.col(c).isNotNull(), F.col(c))])
    row = F.struct(*[c for c in PAYLOAD.fieldNames() if c != "ticker"])
    best = clean.groupBy("market_date", "ticker").agg(F.max_by(row, key).alias("r"))
    ts = F.col("r.timestamp")
    return best.select(
        F.col("ticker"), F.col("market_date"),
        *[F.col(f"r.{c}").alias(c) for c in ["open", "high", "low", "close", "volume", "vwap"]],
        ts.alias("timestamp"), F.col("r.transactions").alias("transactions"),
        F.timestamp_millis(ts).cast("timestamp_ntz").alias("datetime"),
    )


def read_bars(spark: SparkSession, path: str, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """The stored bar table; with bounds only the folders of those dates are listed."""
    table = sink.stored_table(spark, path, BARS, since, until)
    if table is None:
        raise FileNotFoundError(f"no bar table at {path}")
    return table


def scan_bars(bars: DataFrame, end: dt.date | Column | None = None, lookback_days: int | None = None) -> DataFrame:
    """I-10 / I-11: the seven indicator inputs, optionally ``end - lookback <= date <= end``.

    On a stored table both bounds prune folders (``functions.dates``).
    """
    if end is None:
        return bars.select(*BAR_INPUT)
    end_c = end if isinstance(end, Column) else F.lit(end)
    cond = dates.not_after(bars, end_c)
    if lookback_days is not None:
        cond = cond & dates.since(bars, F.date_sub(end_c, lookback_days))
    return bars.where(cond).select(*BAR_INPUT)


def business_days(spark: SparkSession, start: Column, end: Column) -> DataFrame:
    """I-12: Monday-to-Friday dates from ``start`` to ``end`` (no holiday calendar).

    ``start`` and ``end`` are scalar columns (e.g. scalar subqueries); the
    spine holds one row per calendar day of the range.
    """
    one = spark.range(1).select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias("market_date"))
    return one.where(~F.dayofweek("market_date").isin(1, 7))


def missing_business_days(spark: SparkSession, bars: DataFrame, start: Column | None = None,
                          end: Column | None = None) -> DataFrame:
    """Business days in range without any bar (holidays show here as well)."""
    dates = bars.select("market_date").distinct()
    start = start if start is not None else bars.select(F.min("market_date")).scalar()
    end = end if end is not None else bars.select(F.max("market_date")).scalar()
    return business_days(spark, start, end).join(dates, "market_date", "left_anti")
