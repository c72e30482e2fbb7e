"""Map the driver's TPC-H-style tables onto the bar and instrument schemas.

* bars: one bar per (supplier, ship date) from ``lineitem``, and one per
  (return flag, ship date), whose tickers no supplier has; price is
  ``l_extendedprice / l_quantity``; open/close are the prices of the first/last
  line in (orderkey, linenumber, partkey, extendedprice) order.
* instruments: every supplier with nation (country, industry) and region
  (sector); of ten suppliers one has no name and one no sector.
* payload: one raw object per ``lineitem`` row, as a grouped-daily feed would
  deliver it, with repeated tickers per day and missing tickers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import safe_div


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


LINES_PER_TASK = 500_000  # lines of a task that combines them into bars: it sorts them, so its memory follows their number


def _price() -> F.Column:
    return safe_div(F.col("l_extendedprice"), F.col("l_quantity"))


def bars_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV bars keyed by (ticker, market_date); a map-side combined aggregate.

    File splits are bounded by bytes, not lines: where cores would get more than ``LINES_PER_TASK`` lines each, the lines
    are dealt out to more tasks first (their number is in the files' footers).
    """
    li = table(spark, sf_dir, "lineitem")
    lines, cores = li.count(), spark.sparkContext.defaultParallelism
    li = li.select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
                   "l_quantity", "l_extendedprice", "l_returnflag")
    if lines > cores * LINES_PER_TASK:
        li = li.repartition(-(-lines // LINES_PER_TASK), "l_orderkey", "l_linenumber")
    seq = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    bars = (
        li.where(F.col("l_suppkey").isNotNull() & F.col("l_shipdate").isNotNull())
        .withColumn("price", _price())
        .withColumn("ticker", F.explode(F.array(F.col("l_suppkey").cast("string"), F.col("l_returnflag"))))
        .groupBy("ticker", F.col("l_shipdate").cast("date").alias("market_date"))
        .agg(
            F.min_by("price", seq).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", seq).alias("close"),
            F.sum("l_quantity").alias("volume"),
            # cent amounts summed exactly, so the ratio does not depend on summation order
            safe_div(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double"),
                     F.sum("l_quantity")).alias("vwap"),
            F.count(F.lit(1)).cast("double").alias("transactions"),
        )
    )
    ts = F.unix_millis(F.col("market_date").cast("timestamp"))
    return bars.select(
        "ticker", "market_date", "open", "high", "low", "close", "volume", "vwap",
        ts.alias("timestamp"), "transactions",
        F.timestamp_millis(ts).cast("timestamp_ntz").alias("datetime"),
    )


def instruments_from_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instrument dimension: a small table (one row per supplier) joined once."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    joined = (
        s.join(n, s.s_nationkey == n.n_nationkey, "left")
        .join(r, n.n_regionkey == r.r_regionkey, "left")
    )
    return joined.select(
        F.col("s_suppkey").cast("string").alias("ticker"),
        F.when(F.col("s_suppkey") % 10 != 3, F.col("s_name")).alias("name"),
        F.lit("Equity").alias("asset_class"),
        F.when(F.col("s_suppkey") % 10 != 7, F.col("r_name")).alias("sector"),
        F.col("n_name").alias("industry_group"),
        F.col("n_name").alias("industry"),
        F.concat(F.lit("X"), F.col("n_regionkey").cast("string")).alias("exchange"),
        F.col("r_name").alias("market"),
        F.col("n_name").alias("country"),
        F.lit("USD").alias("currency"),
        F.when(F.col("s_acctbal") >= 5000, "Large Cap").otherwise("Small Cap").alias("market_cap"),
        F.concat_ws(" ", F.col("s_name"), F.lit("in"), F.col("n_name")).alias("summary"),
    )


def payload_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw per-line objects with their delivery date; the first line of an order has no ticker."""
    li = table(spark, sf_dir, "lineitem")
    ts = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    return li.select(
        F.col("l_shipdate").cast("date").alias("market_date"),
        F.when(F.col("l_linenumber") != 1, F.col("l_suppkey").cast("string")).alias("ticker"),
        _price().alias("open"),
        _price().alias("high"),
        _price().alias("low"),
        _price().alias("close"),
        F.col("l_quantity").alias("volume"),
        _price().alias("vwap"),
        ts.alias("timestamp"),
        F.lit(1.0).alias("transactions"),
    )
