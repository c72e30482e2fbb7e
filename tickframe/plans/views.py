"""Temporary views under the names that SQL screens use, and the eight screens as Spark SQL.

SQL written for PostgreSQL runs over the views with two changes, as in
``tickframe/sql``: ``NUMERIC`` without a precision is ``DECIMAL(10,0)`` in
Spark, so rounding needs ``DECIMAL(38,12)``; and a descending sort puts NULL
last unless it says ``NULLS FIRST``.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SQL_FOLDER = Path(__file__).resolve().parent.parent / "sql"
VIEW_NAMES = {"bars": "daily_market_data", "indicators": "daily_indicators", "instruments": "financedatabase"}


def register_views(spark: SparkSession, bars: DataFrame, indicators: DataFrame,
                   instruments: DataFrame | None = None) -> None:
    bars.createOrReplaceTempView(VIEW_NAMES["bars"])
    indicators.createOrReplaceTempView(VIEW_NAMES["indicators"])
    if instruments is not None:
        instruments.createOrReplaceTempView(VIEW_NAMES["instruments"])


def screen_sql(name: str) -> str:
    """Text of a screen in ``tickframe/sql`` (without ``.sql``)."""
    return (SQL_FOLDER / f"{name}.sql").read_text()


def run_screen(spark: SparkSession, name: str) -> DataFrame:
    """A screen of ``tickframe/sql`` over the registered views."""
    return spark.sql(screen_sql(name))
