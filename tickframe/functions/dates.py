"""Conditions on the market date that also prune the folders of a table stored by month.

A frame read from such a table has the folder's month beside the date; each
condition then says the same of both, so that Spark reads the folders of those
months only.  On any other frame it is the condition on the date alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE, MONTH = "market_date", "market_month"


def _both(df: DataFrame, on_date: Column, on_month: Column) -> Column:
    return on_date & on_month if MONTH in df.columns else on_date


def is_day(df: DataFrame, day: Column) -> Column:
    return _both(df, F.col(DATE) == day, F.col(MONTH) == F.trunc(day, "month"))


def not_after(df: DataFrame, day: Column) -> Column:
    return _both(df, F.col(DATE) <= day, F.col(MONTH) <= F.trunc(day, "month"))


def before(df: DataFrame, day: Column) -> Column:
    return _both(df, F.col(DATE) < day, F.col(MONTH) <= F.trunc(day, "month"))


def since(df: DataFrame, day: Column) -> Column:
    return _both(df, F.col(DATE) >= day, F.col(MONTH) >= F.trunc(day, "month"))
