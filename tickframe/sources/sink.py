"""Writers of the bar and indicator tables, and the latest date of a table.

Both tables are stored by ``versions.py``: a write goes beside the folders in
use and takes effect in one step, so a failed job leaves the old table (or day)
in place.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import KEY
from ..session import shuffles_released
from . import files, versions


def replace_days(df: DataFrame, path: str, schema: T.StructType | None = None) -> list[dt.date]:
    """I-4 / I-6: replace exactly the dates present in ``df`` (no rows: nothing changes); returns them."""
    return versions.merge_days(df, path, schema or df.schema)


def add_missing(df: DataFrame, path: str, schema: T.StructType | None = None) -> list[dt.date]:
    """A load that skips what is there: only rows whose (ticker, date) the table lacks are added."""
    return versions.merge_days(df, path, schema or df.schema, keep_existing=True)


def replace_table(df: DataFrame, path: str, source: DataFrame | None = None, grain: str = "month", by_ticker: bool = False) -> bool:
    """I-5: full refresh; skipped when there is nothing to write (I-13).

    With ``source`` (the job input) the emptiness check reads the input's
    first row instead of running the job's plan a second time.  ``by_ticker``:
    the wide rows of a bulk build, written by the tasks that compute them.
    """
    with shuffles_released(df.sparkSession):
        if (source if source is not None else df).isEmpty():
            return False
    versions.publish(df, path, grain, by_ticker)
    return True


def latest_date(spark: SparkSession, path: str) -> dt.date | None:
    """A-1: the last date of a stored table, from its record: neither a listing nor a file of the data.

    A folder without a record (landed payload by ``market_date=``) has its own listed, and from the newest date down those
    of dates until one isn't empty.  None without a table or without a date that has files.
    """
    found = versions.record(spark, path)
    if found is not None:
        return found.latest
    for name in sorted(files.child_names(spark, path), reverse=True):
        day = re.fullmatch(r"market_date=(\d{4}-\d\d-\d\d)", name)
        if day and any(not n.startswith(("_", ".")) for n in files.child_names(spark, f"{path}/{name}")):
            return dt.date.fromisoformat(day[1])
    return None


def stored_table(spark: SparkSession, path: str, schema: T.StructType, since: dt.date | None = None,
                 until: dt.date | None = None) -> DataFrame | None:
    """The table at ``path`` (see ``versions.read``) or plain Parquet files there, None if there is neither.

    Any other failure to read it is an error.
    """
    table = versions.read(spark, path, schema, since, until)
    if table is not None:
        return table
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def reset_all(spark: SparkSession, bars_path: str, indicators_path: str) -> None:
    """I-9: both tables empty, as before a backfill that shall keep nothing (explicit opt-in only)."""
    versions.empty(spark, bars_path)
    versions.empty(spark, indicators_path)


def duplicate_keys(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """I-8: keys that occur more than once (partial counts combined map-side)."""
    key = key or KEY
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def assert_unique(df: DataFrame, key: list[str] | None = None) -> None:
    """Fail the job on a duplicate key instead of swallowing it."""
    dup = duplicate_keys(df, key).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key in {key or KEY}: {dup[0].asDict()}")
