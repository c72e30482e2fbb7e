"""Partitioning and order shared by every indicator stage.

All stages partition by ``ticker`` and order by ``(era, market_date)``.  An
era is a fixed stretch of calendar days, a function of the date alone, so the
order is the order of dates, and windows of one era of a ticker (``ewm.py``)
need the same sort as windows of the whole ticker: Spark sorts each ticker's
rows once and every later ``Window`` operator reuses that order, without
another shuffle or sort.  Frames are counted in rows, not calendar days.

Size bound: ``(ticker, market_date)`` is a key, so one window partition
holds at most one row per calendar day of history (about 252 trading rows a
year).  Data volume grows with the number of instruments and days; a single
partition never grows with the table.
"""

from __future__ import annotations

PARTITION = "ticker"
ERA = "era"
ORDER = f"{ERA}, market_date"
#: Days of an era: (2/3)^1400, the decay of the fastest weight over an era, is far inside the range of a double.
ERA_DAYS = 1400


def era_sql(date: str = "market_date") -> str:
    return f"CAST(floor(unix_date({date}) / {ERA_DAYS}) AS INT)"
