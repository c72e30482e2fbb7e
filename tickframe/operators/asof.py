"""As-of join: for each row, the last row of another table before its date, for all dates in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_before(left: DataFrame, right: DataFrame, values: dict[str, str], key: str = "ticker",
                  date: str = "market_date", same_date: bool = False) -> DataFrame:
    """Rows of ``left`` with ``values`` (column of ``right`` -> new name) of the last row of ``right`` of the same key before.

    J-4 for many dates at once: both sides are put under each other, sorted by (key, date) once, and a running last
    non-null value carries each row of ``right`` to the rows of ``left`` behind it: one exchange, one sort, no range join.
    A row of ``right`` of the same date doesn't count unless ``same_date``.  Rows without an earlier one get nulls; a value
    that is null in the last earlier row stays null.  Rows of one key and date of ``right`` should be one; of several, the
    last in the order of the values counts.  A window holds the rows of one key, which its history bounds.
    """
    found = F.struct(*[F.col(c).alias(v) for c, v in values.items()])
    kinds = {f.name: f.dataType for f in left.schema.fields}
    later = [F.lit(None).cast(kinds[c]).alias(c) if c not in (key, date) else F.col(c) for c in left.columns]
    none = right.select(found.alias("_found")).schema["_found"].dataType
    asked = left.select("*", F.lit(None).cast(none).alias("_found"), F.lit(1 if same_date else 0).alias("_side"))
    known = right.select(*later, found.alias("_found"), F.lit(0 if same_date else 1).alias("_side"))
    w = Window.partitionBy(key).orderBy(date, "_side", "_found").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = asked.unionByName(known).withColumn("_last", F.last("_found", ignorenulls=True).over(w))
    return both.where(F.col("_side") == (1 if same_date else 0)).select(*left.columns, *[F.col(f"_last.{v}").alias(v) for v in values.values()])
