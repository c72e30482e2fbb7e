"""Data checks on the bar and indicator tables (all distributed aggregates)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sink import duplicate_keys

# Value ranges that hold for every row of the indicator table.
BOUNDED_0_100 = ["rsi_14", "rsi_5", "rsi_21", "adx_14", "plus_di", "minus_di"]
TOLERANCE = 1e-4


def invariant_violations(ind: DataFrame) -> DataFrame:
    """Rows breaking an invariant of the indicator maths, with the rule they break."""
    tol = F.lit(TOLERANCE)
    rules = {
        "bands_ordered": (F.col("bb_lower") <= F.col("bb_mid") + tol) & (F.col("bb_mid") <= F.col("bb_upper") + tol),
        "keltner_ordered": (F.col("kc_lower") <= F.col("kc_mid") + tol) & (F.col("kc_mid") <= F.col("kc_upper") + tol),
        **{f"{c}_in_range": F.col(c).between(-TOLERANCE, 100 + TOLERANCE) for c in BOUNDED_0_100},
        **{f"{c}_in_range": F.col(c).between(-TOLERANCE, 1 + TOLERANCE)
           for c in ind.columns if "_r2_" in c},
        "atr_non_negative": F.col("atr_14") >= 0,
    }
    # all rules in the generator itself: a filter on them would be moved below the formulas, with a copy of these for each rule
    broken = F.array_compact(F.array(*[F.when(~cond, F.lit(name)) for name, cond in rules.items()]))
    return ind.select("ticker", "market_date", F.explode(broken).alias("rule"))


def key_check(df: DataFrame) -> DataFrame:
    """I-8 as a query: (ticker, market_date) keys seen more than once."""
    return duplicate_keys(df)
