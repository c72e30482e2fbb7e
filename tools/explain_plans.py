"""Print the physical-plan facts of the headline jobs (exchanges, sorts, windows, scans).

Usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import re
import sys
import tempfile

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from tickframe.operators import screens as S  # noqa: E402
from tickframe.plans import jobs  # noqa: E402
from tickframe.schemas import INDICATORS  # noqa: E402
from tickframe.session import build_session  # noqa: E402
from tickframe.sources import fixtures, ingest, sink  # noqa: E402


def facts(name: str, df) -> None:
    plan = df._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange (\w+(?:\([^)]*\))?)", plan)
    scans = re.findall(r"(PartitionFilters: \[[^\]]*\]|PushedFilters: \[[^\]]*\]|ReadSchema: struct<[^>]*>)", plan)
    print(f"== {name}")
    print(f"   Exchange: {len(exchanges)} {sorted(set(e[:60] for e in exchanges))}")
    print(f"   Sort: {plan.count('Sort [')}  Window: {plan.count('Window [')}  "
          f"BroadcastHashJoin: {plan.count('BroadcastHashJoin')}  SortMergeJoin: {plan.count('SortMergeJoin')}")
    for s in sorted(set(scans)):
        print(f"   {s[:200]}")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    work = tempfile.mkdtemp(prefix="tickframe-explain-")
    sink.replace_table(fixtures.bars_from_lineitem(spark, sf), f"{work}/bars")
    bars = ingest.read_bars(spark, f"{work}/bars")
    sink.replace_table(jobs.bulk_indicators(bars), f"{work}/ind", source=bars)
    ind = sink.stored_table(spark, f"{work}/ind", INDICATORS)
    inst = fixtures.instruments_from_supplier(spark, sf)
    day = bars.select(F.max("market_date")).scalar()
    facts("Q-9 bulk build", jobs.bulk_indicators(bars))
    facts("Q-10 daily build", jobs.daily_indicators(bars, ind, day))
    facts("Q-11 payload clean", ingest.clean_payload(fixtures.payload_from_lineitem(spark, sf)))
    facts("Q-1 attention score (latest)", S.attention_score(ind))
    facts("Q-1 attention score (all dates)", S.attention_score(ind, as_of="all"))
    facts("Q-2 enhanced attention", S.enhanced_attention_score(ind, inst))
    facts("Q-7 sector heatmap", S.sector_heatmap(ind, inst))
    facts("Q-8 zero-line crossover", S.zero_line_crossover(ind))


if __name__ == "__main__":
    main()
