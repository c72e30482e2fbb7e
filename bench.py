"""Benchmark: headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line.  Setup (not timed): the bar table is derived from
``lineitem`` and written as Parquet partitioned by date, as the ingest job
stores it.  Timed, median of ``$BENCH_RUNS`` warm runs each:

* q9_bulk_build     read bars -> 96 indicator columns -> write the date-partitioned table
* q9_bulk_compute   the same plan into a no-op sink
* q10_daily_build   400-day slice -> one date, OBV anchored to the stored table
* q10_daily_from_carry  one date of bars and the stored state of each ticker -> that date and the next state
* q11_payload_clean every raw line object -> one clean bar per (date, ticker)
* q1..q8            the screens over the stored indicator table
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tickframe.operators import screens as S  # noqa: E402
from tickframe.plans import carry, jobs  # noqa: E402
from tickframe.schemas import BARS, INDICATORS  # noqa: E402
from tickframe.session import build_session  # noqa: E402
from tickframe.sources import fixtures, ingest, sink  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session()
    work = tempfile.mkdtemp(prefix="tickframe-bench-")
    bars_path, ind_path = f"{work}/bars", f"{work}/indicators"

    sink.replace_table(fixtures.bars_from_lineitem(spark, sf_dir), bars_path)
    bars = ingest.read_bars(spark, bars_path)
    inst = fixtures.instruments_from_supplier(spark, sf_dir).cache()
    inst.count()

    def timed(fn) -> float:
        out = []
        for _ in range(runs + 1):  # first run warms the JVM and the file cache
            t = time.perf_counter()
            fn()
            out.append(time.perf_counter() - t)
        return statistics.median(out[1:])

    def noop(df) -> None:
        df.write.mode("overwrite").format("noop").save()

    results = {}
    results["q9_bulk_build"] = timed(lambda: sink.replace_table(jobs.bulk_indicators(bars), ind_path, source=bars))
    results["q9_bulk_compute"] = timed(lambda: noop(jobs.bulk_indicators(bars)))
    ind = sink.stored_table(spark, ind_path, INDICATORS)
    last = sink.latest_date(spark, bars_path)  # the daily job's date parameter
    results["q10_daily_build"] = timed(lambda: noop(jobs.daily_indicators(bars, ind, last)))
    state = carry.save(carry.carry_of(bars.where(F.col("market_date") < F.lit(last))), f"{work}/carry", last - dt.timedelta(days=1))
    today = ingest.read_bars(spark, bars_path, last, last).where(F.col("market_date") == F.lit(last))
    results["q10_daily_from_carry"] = timed(lambda: [noop(df) for df in carry.next_day(state, today)])
    payload = fixtures.payload_from_lineitem(spark, sf_dir)
    results["q11_payload_clean"] = timed(lambda: noop(ingest.clean_payload(payload)))

    def latest(screen, path, schema, *more, days: int = 0):
        """The screen on the table's latest date, read from the record and the folders that the screen needs."""
        day = sink.latest_date(spark, path)
        return screen(sink.stored_table(spark, path, schema, day - dt.timedelta(days=days), day), *more, day)

    screens = {
        "q1_attention_score": lambda: latest(S.attention_score, ind_path, INDICATORS),
        "q2_attention_enhanced": lambda: latest(S.enhanced_attention_score, ind_path, INDICATORS, inst),
        "q3_coiled_spring": lambda: latest(S.coiled_spring, ind_path, INDICATORS),
        "q4_stealth_watchlist": lambda: latest(S.stealth_watchlist, ind_path, INDICATORS, inst),
        "q5_instrument_details": lambda: latest(S.instrument_details, bars_path, BARS, inst),
        "q6_high_rvol_high_atr": lambda: latest(S.high_rvol_high_atr, ind_path, INDICATORS),
        "q7_sector_heatmap": lambda: latest(S.sector_heatmap, ind_path, INDICATORS, inst),
        "q8_zero_line_crossover": lambda: latest(S.zero_line_crossover, ind_path, INDICATORS, days=S.CROSSOVER_LOOKBACK_DAYS),
        "q1_all_dates": lambda: S.attention_score(ind, as_of="all"),
        "q8_all_dates": lambda: S.zero_line_crossover(ind, as_of="all"),
    }
    for name, make in screens.items():
        results[name] = timed(lambda make=make: make().collect())

    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in results.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "rows": {"bars": bars.count()},
        "cpus": int(os.environ.get("BENCH_CPUS", "8")),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
