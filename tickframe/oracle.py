"""DuckDB SQL that recomputes every registered query from the raw tables.

This is the independent check of the Spark jobs: plain window SQL for the
row-window indicators and a recursive CTE that folds each ticker's rows one
by one for the exponentially weighted means (the sequential definition,
against which the Spark prefix scan is compared).  Trends are sums written
out, not SQL's regression aggregates: slopes of rounded values lie on ties of
the 4-digit rounding, which only the same sums decide alike.  Periods, weights and column names are written out here
and not taken from the operators.  Tables ``lineitem``,
``supplier``, ``nation`` and ``region`` are DuckDB views.
"""

from __future__ import annotations

from typing import NamedTuple

# Output columns in order, as text.
INDICATOR_COLUMNS = """
ticker market_date close prev_close gap_pct price_change_dod_pct price_change_wow_pct price_change_mom_pct
open_to_close_pct atr_14 atr_14_pct atr_5 atr_21 atr_5_21_dist_pct sma_50 sma_50_dist_pct sma_200 sma_200_dist_pct
ema_9 ema_21 ema_9_21_dist_pct macd macd_signal macd_hist bb_mid bb_upper bb_lower kc_mid kc_upper kc_lower
rsi_14 rsi_5 rsi_21 rsi_5_21_diff adx_14 plus_di minus_di obv vol_ema_5 vol_sma_10 vol_ema_21 vol_sma_60
vol_5_21_dist_pct rvol_ema_5 rvol_sma_10 rvol_ema_21 rvol_sma_60 rvol_ema_5_dod_diff volume_dod_pct volume_wow_pct
volume_mom_pct rsi_14_dod_diff macd_hist_dod_diff atr_14_dod_pct volume_dod_sma_3 rsi_velocity_3d
""".split() + [f"{m}_{kind}_{n}d" for m in ("close", "rsi_14", "obv", "macd_hist", "atr_14")
               for n in (3, 5, 10, 21) for kind in ("slope", "r2")]
TREND_METRICS = ["close", "rsi_14", "obv", "macd_hist", "atr_14"]


class Fold(NamedTuple):
    """An exponentially weighted mean: new weight ``alpha``, first value after ``min_periods`` observations."""

    name: str
    source: str
    alpha: float
    min_periods: int = 0


def spans(name: str, source: str, span: int) -> Fold:
    return Fold(name, source, 1.0 / (1.0 + (span - 1) / 2.0))


def periods(name: str, source: str, n: int) -> Fold:
    # 1 / n by way of the centre of mass, for the same double as the definition
    return Fold(name, source, 1.0 / (1.0 + (1.0 / (1.0 / n) - 1.0)), n)


def lit(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def rnd(expr: str, d: int) -> str:
    s = lit(10.0 ** d)
    return f"(round_even(({expr}) * {s}, 0) / {s} + {lit(0.0)})"


def div(a: str, b: str) -> str:
    return f"(({a}) / NULLIF(({b}), 0))"


def pct(cur: str, base: str) -> str:
    return f"({div(f'({cur}) - ({base})', base)} * {lit(100.0)})"


def dec_round(expr: str, d: int) -> str:
    return f"CAST(round(CAST(({expr}) AS DECIMAL(38,12)), {d}) AS DOUBLE)"


W = "OVER (PARTITION BY ticker ORDER BY market_date"


def over(rows: int | None = None) -> str:
    if rows is None:
        return W + ")"
    return W + f" ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


def lag(c: str, n: int = 1) -> str:
    return f"lag({c}, {n}) {over()}"


def roll(fn: str, c: str, n: int, need: int | None = None, op: str = ">=") -> str:
    need = n if need is None else need
    return f"CASE WHEN count({c}) {over(n)} {op} {need} THEN {fn}({c}) {over(n)} END"


# --------------------------------------------------------------------------- bars
BARS_SQL = """
SELECT ticker, market_date, open, high, low, close, volume, vwap,
       epoch_ms(CAST(market_date AS TIMESTAMP)) AS "timestamp", transactions,
       CAST(market_date AS TIMESTAMP) AS datetime
FROM (
  SELECT unnested AS ticker, CAST(l_shipdate AS DATE) AS market_date,
         arg_min(l_extendedprice / NULLIF(l_quantity, 0),
                 struct_pack(a := l_orderkey, b := l_linenumber, c := l_partkey, d := l_extendedprice)) AS open,
         max(l_extendedprice / NULLIF(l_quantity, 0)) AS high,
         min(l_extendedprice / NULLIF(l_quantity, 0)) AS low,
         arg_max(l_extendedprice / NULLIF(l_quantity, 0),
                 struct_pack(a := l_orderkey, b := l_linenumber, c := l_partkey, d := l_extendedprice)) AS close,
         sum(l_quantity) AS volume,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / NULLIF(sum(l_quantity), 0) AS vwap,
         CAST(count(*) AS DOUBLE) AS transactions
  FROM (SELECT *, CAST(l_suppkey AS VARCHAR) AS unnested FROM lineitem UNION ALL SELECT *, l_returnflag FROM lineitem) li
  WHERE l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL
  GROUP BY 1, 2
) g
"""

INSTRUMENTS_SQL = """
SELECT CAST(s.s_suppkey AS VARCHAR) AS ticker, CASE WHEN s.s_suppkey % 10 <> 3 THEN s.s_name END AS name,
       'Equity' AS asset_class, CASE WHEN s.s_suppkey % 10 <> 7 THEN r.r_name END AS sector, n.n_name AS industry_group, n.n_name AS industry,
       'X' || CAST(n.n_regionkey AS VARCHAR) AS exchange, r.r_name AS market, n.n_name AS country,
       'USD' AS currency, CASE WHEN s.s_acctbal >= 5000 THEN 'Large Cap' ELSE 'Small Cap' END AS market_cap,
       concat_ws(' ', s.s_name, 'in', n.n_name) AS summary
FROM supplier s
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""

PAYLOAD_SQL = """
SELECT CAST(l_shipdate AS DATE) AS market_date,
       CASE WHEN l_linenumber <> 1 THEN CAST(l_suppkey AS VARCHAR) END AS ticker,
       l_extendedprice / NULLIF(l_quantity, 0) AS open,
       l_extendedprice / NULLIF(l_quantity, 0) AS high,
       l_extendedprice / NULLIF(l_quantity, 0) AS low,
       l_extendedprice / NULLIF(l_quantity, 0) AS close,
       l_quantity AS volume,
       l_extendedprice / NULLIF(l_quantity, 0) AS vwap,
       epoch_ms(CAST(l_shipdate AS TIMESTAMP)) AS "timestamp",
       CAST(1.0 AS DOUBLE) AS transactions
FROM lineitem
"""


# --------------------------------------------------------------------------- EWM fold
def _ewm_fold(cte: str, source: str, specs: list[Fold], carry: list[str]) -> str:
    """Recursive CTE stepping each ticker's rows in order, one state triple per series."""
    anchor, step = [], []
    for s in specs:
        c_src, c_cur = f"b.{s.source}", f"s.{s.source}"
        anchor += [f"{c_src} AS w_{s.name}", f"{lit(1.0)} AS o_{s.name}",
                   f"CAST({c_src} IS NOT NULL AS INTEGER) AS n_{s.name}"]
        w, o, f, a = f"r.w_{s.name}", f"r.o_{s.name}", lit(1.0 - s.alpha), lit(s.alpha)
        step += [
            f"CASE WHEN {w} IS NULL THEN {c_cur} WHEN {c_cur} IS NULL THEN {w} "
            f"WHEN {w} = {c_cur} THEN {w} "
            f"ELSE (({o} * {f}) * {w} + {a} * {c_cur}) / (({o} * {f}) + {a}) END AS w_{s.name}",
            f"CASE WHEN {w} IS NULL THEN {o} WHEN {c_cur} IS NULL THEN {o} * {f} ELSE {lit(1.0)} END AS o_{s.name}",
            f"{f'r.n_{s.name}'} + CAST({c_cur} IS NOT NULL AS INTEGER) AS n_{s.name}",
        ]
    keys = ", ".join(["ticker", "rn", "market_date"] + carry)
    b_keys = ", ".join(f"b.{k}" for k in ["ticker", "rn", "market_date"] + carry)
    s_keys = ", ".join(f"s.{k}" for k in ["ticker", "rn", "market_date"] + carry)
    return f"""{cte} AS (
  SELECT {b_keys}, {', '.join(anchor)} FROM {source} b WHERE b.rn = 0
  UNION ALL
  SELECT {s_keys}, {', '.join(step)}
  FROM {cte} r JOIN {source} s ON s.ticker = r.ticker AND s.rn = r.rn + 1
)"""


def _ewm_out(s: Fold) -> str:
    return f"CASE WHEN n_{s.name} >= {max(s.min_periods, 1)} THEN w_{s.name} END"


FIRST_FOLDS = [
    spans("ema_9", "close", 9), spans("ema_21", "close", 21), spans("ema_12", "close", 12), spans("ema_26", "close", 26),
    spans("kc_mid", "close", 20),
    periods("atr14", "true_range", 14), periods("atr5", "true_range", 5), periods("atr21", "true_range", 21),
    periods("atr10", "true_range", 10),
    spans("vol_ema_5", "volume", 5), spans("vol_ema_21", "volume", 21),
    periods("gain14", "up_move", 14), periods("gain5", "up_move", 5), periods("gain21", "up_move", 21),
    periods("loss14", "down_move", 14), periods("loss5", "down_move", 5), periods("loss21", "down_move", 21),
    periods("pdm", "plus_dm", 14), periods("mdm", "minus_dm", 14),
]
SECOND_FOLDS = [spans("macd_signal", "macd", 9), periods("adx", "dx", 14)]


def indicator_ctes(bars: str = "bars", prefix: str = "") -> list[str]:
    """CTEs ending in ``{prefix}ind`` (all 96 columns, every bar) over the bar CTE ``bars``."""
    p = prefix
    first, second = FIRST_FOLDS, SECOND_FOLDS
    s0 = f"""{p}s0 AS (
  SELECT ticker, market_date, open, high, low, close, volume,
         CAST(row_number() {over()} - 1 AS INTEGER) AS rn,
         {lag('close')} AS prev_close, {lag('high')} AS prev_high, {lag('low')} AS prev_low,
         {lag('close', 5)} AS close_l5, {lag('close', 21)} AS close_l21,
         {lag('volume')} AS vol_l1, {lag('volume', 5)} AS vol_l5, {lag('volume', 21)} AS vol_l21,
         {roll('avg', 'close', 50)} AS sma_50_raw, {roll('avg', 'close', 200)} AS sma_200_raw,
         {roll('avg', 'close', 20)} AS sma_20, {roll('stddev_samp', 'close', 20)} AS std_20,
         {roll('avg', 'volume', 10)} AS vol_sma_10_raw, {roll('avg', 'volume', 60)} AS vol_sma_60_raw
  FROM {bars}
)"""
    delta = "(close - prev_close)"
    um, dm = "(high - prev_high)", "(prev_low - low)"
    s1 = f"""{p}s1 AS (
  SELECT ticker, market_date, rn, open, high, low, close, volume, prev_close,
         {rnd(pct('open', 'prev_close'), 4)} AS gap_pct,
         {rnd(pct('close', 'prev_close'), 4)} AS price_change_dod_pct,
         {rnd(pct('close', 'close_l5'), 4)} AS price_change_wow_pct,
         {rnd(pct('close', 'close_l21'), 4)} AS price_change_mom_pct,
         {rnd(pct('close', 'open'), 4)} AS open_to_close_pct,
         greatest(high - low, abs(high - prev_close), abs(low - prev_close)) AS true_range,
         {rnd('sma_50_raw', 4)} AS sma_50,
         {rnd(pct('close', rnd('sma_50_raw', 4)), 2)} AS sma_50_dist_pct,
         {rnd('sma_200_raw', 4)} AS sma_200,
         {rnd(pct('close', rnd('sma_200_raw', 4)), 2)} AS sma_200_dist_pct,
         {rnd('sma_20', 4)} AS bb_mid,
         {rnd(f'sma_20 + {lit(2.0)} * std_20', 4)} AS bb_upper,
         {rnd(f'sma_20 - {lit(2.0)} * std_20', 4)} AS bb_lower,
         {rnd('vol_sma_10_raw', 2)} AS vol_sma_10,
         {rnd('vol_sma_60_raw', 2)} AS vol_sma_60,
         CASE WHEN {delta} IS NOT NULL THEN greatest({delta}, {lit(0.0)}) END AS up_move,
         CASE WHEN {delta} IS NOT NULL THEN -least({delta}, {lit(0.0)}) END AS down_move,
         CASE WHEN {um} > {dm} AND {um} > 0 THEN {um} ELSE {lit(0.0)} END AS plus_dm,
         CASE WHEN {dm} > {um} AND {dm} > 0 THEN {dm} ELSE {lit(0.0)} END AS minus_dm,
         CAST(coalesce(sign({delta}), 0) AS DOUBLE) * volume AS obv_change,
         {rnd(pct('volume', 'vol_l1'), 2)} AS volume_dod_pct,
         {rnd(pct('volume', 'vol_l5'), 2)} AS volume_wow_pct,
         {rnd(pct('volume', 'vol_l21'), 2)} AS volume_mom_pct
  FROM {p}s0
)"""
    s1b = f"""{p}s1b AS (
  SELECT *,
         CASE WHEN obv_change IS NOT NULL THEN sum(obv_change) OVER (PARTITION BY ticker ORDER BY market_date
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS obv
  FROM {p}s1
)"""
    fold1 = _ewm_fold(f"{p}e1", f"{p}s1b", first, [])
    e = {s.name: _ewm_out(s) for s in first}
    atr = {n: rnd(e[f"atr{n}"], 4) for n in (14, 5, 21)}

    def rsi(n):
        up, dn = e[f"gain{n}"], e[f"loss{n}"]
        return rnd(f"CASE WHEN ({dn}) = 0 THEN {lit(100.0)} ELSE {lit(100.0)} - {lit(100.0)} / "
                   f"({lit(1.0)} + {div(up, dn)}) END", 2)

    kc_mid = rnd(e["kc_mid"], 4)
    vol5, vol21 = rnd(e["vol_ema_5"], 2), rnd(e["vol_ema_21"], 2)
    ema9, ema21 = rnd(e["ema_9"], 4), rnd(e["ema_21"], 4)
    plus_di = rnd(div(f"{lit(100.0)} * ({e['pdm']})", atr[14]), 2)
    minus_di = rnd(div(f"{lit(100.0)} * ({e['mdm']})", atr[14]), 2)
    s3 = f"""{p}s3 AS (
  SELECT b.*,
         {atr[14]} AS atr_14, {rnd(f"{div(atr[14], 'b.close')} * {lit(100.0)}", 4)} AS atr_14_pct,
         {atr[5]} AS atr_5, {atr[21]} AS atr_21, {rnd(pct(atr[5], atr[21]), 2)} AS atr_5_21_dist_pct,
         {ema9} AS ema_9, {ema21} AS ema_21, {rnd(pct(ema9, ema21), 2)} AS ema_9_21_dist_pct,
         {rnd(f"({e['ema_12']}) - ({e['ema_26']})", 4)} AS macd,
         {kc_mid} AS kc_mid,
         {rnd(f"{kc_mid} + {lit(2.0)} * ({e['atr10']})", 4)} AS kc_upper,
         {rnd(f"{kc_mid} - {lit(2.0)} * ({e['atr10']})", 4)} AS kc_lower,
         {rsi(14)} AS rsi_14, {rsi(5)} AS rsi_5, {rsi(21)} AS rsi_21,
         {rnd(f"{rsi(5)} - {rsi(21)}", 2)} AS rsi_5_21_diff,
         {plus_di} AS plus_di, {minus_di} AS minus_di,
         {vol5} AS vol_ema_5, {vol21} AS vol_ema_21, {rnd(pct(vol5, vol21), 2)} AS vol_5_21_dist_pct,
         {rnd(div('b.volume', vol5), 2)} AS rvol_ema_5,
         {rnd(div('b.volume', 'b.vol_sma_10'), 2)} AS rvol_sma_10,
         {rnd(div('b.volume', vol21), 2)} AS rvol_ema_21,
         {rnd(div('b.volume', 'b.vol_sma_60'), 2)} AS rvol_sma_60,
         {lit(100.0)} * {div(f'abs({plus_di} - {minus_di})', f'{plus_di} + {minus_di}')} AS dx
  FROM {p}s1b b JOIN {p}e1 x ON x.ticker = b.ticker AND x.rn = b.rn
)"""
    s4 = f"""{p}s4 AS (
  SELECT *,
         {rnd(f"rvol_ema_5 - {lag('rvol_ema_5')}", 2)} AS rvol_ema_5_dod_diff,
         {rnd(f"rsi_14 - {lag('rsi_14')}", 2)} AS rsi_14_dod_diff,
         {rnd(pct('atr_14', lag('atr_14')), 2)} AS atr_14_dod_pct
  FROM {p}s3
)"""
    fold2 = _ewm_fold(f"{p}e2", f"{p}s4", second, [])
    e2 = {s.name: _ewm_out(s) for s in second}
    msig = rnd(e2["macd_signal"], 4)
    s5 = f"""{p}s5 AS (
  SELECT b.*, {msig} AS macd_signal, {rnd(f"b.macd - {msig}", 4)} AS macd_hist,
         {rnd(e2['adx'], 2)} AS adx_14
  FROM {p}s4 b JOIN {p}e2 x ON x.ticker = b.ticker AND x.rn = b.rn
)"""
    widest = 21
    lag_cols = [f"lag({m}, {k}) {over()} AS l{k}_{m}" for m in TREND_METRICS for k in range(1, widest)]

    def vals(m, n):
        return [f"l{n - 1 - j}_{m}" if j < n - 1 else m for j in range(n)]

    def total(terms):
        out = terms[0]
        for t in terms[1:]:
            out = f"({out} + {t})"
        return out

    parts, traj = [], []
    for m in TREND_METRICS:
        for n in (3, 5, 10, 21):
            v = vals(m, n)
            sxy = total([f"({x} * {lit(j - (n - 1) / 2.0)})" for j, x in enumerate(v)])
            parts += [f"({total(v)} / {lit(float(n))}) AS mean_{m}_{n}", f"{sxy} AS sxy_{m}_{n}"]
            sxx = lit(n * (n * n - 1) / 12.0)
            mean, sx = f"mean_{m}_{n}", f"sxy_{m}_{n}"
            syy = total([f"(({x} - {mean}) * ({x} - {mean}))" for x in v])
            std = f"sqrt({syy} / {lit(float(n - 1))})"
            traj.append(f"{rnd(f'{sx} / {sxx}', 4)} AS {m}_slope_{n}d")
            r2 = f"CASE WHEN {std} < {lit(1e-8)} THEN {lit(0.0)} ELSE {sx} * {sx} / ({sxx} * {syy}) END"
            traj.append(f"{rnd(r2, 4)} AS {m}_r2_{n}d")

    def mean_present(cols):
        tot = total([f"coalesce({c}, {lit(0.0)})" for c in cols])
        cnt = total([f"CASE WHEN {c} IS NOT NULL THEN {lit(1.0)} ELSE {lit(0.0)} END" for c in cols])
        return f"CASE WHEN {cnt} > 0 THEN {tot} / {cnt} END"

    s6a = f"""{p}s6a AS (
  SELECT *, {', '.join(lag_cols)},
         lag(volume_dod_pct, 1) {over()} AS vdp1, lag(volume_dod_pct, 2) {over()} AS vdp2,
         lag(rsi_14_dod_diff, 1) {over()} AS rdd1, lag(rsi_14_dod_diff, 2) {over()} AS rdd2
  FROM {p}s5
)"""
    s6b = f"""{p}s6b AS (SELECT *, {', '.join(parts)} FROM {p}s6a)"""
    s6 = f"""{p}s6 AS (
  SELECT *,
         {rnd("macd_hist - l1_macd_hist", 4)} AS macd_hist_dod_diff,
         {rnd(mean_present(['rdd2', 'rdd1', 'rsi_14_dod_diff']), 2)} AS rsi_velocity_3d,
         {rnd(mean_present(['vdp2', 'vdp1', 'volume_dod_pct']), 2)} AS volume_dod_sma_3_x,
         {', '.join(traj)}
  FROM {p}s6b
)"""
    cols = [("volume_dod_sma_3_x AS volume_dod_sma_3" if c == "volume_dod_sma_3" else c) for c in INDICATOR_COLUMNS]
    ind = f"""{p}ind AS (SELECT {', '.join(cols)} FROM {p}s6)"""
    return [s0, s1, s1b, fold1, s3, s4, fold2, s5, s6a, s6b, s6, ind]


def all_null_filter(alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return f"coalesce({a}atr_14, {a}sma_50, {a}sma_200, {a}rvol_ema_5, {a}rsi_14) IS NOT NULL"


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + body


def indicator_table_ctes(bars_sql: str = BARS_SQL) -> list[str]:
    """bars, inst, the indicator CTEs and ``daily_indicators`` (rows kept by the all-null rule)."""
    return ([f"bars AS ({bars_sql})", f"inst AS ({INSTRUMENTS_SQL})"]
            + indicator_ctes("bars")
            + [f"daily_indicators AS (SELECT * FROM ind WHERE {all_null_filter()})"])
