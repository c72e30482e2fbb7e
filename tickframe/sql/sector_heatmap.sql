-- Tickers that pass the squeeze, by sector.
SELECT sector, count(*) AS stocks_accumulating,
       CAST(round(CAST(avg(vol_5_21_dist_pct) AS DECIMAL(38, 12)), 2) AS DOUBLE) AS avg_volume_surge_pct
FROM daily_indicators JOIN financedatabase USING (ticker)
WHERE market_date = (SELECT max(market_date) FROM daily_indicators) AND sector IS NOT NULL
  AND vol_5_21_dist_pct > 25 AND atr_5_21_dist_pct < -20
  AND abs(sma_50_dist_pct) < 4 AND rsi_14 BETWEEN 45 AND 55
GROUP BY sector
ORDER BY stocks_accumulating DESC, sector
