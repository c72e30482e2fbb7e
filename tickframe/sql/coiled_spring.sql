-- Rising volume baseline, falling volatility, price near its 50-row mean, neutral RSI.
SELECT ticker, market_date, vol_5_21_dist_pct, atr_5_21_dist_pct, sma_50_dist_pct, rsi_14
FROM daily_indicators
WHERE market_date = (SELECT max(market_date) FROM daily_indicators)
  AND vol_5_21_dist_pct > 25 AND atr_5_21_dist_pct < -20
  AND abs(sma_50_dist_pct) < 4 AND rsi_14 BETWEEN 45 AND 55
ORDER BY vol_5_21_dist_pct DESC, ticker
