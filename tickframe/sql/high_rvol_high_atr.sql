-- Volatile tickers by relative volume.
SELECT ticker, market_date, rvol_ema_21, rsi_14, atr_14_pct
FROM daily_indicators
WHERE market_date = (SELECT max(market_date) FROM daily_indicators) AND atr_14_pct > 8 AND rsi_14 IS NOT NULL
ORDER BY rvol_ema_21 DESC NULLS FIRST, ticker
