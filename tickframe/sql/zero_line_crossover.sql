-- Momentum has turned up: RSI(5) - RSI(21) is above zero on the latest date, and was not at the ticker's bar before,
-- which is at most 10 days older. One hash aggregate a ticker over those days: its newest bar and the one before it.
WITH turned AS (
  SELECT ticker, max(market_date) AS market_date,
         max_by(rsi_14, market_date) AS rsi_14,
         max_by(rsi_5_21_diff, market_date) FILTER (WHERE market_date < today) AS prev_rsi_diff,
         max_by(rsi_5_21_diff, market_date) AS rsi_5_21_diff,
         today
  FROM (SELECT *, (SELECT max(market_date) FROM daily_indicators) AS today FROM daily_indicators) dated
  WHERE market_date >= date_sub(today, 10)
  GROUP BY ticker, today)
SELECT ticker, market_date, rsi_14, prev_rsi_diff, rsi_5_21_diff
FROM turned
WHERE market_date = today AND prev_rsi_diff <= 0 AND rsi_5_21_diff > 0
ORDER BY rsi_5_21_diff DESC, ticker
