-- Weighted relative volume of the latest date: the 50 highest scores.
SELECT ticker, market_date, rvol_ema_5, rvol_sma_10, rvol_ema_21, rvol_sma_60,
       CAST(round(CAST(rvol_ema_5_share + rvol_sma_10_share + rvol_ema_21_share + rvol_sma_60_share AS DECIMAL(38, 12)), 2) AS DOUBLE)
         AS dynamic_attention_score
FROM (SELECT *, 0.15D * coalesce(rvol_ema_5, 0D) AS rvol_ema_5_share, 0.15D * coalesce(rvol_sma_10, 0D) AS rvol_sma_10_share,
             0.30D * coalesce(rvol_ema_21, 0D) AS rvol_ema_21_share, 0.40D * coalesce(rvol_sma_60, 0D) AS rvol_sma_60_share
      FROM daily_indicators WHERE market_date = (SELECT max(market_date) FROM daily_indicators))
ORDER BY dynamic_attention_score DESC, ticker
LIMIT 50
