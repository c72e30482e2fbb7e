-- Relative volume boosted by the trend fit of price and volume, for one country and sector.
WITH scored AS (
  SELECT ticker, name, sector, market_date, atr_14_pct,
         0.15D * coalesce(rvol_ema_5, 0D) + 0.15D * coalesce(rvol_sma_10, 0D)
           + 0.30D * coalesce(rvol_ema_21, 0D) + 0.40D * coalesce(rvol_sma_60, 0D) AS volume_score,
         coalesce(close_r2_10d, 0D) AS price_fit, coalesce(obv_r2_10d, 0D) AS volume_fit, coalesce(rsi_14_slope_3d, 0D) AS kick
  FROM daily_indicators JOIN financedatabase USING (ticker)
  WHERE market_date = (SELECT max(market_date) FROM daily_indicators) AND country = 'United States' AND sector = 'Energy' AND atr_14_pct > 8)
SELECT ticker, name, sector, market_date,
       CAST(round(CAST(atr_14_pct AS DECIMAL(38, 12)), 2) AS DOUBLE) AS atr_14_pct,
       CAST(round(CAST(volume_score AS DECIMAL(38, 12)), 2) AS DOUBLE) AS base_vol_score,
       CAST(round(CAST(price_fit AS DECIMAL(38, 12)), 2) AS DOUBLE) AS close_r2_10d,
       CAST(round(CAST(volume_fit AS DECIMAL(38, 12)), 2) AS DOUBLE) AS obv_r2_10d,
       CAST(round(CAST(kick AS DECIMAL(38, 12)), 2) AS DOUBLE) AS rsi_slope_3d,
       CAST(round(CAST(volume_score * ((1D + price_fit * 0.5D) * (1D + volume_fit * 0.5D)) + greatest(0D, kick * 0.1D)
                       AS DECIMAL(38, 12)), 2) AS DOUBLE) AS enhanced_attention_score
FROM scored WHERE volume_score > 1
ORDER BY enhanced_attention_score DESC, ticker
LIMIT 50
