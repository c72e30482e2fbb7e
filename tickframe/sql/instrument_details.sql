-- Latest bars of the instruments that have a name and a sector.
SELECT ticker, market_date, close, volume, name, asset_class, sector, industry_group, industry, exchange, market,
       country, currency, market_cap, summary
FROM daily_market_data JOIN financedatabase USING (ticker)
WHERE market_date = (SELECT max(market_date) FROM daily_market_data) AND name IS NOT NULL AND sector IS NOT NULL
ORDER BY volume DESC NULLS FIRST, ticker
