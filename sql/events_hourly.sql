SELECT
  window.start AS hour,
  event_type,
  COUNT(*) AS n_events,
  COUNT(DISTINCT user_id) AS n_users,
  CAST(SUM(CAST(value AS DECIMAL(12, 2))) AS DOUBLE) AS total_value
FROM parquet.`${sf}/events.parquet`
GROUP BY window(ts, '1 hour'), event_type
