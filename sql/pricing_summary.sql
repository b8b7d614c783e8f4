SELECT
  l_returnflag,
  l_linestatus,
  CAST(SUM(CAST(l_quantity AS DECIMAL(8, 2))) AS DOUBLE) AS sum_qty,
  CAST(SUM(CAST(l_extendedprice AS DECIMAL(12, 2))) AS DOUBLE) AS sum_base_price,
  CAST(SUM(CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(1 - l_discount AS DECIMAL(4, 2))) AS DOUBLE) AS sum_disc_price,
  CAST(SUM(CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(1 - l_discount AS DECIMAL(4, 2)) * CAST(1 + l_tax AS DECIMAL(4, 2))) AS DOUBLE) AS sum_charge,
  CAST(SUM(CAST(l_quantity AS DECIMAL(8, 2))) AS DOUBLE) / COUNT(*) AS avg_qty,
  COUNT(*) AS count_order
FROM parquet.`${sf}/lineitem.parquet`
WHERE l_shipdate <= TIMESTAMP_NTZ '${cutoff}'
GROUP BY l_returnflag, l_linestatus
