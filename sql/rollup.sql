-- Orders are summed per customer, then per nation, before they meet the next table.
WITH by_customer AS (
  SELECT o_custkey, COUNT(*) AS n_orders, SUM(CAST(o_totalprice AS DECIMAL(12, 2))) AS total
  FROM parquet.`${sf}/orders.parquet`
  GROUP BY o_custkey
),
by_nation AS (
  SELECT c_nationkey, SUM(n_orders) AS n_orders, SUM(total) AS total
  FROM by_customer
  JOIN parquet.`${sf}/customer.parquet` ON c_custkey = o_custkey
  GROUP BY c_nationkey
)
SELECT r_name, n_name, CAST(SUM(n_orders) AS BIGINT) AS n_orders, CAST(SUM(total) AS DOUBLE) AS total
FROM by_nation
JOIN parquet.`${sf}/nation.parquet` ON n_nationkey = c_nationkey
JOIN parquet.`${sf}/region.parquet` ON r_regionkey = n_regionkey
GROUP BY ROLLUP (r_name, n_name)
