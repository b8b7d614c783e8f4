-- Both sides of the first join hold an order once, so no key is hot; the
-- customers meet ten rows only.
WITH revenue AS (
  SELECT
    l_orderkey,
    SUM(CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(1 - l_discount AS DECIMAL(4, 2))) AS revenue
  FROM parquet.`${sf}/lineitem.parquet`
  GROUP BY l_orderkey
),
top AS (
  SELECT o_orderkey, o_custkey, o_orderdate, revenue
  FROM revenue
  JOIN parquet.`${sf}/orders.parquet` ON o_orderkey = l_orderkey
  ORDER BY revenue DESC, o_orderkey
  LIMIT ${top}
)
SELECT c_name, o_orderkey, o_orderdate, CAST(revenue AS DOUBLE) AS revenue
FROM top
JOIN parquet.`${sf}/customer.parquet` ON c_custkey = o_custkey
