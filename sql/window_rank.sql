-- Spark keeps the first rows of each customer per task before the shuffle.
SELECT o_custkey, o_orderkey, o_totalprice, CAST(place AS BIGINT) AS place
FROM (
  SELECT
    o_custkey,
    o_orderkey,
    o_totalprice,
    ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place
  FROM parquet.`${sf}/orders.parquet`
)
WHERE place <= ${top}
