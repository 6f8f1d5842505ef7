WITH base AS (
  SELECT p_partkey AS product_id, p_name AS product_name, c.name AS category_name,
         CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_quantity_sold,
         CAST(sum(CAST(l_quantity AS DECIMAL(10,0)) * CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue,
         count(DISTINCT o_custkey) AS unique_customers,
         count(l_linenumber) AS total_orders,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(l_extendedprice) AS avg_selling_price,
         min(o_orderdate) AS first_sale_date, max(o_orderdate) AS last_sale_date,
         DATE '2001-08-01' AS analysis_date
  FROM part
  JOIN (SELECT DISTINCT p_type AS category_id, p_type AS name FROM part) c ON p_type = c.category_id
  JOIN lineitem ON p_partkey = l_partkey
  JOIN orders ON o_orderkey = l_orderkey
  WHERE o_orderstatus = 'F'
  GROUP BY p_partkey, p_name, c.name
)
SELECT * FROM base
