SELECT customer_id, product_id,
       CAST(quantity * CASE WHEN age <= 30 THEN 1.0 WHEN age <= 90 THEN 0.8 WHEN age <= 180 THEN 0.6
                            ELSE 0.4 END AS DOUBLE) AS weight,
       ts AS "timestamp"
FROM (
  SELECT DISTINCT o_custkey AS customer_id, l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity, o_orderdate AS ts,
         date_diff('day', o_orderdate, TIMESTAMP '2001-08-01') AS age
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
)
