SELECT c.customer_id, c.last_name, c.email,
       count(o_orderkey) AS total_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_spent,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS avg_spent,
       CASE WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) > 3500000 THEN 'high value'
            WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) > 2000000 THEN 'medium value'
            ELSE 'low value' END AS customer_segment
FROM orders LEFT JOIN (
  SELECT c_custkey AS customer_id, c_name AS last_name, c_mktsegment AS email
  FROM customer
) c ON o_custkey = c.customer_id
GROUP BY c.customer_id, c.last_name, c.email
