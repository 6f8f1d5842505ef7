SELECT customer_segment, count(*) AS customers FROM (
  SELECT o_custkey,
         CASE WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) >= 3500000 THEN 'High Value'
              WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) >= 2000000 THEN 'Medium Value'
              ELSE 'Low Value' END AS customer_segment
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey
) GROUP BY customer_segment
