SELECT c_custkey AS customer_id, c_mktsegment AS first_name, c_name AS last_name,
       count(o_orderkey) AS total_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_spent,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(o_totalprice), 0) AS avg_order_value,
       CASE WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) > 3500000 THEN 'High Value'
            WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) > 2000000 THEN 'Medium Value'
            ELSE 'Low Value' END AS customer_segment
FROM customer LEFT JOIN orders ON o_custkey = c_custkey
GROUP BY c_custkey, c_mktsegment, c_name
