SELECT c_custkey AS customer_id, c_name AS last_name, c_mktsegment AS email,
       count(o_orderkey) AS total_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_spent,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS avg_order_spent,
       min(o_orderdate) AS first_order_date, max(o_orderdate) AS last_order_date,
       CASE WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) >= 3500000 THEN 'High Value'
            WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) >= 2000000 THEN 'Medium Value'
            ELSE 'Low Value' END AS customer_segment,
       DATE '2001-08-01' AS process_date,
       CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) AS INTEGER) AS customer_lifetime_days,
       CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) AS DOUBLE) / count(o_orderkey) AS avg_days_between_orders
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY c_custkey, c_name, c_mktsegment
