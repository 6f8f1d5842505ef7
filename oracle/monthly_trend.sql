SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS order_month,
       count(DISTINCT o_orderkey) AS total_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS monthly_revenue,
       count(DISTINCT o_custkey) AS unique_customers,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(DISTINCT o_orderkey) AS avg_order_value
FROM orders
WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2000-08-01'
GROUP BY 1
