SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS order_month,
       count(DISTINCT o_custkey) AS unique_customer,
       count(DISTINCT o_orderkey) AS total_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(DISTINCT o_custkey) AS avg_revenue_per_customer,
       CAST(count(DISTINCT o_orderkey) AS DOUBLE) / count(DISTINCT o_custkey) AS orders_per_customer,
       DATE '2001-08-01' AS analysis_date
FROM orders
WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2000-08-01'
GROUP BY 1
