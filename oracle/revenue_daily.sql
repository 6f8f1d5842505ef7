SELECT CAST(o_orderdate AS DATE) AS order_date_only,
       CAST(dayofweek(CAST(o_orderdate AS DATE)) + 1 AS INTEGER) AS day_of_week,
       dayname(CAST(o_orderdate AS DATE)) AS day_name,
       dayofweek(CAST(o_orderdate AS DATE)) IN (0, 6) AS is_weekend,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS daily_revenue,
       count(o_orderkey) AS daily_orders,
       count(DISTINCT o_custkey) AS daily_unique_customers,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS daily_avg_order_value,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(DISTINCT o_custkey) AS revenue_per_customer,
       DATE '2001-08-01' AS analysis_date
FROM orders
WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2001-05-03'
GROUP BY CAST(o_orderdate AS DATE)
