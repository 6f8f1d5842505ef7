SELECT strftime(o_orderdate, '%Y-%m') AS order_month, count(*) AS orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue
FROM orders
GROUP BY 1
