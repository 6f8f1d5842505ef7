SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS order_month,
       2 * count(*) AS change_events, count(*) AS new_orders
FROM orders GROUP BY 1
