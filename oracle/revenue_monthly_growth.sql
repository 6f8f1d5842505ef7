WITH m AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS order_month,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue,
         count(DISTINCT o_custkey) AS unique_customer
  FROM orders
  WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2000-08-01'
  GROUP BY 1
), p AS (
  SELECT *, lag(total_revenue) OVER (ORDER BY order_month) AS prev_month_revenue,
         lag(unique_customer) OVER (ORDER BY order_month) AS prev_month_customers
  FROM m
)
SELECT *,
       CASE WHEN prev_month_revenue > 0
            THEN (CAST(total_revenue AS DOUBLE) - CAST(prev_month_revenue AS DOUBLE))
                 / CAST(prev_month_revenue AS DOUBLE) * 100 ELSE 0 END AS revenue_growth_rate,
       CASE WHEN prev_month_customers > 0
            THEN (CAST(unique_customer AS DOUBLE) - CAST(prev_month_customers AS DOUBLE))
                 / CAST(prev_month_customers AS DOUBLE) * 100 ELSE 0 END AS customer_growth_rate
FROM p
