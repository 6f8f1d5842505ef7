WITH w AS (
  SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, count(*) AS total_orders,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue
  FROM events GROUP BY 1
), p AS (
  SELECT *, lag(total_revenue) OVER (ORDER BY window_start) AS prev_revenue,
         lag(total_orders) OVER (ORDER BY window_start) AS prev_orders
  FROM w
)
SELECT *, CASE WHEN prev_revenue > 0 THEN
         (CAST(total_revenue AS DOUBLE) - CAST(prev_revenue AS DOUBLE)) / CAST(prev_revenue AS DOUBLE) * 100
         ELSE 0 END AS revenue_growth_rate
FROM p
