SELECT time_bucket(INTERVAL '10 seconds', ts) AS window_start,
       time_bucket(INTERVAL '10 seconds', ts) + INTERVAL '10 seconds' AS window_end,
       count(*) AS total_orders,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_order_value
FROM events GROUP BY 1, 2
