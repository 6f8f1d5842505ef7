SELECT 'revenue_window' AS metric,
       CAST(epoch(time_bucket(INTERVAL '1 day', ts)) AS BIGINT) AS window_start,
       CAST(epoch(time_bucket(INTERVAL '1 day', ts)) AS BIGINT) + 86400 AS window_end,
       count(*) AS total_orders,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue,
       CAST(1440 AS DOUBLE) AS window_duration_minutes
FROM events GROUP BY 2, 3
