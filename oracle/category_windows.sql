SELECT time_bucket(INTERVAL '1 day', ts) AS window_start,
       time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end,
       p_type AS category_id,
       CAST(sum(event_id % 5 + 1) AS BIGINT) AS total_quantity,
       CAST(sum(CAST(event_id % 5 + 1 AS DECIMAL(10,0)) * CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue,
       count(*) AS item_count
FROM events JOIN part ON p_partkey = CAST(json_extract_string(props, '$.k') AS BIGINT)
WHERE event_type = 'purchase'
GROUP BY 1, 2, 3
