WITH w AS (
  SELECT time_bucket(INTERVAL '1 day', ts) AS window_start,
         time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
         CAST(sum(event_id % 5 + 1) AS BIGINT) AS total_quantity,
         CAST(sum(CAST(event_id % 5 + 1 AS DECIMAL(10,0)) * CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue,
         count(*) AS item_count
  FROM events WHERE event_type = 'purchase' GROUP BY 1, 2, 3
)
, p AS (
  SELECT window_start, product_id, item_count,
         lag(item_count) OVER (PARTITION BY product_id ORDER BY window_start) AS prev_item_count
  FROM w
)
SELECT *, (CAST(item_count AS DOUBLE) - CAST(prev_item_count AS DOUBLE)) / CAST(prev_item_count AS DOUBLE) * 100 AS growth_rate
FROM p WHERE item_count > prev_item_count
