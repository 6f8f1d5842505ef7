WITH w AS (
  SELECT time_bucket(INTERVAL '1 day', ts) AS window_start,
         time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
         CAST(sum(event_id % 5 + 1) AS BIGINT) AS total_quantity,
         CAST(sum(CAST(event_id % 5 + 1 AS DECIMAL(10,0)) * CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue,
         count(*) AS item_count
  FROM events WHERE event_type = 'purchase' GROUP BY 1, 2, 3
)
SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY total_quantity DESC, product_id) AS INTEGER) AS rank
FROM w
WHERE window_end <= (
  SELECT max(ts) - INTERVAL 5 SECOND FROM events WHERE event_type = 'purchase'
)
QUALIFY rank <= 5
