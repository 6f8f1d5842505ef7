WITH w AS (
  SELECT time_bucket(INTERVAL '1 day', ts) AS window_start,
         time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
         CAST(sum(event_id % 5 + 1) AS BIGINT) AS total_quantity,
         CAST(sum(CAST(event_id % 5 + 1 AS DECIMAL(10,0)) * CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue,
         count(*) AS item_count
  FROM events WHERE event_type = 'purchase' GROUP BY 1, 2, 3
)
, top AS (
  SELECT 'top_product_window' AS metric, CAST(epoch(window_start) AS BIGINT) AS window_start,
         CAST(epoch(window_end) AS BIGINT) AS window_end, product_id, total_quantity,
         CAST(row_number() OVER (PARTITION BY window_start ORDER BY total_quantity DESC, product_id) AS INTEGER) AS rank,
         CAST(1440 AS DOUBLE) AS window_duration_minutes
  FROM w QUALIFY rank <= 5
)
SELECT top.*, p_name AS product_name, p_type AS category_id, CAST(p_retailprice AS DECIMAL(18,2)) AS price,
       CASE WHEN p_partkey IS NULL THEN 'Product not found' END AS error
FROM top LEFT JOIN part ON product_id = p_partkey
