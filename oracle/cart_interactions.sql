SELECT customer_id, product_id,
       CAST(quantity * CASE WHEN age <= 30 THEN 1.0 WHEN age <= 90 THEN 0.8 WHEN age <= 180 THEN 0.6
                            ELSE 0.4 END AS DOUBLE) AS weight,
       ts AS "timestamp"
FROM (
  SELECT DISTINCT user_id AS customer_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
         CAST(event_id % 5 + 1 AS INTEGER) AS quantity, ts,
         date_diff('day', ts, TIMESTAMP '2024-02-15') AS age
  FROM events JOIN customer ON user_id = c_custkey
  WHERE event_type = 'click'
)
