SELECT DISTINCT user_id AS customer_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
       CAST(0.6 AS DOUBLE) AS weight, ts AS "timestamp"
FROM events JOIN customer ON user_id = c_custkey
WHERE event_type = 'view'
