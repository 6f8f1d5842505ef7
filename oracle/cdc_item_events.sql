SELECT event_id AS order_item_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
       event_id % 5 + 1 AS quantity, CAST(value AS DECIMAL(18,2)) AS price, ts AS event_time
FROM events WHERE event_type = 'purchase'
