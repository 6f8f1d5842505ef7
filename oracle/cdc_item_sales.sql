SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
       CAST(sum(event_id % 5 + 1) AS BIGINT) AS units, count(*) AS items
FROM events WHERE event_type = 'purchase' GROUP BY 1
