SELECT CAST(user_id AS VARCHAR) AS key,
       CASE WHEN event_type <> 'error' THEN '{"payload":{"event_id":' || event_id || ',"value":' || value || '}}' END AS value,
       CASE WHEN event_type = 'error' THEN 'not valid JSON' END AS error,
       CASE WHEN event_type = 'error' THEN 'broken ' || event_id END AS raw_data,
       CAST(event_id % 3 AS INTEGER) AS "partition", event_id AS "offset", ts AS "timestamp"
FROM events ORDER BY event_id % 3, event_id LIMIT 5
