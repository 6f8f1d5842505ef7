SELECT user_id AS customer_id, 'Similar orders' AS reason,
       count(*) || ' x ' || regexp_replace(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '0$', '') || ' VND' AS value
FROM events GROUP BY user_id, CAST(value AS DECIMAL(18,2)), events.value, time_bucket(INTERVAL '1 day', ts) HAVING count(*) >= 2
