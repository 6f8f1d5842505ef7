SELECT event_id AS order_id, user_id AS customer_id, CAST(value AS DECIMAL(18,2)) AS total_price,
       event_type AS status, ts AS order_date, 'c' AS op
FROM events
