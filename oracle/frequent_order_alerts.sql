WITH a AS (
SELECT user_id AS customer_id, 'Frequent orders' AS reason, count(*) || ' orders in 1 day' AS value
FROM events GROUP BY user_id, time_bucket(INTERVAL '1 day', ts) HAVING count(*) > 5
)
SELECT *, '🚨 Fraud Alert: Customer ' || customer_id || ' | ' || reason || ' (Value: ' || value || ')' AS message FROM a
