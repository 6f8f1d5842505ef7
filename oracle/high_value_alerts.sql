WITH a AS (
SELECT user_id AS customer_id, 'High value order' AS reason, 1000 * CAST(value AS DECIMAL(18,2)) AS amount FROM events
), b AS (
SELECT customer_id, reason, format('{:,}', CAST(floor(amount) AS BIGINT)) || '.' || CAST(CAST(10 * (amount - floor(amount)) AS INTEGER) AS VARCHAR) || ' VND' AS value
FROM a WHERE amount > 200000
)
SELECT *, '🚨 Fraud Alert: Customer ' || customer_id || ' | ' || reason || ' (Value: ' || value || ')' AS message FROM b
