WITH o AS (
  SELECT user_id, CAST(10000 * ceil(CAST(value AS DECIMAL(18,2)) / 10) AS BIGINT) AS amount,
         time_bucket(INTERVAL '1 day', ts) AS day,
         time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' <= (SELECT max(ts) - INTERVAL 5 SECOND FROM events) AS closed
  FROM events
)
SELECT user_id AS customer_id, 'High value order' AS reason, format('{:,}', amount) || '.5 VND' AS value
FROM o WHERE amount + 0.5 > 200000
UNION ALL
SELECT user_id AS customer_id, 'Frequent orders' AS reason, count(*) || ' orders in 1 day' AS value
FROM o WHERE closed GROUP BY user_id, day HAVING count(*) > 5
UNION ALL
SELECT user_id AS customer_id, 'Similar orders' AS reason, count(*) || ' x ' || format('{:,}', amount) || '.5 VND' AS value
FROM o WHERE closed GROUP BY user_id, amount, day HAVING count(*) >= 2
