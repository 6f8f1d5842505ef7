WITH bought AS (
  SELECT DISTINCT o_custkey AS customer_id, l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity, o_orderdate AS ts
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
), carted AS (
  SELECT DISTINCT user_id AS customer_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
         CAST(event_id % 5 + 1 AS INTEGER) AS quantity, ts
  FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'click'
), wished AS (
  SELECT DISTINCT user_id AS customer_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id, ts
  FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'view'
), weighted AS (
  SELECT customer_id, product_id, ts,
         CAST(quantity * CASE WHEN date_diff('day', ts, TIMESTAMP '2024-02-15') <= 30 THEN 1.0
                              WHEN date_diff('day', ts, TIMESTAMP '2024-02-15') <= 90 THEN 0.8
                              WHEN date_diff('day', ts, TIMESTAMP '2024-02-15') <= 180 THEN 0.6
                              ELSE 0.4 END AS DECIMAL(18,1)) AS weight
  FROM (SELECT * FROM bought UNION ALL SELECT * FROM carted)
  UNION ALL
  SELECT customer_id, product_id, ts, CAST(0.6 AS DECIMAL(18,1)) FROM wished
), matrix AS (
  SELECT customer_id, product_id, CAST(sum(weight) AS DOUBLE) / count(weight) AS avg_weight,
         max(ts) AS last_interaction, count(*) AS interaction_count
  FROM weighted GROUP BY customer_id, product_id
)
SELECT * FROM matrix
