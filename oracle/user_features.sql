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
), activity AS (
  SELECT customer_id,
         CAST(sum(CAST(avg_weight AS DECIMAL(28,12))) AS DOUBLE) AS total_activity_score,
         count(product_id) AS unique_products_interacted,
         CAST(sum(CAST(avg_weight AS DECIMAL(28,12))) AS DOUBLE) / count(avg_weight) AS avg_interaction_strength,
         max(last_interaction) AS last_activity_date,
         CAST(sum(interaction_count) AS BIGINT) AS total_interactions
  FROM matrix GROUP BY customer_id
), paid AS (
  SELECT o_custkey AS customer_id, count(o_orderkey) AS total_orders,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_spent,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS avg_order_value,
         min(o_orderdate) AS first_purchase_date, max(o_orderdate) AS last_purchase_date,
         date_diff('day', min(o_orderdate), max(o_orderdate)) AS lifetime
  FROM orders GROUP BY o_custkey
)
SELECT c_custkey AS customer_id,
       coalesce(total_activity_score, 0) AS total_activity_score,
       coalesce(unique_products_interacted, 0) AS unique_products_interacted,
       coalesce(avg_interaction_strength, 0) AS avg_interaction_strength,
       last_activity_date,
       coalesce(total_interactions, 0) AS total_interactions,
       coalesce(total_orders, 0) AS total_orders,
       coalesce(total_spent, 0) AS total_spent,
       coalesce(avg_order_value, 0) AS avg_order_value,
       first_purchase_date, last_purchase_date,
       CAST(coalesce(lifetime, 0) AS INTEGER) AS customer_lifetime_days,
       coalesce(CAST(total_orders AS DOUBLE) / (lifetime + 1), 0) AS purchase_frequency
FROM customer
LEFT JOIN activity a ON a.customer_id = c_custkey
LEFT JOIN paid ON paid.customer_id = c_custkey
