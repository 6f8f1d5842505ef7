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
), popularity AS (
  SELECT product_id,
         CAST(sum(CAST(avg_weight AS DECIMAL(28,12))) AS DOUBLE) AS total_popularity_score,
         count(customer_id) AS total_customers_interacted,
         CAST(sum(CAST(avg_weight AS DECIMAL(28,12))) AS DOUBLE) / count(avg_weight) AS avg_user_rating,
         max(last_interaction) AS last_interaction_date
  FROM matrix GROUP BY product_id
), sold AS (
  SELECT l_partkey AS product_id,
         CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_sold,
         count(l_orderkey) AS total_orders,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(l_extendedprice) AS avg_selling_price,
         CAST(sum(CAST(l_quantity AS DECIMAL(10,0)) * CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue
  FROM lineitem GROUP BY l_partkey
)
SELECT p_partkey AS product_id, p_type AS category_id, CAST(p_retailprice AS DECIMAL(18,2)) AS price,
       CAST(DATE '1995-01-01' + p_size AS TIMESTAMP) AS created_at,
       coalesce(total_popularity_score, 0) AS total_popularity_score,
       coalesce(total_customers_interacted, 0) AS total_customers_interacted,
       coalesce(avg_user_rating, 0) AS avg_user_rating,
       last_interaction_date,
       coalesce(total_sold, 0) AS total_sold,
       coalesce(total_orders, 0) AS total_orders,
       coalesce(avg_selling_price, 0) AS avg_selling_price,
       coalesce(total_revenue, 0) AS total_revenue,
       CAST(date_diff('day', DATE '1995-01-01' + p_size, DATE '2024-02-15') AS INTEGER) AS days_since_launch
FROM part
LEFT JOIN popularity ON popularity.product_id = p_partkey
LEFT JOIN sold ON sold.product_id = p_partkey
