WITH sold AS (
  SELECT l_partkey, min(o_orderdate) AS first_sale, max(o_orderdate) AS last_sale
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
  WHERE o_orderstatus = 'F' GROUP BY l_partkey
), pairs AS (
  SELECT o_custkey AS customer_id, l_partkey AS product_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  UNION
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT)
  FROM events JOIN customer ON user_id = c_custkey WHERE event_type IN ('click', 'view')
), reads AS (
  SELECT 'customers' AS table_name, count(*) AS row_count FROM customer
  UNION ALL SELECT 'orders', count(*) FROM orders
  UNION ALL SELECT 'order_items', count(*) FROM lineitem
  UNION ALL SELECT 'products', count(*) FROM part
  UNION ALL SELECT 'categories', count(DISTINCT p_type) FROM part
  UNION ALL SELECT 'carts', count(*) FROM events WHERE event_type = 'click'
  UNION ALL SELECT 'wishlists', count(*) FROM events WHERE event_type = 'view'
), uses(job_name, table_name) AS (
  VALUES ('segmentation_customer', 'orders'), ('segmentation_customer', 'customers'),
         ('product_analytics', 'orders'), ('product_analytics', 'order_items'),
         ('product_analytics', 'categories'), ('product_analytics', 'products'),
         ('revenue_statistics', 'orders'),
         ('feature_ml', 'orders'), ('feature_ml', 'order_items'), ('feature_ml', 'customers'),
         ('feature_ml', 'products'), ('feature_ml', 'carts'), ('feature_ml', 'wishlists')
)
SELECT job_name, 'SUCCESS' AS status, 'read' AS direction, table_name, row_count FROM uses JOIN reads USING (table_name)
UNION ALL SELECT 'segmentation_customer', 'SUCCESS', 'written', 'customer_segmentation',
  (SELECT count(DISTINCT o_custkey) FROM orders JOIN customer ON o_custkey = c_custkey)
UNION ALL SELECT 'revenue_statistics', 'SUCCESS', 'written', 'revenue_monthly',
  (SELECT count(DISTINCT date_trunc('month', o_orderdate)) FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2000-08-01')
UNION ALL SELECT 'revenue_statistics', 'SUCCESS', 'written', 'revenue_daily',
  (SELECT count(DISTINCT CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2001-05-03')
UNION ALL SELECT 'product_analytics', 'SUCCESS', 'written', 'top_products_summary', (SELECT least(count(*), 10) FROM sold)
UNION ALL SELECT 'product_analytics', 'SUCCESS', 'written', 'product_pricing_analytics', (SELECT count(*) FROM sold)
UNION ALL SELECT 'product_analytics', 'SUCCESS', 'written', 'product_lifecycle_metrics',
  (SELECT count(*) FROM sold WHERE date_diff('day', first_sale, last_sale) > 0)
UNION ALL SELECT 'product_analytics', 'SUCCESS', 'written', 'category_performance',
  (SELECT count(DISTINCT p_type) FROM sold JOIN part ON p_partkey = l_partkey)
UNION ALL SELECT 'feature_ml', 'SUCCESS', 'written', 'user_item_interactions', (SELECT count(*) FROM pairs)
UNION ALL SELECT 'feature_ml', 'SUCCESS', 'written', 'user_features', (SELECT count(*) FROM customer)
UNION ALL SELECT 'feature_ml', 'SUCCESS', 'written', 'product_features', (SELECT count(*) FROM part)
