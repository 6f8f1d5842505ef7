SELECT 'orders' AS table_name, 'null:status' AS check_name, count(*) FILTER (o_orderstatus IS NULL) AS violations FROM orders
UNION ALL SELECT 'orders', 'range:total_price', count(*) FILTER (NOT o_totalprice BETWEEN 0 AND 400000) FROM orders
UNION ALL SELECT 'order_items', 'null:order_id', count(*) FILTER (l_orderkey IS NULL) FROM lineitem
UNION ALL SELECT 'order_items', 'null:product_id', count(*) FILTER (l_partkey IS NULL) FROM lineitem
UNION ALL SELECT 'order_items', 'null:price', count(*) FILTER (l_extendedprice IS NULL) FROM lineitem
UNION ALL SELECT 'orders', 'duplicate:order_id', count(*) - count(DISTINCT o_orderkey) FROM orders
UNION ALL SELECT 'order_items', 'duplicate:order_id+order_item_id',
       (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
UNION ALL SELECT 'order_items', 'orphan:order_id', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'orders', 'orphan:customer_id', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'order_items', 'orphan:product_id', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'orders', 'null:customer_id', count(*) FILTER (o_custkey IS NULL) FROM orders
