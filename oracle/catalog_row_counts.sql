SELECT 'customer' AS table_name, count(*) AS row_count FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'part', count(*) FROM part
