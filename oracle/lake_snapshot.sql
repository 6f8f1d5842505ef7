SELECT 'customer' AS table_name, 'SUCCESS' AS status, count(*) AS row_count FROM customer
UNION ALL SELECT 'orders', 'SUCCESS', count(*) FROM orders
UNION ALL SELECT 'lineitem', 'SUCCESS', count(*) FROM lineitem
UNION ALL SELECT 'part', 'SUCCESS', count(*) FROM part
UNION ALL SELECT 'events', 'SUCCESS', count(*) FROM events
UNION ALL SELECT 'no_such_table', 'FAILED', 0
