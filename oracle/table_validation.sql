SELECT 'customer' AS table_name, count(*) AS row_count, 'c_email' AS missing_cols, false AS ok FROM customer
UNION ALL SELECT 'orders', count(*), '', count(*) > 0 FROM orders
UNION ALL SELECT 'lineitem', count(*), '', count(*) > 0 FROM lineitem
UNION ALL SELECT 'part', count(*), '', count(*) > 0 FROM part
