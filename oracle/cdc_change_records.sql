SELECT 'orders' AS table_name, 'c' AS op, false AS deleted, count(*) AS records, max(o_orderkey) * 10 AS last_lsn FROM orders
UNION ALL
SELECT 'orders', 'u', false, count(*) + count(*) FILTER (o_orderpriority = '5-LOW'), max(o_orderkey) * 10 + 1 FROM orders
UNION ALL
SELECT 'orders', 'd', true, count(*), max(o_orderkey) * 10 + 2 FROM orders WHERE o_orderstatus = 'P'
