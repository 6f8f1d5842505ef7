SELECT 'order_id' AS column_name, count(*) FILTER (o_orderpriority = '5-LOW') AS misfits FROM orders
UNION ALL SELECT 'order_date', count(*) FILTER (o_orderstatus = 'P') FROM orders
UNION ALL SELECT 'total_price', count(*) FILTER (o_orderstatus = 'O') FROM orders
UNION ALL SELECT 'status', 0 FROM (SELECT 1)
UNION ALL SELECT 'customer_id', count(*) FILTER (o_orderstatus = 'F' AND o_orderpriority <> '5-LOW') FROM orders
