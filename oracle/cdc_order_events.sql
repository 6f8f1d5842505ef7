SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(18,2)) AS total_price,
       'pending' AS status, epoch_ms(o_orderdate) AS "timestamp", 'c' AS op, o_orderkey * 10 AS lsn
FROM orders
UNION ALL
SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)), o_orderstatus, epoch_ms(o_orderdate), 'u',
       o_orderkey * 10 + 1
FROM orders
