SELECT 'order_id' AS column_name, count(*) - count(o_orderkey) AS nulls, count(o_orderkey) = 0 AS all_null FROM orders
UNION ALL SELECT 'order_date', count(*) - count(o_orderdate), count(o_orderdate) = 0 FROM orders
UNION ALL SELECT 'total_price', count(*) - count(o_totalprice), count(o_totalprice) = 0 FROM orders
UNION ALL SELECT 'status', count(*) - count(nullif(o_orderstatus, 'P')), count(nullif(o_orderstatus, 'P')) = 0 FROM orders
UNION ALL SELECT 'customer_id', count(*) - count(o_custkey), count(o_custkey) = 0 FROM orders
UNION ALL SELECT 'shipment_id', count(*), true FROM orders
