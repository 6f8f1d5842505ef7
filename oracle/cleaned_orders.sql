SELECT o_orderkey AS order_id,
       CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'O' THEN o_orderdate - INTERVAL 7 HOUR ELSE o_orderdate END AS order_date,
       CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS total_price,
       CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS status,
       CAST(o_custkey AS INTEGER) AS customer_id,
       '00' || o_custkey AS phone_number,
       CAST(NULL AS INTEGER) AS shipment_id
FROM orders
