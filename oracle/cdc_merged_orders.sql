SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CASE WHEN o_orderdate < TIMESTAMP '2000-06-01' THEN 'pending' ELSE o_orderstatus END AS status
FROM orders WHERE o_orderstatus <> 'P'
