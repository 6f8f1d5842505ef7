SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(18,2)) AS total_price,
       o_orderstatus AS status, o_orderdate AS order_date
FROM orders WHERE o_orderstatus <> 'P'
