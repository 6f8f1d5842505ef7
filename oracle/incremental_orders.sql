SELECT o_orderkey AS order_id, date_trunc('day', o_orderdate) AS order_date, CAST(o_totalprice AS DECIMAL(18,2)) AS total_price,
       o_orderstatus AS status, o_custkey AS customer_id
FROM orders
