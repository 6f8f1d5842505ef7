SELECT o_custkey AS customer_id,
       CAST(date_diff('day', max(o_orderdate), TIMESTAMP '2001-08-01') AS INTEGER) AS recency,
       count(*) AS frequency,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS monetary
FROM orders GROUP BY o_custkey
