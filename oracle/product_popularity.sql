SELECT l_partkey AS product_id, count(*) AS purchase_count,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(l_extendedprice) AS avg_price
FROM lineitem GROUP BY l_partkey
