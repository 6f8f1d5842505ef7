SELECT 'user:' || o_custkey || ':interactions' AS key, CAST(l_partkey AS VARCHAR) AS field,
       '{"product_id":' || l_partkey || ',"score":' || CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) || '}' AS value
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
GROUP BY o_custkey, l_partkey
