WITH spend AS (
  SELECT c_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spent
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey
)
SELECT CASE WHEN spent >= 3500000 THEN 'High Value' WHEN spent >= 2000000 THEN 'Medium Value'
            ELSE 'Low Value' END AS customer_segment,
       count(*) AS customers
FROM spend GROUP BY 1
