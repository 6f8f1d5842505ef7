-- Five rounds of Lloyd's algorithm in exact integers; vectors and centroids as lists.
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS v,
         sha256('2:' || vec_id::VARCHAR) AS h, embedding::DOUBLE[] AS raw
  FROM embeddings
  WHERE len(embedding) = 64 AND list_count(embedding) = 64 AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
),
part AS MATERIALIZED (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h NULLS LAST, raw) - 1)::INT AS cluster, v FROM kept
  QUALIFY row_number() OVER (ORDER BY h NULLS LAST, raw) <= 40
),
a0 AS MATERIALIZED (
  SELECT r, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d
  FROM (
    SELECT k.r, c.cluster, list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT AS d
    FROM kept k CROSS JOIN c0 c
  ) GROUP BY r
),
m1 AS (
  SELECT cluster, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM a0 JOIN part USING (r) GROUP BY cluster, i
),
c1 AS MATERIALIZED (
  SELECT c.cluster, coalesce(any_value(m.v), any_value(c.v)) AS v
  FROM c0 c LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM m1 GROUP BY cluster
  ) m USING (cluster) GROUP BY c.cluster
),
a1 AS MATERIALIZED (
  SELECT r, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d
  FROM (
    SELECT k.r, c.cluster, list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT AS d
    FROM kept k CROSS JOIN c1 c
  ) GROUP BY r
),
m2 AS (
  SELECT cluster, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM a1 JOIN part USING (r) GROUP BY cluster, i
),
c2 AS MATERIALIZED (
  SELECT c.cluster, coalesce(any_value(m.v), any_value(c.v)) AS v
  FROM c1 c LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM m2 GROUP BY cluster
  ) m USING (cluster) GROUP BY c.cluster
),
a2 AS MATERIALIZED (
  SELECT r, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d
  FROM (
    SELECT k.r, c.cluster, list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT AS d
    FROM kept k CROSS JOIN c2 c
  ) GROUP BY r
),
m3 AS (
  SELECT cluster, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM a2 JOIN part USING (r) GROUP BY cluster, i
),
c3 AS MATERIALIZED (
  SELECT c.cluster, coalesce(any_value(m.v), any_value(c.v)) AS v
  FROM c2 c LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM m3 GROUP BY cluster
  ) m USING (cluster) GROUP BY c.cluster
),
a3 AS MATERIALIZED (
  SELECT r, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d
  FROM (
    SELECT k.r, c.cluster, list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT AS d
    FROM kept k CROSS JOIN c3 c
  ) GROUP BY r
),
m4 AS (
  SELECT cluster, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM a3 JOIN part USING (r) GROUP BY cluster, i
),
c4 AS MATERIALIZED (
  SELECT c.cluster, coalesce(any_value(m.v), any_value(c.v)) AS v
  FROM c3 c LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM m4 GROUP BY cluster
  ) m USING (cluster) GROUP BY c.cluster
),
a4 AS MATERIALIZED (
  SELECT r, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d
  FROM (
    SELECT k.r, c.cluster, list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT AS d
    FROM kept k CROSS JOIN c4 c
  ) GROUP BY r
),
m5 AS (
  SELECT cluster, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM a4 JOIN part USING (r) GROUP BY cluster, i
),
c5 AS MATERIALIZED (
  SELECT c.cluster, coalesce(any_value(m.v), any_value(c.v)) AS v
  FROM c4 c LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM m5 GROUP BY cluster
  ) m USING (cluster) GROUP BY c.cluster
),
a5 AS MATERIALIZED (
  SELECT r, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d
  FROM (
    SELECT k.r, c.cluster, list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT AS d
    FROM kept k CROSS JOIN c5 c
  ) GROUP BY r
),
told AS (
  SELECT cluster, sha256(array_to_string(v, ',')) AS centroid_sha256 FROM c5
)
SELECT k.vec_id, a.cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, t.centroid_sha256
FROM a5 a JOIN kept k USING (r) JOIN told t USING (cluster)
