"""DuckDB SQL for the dealt operators that SQL can express."""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest, coalesce(text, '') AS body,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST(kind + 1 AS DOUBLE) AS weight, 3 * source_size AS cap FROM totals
), -- the level: the least x with sum(min(cap, x * weight)) = all words, tried at every source's own stop
tried AS (
  SELECT a.cap / a.weight AS stop,
         ((SELECT sum(source_size) FROM weighed) - coalesce(sum(b.cap) FILTER (WHERE b.cap / b.weight < a.cap / a.weight), 0))
         / sum(b.weight) FILTER (WHERE b.cap / b.weight >= a.cap / a.weight) AS level
  FROM weighed a, weighed b GROUP BY a.source, a.cap, a.weight
), goals AS (
  SELECT source, source_size, kind,
         least(CAST(cap AS DOUBLE), (SELECT arg_min(level, stop) FROM tried WHERE level <= stop) * weight) AS target
  FROM weighed
), placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.kind,
         CAST(CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 0 END AS BIGINT) AS passes,
         CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.digest, s.size, md5(s.body)
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), cut AS (
  SELECT *, greatest(0, least(size, CAST(round(target - passes * source_size) AS BIGINT) - ahead)) AS part FROM placed
), shared AS (
  SELECT *, passes * size + part AS taken,
         least(1.0, (ahead + (CASE WHEN passes > 0 THEN size ELSE part END) / 2.0) / target) AS share
  FROM cut
)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN taken > 0 THEN round(CASE kind
         WHEN 0 THEN (sqrt(0.25 + 2 * share) - 0.5)            -- demand t/2 + t^2/2
         WHEN 1 THEN share
         ELSE 1.5 - sqrt(2.25 - 2 * share) END, 6) END AS first_position  -- demand 3t/2 - t^2/2
FROM shared
"""


def _clustering(centroids: int = 16, components: int = 64, scale: int = 64, rounds: int = 3, salt: str = "1") -> str:
    """Every distance to every centroid, round by round."""
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {components} AND len(list_filter(embedding, lambda x: isfinite(x))) = {components}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS n, v FROM (
    SELECT sha256('{salt}:' || vec_id) AS h, v FROM kept ORDER BY h NULLS LAST, v LIMIT {centroids}))"""
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (
  SELECT r, n, d FROM (
    SELECT r, n, d, row_number() OVER (PARTITION BY r ORDER BY d, n) AS place FROM (
      SELECT r, n, CAST(list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
      FROM kept k, c{i} c)) WHERE place = 1)"""
        )
        if i < rounds:
            parts.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT c.n, coalesce(f.v, c.v) AS v FROM c{i} c LEFT JOIN (
    SELECT n, list(CAST((s - ((s % m) + m) % m) // m AS BIGINT) ORDER BY j) AS v FROM (
      SELECT n, j, sum(x) AS s, count(*) AS m FROM (
        SELECT n, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM kept JOIN a{i} USING (r)) GROUP BY n, j) GROUP BY n) f ON c.n = f.n)"""
            )
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(a.n AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.n) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept USING (r) JOIN c{rounds} c ON a.n = c.n"""


CLUSTERING = _clustering()


RESAMPLING = r"""
WITH codes AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
              lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS code
  FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))
), texts AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark
), words AS MATERIALIZED (
  SELECT side, r, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM texts
), buckets AS MATERIALIZED (  -- crc32 of each word, byte by byte from its hexadecimal digits
  SELECT w, xor(list_reduce(
           list_concat([4294967295], list_transform(range(1, CAST(length(h) AS BIGINT), 2),
             lambda i: CAST((strpos('0123456789ABCDEF', substr(h, i, 1)) - 1) * 16 + strpos('0123456789ABCDEF', substr(h, i + 1, 1)) - 1 AS BIGINT))),
           lambda c, b: xor(c >> 8, code[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT w, hex(encode(w)) AS h FROM words), codes
), counts AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM words JOIN buckets USING (w) GROUP BY bucket
), totals AS (
  SELECT sum(s) AS all_s, sum(t) AS all_t FROM counts
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM counts, totals
), weights AS (
  SELECT r, count(*) AS n_features, sum(gain) AS weight FROM words JOIN buckets USING (w) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM texts LEFT JOIN weights USING (r) WHERE side = 'd'
), placed AS (
  SELECT doc_id, n_features, weight, CAST(weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM scored
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
         count(*) FILTER (n_features >= 20) OVER () AS many
  FROM placed
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * many // 100 THEN place END AS "rank" FROM ranked
"""
