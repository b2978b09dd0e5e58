"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _base32(digest: str) -> str:
    """Base32 of a 160-bit hexadecimal digest: five hexadecimal digits are four letters."""
    letters = [
        f"substr('{_BASE32}', 1 + ((('0x' || substr({digest}, {1 + 5 * i}, 5))::BIGINT >> {15 - 5 * j}) & 31)::INT, 1)"
        for i in range(8)
        for j in range(4)
    ]
    return " || ".join(letters)


OP9 = f"""
WITH paid AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), first AS (
  SELECT payload, min(page_id) AS first FROM paid GROUP BY payload
), hashed AS (
  SELECT page_id, first, strlen(payload) AS payload_bytes, sha1(payload) AS digest
  FROM paid JOIN first USING (payload)
)
SELECT page_id, payload_bytes, {_base32("digest")} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM hashed
"""

# Words are split at ASCII white space; the sets are compared over an inverted index of shingles.
OP4 = """
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), shingled AS (
  SELECT DISTINCT doc_id, unnest(CASE
           WHEN len(words) = 0 THEN CAST([] AS VARCHAR[])
           WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
           ELSE list_transform(range(1, len(words) - 2),
                               lambda i: array_to_string(words[i:i + 3], ' ')) END) AS shingle
  FROM split
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared
  FROM shingled a JOIN shingled b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY 1, 2
), links AS (
  SELECT u, v FROM pairs JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v
  WHERE 100 * shared >= 80 * (a.n + b.n - shared)
), reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION
  SELECT node, v FROM reach JOIN links ON u = other
), comps AS (
  SELECT node, min(other) AS component_id FROM reach GROUP BY node
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, component_id, component_id = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN comps ON node = d.doc_id
"""

# A chunk is two filled lines in a row; a filled line owns the blank ones after it, and goes with a repeated chunk.
OP5 = """
WITH split AS (
  SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL
), lines AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM split
), owned AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(13)) <> '' AS filled,
         sum((trim(line, ' ' || chr(9) || chr(13)) <> '')::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM lines
), chunks AS (
  SELECT doc_id, k, line, lead(line) OVER (PARTITION BY doc_id ORDER BY k) AS below FROM owned WHERE filled
), repeats AS (
  SELECT doc_id, k FROM chunks WHERE below IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY line, below ORDER BY doc_id, k) > 1
), gone AS (
  SELECT doc_id, k FROM repeats UNION SELECT doc_id, k + 1 FROM repeats
), runs AS (
  SELECT doc_id, count(*) AS n FROM gone WHERE (doc_id, k - 1) NOT IN (SELECT (doc_id, k) FROM gone) GROUP BY doc_id
), kept AS (
  SELECT o.doc_id, string_agg(line, chr(10) ORDER BY i) FILTER (g.k IS NULL) AS text, count(g.k) AS removed_lines
  FROM owned o LEFT JOIN gone g ON g.doc_id = o.doc_id AND g.k = o.k GROUP BY o.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text,
       coalesce(runs.n, 0) AS removed_chunks, coalesce(removed_lines, 0) AS removed_lines
FROM documents d LEFT JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN runs ON runs.doc_id = d.doc_id
"""

def _centroid_rounds(rounds: int) -> str:
    """Rounds of assignment to the nearest centroid, and of moving centroids to floors of means."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT row, vec_id, x, k, d FROM (
    SELECT row, vec_id, x, k, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM kept CROSS JOIN c{i})
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, k) = 1
)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
    SELECT k, i, sum(v)::HUGEINT AS s, count(*) AS n
    FROM (SELECT k, unnest(x) AS v, unnest(range(64)) AS i FROM a{i}) GROUP BY k, i) GROUP BY k
  UNION ALL
  SELECT k, c FROM c{i} WHERE k NOT IN (SELECT k FROM a{i})
)""")
    return ",\n".join(steps)


OP13 = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS HUGEINT)) AS x
  FROM embeddings
  WHERE len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64 AND len(embedding) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), x) - 1 AS k, x AS c FROM kept
  QUALIFY k < 8
),
{_centroid_rounds(10)}
SELECT vec_id, k::INTEGER AS cluster, d::BIGINT AS distance,
       sum(d) OVER (PARTITION BY k)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a10 JOIN c10 USING (k)
"""

ORACLES: dict[str, str] = {
    "op4_near_duplicates": OP4,
    "op5_line_chunks": OP5,
    "op9_warc": OP9,
    "op13_centroids": OP13,
}
