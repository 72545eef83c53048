"""DuckDB SQL for the queries that SQL can express."""

WORDS = r"[^\x20\x09-\x0D]+"


def _draw(shard: str) -> str:
    return f"(('0x' || left(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || CAST({shard} AS VARCHAR)), 13))::BIGINT + 0.5) / pow(16, 13)"


def _shard(n: int) -> str:
    return f"CAST(list_aggregate(list_transform(range({n}), lambda s: {{'score': -1.0 / ln({_draw('s')}), 'shard': -s}}), 'max').shard * -1 AS INTEGER)"


SHARDING = f"""
WITH placed AS (
    SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, {_shard(16)} AS shard, {_shard(17)} AS grown_shard FROM documents)
SELECT doc_id, size, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot
FROM placed
"""

MIXING = f"""
WITH sized AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORDS}')), 0) AS BIGINT) AS size FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
    SELECT *, CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS BIGINT) AS weight FROM sources),
filled AS (
    SELECT *, source_size / weight AS at_full,
           coalesce(sum(source_size) OVER before, 0) AS size_before, coalesce(sum(weight) OVER before, 0) AS weight_before,
           sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
    FROM weighed WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT *, (CAST(1.5 AS DOUBLE) * total - 2.0::DOUBLE * size_before) / (weights - weight_before) AS level FROM filled),
found AS (SELECT first(level ORDER BY at_full, source NULLS LAST) AS level FROM levels WHERE at_full * 2.0::DOUBLE > level),
targets AS (
    SELECT source, source_size,
           CAST(CASE WHEN f.level IS NULL THEN 2.0 * source_size ELSE least(2.0::DOUBLE * source_size, f.level * weight) END AS DOUBLE) AS target
    FROM filled, found f),
ranked AS (
    SELECT s.*, t.source_size, t.target,
           row_number() OVER (PARTITION BY s.source ORDER BY size DESC, doc_id NULLS LAST) AS k,
           CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
           ('0x' || left(md5('5|' || coalesce(s.source, '')), 8))::BIGINT / CAST(4294967296 AS DOUBLE) AS shift
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copied AS (SELECT *, CAST(floor(k * rate + shift) - floor((k - 1) * rate + shift) AS BIGINT) AS copies FROM ranked)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM copied
"""

WARC = """
WITH paged AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM paged)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM firsts
"""


def _whole(scale: int) -> str:
    return f"""
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


TOP_K = f"""
WITH whole AS ({_whole(256)}),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
    FROM (SELECT * FROM whole WHERE vec_id % 50 = 0) q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Letters, digits and everything from U+0080.
_TERMS = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
LEXICAL = f"""
WITH words AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERMS}') AS terms FROM documents),
documents_ AS (SELECT row, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM words WHERE len(terms) > 0),
counts AS (SELECT CAST(count(*) AS BIGINT) AS n_all, CAST(sum(n) AS BIGINT) AS l_all FROM documents_),
postings AS (SELECT row, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT row, unnest(terms) AS term FROM documents_) GROUP BY row, term),
holding AS (SELECT term, CAST(count(*) AS BIGINT) AS df FROM postings GROUP BY term),
items AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERMS}')) AS term FROM benchmark),
weighed AS (
    SELECT item_id, term, CAST(floor(1000 * ln(CAST(2 * n_all + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM items JOIN holding USING (term), counts),
scored AS (
    SELECT item_id, doc_id, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_all) // l_all)))) AS BIGINT) AS score
    FROM weighed JOIN postings USING (term) JOIN documents_ USING (row), counts GROUP BY item_id, doc_id, row),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def _nearest(n: int) -> str:
    """Every vector's nearest centroid of round ``n``."""
    gap = "list_sum(list_transform(range(1, 65), lambda i: (v[i] - centre[i]) * (v[i] - centre[i])))"
    return f"""
met{n} AS (
    SELECT line, vec_id, v, min({{'distance': CAST({gap} AS BIGINT), 'cluster': cluster}}) AS best
    FROM kept, centres{n} GROUP BY line, vec_id, v)"""


def _moved(n: int) -> str:
    """The centroids after round ``n``: the floor of the mean; the product with the count is a whole number."""
    mean = "list(CAST((total - ((total % rows + rows) % rows)) // rows AS BIGINT) ORDER BY i)"
    return f"""
totals{n} AS (
    SELECT best.cluster AS cluster, i, CAST(sum(v[i]) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS rows
    FROM met{n - 1}, range(1, 65) AS places(i) GROUP BY 1, 2),
centres{n} AS (
    SELECT c.cluster, coalesce(m.centre, c.centre) AS centre FROM centres{n - 1} c
    LEFT JOIN (SELECT cluster, {mean} AS centre FROM totals{n} GROUP BY cluster) m USING (cluster))"""


CLUSTERS = f"""
WITH kept AS (SELECT row_number() OVER () AS line, vec_id, v FROM ({_whole(64)}) WHERE len(v) = 64),
centres0 AS (
    SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS INTEGER) AS cluster, v AS centre
    FROM kept QUALIFY cluster < 16),
{_nearest(0)}, {_moved(1)}, {_nearest(1)}, {_moved(2)}, {_nearest(2)}, {_moved(3)}, {_nearest(3)}
SELECT vec_id, best.cluster AS cluster, best.distance AS distance,
       CAST(sum(best.distance) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(centre, ',')) AS centroid_sha256
FROM met3 JOIN centres3 c ON c.cluster = best.cluster
"""

ORACLES: dict[str, str] = {
    "op5_mixing": MIXING, "op10_warc": WARC, "op11_exact_top_k": TOP_K, "op12_lexical_search": LEXICAL, "op13_centroid_clusters": CLUSTERS,
}
