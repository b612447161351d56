"""SQL counterparts of the corpus queries that SQL can express."""

from __future__ import annotations

from .shards import HASH_BITS, LIMIT_BYTES
from .warc import _BASE32

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = r"[^\x20\x09-\x0D]+"

_DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark WHERE item_id IS NOT NULL),
sized AS (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS words
    FROM sized, unnest(range(1, len(w) - n + 2)) AS t(i)
),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS words
    FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n
),
found AS (SELECT p.doc_id, p.i, p.n, x.item_id FROM places p JOIN windows x ON x.words = p.words AND x.n = p.n),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM found, unnest(range(i, i + n)) AS t(k) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_SUBSTRING = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
windows AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS words
    FROM d, unnest(range(1, len(w) - 48)) AS t(i) WHERE len(w) >= 50
),
first AS (SELECT words, min(doc_id) AS least FROM windows GROUP BY words),
gone AS (
    SELECT DISTINCT doc_id, k FROM windows JOIN first USING (words), unnest(range(i, i + 50)) AS t(k)
    WHERE least < doc_id
),
words AS (SELECT doc_id, k, w[k] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(k)),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS left_over
    FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
    sha256(coalesce(left_over, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_SHARDS = f"""
WITH r AS (
    SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
    FROM documents
),
e AS (SELECT r.*, d::INTEGER AS d, h >> ({HASH_BITS} - d)::INTEGER AS prefix FROM r, unnest(range(0, {HASH_BITS + 1})) AS t(d)),
buckets AS (SELECT d, prefix, sum(n_bytes)::BIGINT AS shard_bytes FROM e GROUP BY d, prefix),
fitting AS (
    SELECT e.*, shard_bytes FROM e JOIN buckets USING (d, prefix) WHERE shard_bytes <= {LIMIT_BYTES}
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY d) = 1
)
SELECT doc_id, n_bytes, CASE WHEN d = 0 THEN '' ELSE lpad(bin(prefix), d, '0') END AS shard, shard_bytes,
    shard_bytes <= {LIMIT_BYTES} AS fits
FROM fitting
"""

_GROUPS = " || ".join(
    f"substr('{_BASE32}', ((('0x' || substr(hex, {i}, 5))::INTEGER >> {shift}) & 31) + 1, 1)"
    for i in range(1, 41, 5)
    for shift in (15, 10, 5, 0)
)

_WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT payload, min(page_id) AS first_id FROM p GROUP BY payload)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, {_GROUPS} AS payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to, TRUE AS verified
FROM p JOIN f USING (payload)
"""

_HARD_NEGATIVES = """
WITH r AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
n AS (
    SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS place
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE place <= 3
"""

# bytes as pairs of hexadecimal digits, so that slices of them are slices of text
_SUFFIX = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
    SELECT r, i, md5(substr(h, 2 * i + 1, 400)) AS m
    FROM d, unnest(range(0, greatest(len(h) // 2 - 199, 0))) AS t(i)
),
again AS (SELECT r, i FROM w QUALIFY count(*) OVER (PARTITION BY m) > 1),
marked AS (
    SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 200 THEN 0 ELSE 1 END AS head FROM again
),
numbered AS (SELECT r, i, sum(head) OVER (PARTITION BY r ORDER BY i) AS g FROM marked),
runs AS (SELECT r, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY r, g),
gaps AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS since FROM runs),
cut AS (
    SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
        string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS kept
    FROM gaps JOIN d USING (r) GROUP BY r
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
    coalesce(n_spans, 0)::BIGINT AS n_spans,
    sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""

# components: the smallest id that a chain of links leads to
_REACHED = """
both_ways AS (SELECT x AS a, y AS b FROM links UNION ALL SELECT y, x FROM links),
reached(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reached r JOIN both_ways l ON l.a = r.b),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
"""

_NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 2], ' ')) AS m
    FROM d, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS t(i) WHERE len(w) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM s a JOIN s b ON a.m = b.m AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y FROM shared i JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
    WHERE 100 * i.n >= 85 * (a.n + b.n - i.n)
),
{_REACHED}
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(least.b, d.doc_id)) AS component_id,
    d.doc_id <= coalesce(least.b, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.a = d.doc_id
"""

_NEAR_VECTORS = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c <> 0)) > 0
        AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
),
links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
),
{_REACHED},
counts AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT e.vec_id, coalesce(counts.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(least.b, e.vec_id)) AS component_id,
    e.vec_id <= coalesce(least.b, e.vec_id) AS kept
FROM embeddings e LEFT JOIN counts ON counts.a = e.vec_id LEFT JOIN least ON least.a = e.vec_id
"""

ORACLE_SQL: dict[str, str] = {
    "op2_suffix_dedup": _SUFFIX,
    "op3_decontamination": _DECONTAMINATION,
    "op4_substring_dedup": _SUBSTRING,
    "op6_sharding": _SHARDS,
    "op8_embedding_dedup": _NEAR_VECTORS,
    "op9_warc": _WARC,
    "op10_minhash": _NEAR_DUPLICATES,
    "op12_hard_negatives": _HARD_NEGATIVES,
}
