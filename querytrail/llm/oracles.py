"""DuckDB SQL for the queries of :mod:`querytrail.llm.queries` that it can express."""

CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
    SELECT *, replace(replace(replace(role, '\', '\\'), '### ', '\h'), '</turn>', '\t') AS erole,
           replace(replace(replace(text, '\', '\\'), '### ', '\h'), '</turn>', '\t') AS etext
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('### ') + length(replace(erole, ':', '\c')) + 2 + length(etext) + length('</turn>') + 1)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""

TOPK = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""

CONTAINED = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents
), i AS (
    SELECT DISTINCT item_id, text AS item, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark
), lengths AS (
    SELECT DISTINCT least(len(w), 5) AS k FROM i WHERE len(w) > 0
), ds AS (
    SELECT DISTINCT r, doc_id, array_to_string(w[j:j+k-1], ' ') AS s
    FROM (SELECT r, doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS j FROM d JOIN lengths ON len(w) >= k)
), iss AS (
    SELECT DISTINCT item_id, item, array_to_string(w[j:j+4], ' ') AS s
    FROM (SELECT item_id, item, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS j FROM i WHERE len(w) > 0)
), sized AS (SELECT *, count(*) OVER (PARTITION BY item_id, item) AS n FROM iss),
hits AS (SELECT r, doc_id, item_id, item, n, count(*) AS c FROM ds JOIN sized USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n AS n_shingles, c AS n_found, c / n AS containment
FROM hits WHERE c >= 0.8 * n - 1e-9
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY c / n DESC, n DESC) = 1
"""

WINDOWS = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), starts AS (
    SELECT r, i, md5(array_to_string(w[i:i+34], ' ')) AS s
    FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
), gone AS (
    SELECT DISTINCT r, unnest(range(i, i + 35)) AS k FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS c FROM starts) WHERE c > 1
), words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS t FROM words ANTI JOIN gone USING (r, k) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

RANKED = r"""
WITH dt AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
    FROM documents WHERE text IS NOT NULL
), d AS (SELECT r, doc_id, t, len(t)::BIGINT AS n FROM dt WHERE len(t) > 0),
corpus AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM d),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
weight AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), corpus),
items AS (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL),
terms AS (
    SELECT DISTINCT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM items
), scored AS (
    SELECT item_id, text, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l))))::BIGINT AS score
    FROM terms JOIN weight USING (term) JOIN tf USING (term) JOIN d USING (r), corpus GROUP BY item_id, text, r
)
SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank, doc_id, score
FROM scored JOIN d USING (r) WHERE score > 0 QUALIFY rank <= 10
"""

SQL: dict[str, str] = {"op1_chat_format": CHAT, "op6_decontaminate": CONTAINED, "op10_topk_search": TOPK, "op12_relative_lz": WINDOWS, "op13_ranked_search": RANKED}
