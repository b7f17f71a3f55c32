"""SQL of the operators that SQL can express, over whole tables, written as plainly as it goes."""

from __future__ import annotations

#: What the turns say; the escape puts a backslash after the opening of a control string.
CHAT_FORMAT_SQL = r"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
    SELECT *, regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g') AS head,
           regexp_replace(body, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g') AS escaped
    FROM given
), said AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(role || chr(10) || body || chr(10), '' ORDER BY turn NULLS FIRST, role, body) AS said,
           coalesce(string_agg(body, '' ORDER BY turn NULLS FIRST, role, body) FILTER (role = 'assistant'), '') AS loss,
           sum(length('<|turn|>' || head || '<|text|>' || escaped || '<|end|>') + 1)::BIGINT AS formatted_chars
    FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM said
"""

#: Equal texts after white space is folded, by their text.
EXACT_DEDUP_SQL = r"""
WITH t AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST) = 1 AS kept,
       sha256(body) AS text_sha256
FROM t WINDOW same AS (PARTITION BY body)
"""

#: Every anchor against every row.
HARD_NEGATIVES_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x, row_number() OVER () AS r
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r AS other, b.vec_id, a.label = b.label AS same,
           list_dot_product(a.x, b.x)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r
), positive AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.vec_id)::INTEGER AS "rank",
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n
  ON n.anchor = p.anchor AND NOT n.same AND 100 * n.score BETWEEN 50 * p.score AND 95 * p.score
QUALIFY "rank" <= 3
"""

#: Every vector against every vector.
NEAR_EMBEDDINGS_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, row_number() OVER () AS r,
           CASE WHEN len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
                 AND len(list_filter(embedding, lambda e: e <> 0)) > 0
                THEN list_transform(embedding, lambda e: e::DOUBLE) END AS x
    FROM embeddings
), good AS (
    SELECT r, x, len(x) AS n, sqrt(list_dot_product(x, x)) AS size FROM v WHERE x IS NOT NULL
), links AS (
    SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.n = b.n AND a.r <> b.r
    WHERE CASE WHEN a.n = b.n THEN list_dot_product(a.x, b.x) / (a.size * b.size) END >= 0.9
), steps AS (
    SELECT a, b FROM links
    UNION SELECT a.r, b.r FROM v a JOIN v b ON a.vec_id = b.vec_id AND a.r <> b.r
), reach AS (
    SELECT r AS a, r AS b FROM v
    UNION SELECT reach.a, steps.b FROM reach JOIN steps ON reach.b = steps.a
), component AS (
    SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a
)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN component USING (r) LEFT JOIN (SELECT a AS r, count(*) AS n_links FROM links GROUP BY a) USING (r)
"""

#: Words one deletion apart, or alike without one place; CRC-32 by its table of 256.
SPELLING_SQL = """
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (
    SELECT run, times, xor(4294967295, list_reduce([4294967295] || flatten(list_transform(
        string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
        lambda s: CASE WHEN unicode(s) < 128 THEN [unicode(s)::BIGINT] ELSE [192 + (unicode(s) >> 6), 128 + (unicode(s) & 63)]::BIGINT[] END)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
    FROM runs, crc
), words AS (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
           sum(times)::BIGINT AS n
    FROM hashed GROUP BY word HAVING length(word) >= 6 AND sum(times) >= 5
), shorter AS (
    SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n
    FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
    FROM near GROUP BY word
), formed AS (
    SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near,
           CASE WHEN other_n >= 5 * n THEN other END AS form, CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
    FROM words LEFT JOIN best USING (word)
), roots AS (
    SELECT word AS root, word FROM formed WHERE form IS NULL
    UNION ALL SELECT root, formed.word FROM roots JOIN formed ON formed.form = roots.word
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""

#: Exact overlap of all texts that share a run of words.
NEAR_MINHASH_SQL = r"""
WITH RECURSIVE given AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), classes AS (
    SELECT w, min(doc_id) AS class_id FROM given WHERE len(w) > 0 GROUP BY w
), bags AS (
    SELECT class_id, run, count(*) AS n
    FROM (SELECT class_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS run FROM classes)
    GROUP BY ALL
), sizes AS (
    SELECT class_id, sum(n) AS size FROM bags GROUP BY class_id
), links AS (
    SELECT a.class_id AS a, b.class_id AS b
    FROM bags a JOIN bags b ON a.run = b.run AND a.class_id <> b.class_id
    JOIN sizes p ON p.class_id = a.class_id JOIN sizes q ON q.class_id = b.class_id
    GROUP BY ALL HAVING 10 * sum(least(a.n, b.n)) >= 8 * (any_value(p.size + q.size) - sum(least(a.n, b.n)))
), reach AS (
    SELECT class_id AS a, class_id AS b FROM sizes
    UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), component AS (
    SELECT a AS class_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, len(given.w)::BIGINT AS n_words, coalesce(class_id, doc_id) AS class_id,
       coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept
FROM given LEFT JOIN classes ON classes.w = given.w LEFT JOIN component USING (class_id)
"""

#: Every string of 400 bytes, as hexadecimal digits cut from blocks of 128 places.
SUFFIX_DEDUP_SQL = """
WITH RECURSIVE given AS (
    SELECT doc_id, row_number() OVER () AS r, hex(coalesce(text, '')) AS digits, length(hex(coalesce(text, ''))) // 2 AS n_bytes
    FROM documents
), blocks AS (
    SELECT r, lo, least(128, n_bytes - 399 - lo) AS places, substr(digits, 2 * lo + 1, 2 * 527) AS digits
    FROM (SELECT *, unnest(range(0, n_bytes - 399, 128)) AS lo FROM given)
), strings AS MATERIALIZED (
    SELECT r, lo + i AS start, md5_number(substr(digits, 2 * i + 1, 800)) AS string
    FROM (SELECT *, unnest(range(places)) AS i FROM blocks)
), found AS (
    SELECT r, start FROM strings WHERE string IN (SELECT string FROM strings GROUP BY string HAVING count(*) > 1)
), marked AS (
    SELECT r, start, start > coalesce(lag(start) OVER (PARTITION BY r ORDER BY start) + 400, -1) AS opens FROM found
), spans AS (
    SELECT r, min(start) AS lo, max(start) + 400 AS hi
    FROM (SELECT r, start, count(*) FILTER (opens) OVER (PARTITION BY r ORDER BY start) AS span FROM marked) GROUP BY r, span
), stays AS (
    SELECT r, hi AS lo, lead(spans.lo) OVER (PARTITION BY r ORDER BY spans.lo, spans.hi) AS hi
    FROM (SELECT r, lo, hi FROM spans UNION ALL SELECT r, 0, 0 FROM given) AS spans
), left_over AS (
    SELECT r, string_agg(substr(digits, 2 * lo + 1, 2 * (coalesce(hi, n_bytes) - lo)), '' ORDER BY lo) AS digits
    FROM stays JOIN given USING (r) GROUP BY r
)
SELECT doc_id, n_bytes::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(left_over.digits)) AS kept_sha256
FROM given JOIN left_over USING (r) LEFT JOIN (SELECT r, sum(hi - lo) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r) USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_chat_format": CHAT_FORMAT_SQL,
        "op4_suffix_dedup": SUFFIX_DEDUP_SQL,
        "op5_near_embeddings": NEAR_EMBEDDINGS_SQL,
        "op6_near_minhash": NEAR_MINHASH_SQL,
        "op11_exact_dedup": EXACT_DEDUP_SQL,
        "op12_hard_negatives": HARD_NEGATIVES_SQL,
        "op13_spelling_groups": SPELLING_SQL,
    }
