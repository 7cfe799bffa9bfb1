"""DuckDB SQL for the queries that SQL can express, written from their definitions."""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_A_Z = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
WITH items AS (
  SELECT item_id, regexp_extract_all({_A_Z.format("text")}, '{_WORD}') AS w
  FROM benchmark WHERE text IS NOT NULL
), sized AS (
  SELECT item_id, w, least(10, len(w)) AS k FROM items WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS gram
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all({_A_Z.format("text")}, '{_WORD}'), []) AS w
  FROM documents
), grams AS (
  SELECT r, k, i, array_to_string(w[i : i + k - 1], ' ') AS gram
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM docs, (SELECT DISTINCT k FROM windows))
), hits AS (
  SELECT g.r, g.i, g.k, x.item_id FROM grams g JOIN windows x USING (k, gram)
), words AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL)
  GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN named USING (r)
"""

OP3 = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM rows q JOIN rows c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP10 = """
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), firsts AS (
  SELECT body, max(page_id) AS first, count(*) AS copies FROM rows WHERE n >= 1000 GROUP BY body
)
SELECT page_id, n AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM rows LEFT JOIN firsts USING (body)
"""

OP11 = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
         coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM rows a JOIN rows c ON a.vec_id <> c.vec_id
  WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

OP12 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece,
         regexp_extract_all(t, '[^ \\t]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array({_A_Z.format("coalesce(text, '')")},
                                                  '[.,;:!?\\n\\x0B\\f\\r]')) AS t
        FROM documents)
), words AS (
  SELECT lang, piece, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), counts AS (
  SELECT lang, size, phrase, count(*) AS f
  FROM (SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase
        FROM words, range(1, 5) AS s(size) WHERE i + size - 1 <= len(w))
  GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang
), frequent AS (
  SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE f >= 30
), candidates AS (
  SELECT lang, size, phrase, w, f AS a FROM frequent WHERE size > 1
), cuts AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : k], ' ')
  JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1 : c.size], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS i
        FROM (SELECT *, unnest(range(2, size)) AS m FROM candidates))
  GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM best LEFT JOIN inside USING (lang, phrase) JOIN totals USING (lang)
WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
QUALIFY rank <= 2000
"""

_TAILS = r"(/?(?:INST|ROLE|TURN)\]|</?SYS>>|/?s>)"
_CONTROL = r"\[/?(?:INST|ROLE|TURN)\]|<</?SYS>>|</?s>"

OP13 = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, regexp_matches(text, '{_CONTROL}') OR regexp_matches(text, '([\[<])\\(\\*){_TAILS}')
         AS conflict
  FROM rows
), sized AS (
  SELECT *, length(CASE WHEN conflict
                        THEN regexp_replace(text, '([\[<])(\\*){_TAILS}', '\1\\\2\3', 'g')
                        ELSE text END)
         + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 15 WHEN 'assistant' THEN 7
           ELSE 26 + length(regexp_replace(role, '([\[<])(\\*){_TAILS}', '\1\\\2\3', 'g')) END AS n
  FROM marked
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
         AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars,
       count_if(conflict)::BIGINT AS n_escaped
FROM sized GROUP BY conv_id
"""

SQL = {
    "op1_decontamination": OP1,
    "op3_exact_top_k": OP3,
    "op10_warc": OP10,
    "op11_hard_negatives": OP11,
    "op12_collocations": OP12,
    "op13_chat_format": OP13,
}
