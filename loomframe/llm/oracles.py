"""DuckDB SQL for the operators that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op1_rotation_codes"] = r"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n
    FROM embeddings
    WHERE embedding IS NOT NULL AND label IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    WHERE list_dot_product(a.e, b.e) / a.n / b.n >= 0.93
),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
low AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
many AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, coalesce(many.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(low.y, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(low.y, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN low ON low.x = e.vec_id LEFT JOIN many ON many.x = e.vec_id
"""

ORACLES["op2_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w WHERE len(w) >= 20)
),
later AS (
    SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM w),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
    FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT w.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

ORACLES["op4_chat_machine"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
),
t AS (
    SELECT *, row_number() OVER o AS n, lag(role) OVER o AS before, lead(role) OVER o IS NULL AS last,
           len(text) + len(role) + len(regexp_extract_all(role || text, '<\|im_start\|>|<\|im_sep\|>|<\|im_end\|>|<s>|</s>|\[INST\]|\[/INST\]|<\|endoftext\|>|\\'))
             + len('<|im_start|><|im_sep|><|im_end|>') AS chars
    FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars,
       bool_and(
           (coalesce(before, ''), role) IN (
               ('', 'system'), ('', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user'), ('assistant', 'tool'), ('tool', 'assistant'))
           AND (NOT last OR role = 'assistant')) AS legal
FROM t GROUP BY conv_id
"""

ORACLES["op6_minhash"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
    FROM w
),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
low AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(low.y, s.doc_id)) AS component_id,
       s.doc_id = least(s.doc_id, coalesce(low.y, s.doc_id)) AS kept
FROM sets s LEFT JOIN low ON low.x = s.doc_id
"""

ORACLES["op12_ball_tree"] = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes),
damped AS (SELECT doc_id, 10 + (90 * n * docs) // total AS m FROM sizes, totals),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals
),
scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN damped USING (doc_id) GROUP BY item_id, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""

ORACLES["op11_integer_repair"] = r"""
WITH RECURSIVE crcs AS (
    SELECT list_transform(range(256), lambda n: list_reduce(
        list_prepend(n, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
checked AS (
    SELECT c.*, xor(list_reduce(
        list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
    FROM conversations c, crcs
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(coalesce(text, ' '), '.!?', '') ELSE coalesce(text, ' ') END AS text
    FROM checked, LATERAL unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copies(c)
    WHERE kind <> 0
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
),
judged AS (
    SELECT conv_id, turn, i, role, text, CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE '?' END AS initial,
           right(rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 1) AS final,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS copy
    FROM placed
),
rows AS (
    SELECT *, CASE WHEN final = '' THEN 'blank' WHEN copy > 1 THEN 'duplicate' WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM judged
),
put(a, b, cost, said) AS (
    VALUES ('-', '-', 0, ''), ('-', 'u', 5, 'I'), ('-', 'a', 10, 'II'), ('s', 's', 0, ''), ('s', 'u', 5, 'I'), ('s', 'a', 10, 'II'),
           ('u', 'u', 0, ''), ('u', 'a', 5, 'I'), ('a', 'a', 0, ''), ('a', 'u', 5, 'I')
),
follows(a, b) AS (VALUES ('-', 's'), ('-', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
steps(initial, fault, a, b, cost, said) AS (
    SELECT initial, fault, m.a, put.b, m.cost + put.cost, m.said || put.said
    FROM (
        SELECT initial, fault, a, a AS b, 2 AS cost, 'D' AS said FROM (SELECT DISTINCT initial, fault FROM rows), (SELECT DISTINCT a FROM put)
        UNION ALL
        SELECT initial, fault, a, b, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, 'K'
        FROM (SELECT DISTINCT initial, fault FROM rows WHERE fault NOT IN ('blank', 'duplicate')) JOIN follows ON b = initial
        UNION ALL
        SELECT initial, fault, a, b, CASE fault WHEN 'truncated' THEN 6 ELSE 1 END, 'R'
        FROM (SELECT DISTINCT initial, fault FROM rows WHERE fault NOT IN ('blank', 'duplicate')), follows WHERE b IN ('u', 'a')
    ) m JOIN put ON put.a = m.b
),
walk(conv_id, i, state, best) AS (
    SELECT c.conv_id, 0::BIGINT, put.b, {'cost': put.cost, 'audit': put.said} FROM (SELECT DISTINCT conv_id FROM rows) c, put WHERE put.a = '-'
    UNION ALL
    SELECT w.conv_id, w.i + 1, s.b, min({'cost': w.best.cost + s.cost, 'audit': w.best.audit || s.said})
    FROM walk w JOIN rows r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
    JOIN steps s ON s.initial = r.initial AND s.fault = r.fault AND s.a = w.state
    GROUP BY w.conv_id, w.i, s.b
),
counts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM rows GROUP BY conv_id
),
ends AS (
    SELECT w.conv_id, min(w.best) AS best FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i
    WHERE w.state IN ('-', 'a') GROUP BY w.conv_id
),
spelled AS (
    SELECT conv_id, k, best.audit[k] AS letter, k - len(replace(best.audit[1:k], 'I', '')) AS put_in,
           len(replace(best.audit, 'D', '')) - len(replace(best.audit[1:k], 'D', '')) AS after
    FROM (SELECT conv_id, best, unnest(range(1, len(best.audit) + 1)) AS k FROM ends)
),
repaired AS (
    SELECT s.conv_id, string_agg(CASE s.letter WHEN 'K' THEN r.role ELSE CASE WHEN s.after % 2 = 0 THEN 'assistant' ELSE 'user' END END
           || ':' || CASE s.letter WHEN 'I' THEN '' ELSE r.text END, chr(10) ORDER BY k) AS said
    FROM spelled s LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.k - s.put_in AND s.letter <> 'I'
    WHERE s.letter <> 'D' GROUP BY s.conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
       coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(e.best.cost, 0)::BIGINT AS cost,
       coalesce(e.best.audit, '') AS audit, sha256(coalesce(p.said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired p ON p.conv_id IS NOT DISTINCT FROM o.conv_id
"""
