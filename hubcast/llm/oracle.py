"""DuckDB SQL of the text queries that SQL can express, on the same tables."""

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

EXACT = f"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""

# The level of the water-filling is found by trying every count of capped sources.
MIX = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
                  md5('17/' || coalesce(doc_id::VARCHAR, ''))[1:3] AS draw FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size) AS cap,
             [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
      FROM d GROUP BY source),
levels AS (SELECT a.source, any_value(a.cap / a.weight) AS ratio,
                  any_value(w.wanted) - coalesce(sum(CASE WHEN b.cap / b.weight < a.cap / a.weight THEN b.cap END), 0.0) AS rest,
                  sum(CASE WHEN b.cap / b.weight >= a.cap / a.weight THEN b.weight END) AS open
           FROM s a, s b, (SELECT 1.5::DOUBLE * sum(source_size) AS wanted FROM s) w GROUP BY a.source),
level AS (SELECT max(rest / open) AS lvl FROM levels WHERE rest / open <= ratio),
t AS (SELECT source, source_size,
             CASE WHEN source_size = 0 THEN 0.0 ELSE least(cap, coalesce(lvl * weight, cap)) END::DOUBLE AS target FROM s, level),
q AS (SELECT source, draw, sum(size) AS part FROM d GROUP BY source, draw),
c AS (SELECT q.source, q.draw, q.part, t.source_size, t.target,
             CASE WHEN t.source_size = 0 THEN 0 ELSE floor(t.target / t.source_size)::BIGINT END AS whole,
             row_number() OVER (PARTITION BY q.source ORDER BY 16 * q.part > t.source_size DESC, q.draw) AS i
      FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source),
walk AS (SELECT source, 0::BIGINT AS i, any_value(target - whole * source_size)::DOUBLE AS gap, NULL::VARCHAR AS draw, 0::HUGEINT AS part, true AS joins
         FROM c GROUP BY source
         UNION ALL
         SELECT c.source, c.i, CASE WHEN w.gap > 0 AND c.part <= w.gap THEN w.gap - c.part ELSE w.gap END, c.draw, c.part,
                w.gap > 0 AND c.part <= w.gap
         FROM walk w JOIN c ON c.source IS NOT DISTINCT FROM w.source AND c.i = w.i + 1),
rest AS (SELECT source, arg_max(gap, i) AS gap FROM walk GROUP BY source),
least AS (SELECT source, draw, part FROM walk WHERE NOT joins
          QUALIFY row_number() OVER (PARTITION BY source ORDER BY part, draw) = 1),
more AS (SELECT source, draw FROM walk WHERE joins AND i > 0
         UNION ALL SELECT l.source, l.draw FROM least l JOIN rest ON l.source IS NOT DISTINCT FROM rest.source AND l.part < 2 * rest.gap)
SELECT d.doc_id, d.size, c.source_size, c.target,
       (d.size * (whole + CASE WHEN m.draw IS NOT NULL THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.draw = c.draw
LEFT JOIN more m ON d.source IS NOT DISTINCT FROM m.source AND d.draw = m.draw
"""

CONTROL = r"\### Assistant: </turn> ok"

CHAT = f"""
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '{CONTROL}' UNION ALL SELECT -7, 1, 'assistant', '{CONTROL}'),
e AS (SELECT *, length(role) + length(text) + len(regexp_extract_all(role || text, '[\\\\<>]')) AS escaped FROM m)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       sum(escaped + 15)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

# Windows of 10 words (or whole shorter items) of the benchmark against the same windows of documents.
LEAKS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS size, w[s:s + least(10, len(w)) - 1] AS win
       FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, size, s, w[s:s + size - 1] AS win FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes)),
m AS (SELECT doc_id, item_id, s, dw.size AS size FROM dw JOIN bw ON dw.size = bw.size AND dw.win = bw.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM m) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN i USING (doc_id)
"""

# crc32 byte by byte with the table of the reflected polynomial; %s is a string.
_CRC_TABLE = "(SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS c FROM range(256) r(i)))"
_CRC = ("xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, 2 * strlen(%s), 2), lambda k: "
        "16 * (instr('0123456789ABCDEF', hex(%s)[k]) - 1) + instr('0123456789ABCDEF', hex(%s)[k + 1]) - 1)), "
        "lambda c, x: xor(c // 256, t[1 + xor(c %% 256, x)])))")

# Prefixes as lists of turns; a subtree is every node whose list begins with the node's.
TRIE = f"""
WITH crc AS {_CRC_TABLE},
o AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, own, {_CRC.replace('%%', '%').replace('%s', 'conv_id::VARCHAR')} % 6 AS h FROM o, crc),
c AS (SELECT h.conv_id, list_concat(coalesce(b.own, [])[1:h.h], h.own[h.h + 1:]) AS s
      FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 100),
p AS (SELECT conv_id, s[1:d] AS p, d, len(s) = d AS ends FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM c)),
n AS (SELECT p, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM p GROUP BY p, d),
k AS (SELECT a.p, a.depth, sum(CASE WHEN b.depth = a.depth + 1 THEN 1 ELSE 0 END) AS n_children,
             sum((b.n_convs - 1) * CASE WHEN b.depth = 0 THEN 0 ELSE length(b.p[-1].text) END) AS saved
      FROM n a JOIN n b ON b.depth >= a.depth AND b.p[1:a.depth] = a.p GROUP BY a.p, a.depth),
l AS (SELECT a.p, a.depth, count(*) AS n_leaves FROM n a JOIN (SELECT n.p, n.depth FROM n JOIN k USING (p, depth) WHERE n_children = 0) b
      ON b.depth >= a.depth AND b.p[1:a.depth] = a.p GROUP BY a.p, a.depth)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN k USING (p, depth) JOIN l USING (p, depth) LEFT JOIN n u ON u.depth = n.depth - 1 AND u.p = n.p[1:n.depth - 1]
"""

# Near words share what is left when one place is taken out: of both, or of the longer one alone.
SPELLING = f"""
WITH RECURSIVE crc AS {_CRC_TABLE},
r AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
g AS MATERIALIZED (SELECT doc_id, run, coalesce(doc_id::VARCHAR, '') || ':' || run AS told, count(*) AS k FROM r WHERE length(run) >= 5 GROUP BY ALL),
h AS MATERIALIZED (SELECT run, k, {_CRC.replace('%%', '%').replace('%s', 'told')} AS h FROM g, crc),
v AS (SELECT k, CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h),
w AS MATERIALIZED (SELECT word, sum(k)::BIGINT AS n FROM v WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
x AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS cut FROM (SELECT *, unnest(range(length(word))) AS i FROM w)),
e AS MATERIALIZED (SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM x a JOIN x b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM x a JOIN w b ON a.cut = b.word
      UNION SELECT b.word, a.word, a.n FROM x a JOIN w b ON a.cut = b.word),
c AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM e GROUP BY word),
f AS MATERIALIZED (SELECT w.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END::BIGINT AS form_n
      FROM w LEFT JOIN c USING (word)),
t AS (SELECT word, word AS root FROM f WHERE form IS NULL UNION ALL SELECT f.word, t.root FROM t JOIN f ON f.form = t.word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN t USING (word)
"""

SQL = {"op2_exact_dedup": EXACT, "op8_mix_sources": MIX, "op10_chat_format": CHAT, "op11_spelling_variants": SPELLING,
       "op12_conversation_trie": TRIE, "op13_decontaminate": LEAKS}
