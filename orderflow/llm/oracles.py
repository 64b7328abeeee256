"""Comparison SQL (DuckDB) of the training-data queries that SQL can express."""

from __future__ import annotations

#: Text with A-Z in lower case.
_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"


def _hex(text: str, first: int, digits: int) -> str:
    return f"('0x' || substr(md5({text}), {first}, {digits}))::BIGINT"


_CHAT = rf"""
WITH RECURSIVE calls AS (
  SELECT conv_id, 'call_' || turn AS id, turn, text, len({_WORDS}) AS words,
    turn % 2 + 2 * ((turn - turn % 2) // 4) AS middle
  FROM conversations WHERE role = 'user'
), named AS (
  SELECT *, CASE WHEN words <= 25 THEN 'search' ELSE 'summarise' END AS name FROM calls
), chain AS (
  SELECT conv_id, turn, 0 AS level FROM calls c
  WHERE middle >= turn OR NOT EXISTS (SELECT 1 FROM calls o WHERE o.conv_id = c.conv_id AND o.turn = c.middle)
  UNION ALL
  SELECT c.conv_id, c.turn, chain.level + 1 FROM chain JOIN calls c
    ON c.conv_id = chain.conv_id AND c.middle = chain.turn AND c.middle < c.turn
), answers AS (
  SELECT conv_id, 'call_' || (turn - 1) AS id, min(turn) AS answered, count(*) AS n_results, min_by(text, turn) AS content
  FROM conversations WHERE role = 'assistant' GROUP BY ALL
), linked AS (
  SELECT coalesce(n.conv_id, a.conv_id) AS conv_id, coalesce(n.id, a.id) AS id, coalesce(n.turn, a.answered) AS turn, chain.level, n.name,
    coalesce(a.n_results, 0) AS n_results, n.words, n.text, a.content, n.id IS NOT NULL AS is_call, a.id IS NOT NULL AS has_result, n.turn AS called,
    n.middle < n.turn AND NOT EXISTS (SELECT 1 FROM calls o WHERE o.conv_id = n.conv_id AND o.turn = n.middle) AS dangling
  FROM named n FULL JOIN answers a ON n.conv_id = a.conv_id AND n.id = a.id
  LEFT JOIN chain ON chain.conv_id = n.conv_id AND chain.turn = n.turn
)
SELECT conv_id, id AS call_id, turn, level::BIGINT AS level, name, n_results::BIGINT AS n_results,
  concat_ws('; ',
    CASE WHEN NOT is_call THEN 'no call' END,
    CASE WHEN is_call AND NOT has_result THEN 'no result' END,
    CASE WHEN dangling THEN 'waits for no call' END,
    CASE WHEN name = 'summarise' AND words % 2 = 1 THEN 'missing limit' END,
    CASE WHEN name = 'search' AND words % 2 = 0 THEN 'unknown limit' END) AS errors,
  json_object(
    'arguments', CASE WHEN NOT is_call THEN NULL WHEN words % 2 = 0 THEN json_object('limit', called, 'query', text, 'words', words)
      ELSE json_object('query', text, 'words', words) END,
    'conversation', conv_id, 'id', id, 'level', level, 'name', name, 'result', content)::VARCHAR AS json
FROM linked
"""

_CONTAMINATION = rf"""
WITH worded AS (
  SELECT doc_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
    unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i+9], ' '))) AS g
  FROM items WHERE len(w) > 0
), spans AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM worded, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
), hits AS (
  SELECT s.doc_id, s.i, s.n, x.item_id FROM (SELECT doc_id, n, i, array_to_string(w[i:i+n-1], ' ') AS g FROM spans) s
  JOIN windows x ON s.n = x.n AND s.g = x.g
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(d.w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM worded d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_JACCARD = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE
    WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' ')))
  END AS s FROM worded
), flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, min(reach.b) AS component_id, coalesce(any_value(counted.n), 0)::BIGINT AS n_links
FROM sets JOIN reach ON sets.doc_id = reach.a LEFT JOIN counted ON counted.a = sets.doc_id
GROUP BY sets.doc_id, len(s)
"""

_MIXTURE = rf"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len({_WORDS}), 0)::BIGINT AS size,
    md5(concat_ws(':', '7', coalesce(doc_id::VARCHAR, ''), coalesce(md5(text), ''))) AS tie FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n,
    [5, 2, 1][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM docs GROUP BY source
), caps AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS pool FROM sources
), levels AS (
  SELECT *, (pool - coalesce(sum(cap) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM caps WINDOW f AS (ORDER BY cap / weight, source ASC NULLS LAST)
), aims AS (
  SELECT source, source_size, n, least(cap, max(level) OVER () * weight) AS target,
    ('0x' || substr(md5(concat_ws(':', '7', coalesce(source, ''))), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS offs FROM levels
), rates AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE target / source_size::DOUBLE END AS rate FROM aims
), placed AS (
  SELECT d.*, source_size, target, rate, offs, row_number() OVER (PARTITION BY d.source ORDER BY length(bin(size)),
    ('0x' || substr(tie, 1, 8))::BIGINT % ceil(n / 2000.0)::BIGINT, size, tie) AS upto
  FROM docs d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
), copied AS (
  SELECT *, least(floor(rate * upto + offs) - floor(rate * (upto - 1) + offs), ceil(rate))::BIGINT AS copies FROM placed
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM copied
"""

_SHARDS = f"""
WITH RECURSIVE names AS (
  SELECT s, {_hex("printf('shard-%03d/start', s)", 1, 15)} % 4099 AS a, {_hex("printf('shard-%03d/step', s)", 1, 15)} % 4098 + 1 AS b
  FROM range(0, 32) r(s)
), prefs AS (
  SELECT list(list_transform(range(0, 4099), lambda j: (a + j * b) % 4099) ORDER BY s) AS p FROM names
), fill AS (
  SELECT 0 AS n, list_transform(range(0, 4099), lambda x: -1) AS t
  UNION ALL
  SELECT n + 1, list_concat(list_concat(t[:slot], [n % 32]), t[slot+2:]) FROM (
    SELECT n, t, list_filter(p[n % 32 + 1], lambda j: t[j + 1] < 0)[1] AS slot FROM fill, prefs WHERE n < 4099)
), slots AS (
  SELECT unnest(range(0, 4099)) AS slot, unnest(t) AS shard FROM fill WHERE n = 4099
)
SELECT doc_id, slot::BIGINT AS slot, shard::BIGINT AS shard
FROM (SELECT doc_id, {_hex("coalesce(doc_id::VARCHAR, md5(text), '')", 1, 15)} % 4099 AS slot FROM documents) JOIN slots USING (slot)
"""

_URLS = rf"""
WITH pages_ AS (
  SELECT page_id, nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.$', ''), '') AS host,
    DATE '2024-01-01' + ({_hex("page_id::VARCHAR", 1, 6)} % 366)::INT AS fetched FROM pages
), hosts AS (
  SELECT host, string_split(host, '.') AS parts, {_hex("host", 1, 4)} % 10 AS pick, {_hex("host", 5, 4)} % 3 AS above,
    DATE '2024-01-01' + ({_hex("host", 9, 4)} % 300)::INT AS start, {_hex("host", 13, 4)} % 3 AS list, {_hex("host", 17, 4)} % 5 AS kind,
    ({_hex("host", 21, 4)} % 90)::INT AS days
  FROM (SELECT DISTINCT host FROM pages_ WHERE host IS NOT NULL)
), entries AS (
  SELECT ['adult', 'malware', 'spam'][list + 1] AS list, CASE WHEN kind = 0 THEN 'allow' ELSE 'block' END AS kind,
    CASE WHEN above = 0 AND len(parts) >= 4 THEN array_to_string(parts[2:], '.') ELSE host END AS pattern,
    unnest([{{'add': true, 'day': start}}, {{'add': false, 'day': start + days}}, {{'add': true, 'day': start + days + 30}}]) AS step
  FROM hosts WHERE pick < 5
), days AS (
  SELECT list, kind, pattern, step.day AS day, bool_and(step.add) AS active FROM entries GROUP BY ALL
), changes AS (
  SELECT * FROM (SELECT *, coalesce(lag(active) OVER (PARTITION BY list, kind, pattern ORDER BY day), false) AS was FROM days) WHERE active <> was
), valid AS (
  SELECT * FROM (SELECT *, lead(day) OVER (PARTITION BY list, kind, pattern ORDER BY day) AS until FROM changes) WHERE active
), matched AS (
  SELECT p.page_id, v.list, v.kind, v.pattern, v.day,
    count(*) OVER (PARTITION BY p.page_id) AS n_active,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(v.pattern) DESC, v.kind, v.list) AS place
  FROM pages_ p JOIN valid v ON (p.host = v.pattern OR ends_with(p.host, '.' || v.pattern))
    AND p.fetched >= v.day AND (v.until IS NULL OR p.fetched < v.until)
)
SELECT p.page_id, p.host, strftime(p.fetched, '%Y-%m-%d') AS fetched, coalesce(n_active, 0)::BIGINT AS n_active, coalesce(kind = 'block', false) AS blocked,
  list, pattern, strftime(day, '%Y-%m-%d') AS valid_from
FROM pages_ p LEFT JOIN (SELECT * FROM matched WHERE place = 1) m USING (page_id)
"""

_TOPK = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""

#: Checksum (CRC-32, reflected polynomial 0xEDB88320) by a table that the rule fills.
_CRC = """
bits AS (
  SELECT list(v ORDER BY b) AS crc_table FROM (
    SELECT b, list_reduce(list_concat([b], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(0, 256) r(b))
)
"""


def _crc(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text without null; `crc_table` must be in scope."""
    octets = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: ('0x' || substr(hex(encode({text})), (2 * i - 1)::BIGINT, 2))::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295], {octets}), lambda c, o: xor(c >> 8, crc_table[(xor(c & 255, o) + 1)::BIGINT])), 4294967295)"


_SPELLING = rf"""
WITH RECURSIVE {_CRC}, found AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all({_LOW}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), hashed AS (
  SELECT run, {_crc("(id || ':' || run)")} AS h FROM found, bits WHERE length(run) >= 7
), words AS (
  SELECT word, count(*) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), less AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), near AS (
  SELECT word, count(*) AS n_near, max(m) AS most FROM pairs GROUP BY word
), firsts AS (
  SELECT p.word, min(other) AS first FROM pairs p JOIN near USING (word) WHERE m = most GROUP BY p.word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN most >= 10 * n THEN first END AS form, CASE WHEN most >= 10 * n THEN most END AS form_n
  FROM words w LEFT JOIN near USING (word) LEFT JOIN firsts USING (word)
), chains AS (
  SELECT word, word AS root, 0 AS steps FROM forms
  UNION ALL
  SELECT c.word, f.form, steps + 1 FROM chains c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN (SELECT word, max_by(root, steps) AS root FROM chains GROUP BY word) USING (word)
"""

_TRIE = f"""
WITH RECURSIVE {_CRC}, turns AS (
  SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), shared AS (
  SELECT c, l, ({_crc("c::VARCHAR")} % 6)::BIGINT AS h FROM turns, bits
), rebuilt AS (
  SELECT s.c, list_concat(coalesce(b.l[1:h], []), s.l[h + 1:]) AS l FROM shared s LEFT JOIN turns b ON b.c = s.c - s.c % 100
), starts AS (
  SELECT c, len(l) AS n, d, l[1:d] AS p FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE length(any_value(p[d].text)) END AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM starts GROUP BY p, d
), children AS (
  SELECT p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), own AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (p)
), totals AS (
  SELECT p[1:a] AS p, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saved) AS saved_tokens FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM own) GROUP BY ALL
)
SELECT o.conv_id, o.d AS depth, u.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, o.ends_sha256
FROM own o JOIN totals USING (p) LEFT JOIN nodes u ON o.d > 0 AND u.p = o.p[1:o.d - 1]
"""

_FINGERPRINTS = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), paired AS (
  SELECT doc_id, text, length(text) AS n, coalesce(lead(doc_id) OVER o, first_value(doc_id) OVER o) AS next_id,
    coalesce(lead(text) OVER o, first_value(text) OVER o) AS next_text
  FROM docs WINDOW o AS (ORDER BY doc_id DESC NULLS LAST, md5(text))
), edits AS (
  SELECT *, substr(text, 1, n - n // 3) || substr(next_text, 1, n // 3) AS edited FROM paired
), versions AS (
  SELECT doc_id, false AS e, text FROM edits UNION ALL SELECT doc_id, true, edited FROM edits
), units AS (
  SELECT doc_id, e, unnest(u) AS u, unnest(range(1, len(u) + 1)) AS i FROM (SELECT doc_id, e,
    regexp_extract_all(text, '[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{1100}-\x{11FF}\x{2E80}-\x{D7FF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]|[^\x20\x09-\x0D\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{1100}-\x{11FF}\x{2E80}-\x{D7FF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]{1,16}') AS u FROM versions)
), runs AS (
  SELECT doc_id, e, i, u AS s, lead(u, 7) OVER w AS last,
    u || ' ' || lead(u, 1) OVER w || ' ' || lead(u, 2) OVER w || ' ' || lead(u, 3) OVER w || ' ' || lead(u, 4) OVER w || ' ' || lead(u, 5) OVER w
      || ' ' || lead(u, 6) OVER w || ' ' || lead(u, 7) OVER w AS run,
    min(u) OVER (PARTITION BY doc_id, e ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS least
  FROM units WINDOW w AS (PARTITION BY doc_id, e ORDER BY i)
), anchors AS (
  SELECT doc_id, e, i, printf('%02x', least(coalesce(i - lag(i) OVER (PARTITION BY doc_id, e ORDER BY i), 0), 255)) || substr(md5(run), 1, 6) AS t
  FROM runs WHERE run IS NOT NULL AND least(s, last) = runs.least
), listed AS (
  SELECT v.doc_id, v.e, CASE WHEN count(t) > 0 THEN list(t ORDER BY i) WHEN any_value(text) = '' THEN [] ELSE ['00' || substr(md5(any_value(text)), 1, 6)] END AS t
  FROM versions v LEFT JOIN anchors a ON v.doc_id = a.doc_id AND v.e = a.e GROUP BY v.doc_id, v.e
), joined AS (
  SELECT p.doc_id, p.n, p.edited, o.t AS own, c.t AS changed, x.t AS others FROM edits p
  JOIN listed o ON o.doc_id = p.doc_id AND NOT o.e JOIN listed c ON c.doc_id = p.doc_id AND c.e JOIN listed x ON x.doc_id = p.next_id AND NOT x.e
)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, array_to_string(own, '') AS fingerprint, array_to_string(changed, '') AS edited_fingerprint,
  CASE WHEN len(own) + len(changed) = 0 THEN 1 ELSE len(list_intersect(own, changed))::DOUBLE / len(list_distinct(list_concat(own, changed))) END AS near_edited,
  CASE WHEN len(own) + len(others) = 0 THEN 1 ELSE len(list_intersect(own, others))::DOUBLE / len(list_distinct(list_concat(own, others))) END AS near_next
FROM joined
"""

ORACLES = {
    "op2_chat_calls": _CHAT,
    "op3_decontamination": _CONTAMINATION,
    "op4_jaccard_join": _JACCARD,
    "op6_mixture": _MIXTURE,
    "op7_shards": _SHARDS,
    "op9_url_filter": _URLS,
    "op10_topk": _TOPK,
    "op11_fingerprints": _FINGERPRINTS,
    "op12_prefix_trie": _TRIE,
    "op13_spelling": _SPELLING,
}
