"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from corpusloom.llm import op06_licenses


MIX = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, 3 * source_size AS cap FROM s
), f AS (
  SELECT *,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS taken_up,
    (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS open_weight,
    (sum(source_size) OVER ())::BIGINT AS whole
  FROM w
), l AS (
  SELECT *, (whole - taken_up)::DOUBLE / open_weight AS level FROM f
), e AS (
  SELECT max(level) AS level FROM l
), t AS (
  SELECT l.source, l.source_size, least(l.cap::DOUBLE, e.level * l.weight) AS target FROM l, e
), o AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    ('0x' || substr(md5(coalesce('=' || d.source, '~') || 'mix-1'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u,
    row_number() OVER (PARTITION BY d.source ORDER BY
      lpad(length(bin(d.size))::VARCHAR, 2, '0') || rpad(substr(bin(d.size), 1, 4), 4, '0'), md5(d.doc_id::VARCHAR), d.doc_id, d.size) AS n
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (floor(rate * n + u) - floor(rate * (n - 1) + u))::BIGINT * size AS taken FROM o
"""

URLS = r"""
WITH p AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/') THEN 'org/'
  END AS rule FROM p
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN substr(md5(host), 1, 1) IN ('0', '1') THEN 'block'
  ELSE 'allow' END AS verdict
FROM r
"""


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def licenses() -> str:
    """The canonical form of documents and of known texts, and their join by digest."""
    form = "lower(text)"
    for _, pattern, replacement in op06_licenses.NOTICES:
        form = f"regexp_replace({form}, {_literal(pattern)}, {_literal(replacement)}, 'g')"
    form = f"trim(regexp_replace({form}, {_literal(op06_licenses.SEPARATORS)}, ' ', 'g'))"
    for spelling, other in op06_licenses.SPELLINGS:
        form = f"replace({form}, {_literal(spelling)}, {_literal(other)})"
    known = ", ".join(f"({_literal(name)}, {_literal(text)})" for name, text in op06_licenses.known_texts())
    digest = f"sha256(nullif({form}, ''))"
    return f"""
WITH known(name, text) AS (VALUES {known}),
k AS (SELECT {digest} AS digest, min(name) AS license FROM known GROUP BY 1),
d AS (SELECT doc_id, {digest} AS digest FROM documents)
SELECT d.doc_id, d.digest, k.license FROM d LEFT JOIN k ON d.digest = k.digest
"""


TOP_PRODUCTS = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

JACCARD = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS k FROM d, unnest(range(1, greatest(len(w) - 3, 2))) t(i) WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n, md5(string_agg(k, '' ORDER BY k)) AS whole FROM s GROUP BY doc_id
), c AS (
  SELECT doc_id, n, min(doc_id) OVER (PARTITION BY whole) AS copy_id FROM n
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 9 * count(*) >= 4 * (na.n + nb.n)
), g AS (
  SELECT doc_id, doc_id AS near FROM d
  UNION
  SELECT g.doc_id, p.b FROM g JOIN p ON p.a = g.near
), m AS (
  SELECT doc_id, min(near) AS class_id FROM g GROUP BY doc_id
), l AS (
  SELECT a AS doc_id, count(*) AS n_links FROM p GROUP BY a
)
SELECT d.doc_id, coalesce(c.copy_id, d.doc_id) AS copy_id, m.class_id, coalesce(l.n_links, 0)::BIGINT AS n_links
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id LEFT JOIN l ON l.doc_id = d.doc_id
"""

SUBSTRINGS = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), v AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM d, unnest(range(1, len(w) - 11)) t(i)
), f AS (
  SELECT k, min(doc_id) AS first FROM v GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, p FROM v JOIN f USING (k), unnest(range(i, i + 13)) u(p) WHERE first < doc_id
), words AS (
  SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) t(p)
), kept AS (
  SELECT words.doc_id, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY words.p) FILTER (WHERE gone.p IS NULL) AS left_text
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.p = words.p GROUP BY words.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(left_text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

#: The 256 values of CRC-32 (reversed polynomial 0xEDB88320), by eight halvings each, as one list.
_CRC_TABLE = r"""
crc_steps(k, c, n) AS (
  SELECT k, k, 0 FROM range(256) t(k)
  UNION ALL
  SELECT k, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n + 1 FROM crc_steps WHERE n < 8
), crc_table AS (
  SELECT list(c ORDER BY k) AS crcs FROM crc_steps WHERE n = 8
)"""


def _crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, with ``crcs`` in scope."""
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    step = "lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), {step}), 4294967295)"


def shards() -> str:
    """Draws of nine shards by digest, the highest of eight and of all, and places inside each shard."""
    return f"""
WITH RECURSIVE {_CRC_TABLE}, d AS (
  SELECT doc_id, coalesce('=' || doc_id::VARCHAR, '~') AS key, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
    {_crc32("coalesce(text, '')")}::BIGINT AS text_crc32
  FROM documents, crc_table
), w AS (
  SELECT *, list_transform(range(9), lambda s: -1 / ln((('0x' || substr(md5(key || ':' || s::VARCHAR), 1, 13))::BIGINT + 0.5::DOUBLE) / pow(16::DOUBLE, 13))) AS draws FROM d
), p AS (
  SELECT *, list_position(draws[1:8], list_max(draws[1:8])) - 1 AS shard, list_position(draws, list_max(draws)) - 1 AS grown FROM w
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
  (row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1)::BIGINT AS slot, grown::INTEGER AS grown_shard
FROM p
"""


def _edit(value: str, cost: str, letter: str, item: str = "''") -> str:
    """A repair with an edit before it."""
    return f"struct_pack(c := {value}.c + {cost}, l := '{letter}' || {value}.l, t := {item} || {value}.t)"


def repairs() -> str:
    """Rows taken from the last to the first, with the least (cost, letters, text) for each state behind them."""
    states = {"e": ("u", "user"), "s": ("u", "user"), "u": ("a", "assistant"), "a": ("u", "user")}
    keeps = {"e": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    own, whole = [], []
    for q, (following, role) in states.items():
        kept = " ".join(f"WHEN first = '{i}' THEN {_edit('v.' + to, 'short', 'K', 'item')}" for i, to in keeps[q].items())
        rerole = _edit(f"v.{following}", "2 + short", "R", f"'{role}:' || text || chr(10)")
        own.append(f"list_min([{_edit('v.' + q, '3', 'D')}, CASE WHEN goes THEN NULL {kept} END, CASE WHEN NOT goes THEN {rerole} END]) AS o_{q}")
        insert = _edit(f"o_{following}", "2", "I", f"'{role}:' || chr(10)")
        whole.append(f"list_min([o_{q}, {insert}]) AS {q}")
    end = lambda c, l, t: f"struct_pack(c := {c}, l := '{l}', t := {t})"  # noqa: E731, E741
    ends = ", ".join([end(0, "", "''"), end(1000000, "", "''"), end(2, "I", "'assistant:' || chr(10)"), end(0, "", "''")])
    return rf"""
WITH RECURSIVE {_CRC_TABLE}, d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault
  FROM conversations, crc_table
), h AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM d, unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) WHERE fault <> 0
), i AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id) AS g,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, substr(text, 1, 32), md5(text)) AS i, substr(role, 1, 1) AS first
  FROM h
), f AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, role || ':' || text || chr(10) AS item,
    row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 AS again, regexp_matches(text, '[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*$') AS open,
    i > 1 AND lag(first) OVER (PARTITION BY g ORDER BY i) || first NOT IN ('su', 'ua', 'au') AS illegal
  FROM i
), r AS (
  SELECT *, blank OR again AS goes, (open AND NOT blank AND NOT again)::INTEGER AS short FROM f
), c AS (
  SELECT g, any_value(conv_id) AS conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again AND NOT blank) AS duplicate, sum(short) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM r GROUP BY g
), v(g, i, e, s, u, a) AS (
  SELECT g, n, {ends} FROM c
  UNION ALL
  SELECT g, i - 1, {", ".join(whole)} FROM (
    SELECT v.g, v.i, {", ".join(own)} FROM v JOIN r ON r.g = v.g AND r.i = v.i
  )
), b AS (
  SELECT c.*, v.e FROM c JOIN v ON v.g = c.g AND v.i = 0
)
SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.c, 0)::BIGINT AS cost, coalesce(e.l, '') AS audit,
  sha256(coalesce(e.t[:-2], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN b ON k.conv_id IS NOT DISTINCT FROM b.conv_id
"""
