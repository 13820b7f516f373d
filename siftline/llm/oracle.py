"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
g AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, w[i:i + least(len(w), 13) - 1] AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
p AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
t AS (SELECT r, i, n, w[i:i + n - 1] AS gram
      FROM p, (SELECT DISTINCT n FROM g) WHERE i + n - 1 <= len(w)),
h AS (SELECT t.r, t.i, t.n, g.item_id FROM t JOIN g ON t.n = g.n AND t.gram = g.gram),
c AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS x FROM h) GROUP BY r),
k AS (SELECT r, count(DISTINCT item_id) AS n_items,
             string_agg(s, ',' ORDER BY s) AS ids
      FROM (SELECT DISTINCT r, item_id, item_id::VARCHAR AS s FROM h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w)) AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN k USING (r)
"""

OP2 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
g AS (SELECT r, doc_id, i, w[i:i + 12] AS gram
      FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
m AS (SELECT gram, min(doc_id) AS least FROM g GROUP BY gram),
x AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS i FROM g JOIN m USING (gram) WHERE least < doc_id),
k AS (SELECT d.r, string_agg(d.word, ' ' ORDER BY d.i) AS kept, count(*) AS n
      FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d) AS d
      ANTI JOIN x ON d.r = x.r AND d.i = x.i GROUP BY d.r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""

OP9 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_sum(list_transform(list_zip(q.x, v.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.x) = len(v.x) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def _label(label: str, cost: str, edit: str) -> str:
    """A label (nine digits of cost, then edits) after one more edit."""
    return f"lpad((substr({label}, 1, 9)::INT + {cost})::VARCHAR, 9, '0') || substr({label}, 10) || '{edit}'"


def _inserted(a: str, b: str, c: str, d: str) -> str:
    """The four states' labels with inserts: a and b as they are, c and d also from others."""
    put_user = f"least({c}, {_label(a, '3', 'I')}, {_label(b, '3', 'I')}, {_label(d, '3', 'I')})"
    return f"{a} AS a, {b} AS b, {put_user} AS c, least({d}, {_label(put_user, '3', 'I')}) AS d"


_CRC = """(SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n) ORDER BY n)
     FROM (SELECT unnest(range(256)) AS n))"""


#: Labels at each row for the states start, system, user and assistant, from row to row.
OP13 = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations
), bytes AS (
  SELECT *, list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::BIGINT) AS b, {_CRC} AS t FROM keyed
), coded AS (
  SELECT conv_id, turn, role, text, xor(4294967295,
    list_reduce(b, lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1]), 4294967295::BIGINT)) % 20 AS damage
  FROM bytes
), damaged AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
    CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN damage = 3 THEN 2 ELSE 1 END)) AS copy
  FROM coded WHERE damage <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM damaged
), marked AS (
  SELECT conv_id, turn, pos, role, text, substr(role, 1, 1) AS initial,
    CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 2
      WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 3 ELSE 0 END AS fault,
    substr(lag(role) OVER (PARTITION BY conv_id ORDER BY pos), 1, 1) AS before
  FROM placed
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
  FROM marked GROUP BY conv_id
), labels AS (
  SELECT conv_id, 0::BIGINT AS pos, {_inserted("'000000000'", 'NULL::VARCHAR', 'NULL::VARCHAR', 'NULL::VARCHAR')} FROM counts
  UNION ALL
  SELECT conv_id, pos, {_inserted('w', 'x', 'y', 'z')} FROM (
    SELECT m.conv_id, m.pos, {_label('a', '4', 'D')} AS w,
      least({_label('b', '4', 'D')}, CASE WHEN fault IN (0, 3) AND initial = 's' THEN {_label('a', 'fault', 'K')} END) AS x,
      least({_label('c', '4', 'D')},
        CASE WHEN fault IN (0, 3) THEN {_label('least(a, b, d)', '3 + fault', 'R')} END,
        CASE WHEN fault IN (0, 3) AND initial = 'u' THEN {_label('least(a, b, d)', 'fault', 'K')} END) AS y,
      least({_label('d', '4', 'D')},
        CASE WHEN fault IN (0, 3) THEN {_label('c', '3 + fault', 'R')} END,
        CASE WHEN fault IN (0, 3) AND initial = 'a' THEN {_label('c', 'fault', 'K')} END) AS z
    FROM labels l JOIN marked m ON m.conv_id IS NOT DISTINCT FROM l.conv_id AND m.pos = l.pos + 1)
), best AS (
  SELECT c.*, substr(least(a, d), 1, 9)::BIGINT AS cost, substr(least(a, d), 10) AS audit
  FROM counts c JOIN labels l ON l.conv_id IS NOT DISTINCT FROM c.conv_id AND l.pos = c.n
), edits AS (
  SELECT conv_id, audit, k, audit[k] AS edit, length(replace(audit[:k], 'I', '')) AS pos, length(replace(audit[:k], 'D', '')) AS line
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM best)
), lines AS (
  SELECT e.*, m.role, CASE WHEN edit = 'I' THEN '' ELSE m.text END AS text,
    max(CASE WHEN line = 1 AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS system
  FROM edits e LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM e.conv_id AND m.pos = e.pos
  WHERE edit <> 'D'
), joined AS (
  SELECT conv_id, string_agg((CASE WHEN edit = 'K' THEN role WHEN (line - system) % 2 = 1 THEN 'user' ELSE 'assistant' END)
    || ':' || text, chr(10) ORDER BY k) AS whole
  FROM lines GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN joined j ON j.conv_id IS NOT DISTINCT FROM o.conv_id
"""


#: 8 shards of equal row counts; crc32 byte by byte.
OP7 = f"""
WITH d AS (
  SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size, md5('17:' || coalesce(doc_id::VARCHAR, 'null')) AS h,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda p: ('0x' || p)::BIGINT) AS b, {_CRC} AS t
  FROM documents
), r AS (
  SELECT doc_id, source, size, h, xor(4294967295,
    list_reduce(b, lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1]), 4294967295::BIGINT))::BIGINT AS text_crc32,
    row_number() OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST) - 1 AS r, count(*) OVER (PARTITION BY source) AS n
  FROM d
), p AS (
  SELECT *, row_number() OVER (ORDER BY (2 * r + 1)::DOUBLE / (2 * n), source NULLS FIRST, h, doc_id NULLS FIRST) - 1 AS place,
    count(*) OVER () // 8 AS small, count(*) OVER () % 8 AS longer
  FROM r
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law,
  (CASE WHEN place < longer * (small + 1) THEN place // (small + 1)
    ELSE longer + (place - longer * (small + 1)) // small END)::INTEGER AS shard,
  (CASE WHEN place < longer * (small + 1) THEN place % (small + 1)
    ELSE (place - longer * (small + 1)) % small END)::BIGINT AS slot,
  NULL::INTEGER AS grown_shard
FROM p
"""


QUOTED_REPLIES = r"""
WITH f AS (SELECT conv_id, text, min(turn) AS first FROM conversations GROUP BY ALL),
h AS (SELECT conv_id, min(turn) AS head FROM conversations GROUP BY ALL)
SELECT c.conv_id, c.turn, CASE WHEN b.text IS NOT NULL THEN f.first WHEN c.turn > head THEN head END AS reply_turn,
  (coalesce(regexp_matches(b.text, '\w'), false)::BIGINT + coalesce(regexp_matches(a.text, '\w'), false)::BIGINT) AS n_quotes,
  n_quotes AS n_linked, len(regexp_extract_all(c.text, '\S+'))::BIGINT AS n_words
FROM conversations c JOIN h USING (conv_id)
LEFT JOIN conversations b ON b.conv_id = c.conv_id AND b.turn = c.turn - 1
LEFT JOIN conversations a ON a.conv_id = c.conv_id AND a.turn = c.turn - 2
LEFT JOIN f ON f.conv_id = c.conv_id AND f.text = b.text
"""


def registered() -> dict[str, str]:
    return {"op1_decontaminate": OP1, "op2_passages": OP2, "op7_sharding": OP7, "quoted_replies": QUOTED_REPLIES, "op9_nearest": OP9, "op13_repair": OP13}
