"""The same results in SQL, for the operators that SQL can express."""

SUBSTRINGS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d),
keyed AS (SELECT doc_id, i, array_to_string(list_slice(words, i, i + 19), ' ') AS k FROM starts),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS nth FROM keyed),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM ranked WHERE nth > 1),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM d),
kept AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.p) AS text FROM placed p ANTI JOIN covered c ON p.doc_id = c.doc_id AND p.p = c.p GROUP BY ALL),
gone AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY ALL)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(gone.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

LINES = r"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS p FROM parts),
keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM placed),
repeated AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT d.doc_id, d.line, d.p, r.k IS NOT NULL AND d.doc_id < r.keeper AS gone FROM keyed d LEFT JOIN repeated r ON d.k = r.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

CONTAMINATION = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
starts AS (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0),
windows AS (SELECT DISTINCT item_id, array_to_string(list_slice(words, i, i + 9), ' ') AS w, least(len(words), 10) AS size FROM starts),
places AS (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM windows)),
keyed AS (SELECT doc_id, i, size, array_to_string(list_slice(words, i, i + size - 1), ' ') AS w FROM places),
found AS (SELECT doc_id, i, k.size, item_id FROM keyed k JOIN windows USING (w)),
hits AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(hits.n, 0) AS n_hit, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

PERSPECTIVES = r"""
WITH t AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
v AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (SELECT t.conv_id, perspective, turn, speaker, text,
    CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role
  FROM t JOIN v ON t.conv_id IS NOT DISTINCT FROM v.conv_id),
h AS (SELECT *, '<|' || role || '|>' || CASE WHEN role = 'user' THEN ' ' || speaker ELSE '' END || chr(10) AS head FROM r),
s AS (SELECT *, head || text || chr(10) AS segment,
    sum(length(head || text || chr(10))) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text ROWS UNBOUNDED PRECEDING) AS upto,
    row_number() OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text) - 1 AS place FROM h)
SELECT conv_id, perspective, turn, place, role, CASE WHEN role = 'user' THEN speaker END AS name, segment,
  CAST(upto - length(segment) AS BIGINT) AS seg_start, CAST(upto AS BIGINT) AS seg_end,
  CASE WHEN role = 'assistant' THEN CAST(upto - length(segment) + length(head) AS BIGINT) END AS mask_start,
  CASE WHEN role = 'assistant' THEN CAST(upto - 1 AS BIGINT) END AS mask_end
FROM s
"""


def secrets(rules, base: int) -> str:
    """Places of all matches from the lengths of the gaps between them, rule by rule."""
    parts = []
    for number, rule in enumerate(rules):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
  SELECT doc_id, {number} AS rule, '{rule.kind}' AS kind, {rule.least} AS least, unnest(string_split_regex(text, '{pattern}')) AS gap,
    unnest(regexp_extract_all(text, '{pattern}', 0)) AS found, unnest(regexp_extract_all(text, '{pattern}', {rule.group})) AS tested,
    generate_subscripts(string_split_regex(text, '{pattern}'), 1) AS nth FROM d""")
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in rules[:base])
    item = "kind || ':' || start_at || ':' || end_at"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
pieces AS ({" UNION ALL ".join(parts)}),
summed AS (SELECT *, sum(length(gap) + length(coalesce(found, ''))) OVER (PARTITION BY doc_id, rule ORDER BY nth ROWS UNBOUNDED PRECEDING) AS end_at FROM pieces),
kept AS (SELECT doc_id, rule, kind, CAST(end_at - length(found) AS BIGINT) AS start_at, CAST(end_at AS BIGINT) AS end_at FROM summed WHERE found IS NOT NULL AND length(tested) >= least)
SELECT d.doc_id, {counts},
  sha256(coalesce(string_agg({item}, ',' ORDER BY start_at, rule) FILTER (WHERE rule < {base}), '')) AS base_sha256,
  coalesce(string_agg({item}, ',' ORDER BY start_at, rule), '') AS spans
FROM d LEFT JOIN kept USING (doc_id) GROUP BY d.doc_id
"""


#: CRC-32 of a text's UTF-8 bytes; ``crc_table`` is a list of the 256 remainders, made by the rule itself.
CRC_TABLE = """crc_table AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY i) AS t
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i))"""


def crc(text: str) -> str:
    """The checksum of a text column, where ``crc_table`` is at hand."""
    octets = f"list_transform(range(1, 2 * CAST(strlen({text}) AS BIGINT), 2), lambda p: CAST('0x' || substr(hex({text}), CAST(p AS BIGINT), 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


RESAMPLED = rf"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
df AS (SELECT doc_id, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS f FROM d),
bf AS (SELECT unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS f FROM b),
known AS (SELECT f, {crc("f")} % 10000 AS bucket FROM (SELECT f FROM df UNION SELECT f FROM bf), crc_table),
s AS (SELECT bucket, count(*) AS n FROM df JOIN known USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bf JOIN known USING (f) GROUP BY bucket),
gains AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM df) + 10000)
  / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM bf) + 10000)))) AS BIGINT) AS gain FROM s FULL JOIN t USING (bucket)),
summed AS (SELECT doc_id, count(*) AS n, sum(gain) AS total FROM df JOIN known USING (f) JOIN gains USING (bucket) GROUP BY doc_id),
weighed AS (SELECT d.doc_id, len(words) AS n_words, coalesce(n, 0) AS n_features, CAST(coalesce(floor(CAST(total AS DOUBLE) / n), 0) AS BIGINT) AS weight,
  CAST('0x' || substr(sha256('7:' || d.doc_id), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN summed USING (doc_id)),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM weighed),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE n_words >= 20)
SELECT s.doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
  CASE WHEN place <= 25 * (SELECT count(*) FROM placed) // 100 THEN place END AS rank
FROM scored s LEFT JOIN placed p ON s.doc_id = p.doc_id
"""

TRIE = rf"""
WITH {CRC_TABLE},
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
counts AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
c AS (SELECT a.conv_id, a.base, a.h, least(h, coalesce(b.n, 0)) AS led
  FROM (SELECT conv_id, conv_id - conv_id % 5 AS base, {crc("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM counts, crc_table) a LEFT JOIN counts b ON a.base = b.conv_id),
placed AS (SELECT c.conv_id, i AS pos, role, text FROM c JOIN t ON t.conv_id = base AND i < h
  UNION ALL SELECT c.conv_id, led + i - h, role, text FROM c JOIN t USING (conv_id) WHERE i >= h),
paths AS (SELECT c.conv_id, coalesce(list({{'r': role, 't': text}} ORDER BY pos) FILTER (WHERE pos IS NOT NULL), []) AS path FROM c LEFT JOIN placed USING (conv_id) GROUP BY c.conv_id),
passed AS (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM paths),
nodes AS (SELECT depth, path[1:depth] AS k, min(conv_id) AS conv_id, count(*) AS n, coalesce(any_value(strlen(path[depth].t)), 0) AS size,
  coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(path) = depth), '') AS ends FROM passed GROUP BY ALL),
kids AS (SELECT k[1:depth - 1] AS k, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(kids.n, 0) AS n_children FROM nodes n LEFT JOIN kids USING (k)),
below AS (SELECT k[1:d] AS k, sum((n - 1) * size) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM full_nodes) GROUP BY ALL)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs, CAST(n.n_children AS BIGINT) AS n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_nodes n JOIN below b ON n.k = b.k LEFT JOIN nodes p ON n.depth > 0 AND p.k = n.k[1:n.depth - 1]
"""
