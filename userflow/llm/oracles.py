"""DuckDB SQL for the rows of the registered queries that SQL can express."""

from __future__ import annotations

from userflow.llm import licenses
from userflow.llm.queries import LISTED_WORDS, URL_RULES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# Components: the smallest number reachable over the links of edges(a, b).
_REACH = """
reach(node, other) AS (
  SELECT a, a FROM edges UNION SELECT b, b FROM edges
  UNION
  SELECT r.node, CASE WHEN e.a = r.other THEN e.b ELSE e.a END
  FROM reach r JOIN edges e ON e.a = r.other OR e.b = r.other
),
smallest AS (SELECT node, min(other) AS component FROM reach GROUP BY node)
"""


def _op1() -> str:
    rules = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)
    listed = ", ".join(f"'{w}'" for w in LISTED_WORDS)
    return rf"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
),
rules(verdict, host, path) AS (VALUES {rules}),
listed AS (SELECT DISTINCT host || path AS key FROM parts
  WHERE list_has_any(string_split_regex(host, '[.-]'), [{listed}])),
fitting AS (
  SELECT p.*, r.host || r.path AS rule, r.verdict AS ruled,
    row_number() OVER (PARTITION BY page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) AS place
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT page_id, host, path, rule, key IS NOT NULL AS listed,
  coalesce(ruled, CASE WHEN key IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM fitting LEFT JOIN listed ON key = host || path
WHERE place = 1
"""


OP2 = rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM split
),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n, any_value(x.n + y.n) AS whole
  FROM items x JOIN items y ON x.item = y.item AND x.doc_id < y.doc_id
  WHERE 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY 1, 2
),
edges AS MATERIALIZED (SELECT a, b FROM shared WHERE 100 * n >= 80 * (whole - n)),
{_REACH}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id,
  coalesce(component, doc_id) = doc_id AS kept
FROM sets LEFT JOIN smallest ON node = doc_id
"""

OP3 = """
WITH bodies AS (
  SELECT page_id, url, encode(coalesce(html, '')) AS body FROM pages
),
sized AS (
  SELECT page_id, url, CAST(octet_length(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM bodies
),
held AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS holder FROM sized
),
parts AS (SELECT *, split_part(url, '://', 2) AS rest FROM held)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN holder <> page_id THEN holder END AS refers_to,
  array_to_string(list_reverse(string_split(lower(split_part(rest, '/', 1)), '.')), ',') || ')'
    || split_part(substr(rest, length(split_part(rest, '/', 1)) + 1), '#', 1) AS url_key,
  1600000000 + page_id AS captured_s
FROM parts
"""


def _op4() -> str:
    known = licenses.known(licenses.TEMPLATES)
    stride = licenses.stride_of(known)
    rows = ", ".join(f"({k.number}, '{k.label}', {k.words!r}, {k.telling!r}, {k.span}, {k.least})" for k in known)
    base = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in licenses.PHRASES.items())
    return rf"""
WITH worded AS (SELECT doc_id, {_WORDS} AS w FROM documents),
phrases(phrase, label, n) AS (VALUES {base}),
spots AS (
  SELECT doc_id, label, unnest(list_filter(range(0, len(w) - n + 1),
    lambda i: array_to_string(w[i + 1 : i + n], ' ') = phrase)) AS spot
  FROM worded, phrases WHERE contains(' ' || array_to_string(w, ' ') || ' ', ' ' || phrase || ' ')
),
base AS (
  SELECT doc_id, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word, list(DISTINCT label) AS own
  FROM spots GROUP BY 1
),
templates(template, label, words, telling, span, least) AS (VALUES {rows}),
windows AS (
  SELECT doc_id, w, template, label, words, telling, span, least, unnest(range(0, len(w))) AS first
  FROM worded, templates WHERE list_has_all(w, telling) AND len(list_intersect(words, w)) >= least
),
counted AS (
  SELECT *, len(list_intersect(words, w[first + 1 : first + span])) AS shared, len(words) AS total FROM windows
  WHERE list_contains(words, w[first + 1]) AND list_has_all(w[first + 1 : first + span], telling)
),
met AS (
  SELECT doc_id, label, span, shared, total, first FROM counted WHERE shared >= least
  QUALIFY row_number() OVER (PARTITION BY doc_id, template, first // {stride} ORDER BY shared DESC, first) = 1
),
kept AS (
  SELECT doc_id, label, shared / total AS part FROM met m
  WHERE NOT EXISTS (
    SELECT 1 FROM met o WHERE o.doc_id = m.doc_id AND o.label <> m.label
      AND o.first < m.first + m.span AND m.first < o.first + o.span
      AND (o.shared * m.total > m.shared * o.total OR (o.shared * m.total = m.shared * o.total AND o.total > m.total))
  )
),
found AS (SELECT doc_id, list(DISTINCT label) AS more, max(part) AS part FROM kept GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  array_to_string(list_sort(coalesce(own, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(more, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(part, 0.0)::DOUBLE END AS score
FROM worded LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)
"""


OP8 = f"""
WITH RECURSIVE able AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
edges AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM able x JOIN able y
    ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.98
),
counts AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM edges UNION ALL SELECT b FROM edges) GROUP BY id),
{_REACH}
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(component, vec_id) AS component_id,
  coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN counts ON id = vec_id LEFT JOIN smallest ON node = vec_id
"""

OP10 = rf"""
WITH items AS (
  SELECT item_id, w, least(13, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0
),
windows AS (
  SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' '))) AS win
  FROM items
),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos, w FROM docs, (SELECT DISTINCT n FROM items) WHERE len(w) >= n
),
found AS (
  SELECT doc_id, pos, p.n, item_id
  FROM (SELECT doc_id, n, pos, array_to_string(w[pos : pos + n - 1], ' ') AS win FROM places) p
  JOIN windows x ON x.win = p.win AND x.n = p.n
),
hits AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS spot FROM found) GROUP BY 1
),
named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids
  FROM found GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP11 = """
WITH RECURSIVE kept AS (
  SELECT vec_id, row_number() OVER () AS row,
    list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS pos
  FROM embeddings
  WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
parts AS (SELECT row, unnest(pos) AS x, unnest(range(64)) AS d FROM kept),
rounds(turn, c, pos) AS (
  SELECT 0, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1, pos
  FROM (SELECT * FROM kept ORDER BY sha256('1:' || vec_id) LIMIT 16)
  UNION ALL
  (WITH apart AS (
    SELECT k.row, r.turn, r.c, list_sum(list_transform(range(1, 65), lambda i: (k.pos[i] - r.pos[i]) * (k.pos[i] - r.pos[i]))) AS far
    FROM kept k, rounds r WHERE r.turn < 3
  ),
  own AS (SELECT row, turn, arg_min(c, far * 1000 + c) AS c FROM apart GROUP BY row, turn),
  sums AS (
    SELECT o.turn, o.c, p.d, sum(p.x)::HUGEINT AS s, count(*)::HUGEINT AS n
    FROM own o JOIN parts p USING (row) GROUP BY o.turn, o.c, p.d
  ),
  moved AS (SELECT turn, c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY d) AS pos FROM sums GROUP BY turn, c)
  SELECT r.turn + 1, r.c, coalesce(m.pos, r.pos) FROM rounds r LEFT JOIN moved m ON m.c = r.c WHERE r.turn < 3)
),
final AS (SELECT c, pos FROM rounds WHERE turn = 3),
apart AS (
  SELECT k.row, k.vec_id, f.c, list_sum(list_transform(range(1, 65), lambda i: (k.pos[i] - f.pos[i]) * (k.pos[i] - f.pos[i]))) AS far
  FROM kept k, final f
),
own AS (SELECT row, any_value(vec_id) AS vec_id, arg_min(c, far * 1000 + c) AS c, min(far) AS far FROM apart GROUP BY row)
SELECT vec_id, c::INTEGER AS cluster, far::BIGINT AS distance,
  (sum(far) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(far) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(pos, ',')) AS centroid_sha256
FROM own JOIN final USING (c)
"""

OP12 = r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
),
sized AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\', '')) AS own,
    list_sum(list_transform(['### System', '### User', '### Assistant', '### Role ', '</turn>'],
      lambda s: (length(text) - length(replace(text, s, ''))) / length(s)))::BIGINT AS broken,
    length('### ' || role || ': ' || '</turn>') + 1 AS around
  FROM turns
),
found AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(own + broken + around)::BIGINT AS formatted_chars,
    string_agg(substr(role, 1, 1), '' ORDER BY turn) AS roles
  FROM sized GROUP BY conv_id
),
good AS (SELECT *, length(regexp_extract(roles, '^s?(ua)*u?')) AS well FROM found)
SELECT conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
  CASE WHEN well < n_turns OR NOT ends_with(roles, 'a') THEN well END AS first_violation
FROM good
"""


def _leaf(n_chars: str) -> str:
    fields = ["doc_id", "source", "lang", n_chars, "text"]
    parts = [f"coalesce(octet_length(encode(({f})::VARCHAR)) || ':' || ({f})::VARCHAR, '-')" for f in fields]
    return f"sha256({' || '.join(parts)})"


OP13 = f"""
WITH RECURSIVE given AS (
  SELECT *, {_leaf('n_chars')} AS leaf, {_leaf('n_chars + 1')} AS changed,
    -- crc32 of the id's decimal form, bit by bit
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda a, b: xor(a >> 1, 3988292384 * (a & 1))))) % 7 = 0 AS tampered
  FROM documents
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
  FROM given
),
low(tree, level, pos, node) AS (
  SELECT tree, 0, pos, leaf FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM low
  WHERE tree IN (SELECT tree FROM low GROUP BY tree HAVING count(*) > 1)
  GROUP BY tree, level, pos // 2
),
subroots AS (SELECT tree, node AS subroot, level FROM low l
  WHERE level = (SELECT max(level) FROM low m WHERE m.tree = l.tree)),
high(level, pos, node) AS (
  SELECT 0, tree, subroot FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM high
  WHERE (SELECT count(*) FROM high) > 1 GROUP BY level, pos // 2
),
steps AS (
  SELECT p.doc_id, p.leaf, l.level AS step, s.node AS sibling, (p.pos >> l.level) % 2 = 1 AS sibling_left, p.tree, p.pos
  FROM placed p
  JOIN (SELECT tree, level FROM low GROUP BY tree, level) l ON l.tree = p.tree
  JOIN subroots r ON r.tree = p.tree AND l.level < r.level
  LEFT JOIN low s ON s.tree = p.tree AND s.level = l.level AND s.pos = xor(p.pos >> l.level, 1)
  UNION ALL
  SELECT p.doc_id, p.leaf, 1000 + h.level, s.node, (p.tree >> h.level) % 2 = 1, p.tree, p.pos
  FROM placed p
  JOIN (SELECT DISTINCT level FROM high) h ON h.level < (SELECT max(level) FROM high)
  LEFT JOIN high s ON s.level = h.level AND s.pos = xor(p.tree >> h.level, 1)
),
paths AS (
  SELECT tree, pos, list(struct_pack(sibling := coalesce(sibling, ''), to_left := sibling_left) ORDER BY step) AS path FROM steps GROUP BY tree, pos
),
proven AS (
  SELECT doc_id, leaf, subroot, (SELECT node FROM high ORDER BY level DESC LIMIT 1) AS root,
    CASE WHEN tampered THEN changed ELSE leaf END AS checked, coalesce(path, []) AS path
  FROM placed p JOIN subroots USING (tree) LEFT JOIN paths USING (tree, pos)
),
folded AS (
  SELECT *, sha256(list_reduce(list_prepend('', list_transform(path, lambda s: s.sibling)), lambda a, b: a || b)) AS proof_sha256,
    list_reduce(list_prepend(struct_pack(sibling := checked, to_left := false), path),
      lambda a, s: struct_pack(sibling := sha256(CASE WHEN s.to_left THEN s.sibling || a.sibling ELSE a.sibling || s.sibling END), to_left := false)
    ).sibling AS folded_root
  FROM proven
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""

ORACLES = {
    "op1_url_filter": _op1(),
    "op2_minhash_near_dedup": OP2,
    "op3_warc": OP3,
    "op4_license_scan": _op4(),
    "op8_embedding_near_dedup": OP8,
    "op10_decontamination": OP10,
    "op11_centroid_clustering": OP11,
    "op12_chat_formatting": OP12,
    "op13_merkle_manifest": OP13,
}
