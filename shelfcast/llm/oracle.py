"""DuckDB SQL for those of the text queries that SQL can express."""

_BLANK = r"E' \t\r'"

SPREAD_LINES = rf"""
lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM documents WHERE text IS NOT NULL
),
spread AS (
  SELECT trim(line, {_BLANK}) AS line FROM lines WHERE trim(line, {_BLANK}) <> ''
  GROUP BY 1 HAVING count(DISTINCT coalesce('s' || source, 'none')) >= 8
)"""

OP2 = r"""
WITH tok AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS t
  FROM documents
),
items AS (
  SELECT min(item_id) AS item_id, t FROM (
    SELECT item_id,
           list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS t
    FROM benchmark)
  WHERE len(t) >= 6 GROUP BY t
),
item_grams AS (
  SELECT item_id, p, array_to_string(t[p:p + 3], ' ') AS g
  FROM (SELECT item_id, t, unnest(range(1, len(t) - 2)) AS p FROM items)
),
doc_grams AS (
  SELECT doc_id, p, array_to_string(t[p:p + 3], ' ') AS g
  FROM (SELECT doc_id, t, unnest(range(1, len(t) - 2)) AS p FROM tok WHERE len(t) >= 4)
),
aligned AS (
  SELECT DISTINCT d.doc_id, i.item_id, d.p - i.p AS shift FROM doc_grams d JOIN item_grams i USING (g)
),
compared AS (
  SELECT doc_id, item_id, shift, ip, least(12, len(i.t)) AS w,
         CASE WHEN len(i.t) >= 12 THEN 10 ELSE len(i.t) END AS need, (i.t[ip] = d.t[ip + shift])::INT AS same
  FROM (SELECT a.*, unnest(range(1, len(t) + 1)) AS ip FROM aligned a JOIN items USING (item_id)) a
  JOIN items i USING (item_id) JOIN tok d USING (doc_id)
  WHERE ip + shift BETWEEN 1 AND len(d.t)
),
windows AS (
  SELECT doc_id, item_id, shift, ip, w, need,
         sum(same) OVER (PARTITION BY doc_id, item_id, shift ORDER BY ip ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS m,
         count(*) OVER (PARTITION BY doc_id, item_id, shift ORDER BY ip ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS n
  FROM compared
)
SELECT doc_id, item_id, (min(ip - w + shift))::BIGINT AS first_word, (max(ip + shift - 1))::BIGINT AS last_word,
       max(m)::BIGINT AS best_match
FROM windows WHERE n = w AND m >= need GROUP BY doc_id, item_id
"""

OP6 = rf"""
WITH {SPREAD_LINES}
SELECT d.doc_id, CASE WHEN coalesce(text, '') = '' THEN 0 ELSE len(string_split(text, chr(10))) END::BIGINT AS n_lines,
       coalesce(c.n_removed, 0)::BIGINT AS n_removed,
       md5(CASE WHEN text IS NOT NULL THEN coalesce(c.kept, '') END) AS kept_md5
FROM documents d LEFT JOIN (
  SELECT l.doc_id, count(s.line) AS n_removed, string_agg(l.line, chr(10) ORDER BY place) FILTER (s.line IS NULL) AS kept
  FROM lines l LEFT JOIN spread s ON trim(l.line, {_BLANK}) = s.line GROUP BY l.doc_id
) c USING (doc_id)
"""

# Twenty bits of the digest at a time give four letters.
OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
latest AS (SELECT h, max(page_id) AS latest FROM p GROUP BY h)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(sha1(h), ((i // 4) * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> latest THEN latest END AS refers_to
FROM p JOIN latest USING (h)
"""

OP8 = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS t
  FROM documents
),
windows AS (
  SELECT doc_id, p, array_to_string(t[p:p + 12], ' ') AS g
  FROM (SELECT doc_id, t, unnest(range(1, len(t) - 11)) AS p FROM w WHERE len(t) >= 13)
),
firsts AS (SELECT g, min(doc_id) AS first FROM windows GROUP BY g),
gone AS (
  SELECT DISTINCT doc_id, p + k AS place
  FROM (SELECT doc_id, p FROM windows JOIN firsts USING (g) WHERE first < doc_id), range(0, 13) AS r(k)
),
places AS (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS place FROM w)
SELECT w.doc_id, len(w.t)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN (
  SELECT p.doc_id, count(g.place) AS n_removed,
         string_agg(t[p.place], ' ' ORDER BY p.place) FILTER (g.place IS NULL) AS kept
  FROM places p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.place = p.place GROUP BY p.doc_id
) USING (doc_id)
"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text in DuckDB, bit by bit."""
    bits = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: [ascii(substr({text}, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(crc, b) >> 1, 3988292384 * (xor(crc, b) & 1))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), lambda crc, b: {step}), 4294967295)"


OP11 = f"""
WITH t AS (
  SELECT conv_id, length(x) AS size, md5(concat(length(r), ':', r, x)) AS id,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, md5(concat(length(r), ':', r, x))) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)
),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS head, {_crc32("conv_id::VARCHAR")} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
),
made AS (
  SELECT c.conv_id, pos, id, size FROM c JOIN t ON t.conv_id = head AND pos <= h
  UNION ALL SELECT c.conv_id, pos, id, size FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h
),
firsts AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(id, '') OVER w AS path, size FROM made
  WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, '', 0 FROM c
),
nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * min(size) AS own FROM firsts GROUP BY depth, path
),
kids AS (SELECT path[:32 * (depth - 1)] AS path, count(*) AS kids FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT nodes.*, coalesce(kids, 0) AS kids FROM nodes LEFT JOIN kids USING (path)),
sums AS (
  SELECT path[:32 * up] AS path, count(*) FILTER (kids = 0) AS leaves, sum(own) AS saved
  FROM (SELECT path, kids, own, unnest(range(0, depth + 1)) AS up FROM full_nodes) GROUP BY 1
),
ends AS (
  SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends
  FROM (SELECT conv_id, max_by(path, depth) AS path FROM firsts GROUP BY conv_id) GROUP BY path
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n::BIGINT AS n_convs, n.kids::BIGINT AS n_children,
       leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM full_nodes n JOIN sums USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[:32 * (n.depth - 1)]
"""

# The four endings of a repaired conversation (nothing, system, user, assistant) hold the least cost, audit and lines.
_NO = 1_000_000_000


def _edit(state: str, cost: str, letter: str, line: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {line}}}"


def _made(x: str, name: str, states: tuple[int, ...]) -> str:
    return ", ".join(_edit(f"{x}[{i}]", "5", "I", f"chr(10) || '{name}:'") for i in states)


def _inserted(x: str) -> str:
    return f"[{x}[1], {x}[2], list_min([{x}[3], {_made(x, 'user', (1, 2, 4))}]), list_min([{x}[4], {_made(x, 'assistant', (3,))}])]"


def _turned(x: str) -> str:
    line = "chr(10) || e.r.role || ':' || e.r.text"
    new = lambda name: f"chr(10) || '{name}:' || e.r.text"
    keep = lambda i, role: _edit(f"{x}[{i}]", f"e.r.{role}", "K", line)
    gone = [_edit(f"{x}[{i}]", "2", "D", "''") for i in (1, 2, 3, 4)]
    user = [keep(i, "u") for i in (1, 2, 4)] + [_edit(f"{x}[{i}]", "e.r.re", "R", new("user")) for i in (1, 2, 4)]
    agent = [keep(3, "a"), _edit(f"{x}[3]", "e.r.re", "R", new("assistant"))]
    options = [[gone[0]], [gone[1], keep(1, "s")], [gone[2], *user], [gone[3], *agent]]
    return "[" + ", ".join(f"list_min([{', '.join(o)}])" for o in options) + "]"


_LET = lambda value, name, body: f"list_transform([{value}], lambda {name}: {body})[1]"
_STEP = _LET(_inserted("s.x"), "y", _LET(_inserted("y"), "z", f"{{'x': {_turned('z')}, 'r': e.r}}"))
_START = "[{'c': 0, 'a': '', 't': ''}" + f", {{'c': {_NO}, 'a': '', 't': ''}}" * 3 + "]"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP12 = f"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("fate_of")} % 20 AS fate
  FROM (SELECT *, concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS fate_of FROM conversations)
),
d AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(0, CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM r WHERE fate <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS p, rtrim(text, {_BLANKS}) AS said
  FROM d
),
judged AS (
  SELECT *, role[1] AS first, CASE
           WHEN said = '' THEN 'b'
           WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'd'
           WHEN said[-1] NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY p) AS before
  FROM placed
),
coded AS (
  SELECT *, CASE WHEN fault IN ('b', 'd') THEN {_NO} WHEN fault = 't' THEN 5 ELSE 0 END AS cost FROM judged
),
told AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (before || first NOT IN ('su', 'ua', 'au')) AS illegal,
         list({{'x': {_START}, 'r': {{'role': role, 'text': text, 're': cost + 1,
                's': CASE WHEN first = 's' THEN cost ELSE {_NO} END, 'u': CASE WHEN first = 'u' THEN cost ELSE {_NO} END,
                'a': CASE WHEN first = 'a' THEN cost ELSE {_NO} END}}}} ORDER BY p) AS turns
  FROM coded GROUP BY conv_id
),
walked AS (
  SELECT * EXCLUDE (turns), list_reduce(list_concat([turns[1]], turns), lambda s, e: {_STEP}).x AS x FROM told
),
best AS (
  SELECT * EXCLUDE (x), {_LET(_inserted("x"), "y", "list_min([y[1], y[4]])")} AS b FROM walked
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost,
       coalesce(b.a, '') AS audit, sha256(coalesce(b.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN best ON o.conv_id IS NOT DISTINCT FROM best.conv_id
"""

OP13 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS t FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(t) >= 2 THEN list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])
                                      ELSE t END) AS g FROM w
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
),
reached AS (
  SELECT doc_id, doc_id AS r FROM w
  UNION SELECT b, r FROM reached JOIN links ON a = reached.doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(r) AS component_id FROM reached GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""

LLM_ORACLE = {
    "op2_decontaminate": OP2,
    "op3_archives": OP3,
    "op6_line_spread": OP6,
    "op8_substrings": OP8,
    "op11_prefix_trie": OP11,
    "op12_repair": OP12,
    "op13_minhash": OP13,
}
