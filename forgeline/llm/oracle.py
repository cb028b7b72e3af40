"""DuckDB SQL for the operators that SQL can express."""

_WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
g AS (SELECT doc_id, unnest(list_transform(range(1, len(ws) - 11), lambda i: {{'i': i, 'k': ws[i:i + 12]}})) AS x FROM w),
m AS (SELECT x.k AS k, min(doc_id) AS first FROM g GROUP BY 1),
c AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(x.i, x.i + 13)) AS p FROM g JOIN m ON g.x.k = m.k WHERE m.first < doc_id) GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN c ON w.doc_id = c.doc_id
"""

OP5 = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(list_transform(range(1, len(ls) + 1), lambda i: {{'i': i, 'ws': regexp_extract_all(ls[i], '{_WORD}')}})) AS x FROM d),
t AS (SELECT doc_id, x.i AS i, list_transform(x.ws, lambda w: CASE WHEN regexp_matches(w, '[0-9@]|://') THEN '<*>' ELSE w END) AS toks FROM l WHERE len(x.ws) > 0),
k AS (SELECT doc_id, i, toks, {{'n': len(toks), 'lead': toks[1:3]}} AS leaf FROM t),
big AS (SELECT leaf FROM k GROUP BY leaf HAVING count(*) >= 10),
c AS (SELECT k.* FROM k JOIN big USING (leaf)),
u AS (SELECT DISTINCT leaf, toks FROM c),
n AS (SELECT leaf, count(*) AS n_lines FROM u GROUP BY leaf),
p AS (SELECT leaf, toks, n_lines, unnest(range(1, len(toks) + 1)) AS pos FROM u JOIN n USING (leaf) WHERE n_lines > 1),
s AS (SELECT leaf, pos, toks[pos] AS tok, count(*) AS support FROM p GROUP BY ALL),
q AS (SELECT p.leaf, p.toks, list({{'pos': p.pos, 'tok': s.tok, 'sup': CASE WHEN support >= 2 AND s.tok <> '<*>' THEN support END}} ORDER BY p.pos) AS parts
      FROM p JOIN s ON p.leaf = s.leaf AND p.pos = s.pos AND p.toks[p.pos] = s.tok GROUP BY p.leaf, p.toks),
a AS (SELECT leaf, toks, parts, list_reverse_sort(list_transform(list_filter(parts, lambda x: x.pos > 3 AND x.sup IS NOT NULL), lambda x: x.sup)) AS beyond,
             len(list_filter(parts, lambda x: x.pos <= 3 AND x.sup IS NOT NULL)) AS n_lead FROM q),
b AS (SELECT *, beyond[greatest(1, ceil(0.5::DOUBLE * len(parts))::BIGINT - n_lead)] AS alike FROM a),
g AS (SELECT leaf, toks, alike, list_transform(parts, lambda x: CASE WHEN x.sup IS NOT NULL AND (x.pos <= 3 OR x.sup >= alike * 0.1::DOUBLE) THEN x.tok ELSE '<*>' END) AS shape
      FROM b WHERE alike IS NOT NULL),
chance AS (SELECT DISTINCT leaf, shape FROM (SELECT leaf, shape, alike, count(*) AS n FROM g GROUP BY ALL) WHERE n < alike * 0.1::DOUBLE),
ok AS (SELECT g.leaf, g.toks, g.shape FROM g LEFT JOIN chance c ON c.leaf = g.leaf AND c.shape = g.shape WHERE c.leaf IS NULL),
m AS (SELECT u.leaf, u.toks, CASE WHEN ok.shape IS NOT NULL THEN {{'general': true, 'shape': ok.shape}} ELSE {{'general': false, 'shape': u.toks}} END AS template
      FROM u LEFT JOIN ok ON u.leaf = ok.leaf AND u.toks = ok.toks),
cm AS (SELECT c.doc_id, c.i, c.leaf, m.template FROM c JOIN m ON c.leaf = m.leaf AND c.toks = m.toks),
r AS (SELECT leaf, template, min(doc_id) AS first FROM cm GROUP BY ALL HAVING count(DISTINCT doc_id) >= 10),
x AS (SELECT doc_id, list(i) AS gone FROM cm JOIN r USING (leaf, template) WHERE doc_id <> first GROUP BY doc_id)
SELECT d.doc_id, len(ls)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_dropped,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN ls ELSE list_filter(ls, lambda l, i: NOT list_contains(gone, i)) END, chr(10))) AS kept_sha256
FROM d LEFT JOIN x ON d.doc_id = x.doc_id
"""

OP6 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

OP9 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: ws[i:i + 4]) WHEN len(ws) > 0 THEN [ws] ELSE [] END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 80 * (na.n + nb.n - common)),
e2 AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e2.b FROM r JOIN e2 ON r.c = e2.a)
SELECT doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(c) AS component_id
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

OP9_LINKS = OP9[:OP9.index("e2 AS")].replace("WITH RECURSIVE", "WITH") + """
k AS (SELECT doc_id, list(sh ORDER BY sh) AS own FROM s GROUP BY 1),
e2 AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, count(DISTINCT kb.own) FILTER (kb.own <> ka.own) AS n_links
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN k ka ON ka.doc_id = d.doc_id LEFT JOIN e2 ON e2.a = d.doc_id LEFT JOIN k kb ON kb.doc_id = e2.b
GROUP BY d.doc_id
"""

OP9 = f"WITH comp AS ({OP9}), links AS ({OP9_LINKS}) SELECT doc_id, comp.n_shingles, component_id, n_links FROM comp JOIN links USING (doc_id)"

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(column: str) -> str:
    return f"regexp_extract_all(translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')"


OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_terms('text')} AS ws FROM documents),
t AS (SELECT count(*) FILTER (len(ws) > 0)::BIGINT AS big_n, sum(len(ws))::BIGINT AS l FROM d),
tf AS (SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(ws) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY 1),
w AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, t),
m AS (SELECT row, doc_id, 10 + (90 * len(ws)::BIGINT * big_n) // l AS m FROM d, t WHERE len(ws) > 0),
i AS (SELECT DISTINCT item, item_id, term FROM (SELECT row_number() OVER () AS item, item_id, unnest({_terms('text')}) AS term FROM benchmark)),
s AS (SELECT item, item_id, doc_id, row, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM i JOIN tf USING (term) JOIN w USING (term) JOIN m USING (row) GROUP BY ALL HAVING score > 0)
SELECT item_id, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM s QUALIFY rank <= 10
"""



def _op12() -> str:
    from forgeline.llm import secret_scan as scan

    k = len(scan.ALPHABET)

    def spans(kind: int, pattern: str, group: int, least: int) -> str:
        p = pattern.replace("'", "''")
        return f"""SELECT row, start, {kind} AS kind, start + size AS stop, value FROM (
            SELECT row, unnest(range(1, len(ms) + 1)) AS i, ms[i] AS m, length(m) AS size, vs[i] AS value,
                   (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start
            FROM (SELECT row, regexp_extract_all(text, '{p}') AS ms, regexp_extract_all(text, '{p}', {group}) AS vs, regexp_split_to_array(text, '{p}') AS gaps FROM d))
            WHERE length(value) >= {least}"""

    rules = " UNION ALL ".join(spans(i, *rule) for i, rule in enumerate(scan.RULES.values()))
    listed = ("string_agg(CASE kind " + " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(scan.KINDS))
              + " END || ':' || start || ':' || stop, ',' ORDER BY start, kind)")
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
base AS ({rules}),
tokens AS (SELECT * FROM ({spans(len(scan.RULES), scan.TOKEN, 1, scan.TOKEN_CHARS)}) t
           WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.row = t.row AND b.start < t.stop AND t.start < b.stop)),
c AS (SELECT row, start, value, random, x.i AS i, instr('{scan.ALPHABET}', x.a) AS a, instr('{scan.ALPHABET}', x.b) AS b FROM (
      SELECT *, unnest(list_transform(range(1, length(value)), lambda i: {{'i': i, 'a': value[i], 'b': value[i + 1]}})) AS x
      FROM (SELECT row, start, value, true AS random FROM base UNION ALL SELECT row, start, value, false FROM tokens))),
n AS (SELECT a, b, count(*) FILTER (random) AS r, count(*) FILTER (NOT random) AS o FROM c WHERE a > 0 AND b > 0 GROUP BY ALL),
na AS (SELECT a, sum(r)::DOUBLE AS r, sum(o)::DOUBLE AS o FROM n GROUP BY 1),
nb AS (SELECT b, sum(r) + 1 AS r, sum(o) + 1 AS o FROM n GROUP BY 1),
nn AS (SELECT sum(r) + {k} AS r, sum(o) + {k} AS o FROM n),
p AS (SELECT n.a, n.b, (n.r::DOUBLE + {scan.PULL}::DOUBLE * (nb.r::DOUBLE / nn.r::DOUBLE)) / (na.r + {scan.PULL}::DOUBLE) AS r,
             (n.o::DOUBLE + {scan.PULL}::DOUBLE * (nb.o::DOUBLE / nn.o::DOUBLE)) / (na.o + {scan.PULL}::DOUBLE) AS o FROM n JOIN na USING (a) JOIN nb USING (b), nn),
ratio AS (SELECT a, b, floor(1000.0::DOUBLE * ln(r / o))::BIGINT AS ratio FROM p),
added AS (SELECT row, start, {len(scan.RULES)} AS kind, start + length(value) AS stop FROM c JOIN ratio USING (a, b) WHERE NOT random
          GROUP BY row, start, value HAVING sum(ratio) >= {scan.MIN_RATIO}),
b2 AS (SELECT row, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex, {listed} AS listed FROM base GROUP BY row),
s2 AS (SELECT row, {listed} AS listed FROM (SELECT row, start, kind, stop FROM base UNION ALL SELECT * FROM added) GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b2.listed, '')) AS base_sha256, coalesce(s2.listed, '') AS spans
FROM d LEFT JOIN b2 USING (row) LEFT JOIN s2 USING (row)
"""


#: crc32 of a decimal number's text, bit by bit
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii((c::VARCHAR)[i])::BIGINT)),
    lambda x, y: list_reduce(list_prepend(xor(x, y), range(8)), lambda u, v: xor(u >> 1, 3988292384 * (u & 1)))))"""

OP13 = f"""
WITH o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place,
                  {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said FROM conversations WHERE conv_id IS NOT NULL),
g AS (SELECT conv_id, list(said ORDER BY place) AS own FROM o GROUP BY 1),
h AS (SELECT conv_id, own, {_CRC.replace('c::', 'conv_id::')} % 9 AS h FROM g),
b AS (SELECT h.conv_id, list_concat(coalesce(d.own[1:h.h], []), h.own[h.h + 1:]) AS said FROM h LEFT JOIN g d ON d.conv_id = h.conv_id - h.conv_id % 5),
p AS (SELECT conv_id AS member, len(said) AS turns, unnest(range(len(said) + 1)) AS depth, said FROM b),
n AS (SELECT depth, said[1:depth] AS way, min(member) AS conv_id, count(*) AS n_convs,
             coalesce(string_agg(member::VARCHAR, ',' ORDER BY member) FILTER (turns = depth), '') AS ended,
             (count(*) - 1) * coalesce(max(octet_length(encode(said[depth].text))), 0) AS saved FROM p GROUP BY ALL),
m AS (SELECT p.member, n.depth, n.conv_id FROM p JOIN n ON n.depth = p.depth AND n.way = p.said[1:p.depth]),
k AS (SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, n.ended, n.saved
      FROM n LEFT JOIN m up ON up.member = n.conv_id AND up.depth = n.depth - 1),
c AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM k WHERE depth > 0 GROUP BY ALL),
f AS (SELECT k.*, coalesce(n_children, 0) AS n_children FROM k LEFT JOIN c USING (conv_id, depth)),
t AS (SELECT m.conv_id, m.depth, count(*) FILTER (f.n_children = 0) AS n_leaves, sum(f.saved)::BIGINT AS saved_tokens
      FROM f JOIN m ON m.member = f.conv_id AND m.depth <= f.depth GROUP BY ALL)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ended) AS ends_sha256 FROM f JOIN t USING (conv_id, depth)
"""

SQL = {"op1_substring_dedup": OP1, "op5_line_dedup": OP5, "op6_exact_topk": OP6, "op9_ngram_join": OP9, "ngram_join_links": OP9_LINKS, "op11_bag_search": OP11, "op12_secret_scan": _op12(), "op13_prefix_trie": OP13}
