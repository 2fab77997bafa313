"""DuckDB SQL of the queries that SQL can express on whole tables.

Missing on purpose: op1 (tested against a dictionary model), op2 and op6 (a trained model and a
tokenizer), op4 (tested against Python), op12 (eigenvectors; tested against numpy), op13 (a trained model).
"""

from __future__ import annotations

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP3 = (
    r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, """
    + _WORDS.format("t")
    + r""" AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
windows AS (SELECT rid, i, ws[i : i + 4] AS g FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w)),
again AS (SELECT rid, i, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i), i + 5) AS nxt
          FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows) WHERE c > 1),
covered AS (SELECT rid, sum(least(5, nxt - i))::BIGINT AS n FROM again GROUP BY rid),
m AS (SELECT w.rid, doc_id, lang, source, len(ws)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
        coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(list_distinct(ws)) AS n_unlike
      FROM w LEFT JOIN covered c ON c.rid = w.rid),
v AS (SELECT rid, lang, source, n_words, u.rule, u.num, u.den, u.num * 1000 // greatest(u.den, 1) AS v FROM (SELECT rid, lang, source, n_words, unnest([
        {'rule': 'symbols', 'num': n_symbols, 'den': word_chars},
        {'rule': 'dup_lines', 'num': n_dup_lines, 'den': n_lines},
        {'rule': 'variety', 'num': n_unlike, 'den': n_words},
        {'rule': 'words', 'num': word_chars, 'den': n_words}]) AS u FROM m)),
b AS (SELECT lang, source, rule, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bin, count(*) AS n
      FROM v WHERE n_words > 0 GROUP BY ALL),
own AS (SELECT lang, source, rule, max(s) AS size, min(bin) FILTER (cum * 100 >= s * 25) AS q1, min(bin) FILTER (cum * 100 >= s * 50) AS q2, min(bin) FILTER (cum * 100 >= s * 75) AS q3
        FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source, rule ORDER BY bin) AS cum, sum(n) OVER (PARTITION BY lang, source, rule) AS s FROM b) GROUP BY ALL),
bl AS (SELECT lang, rule, bin, sum(n) AS n FROM b GROUP BY ALL),
byl AS (SELECT lang, rule, max(s) AS size, min(bin) FILTER (cum * 100 >= s * 25) AS q1, min(bin) FILTER (cum * 100 >= s * 50) AS q2, min(bin) FILTER (cum * 100 >= s * 75) AS q3
        FROM (SELECT *, sum(n) OVER (PARTITION BY lang, rule ORDER BY bin) AS cum, sum(n) OVER (PARTITION BY lang, rule) AS s FROM bl) GROUP BY ALL),
ba AS (SELECT rule, bin, sum(n) AS n FROM b GROUP BY ALL),
every AS (SELECT rule, min(bin) FILTER (cum * 100 >= s * 25) AS q1, min(bin) FILTER (cum * 100 >= s * 50) AS q2, min(bin) FILTER (cum * 100 >= s * 75) AS q3
        FROM (SELECT *, sum(n) OVER (PARTITION BY rule ORDER BY bin) AS cum, sum(n) OVER (PARTITION BY rule) AS s FROM ba) GROUP BY ALL),
lim AS (SELECT o.lang, o.source, o.rule,
          CASE WHEN o.size >= 50 THEN o.q1 WHEN l.size >= 50 THEN l.q1 ELSE e.q1 END AS q1,
          CASE WHEN o.size >= 50 THEN o.q2 WHEN l.size >= 50 THEN l.q2 ELSE e.q2 END AS q2,
          CASE WHEN o.size >= 50 THEN o.q3 WHEN l.size >= 50 THEN l.q3 ELSE e.q3 END AS q3, 6 * (CASE WHEN o.size >= 50 THEN o.q3 - o.q1 WHEN l.size >= 50 THEN l.q3 - l.q1 ELSE e.q3 - e.q1 END) AS room
        FROM own o JOIN byl l ON o.lang IS NOT DISTINCT FROM l.lang AND o.rule = l.rule JOIN every e ON e.rule = o.rule),
far AS (SELECT v.rid, bool_or(CASE
            WHEN v.rule IN ('symbols', 'dup_lines') THEN num * 1000 > (q3 + room) * den + 8000
            WHEN v.rule = 'variety' THEN num * 1000 < (q1 - room) * den - 8000
            ELSE num * 1000 > (q3 + room) * den + 8 * q2 OR num * 1000 < (q1 - room) * den - 8 * q2 END) AS far
        FROM v JOIN lim ON v.lang IS NOT DISTINCT FROM lim.lang AND v.source IS NOT DISTINCT FROM lim.source AND v.rule = lim.rule GROUP BY v.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       (NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT coalesce(far.far, false)) AS kept
FROM m LEFT JOIN far ON far.rid = m.rid
"""
)

OP5 = r"""
WITH c AS (SELECT page_id, url, 1704067200 + ((page_id * 7919) % 31536000 + 31536000) % 31536000 AS fetched_at,
             lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)', 1)) AS host,
             regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)', 2) AS path FROM pages),
h AS (SELECT host, ('0x' || substr(md5(host), 1, 7))::BIGINT AS x, ('0x' || substr(md5(host), 8, 7))::BIGINT AS y,
        ('0x' || substr(md5(host), 15, 7))::BIGINT AS z FROM (SELECT DISTINCT host FROM c WHERE host <> '')),
t AS (SELECT *, 1704067200 + y % 31536000 AS a, 1704067200 + y % 31536000 + z % 15768000 AS r FROM h),
valid AS (
  SELECT 'unsafe' AS list, 'domain' AS kind, host AS pattern, a AS since, r AS until FROM t WHERE x % 3 = 0 AND r > a
  UNION ALL SELECT 'unsafe', 'domain', host, r + 7884000, NULL FROM t WHERE x % 3 = 0
  UNION ALL SELECT 'directories', 'prefix', host || '/en/', a, a + 10512000 FROM t WHERE x % 5 = 0),
hit AS (SELECT DISTINCT c.url, c.fetched_at, v.list FROM c JOIN valid v ON
          ((v.kind = 'domain' AND (c.host = v.pattern OR ends_with(c.host, '.' || v.pattern)))
           OR (v.kind = 'prefix' AND starts_with(c.host || CASE WHEN c.path = '' THEN '/' ELSE c.path END, v.pattern)))
          AND v.since <= c.fetched_at AND (v.until IS NULL OR c.fetched_at < v.until)),
g AS (SELECT url, fetched_at, string_agg(list, ',' ORDER BY list) AS lists FROM hit GROUP BY ALL)
SELECT c.page_id, c.url, c.fetched_at, g.lists IS NOT NULL AS blocked, coalesce(g.lists, '') AS lists
FROM c LEFT JOIN g ON c.url = g.url AND c.fetched_at = g.fetched_at
"""

OP7 = r"""
WITH l AS (SELECT doc_id, unnest(generate_series(1, len(ls))) - 1 AS line_no, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
w AS (SELECT *, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM l),
k AS (SELECT * FROM w WHERE len(ws) > 0),
u AS (SELECT line, any_value(ws) AS ws, min(struct_pack(doc_id := doc_id, line_no := line_no)) AS f FROM k GROUP BY line),
r AS (SELECT line, ws, f, len(ws) AS n, row_number() OVER (ORDER BY f) AS nr FROM u),
v AS (SELECT line, nr, n, p, array_to_string(list_concat(ws[1 : p - 1], ws[p + 1 :]), ' ') AS key FROM (SELECT *, unnest(generate_series(1, n)) AS p FROM r WHERE n >= 10)),
s AS (SELECT nr, min(nr) OVER (PARTITION BY key, p) AS other FROM v),
g AS (SELECT v.nr AS long, r.nr AS short FROM v JOIN r ON v.key = array_to_string(r.ws, ' ') AND r.n >= 10),
near AS (SELECT nr, min(other) AS other FROM (SELECT nr, other FROM s UNION ALL SELECT long, short FROM g UNION ALL SELECT short, long FROM g) WHERE other < nr GROUP BY nr),
fate AS (SELECT r.line, r.f, o.f AS near_f FROM r LEFT JOIN near ON near.nr = r.nr LEFT JOIN r o ON o.nr = near.other)
SELECT k.doc_id, k.line_no::BIGINT AS line_no, CASE WHEN (k.doc_id, k.line_no) = (f.doc_id, f.line_no) THEN 'near' ELSE 'exact' END AS kind,
       CASE WHEN (k.doc_id, k.line_no) = (f.doc_id, f.line_no) THEN near_f.doc_id ELSE f.doc_id END AS first_doc_id,
       (CASE WHEN (k.doc_id, k.line_no) = (f.doc_id, f.line_no) THEN near_f.line_no ELSE f.line_no END)::BIGINT AS first_line_no
FROM k JOIN fate ON fate.line = k.line
WHERE near_f IS NOT NULL OR (k.doc_id, k.line_no) <> (f.doc_id, f.line_no)
"""

OP8 = (
    r"""
WITH RECURSIVE w AS (SELECT doc_id, """
    + _WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    + r""" AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(generate_series(1, len(ws) - 4), lambda i: array_to_string(ws[i : i + 4], ' ')))
                          WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS g FROM w),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
      HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, q.b FROM reach r JOIN both_ways q ON r.b = q.a)
SELECT s.doc_id, len(g)::BIGINT AS n_shingles, least(s.doc_id, coalesce(m.low, s.doc_id)) AS component_id
FROM s LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) m ON m.a = s.doc_id
"""
)

OP9 = (
    r"""
WITH d AS (SELECT doc_id, """
    + _WORDS.format("lower(coalesce(text, ''))")
    + r""" AS ws FROM documents),
i AS (SELECT item_id, """
    + _WORDS.format("lower(coalesce(text, ''))")
    + r""" AS ws FROM benchmark),
ib AS (SELECT item_id, len(ws) AS n, list_transform(generate_series(1, len(ws) - 4), lambda j: array_to_string(ws[j : j + 4], ' ')) AS g FROM i WHERE len(ws) >= 5),
db AS (SELECT doc_id, len(ws) AS n, list_transform(generate_series(1, len(ws) - 4), lambda j: array_to_string(ws[j : j + 4], ' ')) AS g FROM d WHERE len(ws) >= 5),
pairs AS (SELECT DISTINCT a.doc_id, b.item_id FROM (SELECT doc_id, unnest(g) AS x FROM db) a JOIN (SELECT item_id, unnest(g) AS x FROM ib) b ON a.x = b.x),
win AS (SELECT p.doc_id, p.item_id, ib.n, ib.g AS ig, db.g AS dg, unnest(generate_series(0, greatest(db.n - ib.n, 0))) AS start
        FROM pairs p JOIN ib ON ib.item_id = p.item_id JOIN db ON db.doc_id = p.doc_id),
bag AS (SELECT doc_id, item_id, n, start, len(ig) AS ni, len(dg[start + 1 : start + n - 4]) AS nd, ig, unnest(dg[start + 1 : start + n - 4]) AS x FROM win),
tally AS (SELECT doc_id, item_id, n, start, ni, nd, x, count(*) AS k, any_value(ig) AS ig FROM bag GROUP BY doc_id, item_id, n, start, ni, nd, x),
cnt AS (SELECT doc_id, item_id, n, start, ni, nd, least(k, len(list_filter(ig, lambda y: y = x))) AS c FROM tally),
sim AS (SELECT doc_id, item_id, n, start, sum(c)::DOUBLE / (ni + nd - sum(c))::DOUBLE AS s, sum(c) * 100 >= (ni + nd - sum(c)) * 75 AS ok FROM cnt GROUP BY doc_id, item_id, n, start, ni, nd)
SELECT doc_id, item_id, start::BIGINT AS start, n::BIGINT AS n_words, s AS similarity
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY s DESC, start) AS k FROM sim WHERE ok) WHERE k = 1
"""
)

OP10 = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k, count(*) OVER (PARTITION BY conv_id) AS n,
        12 + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g')) + 1
        + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + 11 AS size FROM t),
c AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM o)
SELECT conv_id, max(n)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR k = n)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""

#: CRC-32 of the decimal doc_id, bit by bit; null stays null.
_CRC = """xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c))),
  lambda x, b: list_reduce(list_concat([xor(x, b)], range(8)), lambda c, _: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295)"""


def _merkle(levels: int = 12) -> str:
    """The manifest of up to 8 ** levels rows a group and groups, level by level: tree a within the
    groups, tree b over them, then every claimed leaf folded through both."""
    field = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    steps = [
        f"picked AS (SELECT *, coalesce({_CRC} % 3 = 0, false) AS hit FROM documents)",
        "told AS (SELECT *, CASE WHEN hit THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS said FROM picked)",
        f"leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {leaf('text')} AS leaf, {leaf('said')} AS claimed FROM told)",
        "a0 AS MATERIALIZED (SELECT g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS pos, leaf AS node, doc_id, claimed, count(*) OVER (PARTITION BY g) AS n FROM leaves)",
    ]
    above = """{0}{2} AS MATERIALIZED (SELECT g, pos // 8 AS pos, (any_value(n) + 7) // 8 AS n,
  CASE WHEN any_value(n) = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node FROM {0}{1} GROUP BY g, pos // 8)"""
    beside = """{0}s{1} AS MATERIALIZED (SELECT g, pos, n, coalesce(string_agg(node, '') OVER (PARTITION BY g, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(node, '') OVER (PARTITION BY g, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {0}{1})"""
    steps += [above.format("a", k, k + 1) for k in range(levels)]
    steps.append(f"b0 AS MATERIALIZED (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS pos, node, g AS name, count(*) OVER () AS n FROM a{levels})")
    steps += [above.format("b", k, k + 1) for k in range(levels)]
    steps += [beside.format(t, k) for t in "ab" for k in range(levels)]
    fold = """{0} AS MATERIALIZED (SELECT f.g, doc_id, leaf, subroot, proof || l || r AS proof, place // 8 AS place,
  CASE WHEN s.n = 1 THEN f.node ELSE sha256(l || f.node || r) END AS node FROM {1} f JOIN {2} s ON {3} AND s.pos = f.place)"""
    steps.append("f0 AS MATERIALIZED (SELECT g, doc_id, node AS leaf, NULL AS subroot, '' AS proof, pos AS place, claimed AS node FROM a0)")
    steps += [fold.format(f"f{k + 1}", f"f{k}", f"as{k}", "s.g = f.g") for k in range(levels)]
    steps.append(f"h0 AS MATERIALIZED (SELECT f.g, doc_id, leaf, b0.node AS subroot, proof, b0.pos AS place, f.node FROM f{levels} f JOIN b0 ON b0.name = f.g)")
    steps += [fold.format(f"h{k + 1}", f"h{k}", f"bs{k}", "true") for k in range(levels)]
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, leaf, subroot, b{levels}.node AS root, sha256(proof) AS proof_sha256, h{levels}.node AS folded_root, h{levels}.node = b{levels}.node AS verified
FROM h{levels} CROSS JOIN b{levels}"""


ORACLES = {
    "op3_adaptive_quality": OP3,
    "op5_temporal_url_lists": OP5,
    "op7_line_dedup": OP7,
    "op8_ngram_jaccard": OP8,
    "op9_benchmark_decontamination": OP9,
    "op10_chat_prefix_target": OP10,
    "op11_merkle_manifest": _merkle(),
}
