"""DuckDB SQL of the registered queries, written independently of the code."""

_CRC32 = """
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)),
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i)))
"""


def _crc32(text: str) -> str:
    h = f"hex(encode({text}))"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length({h}) // 2), "
            f"lambda j: ('0x' || substr({h}, (2 * j + 1)::BIGINT, 2))::BIGINT)), "
            f"lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295)")


OP4 = r"""
WITH u AS (
  SELECT page_id, url, regexp_extract(url, '(?s)\A.*?://([^/?#]*)([^?#]*)', 1) AS h,
         regexp_extract(url, '(?s)\A.*?://([^/?#]*)([^?#]*)', 2) AS p FROM pages),
l AS (SELECT page_id, coalesce(translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
             coalesce(p, '') AS path FROM u),
r AS (SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM l)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""

_UNIFORM = "((('0x' || substr(md5({0}), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0"

OP10 = f"""
WITH {_CRC32},
d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(doc_id::VARCHAR, '') AS k FROM documents),
c AS (SELECT doc_id, k, octet_length(encode(text))::BIGINT + 1 AS size,
             CASE WHEN text = '' THEN 0 ELSE {_crc32('text')} END::BIGINT AS text_crc32 FROM d, crc_table),
s AS (SELECT doc_id, size, text_crc32,
             list_transform(range(9), lambda s: -1.0 / ln({_UNIFORM.format("k || ':' || s::VARCHAR")})) AS z FROM c),
w AS (SELECT doc_id, size, text_crc32, (list_position(z[1:8], list_max(z[1:8])) - 1)::INTEGER AS shard,
             (list_position(z, list_max(z)) - 1)::INTEGER AS grown_shard FROM s)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM w
"""

# Targets by water filling: a source is full when the level of those not yet full exceeds its cap.
# Sampling: Pareto ranks; the documents up to the first whose middle lies beyond the missing words.
OP5 = f"""
WITH {_CRC32},
d AS (SELECT doc_id, source, coalesce(text, '') AS text,
             coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
      FROM documents),
c AS (SELECT doc_id, source, size,
             CASE WHEN text = '' THEN 0 ELSE {_crc32('text')} END::BIGINT AS crc FROM d, crc_table),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, 3 * source_size AS cap, sum(source_size) OVER () AS total,
             (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::DOUBLE AS w FROM s),
f AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps_before,
             sum(w) OVER (ORDER BY cap / w, source NULLS LAST
                          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights_left FROM w),
l AS (SELECT *, w * ((total - caps_before) / weights_left) >= cap AS full_up, (total - caps_before) / weights_left AS level FROM f),
t AS (SELECT source, source_size,
             CASE WHEN full_up THEN cap::DOUBLE
                  ELSE w * (SELECT arg_min(level, caps_before) FROM l x WHERE NOT x.full_up) END AS target FROM l),
e AS (SELECT c.*, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size::DOUBLE, 3.0) ELSE 0.0 END AS e,
             {_UNIFORM.format("'mix:' || coalesce(doc_id::VARCHAR, '') || ':' || size::VARCHAR || ':' || crc::VARCHAR")} AS u
      FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, floor(e)::BIGINT AS whole, e - floor(e) AS p FROM e),
r AS (SELECT *, CASE WHEN p > 0 THEN (u / (1.0 - u)) / (p / (1.0 - p)) END AS rank,
             greatest(target - sum(whole * size) OVER (PARTITION BY source), 0.0) AS missing FROM p),
o AS (SELECT *, sum(size) OVER (PARTITION BY source, rank IS NULL
                                ORDER BY rank, doc_id::VARCHAR NULLS FIRST, size, crc ROWS UNBOUNDED PRECEDING) AS run FROM r)
SELECT doc_id, size, source_size, target,
       size * (whole + CASE WHEN rank IS NOT NULL AND run - size / 2.0 <= missing THEN 1 ELSE 0 END) AS taken FROM o
"""

# Shortest runs of at least 50 words from and up to every line (within a document), and whole documents of fewer; all but the first
# occurrence of a run go. A run of the same content has the same words, so its text is its class.
OP1 = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
n AS (SELECT doc_id, ls, list_transform(ls, lambda x: greatest(len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')), 1)) AS ws FROM d),
s AS (SELECT doc_id, ls, ws, unnest(range(1, len(ls) + 1)) AS i FROM n),
f AS (SELECT doc_id, ls, i AS a,
             list_min(list_filter(range(i, len(ls) + 1), lambda e: list_sum(ws[i:e]) >= 50)) AS b FROM s
      UNION
      SELECT doc_id, ls, list_max(list_filter(range(1, i + 1), lambda a: list_sum(ws[a:i]) >= 50)) AS a, i AS b FROM s),
r AS (SELECT DISTINCT doc_id, a, b, array_to_string(ls[a:b], chr(10)) AS run FROM f WHERE a IS NOT NULL AND b IS NOT NULL
      UNION SELECT doc_id, 1, len(ls), text FROM d JOIN n USING (doc_id, ls) WHERE text <> '' AND list_sum(ws) < 50),
c AS (SELECT doc_id, a, b, row_number() OVER (PARTITION BY run, b - a ORDER BY doc_id NULLS FIRST, a) AS place FROM r),
g AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM c WHERE place > 1),
p AS (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island FROM g),
h AS (SELECT doc_id, min(i) - 1 AS lo, max(i) - 1 AS hi FROM p GROUP BY doc_id, island),
k AS (SELECT doc_id, sum(hi - lo + 1)::INTEGER AS removed_lines,
             string_agg(lo::VARCHAR || '-' || hi::VARCHAR, ',' ORDER BY lo) AS removed_spans FROM h GROUP BY doc_id),
j AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id)
SELECT x.doc_id,
       CASE WHEN k.doc_id IS NULL THEN x.text
            ELSE array_to_string(list_transform(list_filter(range(1, len(d.ls) + 1), lambda i: NOT list_contains(j.gone, i)),
                                                lambda i: d.ls[i]), chr(10)) END AS text,
       coalesce(removed_lines, 0) AS removed_lines, coalesce(removed_spans, '') AS removed_spans
FROM documents x LEFT JOIN d ON x.doc_id = d.doc_id LEFT JOIN k ON x.doc_id = k.doc_id LEFT JOIN j ON x.doc_id = j.doc_id
"""

OP7 = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 64)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
      FROM e q, e d WHERE q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""

OP3 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e,
         coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                  AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS usable FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b
      WHERE a.usable AND b.usable AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
c AS (SELECT a AS x, b AS y FROM l UNION SELECT c.x, l.b FROM c JOIN l ON c.y = l.a),
m AS (SELECT x, min(y) AS y FROM c GROUP BY x),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m.y, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(m.y, vec_id)) AS kept
FROM v LEFT JOIN n ON vec_id = n.a LEFT JOIN m ON vec_id = m.x
"""

def _edit(state: str, cost: str, initial: str, kept: str | None) -> str:
    """The path ``state`` (cost, audit, kept turns) with one more edit."""
    turns = f"list_append({state}.r, {kept})" if kept else f"{state}.r"
    return f"CASE WHEN {state}.c IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{initial}', 'r': {turns}}} END"


def _insert_after(z: list[str], out: str) -> str:
    """Two rounds of at most one insert each, as columns ``{out}0`` to ``{out}3``."""
    user, bot = "'user:'", "'assistant:'"
    z2 = ", ".join([z[2], *[_edit(z[q], "5", "I", user) for q in (0, 1, 3)]])
    z3 = ", ".join([z[3], _edit(z[2], "5", "I", bot)])
    return f"{z[0]} AS {out}0, {z[1]} AS {out}1, list_min([{z2}]) AS {out}2, list_min([{z3}]) AS {out}3"


def _turn(z: list[str]) -> str:
    """One turn (initial ``c``, fault ``f``, ``role``, ``text``) on four states."""
    keep, extra = "role || ':' || text", "CASE WHEN f = 't' THEN 5 ELSE 0 END"
    cols = []
    for to, letter, origin in ((0, "", ()), (1, "s", (0,)), (2, "u", (0, 1, 3)), (3, "a", (2,))):
        paths = [_edit(z[to], "2", "D", None)]
        for q in origin:
            paths.append(f"CASE WHEN f NOT IN ('b', 'd') AND c = '{letter}' THEN {_edit(z[q], extra, 'K', keep)} END")
            if letter != "s":
                role = "user" if letter == "u" else "assistant"
                paths.append(f"CASE WHEN f NOT IN ('b', 'd') THEN {_edit(z[q], f'1 + {extra}', 'R', repr(role + ':') + ' || text')} END")
        cols.append(f"list_min([{', '.join(paths)}]) AS z{to}")
    return ", ".join(cols)


# A forward recurrence over whole paths: per state the least (cost, edits); the operator goes backward over costs.
OP11 = f"""
WITH RECURSIVE {_CRC32},
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
o AS (SELECT k.*, {_crc32('name')} % 20 AS kind FROM k, crc_table),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM o WHERE kind <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM d),
m AS (SELECT conv_id, i, turn, role, text, left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS p,
             CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b'
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                  WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 't' ELSE '' END AS f FROM n),
s AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 'r': []::VARCHAR[]}} AS z0, NULL::STRUCT(c INTEGER, a VARCHAR, r VARCHAR[]) AS z1,
             NULL::STRUCT(c INTEGER, a VARCHAR, r VARCHAR[]) AS z2, NULL::STRUCT(c INTEGER, a VARCHAR, r VARCHAR[]) AS z3 FROM m
      UNION ALL
      SELECT conv_id, i, {_turn(['y0', 'y1', 'y2', 'y3'])} FROM (
        SELECT conv_id, i, role, text, c, f, {_insert_after(['x0', 'x1', 'x2', 'x3'], 'y')} FROM (
          SELECT m.conv_id, m.i, role, text, c, f, {_insert_after(['z0', 'z1', 'z2', 'z3'], 'x')}
          FROM s JOIN m ON m.i = s.i + 1 AND m.conv_id IS NOT DISTINCT FROM s.conv_id))),
g AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (f = 'b') AS blank, count(*) FILTER (f = 'd') AS duplicate, count(*) FILTER (f = 't') AS truncated,
             count(*) FILTER (p IS NOT NULL AND p || c NOT IN ('su', 'ua', 'au')) AS illegal FROM m GROUP BY conv_id),
e AS (SELECT conv_id, list_min([y0, y3]) AS best FROM (
        SELECT conv_id, {_insert_after(['x0', 'x1', 'x2', 'x3'], 'y')} FROM (
          SELECT s.conv_id, {_insert_after(['z0', 'z1', 'z2', 'z3'], 'x')}
          FROM s JOIN g ON s.i = g.n AND s.conv_id IS NOT DISTINCT FROM g.conv_id)))
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN g ON a.conv_id IS NOT DISTINCT FROM g.conv_id
     LEFT JOIN e ON a.conv_id IS NOT DISTINCT FROM e.conv_id
"""

_SHARE = "1 + (1000000000 * ({0} + 5)::HUGEINT) // ({1} + 5 * {2})::HUGEINT"

OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS (SELECT doc, lang, source, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT t.lang, source, t.term, count(*) AS n FROM t JOIN k ON t.lang = k.lang AND t.term = k.term GROUP BY ALL),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS count,
             {_SHARE.format('coalesce(c.n, 0)', 'coalesce(s.total, 0)', 'v.v')} AS p, {_SHARE.format('k.n', 'v.n', 'v.v')} AS q
      FROM g JOIN k ON g.lang = k.lang JOIN v ON v.lang = g.lang LEFT JOIN s ON s.lang = g.lang AND s.source = g.source
             LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
           LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE count > 0 AND p > q),
r AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM x)
SELECT * FROM r WHERE part = 'pair' OR rank <= 50
"""

ORACLE = {"op11_conversation_repair": OP11, "op12_source_divergence": OP12, "op3_embedding_dedup": OP3, "op7_exact_topk": OP7, "op1_line_dedup": OP1, "op5_source_mixing": OP5, "op4_url_filter": OP4, "op10_sharding": OP10}
