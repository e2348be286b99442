"""DuckDB SQL that computes the rows of the queries of this subpackage another way."""

from __future__ import annotations

from tessera.llm import chat, mixing, ngramjoin, quality, sharding, warc
from tessera.llm.queries import CONTROL

W = r"[^\x20\x09-\x0D]+"


def _unit(*parts: str) -> str:
    text = " || '/' || ".join(parts)
    return f"((('0x' || substr(md5({text}), 1, 13))::BIGINT + 0.5) / {2**52}::DOUBLE)"


def _id(col: str = "doc_id") -> str:
    return f"coalesce({col}::VARCHAR, 'null')"


OP1 = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{W}'))::BIGINT AS size,
  {_unit(f"'{mixing.SEED}'", "coalesce(doc_id::VARCHAR, 'null/' || md5(coalesce(text, '')))")} AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w FROM d GROUP BY source),
f AS (SELECT *, ({mixing.CAP} * source_size)::DOUBLE AS most, ({mixing.CAP} * source_size)::DOUBLE / w AS full_at FROM s),
l AS (SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(most) OVER p, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER p, 0)) AS level
      FROM f WINDOW p AS (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT level FROM l WHERE level * w <= most ORDER BY full_at, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, least(coalesce((SELECT level FROM v) * w, most), most) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
o AS (SELECT *, target - whole * source_size AS owed, CASE WHEN source_size > 0 THEN (target - whole * source_size) / source_size ELSE 0 END AS rest FROM r),
h AS (SELECT o.source, d.size, o.owed, count(*) AS many FROM d JOIN o ON d.source IS NOT DISTINCT FROM o.source WHERE d.size > 0 AND o.owed > 0 GROUP BY ALL),
e AS (SELECT source, size, (owed - coalesce(sum(many * size) OVER (PARTITION BY source ORDER BY size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(many * pow(size, {1 - mixing.TILT})) OVER (PARTITION BY source ORDER BY size ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS factor FROM h),
a AS (SELECT source, arg_min(factor, size) AS factor FROM e WHERE factor <= pow(size, {mixing.TILT}) GROUP BY source),
j AS (SELECT d.doc_id, d.size, d.u, o.*, coalesce(least(a.factor * pow(greatest(d.size, 1), -{mixing.TILT}), 1.0), 0.0) AS pi
  FROM d JOIN o ON d.source IS NOT DISTINCT FROM o.source LEFT JOIN a ON o.source IS NOT DISTINCT FROM a.source),
q AS (SELECT *, CASE WHEN pi >= 1 THEN 0 WHEN pi > 0 THEN (u / (1 - u)) / (pi / (1 - pi)) END AS rank FROM j),
c AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM q)
SELECT doc_id, size, source_size, target, (size * least(whole + CASE WHEN pi >= 1 OR (pi > 0 AND before + size / 2.0 <= owed) THEN 1 ELSE 0 END, {mixing.CAP}))::BIGINT AS taken FROM c
"""


def _op3() -> str:
    value = {r: f"CASE WHEN {d} > 0 THEN {n}::DOUBLE / {d}::DOUBLE ELSE 0 END" for r, (n, d, _) in quality.RULES.items()}
    ladder = ", ".join(f"({i}, {', '.join(f'{quality.threshold(r, i)}::DOUBLE' for r in quality.RULES)})" for i in range(quality.STEPS))
    above = " OR ".join(f"{v} > {r}" for r, v in value.items())
    p = quality.ALPHA
    return f"""
WITH a AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
b AS (SELECT *, regexp_extract_all(t, '{W}') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{W}')) AS lines FROM a),
win AS (SELECT rid, i, list_aggregate(w[i:i + 7], 'string_agg', ' ') AS x FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM b)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, x) AS n FROM win) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT k) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS k FROM twice) GROUP BY rid),
f AS (SELECT b.rid, doc_id, lang, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines, coalesce(rep.n,
    0)::BIGINT AS n_repeat_words
  FROM b LEFT JOIN rep ON rep.rid = b.rid),
g AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f),
l(step, {", ".join(quality.RULES)}) AS (VALUES {ladder}),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
h AS (SELECT lang, step, count(*) AS n, count(*) FILTER (WHERE {above}) AS k FROM g JOIN good USING (doc_id), l WHERE NOT base_failed GROUP BY ALL),
e AS (SELECT *, CASE WHEN k >= n * {p} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
  lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({p}) + (n - j) * ln(1 - {p})))) END AS tail,
  {quality.DELTA} / (SELECT count(DISTINCT coalesce(lang, '?')) FROM h) AS level FROM h),
x AS (SELECT lang, coalesce(min(step) FILTER (WHERE tail > level), {quality.STEPS}) - 1 AS step FROM e GROUP BY ALL),
bad AS (SELECT DISTINCT rid FROM g JOIN x ON g.lang IS NOT DISTINCT FROM x.lang JOIN l ON l.step = x.step WHERE {above})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.rid IS NULL AS kept, n_lines FROM g LEFT JOIN bad USING (rid)
"""


def _op4() -> str:
    n, percent = ngramjoin.N, ngramjoin.PERCENT
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{W}') AS w FROM documents),
g AS (SELECT DISTINCT rid, unnest(CASE WHEN len(w) >= {n} THEN list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}],
  ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM d),
c AS (SELECT rid, count(*) AS n, sha256(string_agg(x, chr(10) ORDER BY x)) AS h FROM g GROUP BY rid),
k AS (SELECT h, any_value(n) AS n, min(doc_id) AS node, arg_min(rid, doc_id) AS rid FROM c JOIN d USING (rid) WHERE doc_id IS NOT NULL GROUP BY h),
s AS (SELECT k.node, k.n, g.x FROM k JOIN g USING (rid)),
p AS (SELECT a.node AS a, b.node AS b, count(*) AS m, any_value(a.n) + any_value(b.n) AS t FROM s a JOIN s b ON a.x = b.x AND a.node < b.node
  AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n) GROUP BY ALL HAVING 100 * count(*) >= {percent} * (any_value(a.n) + any_value(b.n) - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT node AS a, node AS b FROM k UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS node, min(b) AS component FROM r GROUP BY a)
SELECT d.doc_id, coalesce(c.n, 0)::BIGINT AS n_shingles, coalesce(m.component, d.doc_id) AS component_id, coalesce(k.node, d.doc_id) AS class_id
FROM d LEFT JOIN c USING (rid) LEFT JOIN k ON k.h = c.h LEFT JOIN m ON m.node = k.node
"""


def _op6() -> str:
    table = list(range(256))  # checksums of single bytes
    for _ in range(8):
        table = [c >> 1 ^ 0xEDB88320 * (c & 1) for c in table]
    crc = ", ".join(map(str, table))

    def placed(grown: int, into: str) -> str:
        out = []
        for depth, level in enumerate(sharding._levels(sharding.tree(sharding.SHARDS + grown))):
            kids = ", ".join(f"('{node}', '{c}', {w}::DOUBLE)" for node, children in level.items() for c, w in children)
            above = "SELECT DISTINCT doc_id, '' AS node FROM documents" if not depth else f"SELECT doc_id, node FROM {into}{depth - 1}"
            draw = f"-ln({_unit(_id(), 'c')}) / w"
            out.append(f"{into}{depth} AS (SELECT doc_id, arg_min(c, {draw}) AS node FROM ({above}) JOIN (VALUES {kids}) t(node, c, w) USING (node) GROUP BY doc_id)")
        return ",\n".join(out)

    return f"""
WITH {placed(0, "own")},
{placed(1, "big")},
d AS (SELECT doc_id, (strlen(coalesce(text, '')) + {sharding.OVERHEAD})::BIGINT AS size, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
  lambda h: ('0x' || h)::BIGINT) AS b FROM documents),
z AS (SELECT doc_id, size, xor(list_reduce(b, lambda c, x: xor(c >> 8, [{crc}][(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS text_crc32 FROM d),
s AS (SELECT z.*, own2.node[2:]::INT AS shard, big2.node[2:]::INT AS grown_shard, floor({_unit(_id('z.doc_id'), "text_crc32::VARCHAR")} * 4096)::INT AS bin
  FROM z JOIN own2 ON z.doc_id IS NOT DISTINCT FROM own2.doc_id JOIN big2 ON z.doc_id IS NOT DISTINCT FROM big2.doc_id)
SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard, (row_number() OVER (PARTITION BY shard ORDER BY bin, doc_id NULLS FIRST, text_crc32) - 1)::BIGINT AS slot,
  grown_shard FROM s
"""


def _op8() -> str:
    text = lambda x: "'" + x.replace("'", "''") + "'"

    def escaped(column: str) -> str:
        for what, into in chat.ESCAPES:
            column = f"replace({column}, {text(what)}, {text(into)})"
        return column

    role = f"replace({escaped('role')}, ':', '\\c')"
    segment = f"{text(chat.OPEN)} || {role} || {text(chat.AFTER_ROLE)} || {escaped('x')} || '</turn>' || chr(10)"
    return f"""
WITH a AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT -7, 0, 'user', {text(CONTROL)} UNION ALL SELECT -7, 1, 'assistant', {text(CONTROL)}),
s AS (SELECT *, row_number() OVER w AS seq, coalesce(sum(length({segment})) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, length({segment}) AS size
  FROM a WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, x)),
example AS (SELECT conv_id, seq AS target, start AS context_end, start + size AS stop, x AS reply FROM s WHERE role = '{chat.TRAINED}'),
trained AS (SELECT conv_id, sum(length(reply)) AS loss_chars, sha256(string_agg(reply, '' ORDER BY target)) AS loss_sha256, max(stop) AS stop FROM example GROUP BY conv_id),
turns AS (SELECT s.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || x || chr(10), '' ORDER BY seq)) AS turns_sha256, coalesce(any_value(t.stop),
  0) + coalesce(sum(size) FILTER (WHERE start >= coalesce(t.stop, 0)), 0) AS formatted_chars
  FROM s LEFT JOIN trained t ON s.conv_id IS NOT DISTINCT FROM t.conv_id GROUP BY s.conv_id)
SELECT turns.conv_id, n_turns::BIGINT AS n_turns, turns_sha256, coalesce(loss_chars, 0)::BIGINT AS loss_chars, coalesce(loss_sha256, sha256('')) AS loss_sha256,
  formatted_chars::BIGINT AS formatted_chars
FROM turns LEFT JOIN trained ON turns.conv_id IS NOT DISTINCT FROM trained.conv_id
"""


OP9 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS x FROM pages),
h AS (SELECT page_id, strlen(x)::BIGINT AS payload_bytes, sha256(x) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= {warc.LEAST_SHARED} THEN min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS first FROM h)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM f
"""


ORACLES = {"op1_mixing": OP1, "op3_quality_rules": _op3(), "op4_ngram_join": _op4(), "op6_sharding": _op6(), "op8_prefix_targets": _op8(), "op9_warc_salvage": OP9}
