"""SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

from weirflow.llm.chat import CONTROL, END, NEXT, SEP, START

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _escaped(column: str) -> str:
    sql = f"replace(coalesce({column}, ''), '\\', '\\\\')"
    for mark in CONTROL:
        sql = f"replace({sql}, '{mark}', '{mark[0]}\\{mark[1:]}')"
    return sql


OP1 = f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
 m AS (SELECT *, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS starts FROM t)
 SELECT conv_id, COUNT(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
 CAST(coalesce(SUM(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
 CAST(SUM(length({_escaped('text')}) + CASE WHEN starts THEN {len(START + SEP + END)} + length({_escaped('role')}) ELSE {len(NEXT)} END) AS BIGINT) AS formatted_chars
 FROM m GROUP BY conv_id"""

OP3 = f"""WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS ws FROM documents), b AS (SELECT item_id, ws, least(10, len(ws)) AS size FROM (SELECT item_id, {_WORDS.format('text')} AS ws FROM benchmark) WHERE len(ws) > 0),
 g AS (SELECT DISTINCT item_id, size, array_to_string(ws[i : i + size - 1], ' ') AS w FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS i FROM b)),
 p AS (SELECT doc_id, size, i, array_to_string(ws[i : i + size - 1], ' ') AS w FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM g))),
 h AS (SELECT doc_id, i, p.size, item_id FROM p JOIN g ON p.size = g.size AND p.w = g.w),
 n AS (SELECT doc_id, COUNT(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM h) GROUP BY doc_id),
 s AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY doc_id)
 SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
 FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN s ON d.doc_id = s.doc_id"""

OP4 = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
 g AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
 n AS (SELECT doc_id, COUNT(*) AS n FROM g GROUP BY doc_id),
 pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS k FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
 links AS (SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 75 * (x.n + y.n - k)),
 r AS (SELECT a AS doc_id, a AS seen FROM links UNION SELECT r.doc_id, l.b FROM r JOIN links l ON r.seen = l.a)
 SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.m, w.doc_id) AS component_id FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN (SELECT doc_id, MIN(seen) AS m FROM r GROUP BY doc_id) c ON w.doc_id = c.doc_id"""

_SETS = (("ws[i : i + 4]", "ws[i : i + 3]"), ("len(ws) - 3, 2", "len(ws) - 2, 2"), (">= 75 *", ">= 80 *"))
OP13 = OP4
for _old, _new in _SETS:
    OP13 = OP13.replace(_old, _new)
OP13 = f"SELECT *, component_id = doc_id AS kept FROM ({OP13})"

# Leaf and tampered leaf of every document, levels until one node is left in each language, the same over the subroots, then proofs and
# the root folded from each leaf. crc32 is spelled out byte by byte.
_CELL = "CASE WHEN {0} IS NULL THEN '-' ELSE concat(strlen(CAST({0} AS VARCHAR)), ':', CAST({0} AS VARCHAR)) END"
_HEAD = ", ".join(_CELL.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
_CAPITALS_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CRC = """xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT))),
 lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
OP12 = f"""WITH RECURSIVE base AS (SELECT doc_id, lang, sha256(concat({_HEAD}, {_CELL.format('text')})) AS leaf,
  CASE WHEN {_CRC} % 3 = 0 THEN sha256(concat({_HEAD}, {_CELL.format(_CAPITALS_LOWERED)})) END AS other FROM documents),
 leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS pos, COUNT(*) OVER (PARTITION BY lang) AS n FROM base),
 tree AS (SELECT lang, 0 AS lvl, pos, leaf AS h, n FROM leaves
  UNION ALL SELECT lang, lvl + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (MAX(n) + 7) // 8 FROM tree WHERE n > 1 GROUP BY lang, lvl, pos // 8),
 subroots AS (SELECT lang, lvl, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, COUNT(*) OVER () AS m FROM tree WHERE n = 1),
 top AS (SELECT 0 AS lvl, place, subroot AS h, m FROM subroots
  UNION ALL SELECT lvl + 1, place // 8, sha256(string_agg(h, '' ORDER BY place)), (MAX(m) + 7) // 8 FROM top WHERE m > 1 GROUP BY lvl, place // 8),
 around AS (SELECT a.lang, a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM tree a JOIN tree b ON a.lang IS NOT DISTINCT FROM b.lang AND a.lvl = b.lvl AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY 1, 2, 3),
 above AS (SELECT a.lvl, a.place, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS r
  FROM top a JOIN top b ON a.lvl = b.lvl AND a.place // 8 = b.place // 8 WHERE a.m > 1 GROUP BY 1, 2),
 steps AS (SELECT f.lang, f.pos, d.lvl, d.l, d.r FROM leaves f JOIN around d ON f.lang IS NOT DISTINCT FROM d.lang AND d.pos = f.pos >> (3 * d.lvl)
  UNION ALL SELECT f.lang, f.pos, s.lvl + t.lvl, t.l, t.r FROM leaves f JOIN subroots s ON f.lang IS NOT DISTINCT FROM s.lang JOIN above t ON t.place = s.place >> (3 * t.lvl)),
 proofs AS (SELECT lang, pos, string_agg(concat(l, r), '' ORDER BY lvl) AS proof, COUNT(*) AS height FROM steps GROUP BY 1, 2),
 fold AS (SELECT lang, pos, 0 AS lvl, coalesce(other, leaf) AS h FROM leaves
  UNION ALL SELECT f.lang, f.pos, f.lvl + 1, sha256(concat(s.l, f.h, s.r)) FROM fold f JOIN steps s ON f.lang IS NOT DISTINCT FROM s.lang AND f.pos = s.pos AND f.lvl = s.lvl)
SELECT f.doc_id, f.leaf, s.subroot, t.h AS root, sha256(coalesce(p.proof, '')) AS proof_sha256, d.h AS folded_root, d.h = t.h AS verified
 FROM leaves f JOIN subroots s ON f.lang IS NOT DISTINCT FROM s.lang JOIN top t ON t.m = 1 LEFT JOIN proofs p ON f.lang IS NOT DISTINCT FROM p.lang AND f.pos = p.pos
 JOIN fold d ON f.lang IS NOT DISTINCT FROM d.lang AND f.pos = d.pos AND d.lvl = coalesce(p.height, 0)"""

ORACLES: dict[str, str] = {"op1_chat_format": OP1, "op3_decontaminate": OP3, "op4_jaccard_join": OP4, "op12_merkle_manifest": OP12, "op13_minhash_dedup": OP13}
