"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

OP9 = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size FROM documents),
total AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         source_size * 2.0::DOUBLE AS cap
  FROM total),
filling AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS whole, sum(weight) OVER () AS all_weight,
         coalesce(sum(cap) OVER w, 0) AS capped, coalesce(sum(weight) OVER w, 0) AS weight_before
  FROM weighted
  WINDOW w AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT *, (whole - capped) / (all_weight - weight_before) AS level FROM filling),
fit AS (SELECT arg_min(level, weight_before) AS level, min(weight_before) AS at FROM levels WHERE level * weight <= cap),
targets AS (
  SELECT l.source, l.source_size,
         CASE WHEN f.at IS NULL OR l.weight_before < f.at THEN l.cap ELSE f.level * l.weight END AS target
  FROM levels l CROSS JOIN fit f),
rated AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         md5('11:' || coalesce(s.doc_id::VARCHAR, '')) AS digest
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN ('0x' || substr(digest, 1, 8))::BIGINT / 4294967296.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
"""

OP4 = r"""
WITH rows AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
split AS (
  SELECT row, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM rows),
stripped AS (SELECT row, doc_id, line, pos, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS raw FROM split),
keyed AS (SELECT row, doc_id, line, pos, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM stripped),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE len(key) >= 20 GROUP BY key HAVING count(DISTINCT row) >= 3),
judged AS (
  SELECT k.row, k.doc_id, k.line, k.pos, r.key IS NOT NULL AND k.doc_id IS DISTINCT FROM r.keeper AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY row, doc_id
"""

_CRC32 = """xor(list_reduce(list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT),
  lambda crc, b: list_reduce(range(8), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(crc, b)), 4294967295::BIGINT), 4294967295)"""

_FAR = "{'c': 1000000000::BIGINT, 'a': ''}"


def _edit(state: str, cost: str, letter: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}}"


def _insertions(state: str) -> str:
    """SQL of a state (e nothing kept, h after a system turn, o an open question, d whole pairs) that may insert turns."""
    asked = f"list_min([{state}.o, {_edit(f'{state}.e', '2', 'I')}, {_edit(f'{state}.h', '2', 'I')}, {_edit(f'{state}.d', '2', 'I')}])"
    return f"{{'e': {state}.e, 'h': {state}.h, 'o': {asked}, 'd': list_min([{state}.d, {_edit(asked, '2', 'I')}]), 'row': {state}.row}}"


_ROW = "{'role': '', 'gone': false, 'extra': 0::BIGINT}"
_STAYS = f"""{{
  'e': {_edit('s.e', '3', 'D')},
  'h': list_min([{_edit('s.h', '3', 'D')}, CASE WHEN NOT x.row.gone AND x.row.role = 's' THEN {_edit('s.e', 'x.row.extra', 'K')} ELSE {_FAR} END]),
  'o': list_min([{_edit('s.o', '3', 'D')}, CASE WHEN x.row.gone THEN {_FAR}
       ELSE list_min([{_edit('s.e', '2 + x.row.extra', 'R')}, {_edit('s.h', '2 + x.row.extra', 'R')}, {_edit('s.d', '2 + x.row.extra', 'R')}]) END,
       CASE WHEN NOT x.row.gone AND x.row.role = 'u' THEN list_min([{_edit('s.e', 'x.row.extra', 'K')}, {_edit('s.h', 'x.row.extra', 'K')}, {_edit('s.d', 'x.row.extra', 'K')}]) ELSE {_FAR} END]),
  'd': list_min([{_edit('s.d', '3', 'D')}, CASE WHEN x.row.gone THEN {_FAR} ELSE {_edit('s.o', '2 + x.row.extra', 'R')} END,
       CASE WHEN NOT x.row.gone AND x.row.role = 'a' THEN {_edit('s.o', 'x.row.extra', 'K')} ELSE {_FAR} END]),
  'row': s.row}}"""

OP11 = rf"""
WITH raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_CRC32.format(text="(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM raw WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
  FROM damaged),
judged AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY place) || role[1:1] AS pair
  FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal,
         list({{'e': {_FAR}, 'h': {_FAR}, 'o': {_FAR}, 'd': {_FAR},
                'row': {{'role': role[1:1], 'gone': fault IN ('blank', 'duplicate'), 'extra': CASE WHEN fault = 'truncated' THEN 1::BIGINT ELSE 0::BIGINT END}}}} ORDER BY place) AS turns,
         list({{'role': role, 'text': text}} ORDER BY place) AS lines
  FROM judged GROUP BY conv_id),
parsed AS (
  SELECT * EXCLUDE (turns), list_reduce(turns, lambda acc, x: list_transform([{_insertions('acc')}], lambda s: {_STAYS})[1],
           {{'e': {{'c': 0::BIGINT, 'a': ''}}, 'h': {_FAR}, 'o': {_FAR}, 'd': {_FAR}, 'row': {_ROW}}}) AS state
  FROM counted),
won AS (
  SELECT * EXCLUDE (state), list_transform([{_insertions('state')}], lambda s: list_min([s.e, s.d]))[1] AS best FROM parsed),
edits AS (
  SELECT conv_id, lines, unnest(string_split(best.a, '')) AS edit, unnest(range(1, len(best.a) + 1)) AS pos FROM won WHERE best.a <> ''),
taken AS (
  SELECT *, lines[count(*) FILTER (WHERE edit <> 'I') OVER w] AS line, count(*) FILTER (WHERE edit <> 'D') OVER w AS nth
  FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
first_kept AS (
  SELECT conv_id, count(*) FILTER (WHERE nth = 1 AND edit = 'K' AND line.role[1:1] = 's') AS headed FROM taken GROUP BY conv_id),
repaired AS (
  SELECT t.conv_id, string_agg(
      CASE edit WHEN 'K' THEN line.role ELSE CASE WHEN (nth - headed) % 2 = 1 THEN 'user' ELSE 'assistant' END END || ':' || CASE edit WHEN 'I' THEN '' ELSE line.text END,
      chr(10) ORDER BY pos) AS body
  FROM taken t JOIN first_kept f ON t.conv_id IS NOT DISTINCT FROM f.conv_id WHERE edit <> 'D' GROUP BY t.conv_id)
SELECT c.conv_id, coalesce(w.gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(w.best.c, 0) AS cost, coalesce(w.best.a, '') AS audit, sha256(coalesce(r.body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN won w ON c.conv_id IS NOT DISTINCT FROM w.conv_id LEFT JOIN repaired r ON c.conv_id IS NOT DISTINCT FROM r.conv_id
"""

OP12 = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS digest,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
drawn AS (
  SELECT *, len(units) AS n, ('0x' || digest[1:8])::BIGINT % (len(units) + 1) AS x, ('0x' || digest[9:16])::BIGINT % (len(units) + 1) AS y,
         ('0x' || digest[17:24])::BIGINT % 100 AS third, ('0x' || digest[25:32])::BIGINT % 100 AS fourth
  FROM cut),
formed AS (
  SELECT *, array_to_string(units[1:least(x, y)], '') AS prefix, array_to_string(units[least(x, y) + 1:greatest(x, y)], '') AS middle,
         array_to_string(units[greatest(x, y) + 1:], '') AS suffix,
         CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR third >= 50 THEN 'plain' WHEN fourth < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN len(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN len(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM formed
"""

OP13 = r"""
WITH squeezed AS (
  SELECT doc_id, len(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body FROM documents),
ranked AS (
  SELECT doc_id, body, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size
  FROM squeezed WINDOW w AS (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM ranked
"""

ORACLES = {"op11_conversation_repair": OP11, "op12_fill_in_middle": OP12, "op13_exact_dedup": OP13, "op4_line_dedup": OP4, "op9_mixing": OP9}
