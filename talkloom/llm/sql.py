"""SQL of the queries that SQL can express."""

from __future__ import annotations

from talkloom.llm import turns
from talkloom.llm.tokens import SPACE, TOKEN

_TOKENS = f"coalesce(len(regexp_extract_all(text, '{TOKEN}')), 0)"
_SOURCE = f"lower(regexp_replace(source, '^[{SPACE}]+|[{SPACE}]+$', '', 'g'))"

_P8 = """
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents),
w AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
g AS (
  SELECT *, CASE WHEN lead(word, 4) OVER o IS NOT NULL
    THEN concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) END AS gram
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
),
r AS (SELECT *, CASE WHEN gram IS NOT NULL AND row_number() OVER (PARTITION BY doc_id, gram ORDER BY pos) > 1 THEN 1 ELSE 0 END AS again FROM g),
c AS (SELECT *, max(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS covered FROM r),
s AS (SELECT doc_id, count(*) AS n_words, sum(covered) AS n_repeated FROM c GROUP BY doc_id)"""



def _label(x: str) -> str:
    plain = f"lower(regexp_replace(regexp_replace({x}, '^[\\s\\[(>]+|[\\s\\]):]+$', '', 'g'), '\\s+', ' ', 'g'))"
    key = f"regexp_replace({plain}, '^(?:speaker|spk|channel|ch)[ _-]*', '')"
    return f"CASE WHEN regexp_matches({key}, '^(?:a|0+)$') THEN 'A' WHEN regexp_matches({key}, '^(?:b|0*1)$') THEN 'B' ELSE (SELECT max(s.speaker) FROM speaker_aliases s WHERE lower(s.alias) = {plain}) END"


def _p5(texts: bool = False) -> str:
    bare = f"regexp_replace(regexp_replace(w, '{turns.NOTE}', '', 'g'), '{turns.NOTE}', '', 'g')"
    hums = " ".join(f"WHEN lang = '{g}' THEN regexp_matches(core, '{turns.hum_pattern(u)}')" for g, u in turns.HUM_UNITS.items())
    told = ", ".join(f"count(*) FILTER (WHERE core IN ({', '.join(repr(x) for x in ws)})) AS f_{g}" for g, ws in turns.FREQUENT.items())
    more = ", CAST(k - 1 AS BIGINT) AS turn_no, min(st) AS start, max(en) AS \"end\", string_agg(text, ' ' ORDER BY st, word_idx) AS text"
    return f"""
WITH r AS (
  SELECT *, coalesce(word, '') AS w FROM (
    SELECT dialogue_id, word_idx, CASE WHEN NOT isnan("start") THEN "start" END AS st, CASE WHEN NOT isnan("end") THEN "end" END AS en, speaker AS label_text, word FROM raw_words
    QUALIFY row_number() OVER (PARTITION BY dialogue_id, word_idx ORDER BY loaded_at DESC NULLS LAST, CASE WHEN NOT isnan("start") THEN "start" END DESC NULLS LAST, "end" DESC NULLS LAST, speaker DESC NULLS LAST, word DESC NULLS LAST) = 1
  ) WHERE st IS NOT NULL
), p AS (
  SELECT *, CASE WHEN regexp_matches(w, '{turns.LABEL_SIGN}') THEN {_label(f"regexp_extract(w, '{turns.LABEL_TOKEN}', 1)")} END AS tl, {_label('label_text')} AS sl, {bare} AS rest,
    regexp_replace(lower({bare}), '{turns.EDGE}', '', 'g') AS core FROM r
), q AS (
  SELECT *, coalesce(tl, sl) AS label, tl IS NULL AND NOT regexp_matches(w, '{turns.TIME_MARK}') AND core <> '' AS sayable,
    CASE WHEN tl IS NULL AND core <> '' AND rest <> '' THEN instr('[({{<*', left(rest, 1)) ELSE 0 END AS op,
    CASE WHEN tl IS NULL AND core <> '' AND regexp_extract(rest, '([^.,;:!?])[.,;:!?]*$', 1) <> '' THEN instr('])}}>*', regexp_extract(rest, '([^.,;:!?])[.,;:!?]*$', 1)) ELSE 0 END AS cl,
    row_number() OVER (PARTITION BY dialogue_id ORDER BY st, word_idx) AS pos
  FROM p
), n AS (
  SELECT *, last_value(CASE WHEN op > 0 THEN {{'pos': pos, 'kind': op, 'st': st}} END IGNORE NULLS) OVER (o ROWS UNBOUNDED PRECEDING) AS fo,
    first_value(CASE WHEN cl > 0 THEN {{'pos': pos, 'kind': cl, 'st': st}} END IGNORE NULLS) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fc,
    max(CASE WHEN cl > 0 THEN pos END) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pc,
    min(CASE WHEN op > 0 THEN pos END) OVER (o ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS no,
    last_value(label IGNORE NULLS) OVER (o ROWS UNBOUNDED PRECEDING) AS sp
  FROM q WINDOW o AS (PARTITION BY dialogue_id ORDER BY st, word_idx)
), lang AS (
  SELECT c.dialogue_id, coalesce(k.lang, CASE greatest(f_en, f_de, f_fr, f_es) WHEN f_en THEN 'en' WHEN f_de THEN 'de' WHEN f_fr THEN 'fr' ELSE 'es' END) AS lang
  FROM (SELECT dialogue_id, {told} FROM n GROUP BY 1) c
  LEFT JOIN (SELECT dialogue_id, max(CASE WHEN lower(trim(lang))[1:2] IN ('en', 'de', 'fr', 'es') THEN lower(trim(lang))[1:2] END) AS lang FROM dialogues GROUP BY 1) k USING (dialogue_id)
), s AS (
  SELECT n.dialogue_id, word_idx, st, sp, en, trim(rest) AS text FROM n JOIN lang USING (dialogue_id)
  WHERE sayable AND sp IS NOT NULL AND op = 0 AND cl = 0 AND NOT (CASE {hums} ELSE false END)
    AND NOT coalesce(fo.kind = fc.kind AND fo.pos < fc.pos AND (pc IS NULL OR pc <= fo.pos) AND (no IS NULL OR no >= fc.pos), false)
), t AS (SELECT *, sum(c) OVER (PARTITION BY dialogue_id ORDER BY st, word_idx ROWS UNBOUNDED PRECEDING) AS k FROM (
  SELECT *, CASE WHEN lag(sp) OVER (PARTITION BY dialogue_id ORDER BY st, word_idx) = sp THEN 0 ELSE 1 END AS c FROM s))
SELECT dialogue_id, arg_min(word_idx, (st, word_idx)) AS first_word_idx, sp AS speaker, count(*) AS n_words{more if texts else ""} FROM t GROUP BY dialogue_id, sp, k"""


SQL = {
    "p5_found": _p5(),
    "p5_turns": _p5(texts=True),
    "p3_found": """
WITH u AS (
  SELECT dialogue_id, CAST(round("start" * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e FROM words
  WHERE speaker IN ('A', 'B') AND "start" IS NOT NULL AND "end" IS NOT NULL AND NOT isnan("start") AND NOT isnan("end") AND "end" >= "start"
), g AS (
  SELECT *, max(e) OVER (PARTITION BY dialogue_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM u
), i AS (
  SELECT *, sum(CASE WHEN s - p > 300 THEN 1 ELSE 0 END) OVER (PARTITION BY dialogue_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM g
), st AS (SELECT dialogue_id, k, max(e) - min(s) AS n FROM i GROUP BY dialogue_id, k),
m AS (SELECT dialogue_id, max(n) AS n FROM st GROUP BY dialogue_id),
sp AS (SELECT dialogue_id, min(s) AS f, max(e) AS l FROM u GROUP BY dialogue_id),
ev AS (SELECT dialogue_id, max(timestamp_ms) AS t FROM oracle_raw GROUP BY dialogue_id)
SELECT sp.dialogue_id, CASE WHEN m.n > 192000 THEN 'forced' ELSE 'natural' END AS cut_kind
FROM sp JOIN m USING (dialogue_id) LEFT JOIN ev USING (dialogue_id) WHERE greatest(l, coalesce(t, l)) - f > 192000""",
    "p6_found": f"SELECT doc_id FROM documents WHERE {_TOKENS} > 2048",
    "p7_found": f"""
WITH d AS (SELECT {_SOURCE} AS source, {_TOKENS} AS n FROM documents),
t AS (SELECT sum(n) AS total FROM d),
s AS (SELECT source, sum(n) AS n FROM d GROUP BY source)
SELECT m.source FROM mix_targets m LEFT JOIN s ON s.source = m.source, t
WHERE m.max_repeats * coalesce(s.n, 0) < m.target_share * t.total""",
    "p8_found": f"{_P8} SELECT doc_id FROM s WHERE n_repeated * 5 > n_words * 2",
    "p8_share": f"""{_P8} SELECT documents.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_repeated, 0) AS BIGINT) AS n_repeated
FROM documents LEFT JOIN s USING (doc_id)""",
}
