"""SQL that queries are held against: the same page streams and operators, stated independently as common table expressions."""

from __future__ import annotations

from leafcut.sources.adapter import PHRASES, TAXONOMY

_WS = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
_LINE = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def lines(x: str) -> str:
    return f"list_filter(list_transform(string_split_regex(coalesce({x}, ''), '{_LINE}'), lambda l: regexp_replace(l, '^{_WS}+|{_WS}+$', '', 'g')), lambda l: l <> '')"


def quoted(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def dot(a: str, b: str) -> str:
    return f"list_sum(list_transform(range(1, len({a}) + 1), lambda k: {a}[k] * {b}[k]))"


def cosine(a: str, b: str) -> str:
    return f"CASE WHEN {a} IS NULL OR {b} IS NULL OR len({a}) <> len({b}) THEN NULL WHEN sqrt({dot(a, a)}) * sqrt({dot(b, b)}) = 0 THEN 0 ELSE {dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)})) END"


def small(x: str) -> str:
    return f"coalesce(TRY_CAST({x} AS BIGINT) BETWEEN 0 AND 999, false)"


_P1, _P2 = r"(?i)\bpage\s+(\d+)\s+of\s+(\d+)\b", r"(?i)\bpg\.?\s*(\d+)\s*/\s*(\d+)\b"


def total(x: str) -> str:
    """(cur, total) of a text, or null."""
    case = "CASE " + " ".join(f"WHEN regexp_matches(l, '{p}') AND {small(f"regexp_extract(l, '{p}', 1)")} THEN {{'cur': CAST(regexp_extract(l, '{p}', 1) AS BIGINT), 'total': TRY_CAST(regexp_extract(l, '{p}', 2) AS BIGINT)}}" for p in (_P1, _P2)) + " END"
    return f"list_filter(list_transform({lines(x)}, lambda l: {case}), lambda l: l IS NOT NULL)[1]"


def bare(x: str) -> str:
    ps = (r"^-\s*(\d+)\s*-$", r"^\s*(\d+)\s*$")
    case = "CASE " + " ".join(f"WHEN regexp_matches(l, '{p}') AND {small(f"regexp_extract(l, '{p}', 1)")} THEN CAST(regexp_extract(l, '{p}', 1) AS BIGINT)" for p in ps) + " END"
    return f"list_filter(list_transform({lines(x)}, lambda l: {case}), lambda l: l IS NOT NULL)[1]"


def split(x: str) -> str:
    ls = lines(x)
    return f"list_filter(list_transform(range(1, len({ls})), lambda k: CASE WHEN regexp_matches(({ls})[k], '(?i)^(PAGE|PG)\\.?:?\\s*$') AND regexp_matches(({ls})[k + 1], '^(\\d+)$') AND {small(f'({ls})[k + 1]')} THEN CAST(({ls})[k + 1] AS BIGINT) END), lambda l: l IS NOT NULL)[1]"


PAGES = f"""
P AS (SELECT source AS doc_id, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INTEGER) AS page_num, doc_id AS i, text AS own FROM documents),
R0 AS (SELECT *, CASE WHEN i % 11 = 0 THEN 'EXHIBIT ' || (i % 9) || chr(10) || own WHEN i % 11 = 1 THEN 'TO: A' || chr(10) || 'FROM: B' || chr(10) || own WHEN i % 11 = 2 THEN 'Exhibit a' || chr(10) || own
    WHEN i % 11 = 3 THEN 'MEMORANDUM' || chr(10) || 'Subject: x' || chr(10) || own ELSE own END AS body,
  CASE WHEN i % 3 = 0 THEN 'Page ' || (1 + page_num % 7) || ' of 7' WHEN i % 3 = 1 THEN 'PAGE:' || chr(10) || (page_num % 5) ELSE '' END AS header,
  CASE WHEN page_num % 4 = 0 THEN '- ' || (page_num % 6) || ' -' WHEN page_num % 4 = 1 THEN ['Acme Widgets LLC', 'Bolt Works Inc', 'Crane Partners'][(page_num // 10) % 3 + 1] || chr(10) || '12 Main Street, Springfield IL 62701' ELSE '' END AS footer FROM P),
R AS MATERIALIZED (SELECT doc_id, page_num, i, CAST([600, 595, 1100, 700, 792][i % 5 + 1] AS DOUBLE) AS width, CAST([776, 842, 600, 700, 612][i % 5 + 1] AS DOUBLE) AS height,
  trim(CASE WHEN page_num % 13 IN (5, 6) THEN 'Repeated page ' || (page_num // 13) || ' of the stream' WHEN i % 11 = 4 THEN '' ELSE body || chr(10) || {quoted(PHRASES)}[i % {len(PHRASES)} + 1] END) AS text,
  header, footer, CASE WHEN i % 17 = 0 THEN header || chr(10) || 'TEL: 555.123.4567' ELSE header END AS more,
  CAST(i * 37 % 500 AS INTEGER) AS drawing_count, CAST(i % 4 AS INTEGER) AS image_count, CASE WHEN i % 9 = 0 THEN 0.5::DOUBLE ELSE 0::DOUBLE END AS cover, i % 2 = 1 AS large FROM R0),
TOC AS (SELECT doc_id, page_num * 10 + k AS ord, CASE WHEN i % 7 = 0 THEN k + 1 WHEN i % 7 = 1 THEN 2 ELSE 3 END AS level,
    CASE WHEN i % 7 = 0 THEN CASE k WHEN 0 THEN 'Part ' || (page_num // 20) ELSE 'Also' END WHEN i % 7 = 1 THEN 'Section A' ELSE CASE k WHEN 0 THEN 'Leaf' ELSE 'Second leaf' END END AS title, page_num AS page_1based
  FROM P, (VALUES (0), (1)) v(k) WHERE i % 7 IN (0, 2) OR i % 7 = 1 AND k = 0),
MARKS AS (SELECT doc_id, page_1based AS page_num, arg_min(title, level * 1000000 + ord) AS title, CAST(min(level) AS INTEGER) AS level FROM TOC GROUP BY doc_id, page_1based)"""

_W = "(PARTITION BY doc_id ORDER BY page_num)"
_STOP = "['the','of','to','and','in','for','a','on','at','street','st','avenue','ave','road','rd','floor','suite','room','blvd','boulevard','drive','dr','building']"


def bucket(w: str, h: str) -> str:
    lo, sh = f"greatest({w}, {h})", f"least({w}, {h})"
    near = lambda x, t: f"abs({x} - {t}) <= greatest(8, 0.03 * {t})"
    return f"CASE WHEN {lo} > 1000 THEN 'WIDE' WHEN {near(lo, 792)} AND {near(sh, 612)} THEN 'US_LETTER' WHEN {near(lo, 842)} AND {near(sh, 595)} THEN 'A4' ELSE 'OTHER' END"


def head(x: str) -> str:
    block = f"array_to_string(({lines(x)})[1:8], ' ')"
    return f"CASE WHEN regexp_matches({block}, ',\\s*[A-Za-z .]+\\s+\\d{{5}}(-\\d{{4}})?\\b') OR regexp_matches({block}, '(?i)\\b(?:[TF]|TEL|FAX)[:.]?\\s*\\d{{3}}[.\\-]\\d{{3}}[.\\-]\\d{{4}}\\b') OR regexp_matches({block}, '(?i)\\bwww\\.\\S+\\.\\w+') THEN {block} END"


def anchor_label(l: str) -> str:
    return f"CASE WHEN regexp_matches({l}, '(?i)^(TO|FROM|DATE|RE|SUBJECT|CC|SENT)\\s*:') THEN upper(regexp_extract({l}, '(?i)^(TO|FROM|DATE|RE|SUBJECT|CC|SENT)\\s*:', 1)) WHEN regexp_matches({l}, '(?i)^MEMORANDUM\\s*$') THEN 'MEMORANDUM' END"


def words(x: str) -> str:
    return f"list_filter(list_distinct(regexp_extract_all(lower({x}), '[a-z0-9]+')), lambda t: length(t) > 1 AND NOT list_contains({_STOP}, t))"


DETECT = f"""
D0 AS MATERIALIZED (SELECT R.*, title, level,
  NOT (length(text) > 15 OR cover > 0.02) AND drawing_count <= 5 AS is_blank, ({bucket("width", "height")}) || '_' || CASE WHEN width > height THEN 'landscape' ELSE 'portrait' END AS format_label,
  substr(list_filter(({lines("text")})[1:3], lambda l: regexp_matches(l, '^(EXHIBIT|SCHEDULE|ATTACHMENT|APPENDIX|ANNEX|ADDENDUM)\\b') AND regexp_matches(l, '\\p{{Lu}}') AND NOT regexp_matches(l, '\\p{{Ll}}'))[1], 1, 80) AS title_anchor,
  list_sort(list_distinct(list_filter(list_transform(({lines("text")})[1:15], lambda l: {anchor_label("l")}), lambda l: l IS NOT NULL))) AS labels_all,
  coalesce(width > height AND drawing_count <= 20 AND image_count = 1 AND large, false) AS is_drawing,
  coalesce({head("header")}, {head("footer")}, {head("more")}) AS block, {total("footer")} AS tf, {total("header")} AS th, {split("footer")} AS sf, {split("header")} AS sh, {bare("footer")} AS bf, {bare("header")} AS bh
  FROM R LEFT JOIN MARKS USING (doc_id, page_num)),
D1 AS (SELECT *, CASE WHEN len(labels_all) >= 2 THEN labels_all END AS correspondence_labels,
  CASE WHEN tf IS NOT NULL THEN tf.cur WHEN th IS NOT NULL THEN th.cur WHEN sf IS NOT NULL THEN sf ELSE sh END AS cur, CASE WHEN tf IS NOT NULL THEN tf.total WHEN th IS NOT NULL THEN th.total END AS total,
  CASE WHEN tf IS NOT NULL THEN 'footer' WHEN th IS NOT NULL THEN 'header' WHEN sf IS NOT NULL THEN 'footer' WHEN sh IS NOT NULL THEN 'header' END AS region,
  CASE WHEN tf IS NOT NULL OR th IS NOT NULL THEN 'total' WHEN sf IS NOT NULL OR sh IS NOT NULL THEN 'split' END AS kind, CASE WHEN coalesce(bf, 0) <> 0 THEN bf ELSE bh END AS bare_n,
  lag(format_label) OVER {_W} AS prev_label, lag(text) OVER {_W} AS prev_text, lag(drawing_count) OVER {_W} AS pd, last_value(block IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page_num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_block FROM D0),
D AS MATERIALIZED (SELECT *, coalesce(length(text) > 15 AND text = prev_text, false) AS dup, coalesce(pd > 0 AND drawing_count > 3 * pd AND drawing_count > 200, false) AS spike, coalesce(pd > 200 AND drawing_count < pd / 3::DOUBLE, false) AS fall,
  coalesce(CASE WHEN block IS NULL OR prev_block IS NULL THEN false WHEN len({words("block")}) = 0 OR len({words("prev_block")}) = 0 THEN true
    ELSE len(list_intersect({words("block")}, {words("prev_block")})) / len(list_distinct(list_concat({words("block")}, {words("prev_block")})))::DOUBLE < 0.4 END, false) AS letterhead_changed FROM D1)"""

FOLD = """
FOLD AS (
  SELECT DISTINCT doc_id, 0 AS page_num, NULL::BIGINT AS number, NULL::BIGINT AS of_, false AS reset, false AS fresh, false AS other, false AS repeated, false AS mark, false AS changed, false AS ret,
    NULL::BIGINT AS s_cur, NULL::BIGINT AS s_total, NULL::VARCHAR AS s_scheme, NULL::VARCHAR AS s_title, NULL::INTEGER AS s_page, []::VARCHAR[] AS s_labels, false AS s_seen FROM D
  UNION ALL
  SELECT doc_id, page_num, number, of_, reset, fresh, other, repeated, mark, changed, ret, coalesce(number, s_cur), CASE WHEN number IS NULL THEN s_total ELSE of_ END, coalesce(scheme, s_scheme),
    CASE WHEN mark THEN title ELSE s_title END, CASE WHEN mark THEN page_num ELSE s_page END, CASE WHEN anchor THEN [label] ELSE list_distinct(list_append(s_labels, label)) END, CASE WHEN anchor THEN number IS NOT NULL ELSE s_seen OR number IS NOT NULL END
  FROM (SELECT *, NOT dup AND (mark OR (changed AND NOT ret) OR title_anchor IS NOT NULL OR correspondence_labels IS NOT NULL) AS anchor
    FROM (SELECT *, coalesce(level <= 2, false) AND NOT repeated AND NOT dup AS mark
      FROM (SELECT *, coalesce(level <= 2 AND title = s_title AND page_num - s_page <= 1, false) AND NOT reset AND NOT spike AS repeated, coalesce(fresh AND scheme <> s_scheme, false) AS other
        FROM (SELECT *, reset AND number = 1 AND NOT s_seen AS fresh
          FROM (SELECT *, coalesce(number = 1 OR number < s_cur OR number > s_cur + 1, false) AS reset
            FROM (SELECT d.doc_id, d.page_num, d.dup, d.spike, d.title, d.level, d.title_anchor, d.correspondence_labels, d.format_label AS label, coalesce(d.format_label <> d.prev_label, false) AS changed,
                coalesce(d.format_label <> d.prev_label, false) AND list_contains(f.s_labels, d.format_label) AS ret, d.region || '/' || d.kind AS scheme,
                CASE WHEN d.cur IS NOT NULL THEN d.cur WHEN d.bare_n = f.s_cur + 1 THEN d.bare_n END AS number, CASE WHEN d.cur IS NOT NULL AND d.kind = 'total' THEN d.total ELSE f.s_total END AS of_,
                f.s_cur, f.s_total, f.s_scheme, f.s_title, f.s_page, f.s_labels, f.s_seen
              FROM D d JOIN FOLD f ON d.doc_id = f.doc_id AND d.page_num = f.page_num + 1))))))),
FE AS MATERIALIZED (SELECT D.*, number AS page_num_found, CASE WHEN number IS NOT NULL THEN of_ END AS page_total_found, reset AS numbering_reset, fresh AS numbering_fresh_start, other AS numbering_scheme_changed,
    repeated AS bookmark_suppressed, mark AS has_l1_bookmark, changed AS format_changed, ret AS format_returning, CASE WHEN mark THEN title END AS bookmark_title, level AS bookmark_level FROM D JOIN FOLD f USING (doc_id, page_num))"""

VECTORS = """
V AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
PV AS MATERIALIZED (SELECT P.doc_id, P.page_num, list_transform(range(1, len(a.e) + 1), lambda k: a.e[k] + 0.3::DOUBLE * b.e[k]) AS vec FROM P JOIN V a ON a.vec_id = (P.page_num // 10) % 20 JOIN V b ON b.vec_id = (50 + P.i) % (SELECT max(vec_id) + 1 FROM embeddings))"""


def flags(source: str, name: str = "FL") -> str:
    """Chain and flags of a relation (doc_id, page_num, vec), blank pages left out."""
    pair = "PARTITION BY doc_id ORDER BY page_num"
    frame = f"({pair} ROWS BETWEEN 11 PRECEDING AND 1 PRECEDING)"
    return f"""
{name}0 AS (SELECT doc_id, page_num, vec, last_value(vec IGNORE NULLS) OVER ({pair} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM {source}),
{name}1 AS MATERIALIZED (SELECT doc_id, page_num, {cosine("vec", "prev")} AS sim FROM {name}0),
{name}2 AS (SELECT *, count(sim) OVER {frame} AS n, avg(sim) OVER {frame} AS mean, greatest(stddev_pop(sim) OVER {frame}, 0.02) AS std FROM {name}1),
{name} AS MATERIALIZED (SELECT doc_id, page_num, CASE WHEN n < 3 THEN sim ELSE round_even(sim, 4) END AS sim,
  coalesce(CASE WHEN n < 3 THEN sim < 0.55 ELSE (sim - mean) / std < -2 AND mean - sim > 0.07 END, false) AS is_moderate, coalesce(n >= 3 AND (sim - mean) / std < -4 AND mean - sim > 0.07, false) AS is_high FROM {name}2)"""


SCORES = """
S0 AS (SELECT f.*, g.sim, coalesce(g.is_moderate, false) AS m, coalesce(g.is_high, false) AS h FROM FE f LEFT JOIN FL g USING (doc_id, page_num)),
S1 AS (SELECT *, CASE WHEN h THEN 1.0::DOUBLE WHEN m AND sim IS NOT NULL THEN 0.5::DOUBLE ELSE 0::DOUBLE END AS emb,
  CASE WHEN numbering_fresh_start AND numbering_scheme_changed THEN 1.1::DOUBLE WHEN numbering_fresh_start THEN 0.9::DOUBLE WHEN numbering_reset THEN 0.8::DOUBLE ELSE 0::DOUBLE END AS num,
  CASE WHEN spike OR fall THEN 0.3::DOUBLE ELSE 0::DOUBLE END AS draw, CASE WHEN letterhead_changed THEN 0.5::DOUBLE ELSE 0::DOUBLE END AS letter, format_changed AND NOT format_returning AS newf FROM S0),
S2 AS (SELECT *, coalesce(has_l1_bookmark AND (bookmark_level = 1 OR num <> 0 OR draw <> 0 OR newf OR emb <> 0 OR letter <> 0), false) OR (bookmark_suppressed AND h) AS trusted FROM S1),
S3 AS (SELECT *, trusted OR newf OR title_anchor IS NOT NULL OR correspondence_labels IS NOT NULL AS strong FROM S2),
S4 AS (SELECT *, NOT dup AND emb > 0 AND NOT strong AND NOT numbering_reset AND NOT letterhead_changed AS alone FROM S3),
S5 AS (SELECT *, CASE WHEN alone AND coalesce(lag(alone) OVER (PARTITION BY doc_id ORDER BY page_num), false) THEN -0.5::DOUBLE ELSE 0::DOUBLE END AS penalty, CASE WHEN strong THEN 1::DOUBLE WHEN format_changed THEN 0.4::DOUBLE ELSE 0::DOUBLE END AS structure FROM S4),
SC AS MATERIALIZED (SELECT *, CASE WHEN dup THEN 0 ELSE greatest(0, structure + num + emb + draw + letter + penalty) END AS total_, NOT dup AND structure + num + emb + draw + letter + penalty >= 1 AS is_boundary FROM S5),
SI AS MATERIALIZED (SELECT doc_id, page_num, CAST(sum(CASE WHEN is_boundary OR page_num = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY page_num) AS INTEGER) AS segment_index FROM SC),
SG AS MATERIALIZED (SELECT doc_id, segment_index, min(page_num) AS start_page, max(page_num) AS end_page FROM SI GROUP BY doc_id, segment_index)"""

_types = ", ".join(f"({i}, '{t[0]}', '{t[1]}', '{t[2]}', '{t[3]}')" for i, t in enumerate(TAXONOMY))
_phrases = ", ".join(f"({i}, '{t[0]}', '{k}', {j}, '{p}')" for i, t in enumerate(TAXONOMY) for k, ps in (("anchor", t[4]), ("keyword", t[5])) for j, p in enumerate(ps))
TAXON = f"""
TT(type_ord, type_id, label, category, ingest_mode) AS (VALUES {_types}),
TP(type_ord, type_id, kind, phrase_ord, phrase) AS (VALUES {_phrases})"""

CLASSES = f"""
C0 AS (SELECT f.*, s.segment_index, NOT f.is_blank AND length(f.text) > 0 AS texted FROM FE f JOIN SI s USING (doc_id, page_num)),
C1 AS (SELECT *, count(*) FILTER (WHERE texted) OVER (PARTITION BY doc_id, segment_index ORDER BY page_num) AS place FROM C0),
C2 AS MATERIALIZED (SELECT doc_id, segment_index, min(page_num) AS start_page, max(page_num) AS end_page, coalesce(string_agg(bookmark_title, ' ' ORDER BY page_num), '') AS titles, coalesce(string_agg(CASE WHEN texted AND place <= 3 THEN text END, ' ' ORDER BY page_num), '') AS body,
  arg_min(coalesce(title_anchor, ''), page_num) AS first_anchor, bool_or(is_drawing) AS any_drawing, coalesce(avg(CASE WHEN NOT is_blank THEN is_drawing::INTEGER END), 0) AS drawing_share, bool_or(drawing_count > 200) AS has_tables FROM C1 GROUP BY doc_id, segment_index),
AM AS (SELECT doc_id, segment_index, w, type_id, phrase, row_number() OVER (PARTITION BY doc_id, segment_index, w ORDER BY length(phrase) DESC, type_ord, phrase_ord) AS k
  FROM (SELECT doc_id, segment_index, 'titles' AS w, lower(titles) AS t FROM C2 UNION ALL SELECT doc_id, segment_index, 'body', lower(body) FROM C2) x JOIN TP ON kind = 'anchor' AND contains(t, phrase)),
KW AS (SELECT doc_id, segment_index, type_ord, type_id, count(DISTINCT phrase) AS hits FROM C2 JOIN TP ON kind = 'keyword' AND contains(lower(concat_ws(' ', titles, body)), phrase) GROUP BY ALL),
KB AS (SELECT *, row_number() OVER (PARTITION BY doc_id, segment_index ORDER BY hits DESC, type_ord) AS k FROM KW),
CL AS (SELECT c.*, CASE WHEN a.type_id IS NOT NULL THEN a.type_id WHEN b.type_id IS NOT NULL THEN b.type_id WHEN drawing_share >= 0.6 THEN 'engineering_drawing' WHEN k.hits >= CASE WHEN first_anchor <> '' THEN 3 ELSE 1 END THEN k.type_id ELSE 'supporting_misc' END AS document_type_id,
  CASE WHEN a.type_id IS NOT NULL OR b.type_id IS NOT NULL OR drawing_share >= 0.6 THEN 'HIGH' WHEN k.hits >= CASE WHEN first_anchor <> '' THEN 3 ELSE 2 END THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
  CASE WHEN a.type_id IS NOT NULL THEN 'anchor_phrase_bookmark:' || a.phrase[1:40] WHEN b.type_id IS NOT NULL THEN 'anchor_phrase_body:' || b.phrase[1:40] WHEN drawing_share >= 0.6 THEN 'visual_fingerprint:' || CAST(round_even(drawing_share * 100, 0) AS INTEGER) || '%_drawing_pages'
    WHEN k.hits >= CASE WHEN first_anchor <> '' THEN 3 ELSE 1 END THEN 'keyword_score:' || k.hits || '_hits' ELSE 'default' END AS classification_method
  FROM C2 c LEFT JOIN AM a ON a.doc_id = c.doc_id AND a.segment_index = c.segment_index AND a.w = 'titles' AND a.k = 1 LEFT JOIN AM b ON b.doc_id = c.doc_id AND b.segment_index = c.segment_index AND b.w = 'body' AND b.k = 1
  LEFT JOIN KB k ON k.doc_id = c.doc_id AND k.segment_index = c.segment_index AND k.k = 1)"""


def chain(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts) + "\n"


EVENTS = "E AS (SELECT user_id AS doc_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS page_num, event_type AS format_label, CAST(floor(value) AS BIGINT) AS drawing_count, event_id FROM events)"
COSTS = """
K0 AS (SELECT doc_id, CAST(length(text) AS BIGINT) AS len, doc_id % 3 <> 0 AS prim, CASE WHEN doc_id % 6 = 1 THEN length(text) % 900 END AS told, CASE WHEN doc_id % 6 = 3 THEN length(text) % 700 END AS told2 FROM documents),
K1 AS (SELECT *, CASE WHEN prim THEN CASE WHEN told IS NOT NULL THEN least(len // 4, told - 100) ELSE len // 4 END WHEN len = 0 THEN 0 ELSE coalesce(told2, greatest(len // 4, 1)) END AS tt FROM K0),
K AS (SELECT doc_id, CASE WHEN prim THEN 'primary' ELSE 'fallback' END AS method, CAST(tt AS BIGINT) AS text_tokens, CAST(CASE WHEN NOT prim THEN 1 WHEN told IS NOT NULL THEN told - tt ELSE 1290 END AS BIGINT) AS image_tokens, doc_id % 6 IN (2, 4, 5, 0) AS estimated FROM K1),
KC AS (SELECT *, CASE WHEN method = 'primary' THEN text_tokens * (0.20::DOUBLE / 1e6::DOUBLE) + image_tokens * (0.45::DOUBLE / 1e6::DOUBLE) ELSE 0.0001::DOUBLE + text_tokens * (0.15::DOUBLE / 1e6::DOUBLE) END AS cost_usd FROM K)"""
