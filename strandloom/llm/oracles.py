"""SQL that gives the rows of the queries SQL can express."""

from __future__ import annotations

from .quality_rules import COMMON_WORDS

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Slot by slot; the counts from which the others are timed (base, since, whole) begin anew when a source runs out.
MIXING = """
WITH RECURSIVE counts AS (
  SELECT coalesce(source, '') AS src, count(*) AS n, pow(CAST(count(*) AS DOUBLE), 0.5) AS w FROM documents GROUP BY 1
), shares AS (SELECT src, n, w, (n + 15) // 16 AS b, row_number() OVER (ORDER BY src) - 1 AS i FROM counts),
total AS (SELECT CAST(sum(b) AS BIGINT) AS slots, list(n ORDER BY i) AS ns, list(w ORDER BY i) AS ws, list(b ORDER BY i) AS bs FROM shares),
run(t, done, base, since, whole, pick) AS (
  SELECT CAST(0 AS BIGINT), list(CAST(0 AS BIGINT) ORDER BY i), list(CAST(0 AS BIGINT) ORDER BY i), CAST(0 AS BIGINT), sum(w), CAST(-1 AS BIGINT) FROM shares
  UNION ALL
  SELECT t + 1, made, CASE WHEN made[p + 1] < bs[p + 1] THEN base ELSE made END, CASE WHEN made[p + 1] < bs[p + 1] THEN since ELSE t + 1 END,
         CASE WHEN made[p + 1] < bs[p + 1] THEN whole ELSE coalesce(list_sum(list_transform(ws, lambda w, j: CASE WHEN made[j] < bs[j] THEN w ELSE 0 END)), 0) END, p
  FROM (
    SELECT *, list_transform(done, lambda d, j: CASE WHEN j - 1 = p THEN d + 1 ELSE d END) AS made FROM (
      SELECT run.t, run.done, run.base, run.since, run.whole, total.ws, total.bs, (
        SELECT arg_min(s.i, struct_pack(late := floor((run.done[s.i + 1] - run.base[s.i + 1]) * run.whole / s.w + 1e-6) > run.t - run.since,
                                        due := ceil((run.done[s.i + 1] + 1 - run.base[s.i + 1]) * run.whole / s.w - 1e-6), i := s.i))
        FROM shares s WHERE run.done[s.i + 1] < s.b) AS p
      FROM run, total WHERE run.t < total.slots
    ) x
  ) y
), plan AS (
  SELECT t - 1 AS at, pick AS i, done[pick + 1] - 1 AS k, list_transform(done, lambda d, j: CASE WHEN j - 1 = pick THEN d - 1 ELSE d END) AS before FROM run WHERE pick >= 0
), ranked AS (
  SELECT doc_id, source, coalesce(source, '') AS src, row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY md5('mix' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS r FROM documents
)
SELECT r.doc_id, r.source, r.r // 16 AS block, p.at AS slot, CAST(list_sum(list_transform(ns, lambda n, j: least(n, 16 * p.before[j]))) + r.r % 16 AS BIGINT) AS position
FROM ranked r JOIN shares s ON s.src = r.src JOIN plan p ON p.i = s.i AND p.k = r.r // 16 CROSS JOIN total
"""

SUFFIX_DEDUP = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
chunks AS (SELECT doc_id, c, length(h) // 2 AS n, substr(h, 1000 * c + 1, 1198) AS part FROM (SELECT doc_id, h, unnest(range(0, length(h) // 1000 + 1)) AS c FROM d) x),
starts AS (SELECT doc_id, c, part, unnest(range(0, least(500, n - 99 - 500 * c))) AS j FROM chunks),
ranked AS (SELECT doc_id, 500 * c + j AS p, row_number() OVER (PARTITION BY md5(substr(part, 2 * j + 1, 200)) ORDER BY doc_id, 500 * c + j) AS r FROM starts),
dup AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER w <= 100 THEN 0 ELSE 1 END AS fresh FROM ranked WHERE r > 1 WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
numbered AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM dup),
runs AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM numbered GROUP BY doc_id, run),
pieces AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS gap FROM runs),
cut AS (
  SELECT p.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, string_agg(substr(d.h, 2 * gap + 1, 2 * (a - gap)), '' ORDER BY a) AS head, max(b) AS rest
  FROM pieces p JOIN d ON d.doc_id = p.doc_id GROUP BY p.doc_id
)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(rest, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut ON cut.doc_id = d.doc_id
"""

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d),
ranked AS (SELECT doc_id, p, row_number() OVER (PARTITION BY md5(array_to_string(w[p:p + 19], ' ')) ORDER BY doc_id, p) AS r FROM starts),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM ranked WHERE r > 1),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT e.doc_id, count(g.p) AS n_removed, coalesce(string_agg(e.word, ' ' ORDER BY e.p) FILTER (WHERE g.p IS NULL), '') AS t
  FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.p = e.p GROUP BY e.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

NEAR_DEDUP = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS x FROM d WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
both_sides AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM both_sides p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * k >= 80 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other),
least_of AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d JOIN least_of USING (doc_id) LEFT JOIN n ON n.doc_id = d.doc_id
"""

#: Blocks outside the article: the words of a host's pages in six-word runs that occur on two pages cover them or not.
HTML = r"""
WITH a AS (SELECT page_id, url, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1)) AS host, regexp_extract(html, '<article>(.*?)</article>', 1, 's') AS h,
  regexp_replace(regexp_replace(html, '<(title|style|script)>.*?</(title|style|script)>|<!--.*?-->|<!DOCTYPE html>', '', 'gs'), '<article>.*?</article>', '<p>', 's') AS o FROM pages),
b AS (SELECT page_id, url, unnest(string_split_regex(h, '</?(p|h1)>')) AS x, generate_subscripts(string_split_regex(h, '</?(p|h1)>'), 1) AS i FROM a),
c AS (SELECT page_id, url, i, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS x FROM b),
main AS (SELECT page_id, url, coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (WHERE x <> ''), '') AS text FROM c GROUP BY page_id, url),
ob AS (SELECT page_id, host, unnest(string_split_regex(o, '</?(html|head|body|nav|ul|li|div|p|footer)( [^>]*)?>')) AS x, generate_subscripts(string_split_regex(o, '</?(html|head|body|nav|ul|li|div|p|footer)( [^>]*)?>'), 1) AS i FROM a),
oc AS (SELECT page_id, host, i, trim(regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS x FROM ob),
od AS (SELECT page_id, host, i, string_split(x, ' ') AS w FROM oc WHERE x <> ''),
st AS (SELECT page_id, host, list_concat(flatten(list(w ORDER BY i)), ['$', '$', '$', '$', '$']) AS w FROM od GROUP BY 1, 2 HAVING len(flatten(list(w))) >= 6),
win AS (SELECT page_id, host, p, array_to_string(w[p:p + 5], ' ') AS x FROM (SELECT page_id, host, w, unnest(range(1, len(w) - 4)) AS p FROM st) s),
gone AS (SELECT DISTINCT page_id, unnest(range(p, p + 6)) AS p FROM (SELECT *, min(page_id) OVER (PARTITION BY host, x) AS lo, max(page_id) OVER (PARTITION BY host, x) AS hi FROM win) y WHERE lo < hi),
placed AS (SELECT page_id, i, len(w) AS n, sum(len(w)) OVER (PARTITION BY page_id ORDER BY i) - len(w) AS at FROM od),
held AS (SELECT b.page_id, b.i, b.n, count(g.p) AS k FROM placed b LEFT JOIN gone g ON g.page_id = b.page_id AND g.p > b.at AND g.p <= b.at + b.n GROUP BY 1, 2, 3),
boiler AS (SELECT page_id, count(*) AS n FROM held WHERE 100 * k >= 80 * n GROUP BY 1)
SELECT m.page_id, m.url, text, length(text) AS n_chars, coalesce(b.n, 0) AS n_boilerplate FROM main m LEFT JOIN boiler b ON b.page_id = m.page_id
"""


def _quality() -> str:
    classes = [r"[\x09-\x0D\x20]", "[a-z]", "[A-Z]", "[0-9]", r"""[!"''(),\-.:;?]""", r"[#$%&*+/<=>@\[\\\]^_`{|}~]", r"[^\x00-\x7F]"]
    counted = [f"length(text) - length(regexp_replace(text, '{c}', '', 'g'))" for c in classes]
    chars = f"[length(text) - ({' + '.join(f'({c})' for c in counted)}), {', '.join(counted)}]"
    words = " UNION ALL ".join(f"SELECT '{lang}' AS lang, '{w}' AS x, {i} AS i, {len(ws)} AS m" for lang, ws in sorted(COMMON_WORDS.items()) for i, w in enumerate(ws))
    strip = "trim(x, '.,;:!?\"''()*$%&|<>#')"
    js = lambda p, q: f"sqrt(greatest(0.0, list_sum(list_transform(list_zip({p}, {q}), lambda z: CASE WHEN z[1] > 0 THEN z[1] * log2(2 * z[1] / (z[1] + z[2])) ELSE 0 END + CASE WHEN z[2] > 0 THEN z[2] * log2(2 * z[2] / (z[1] + z[2])) ELSE 0 END)) / 2))"
    share = lambda a: f"list_transform({a}, lambda v: CAST(v AS DOUBLE) / list_sum({a}))"
    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM d),
windows AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, md5(array_to_string(w[p:p + 7], ' '))) AS k FROM starts),
marked AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM windows WHERE k > 1) m GROUP BY 1),
ls AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS l FROM d),
chars AS (SELECT doc_id, lang, {chars} AS c FROM d),
ref_c AS (SELECT lang, list_transform(range(1, 9), lambda i: list_sum(list_transform(list(c), lambda y: y[i]))) AS rc FROM chars GROUP BY 1),
common AS ({words}),
each AS (SELECT doc_id, lang, unnest(w) AS x FROM d),
named AS (SELECT e.doc_id, coalesce(c1.i, c2.i, c1.m, (SELECT max(m) FROM common c WHERE c.lang = e.lang)) AS i
  FROM (SELECT *, translate({strip}, '{_UPPER}', '{_LOWER}') AS y FROM each) e LEFT JOIN common c1 ON c1.lang = e.lang AND c1.x = e.x LEFT JOIN common c2 ON c2.lang = e.lang AND c2.x = e.y),
per AS (SELECT doc_id, i, count(*) AS k FROM named GROUP BY 1, 2),
hist AS (SELECT d.doc_id, d.lang, list_transform(range(0, m.m + 1), lambda j: coalesce(map_extract_value(p.k, j), 0)) AS h
  FROM d JOIN (SELECT lang, max(m) AS m FROM common GROUP BY 1) m ON m.lang = d.lang JOIN (SELECT doc_id, map_from_entries(list((CAST(i AS BIGINT), k))) AS k FROM per GROUP BY 1) p ON p.doc_id = d.doc_id),
ref_h AS (SELECT lang, list_transform(range(1, max(len(h)) + 1), lambda i: list_sum(list_transform(list(h), lambda y: y[i]))) AS rh FROM hist GROUP BY 1),
far AS (
  SELECT d.doc_id, len(d.w) AS n_words, list_sum(list_transform(d.w, lambda x: length(x))) AS word_chars, length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(ls.l) - len(list_distinct(ls.l)) AS n_dup_lines, coalesce(m.n, 0) AS n_repeat_words,
    CASE WHEN list_sum(c.c) > 0 THEN {js(share('c.c'), share('r.rc'))} END AS char_distance, CASE WHEN list_sum(h.h) > 0 THEN {js(share('h.h'), share('rh.rh'))} END AS word_distance
  FROM d JOIN ls USING (doc_id) JOIN chars c USING (doc_id) JOIN ref_c r ON r.lang = d.lang LEFT JOIN hist h ON h.doc_id = d.doc_id LEFT JOIN ref_h rh ON rh.lang = d.lang LEFT JOIN marked m ON m.doc_id = d.doc_id
)
SELECT doc_id, n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT (coalesce(word_chars, 0) >= 200 AND coalesce(char_distance, 0) > 0.30) AND NOT (n_words >= 100 AND coalesce(word_distance, 0) > 0.42) AS kept,
  round(char_distance, 6) AS char_distance, round(word_distance, 6) AS word_distance
FROM far
"""


QUALITY = _quality()
