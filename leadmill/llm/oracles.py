"""DuckDB SQL of the queries, written from their definitions."""

from __future__ import annotations

# Words per document with their positions; DuckDB's regular expressions take the same character class.
QUALITY_BASE = r"""
docs AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
      FROM (SELECT r, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM docs)),
wc AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY r),
g AS (SELECT r, i, concat_ws(' ', word, lead(word) OVER o, lead(word, 2) OVER o) AS g, lead(word, 2) OVER o AS third
      FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g WHERE third IS NOT NULL) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r),
ln AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
       FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs)
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
base AS (
  SELECT docs.doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM docs LEFT JOIN wc USING (r) LEFT JOIN rep USING (r) LEFT JOIN ln USING (r)),
m AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             CASE WHEN n_words = 0 THEN 0 ELSE n_symbols * 10000 // n_words END AS symbols,
             CASE WHEN n_words = 0 THEN 0 ELSE word_chars * 100 // n_words END AS word_len,
             CASE WHEN n_lines = 0 THEN 0 ELSE n_dup_lines * 10000 // n_lines END AS dup_lines,
             CASE WHEN n_words = 0 THEN 0 ELSE n_repeat_words * 10000 // n_words END AS repeats FROM base)
"""

# A value's bin keeps its leading 7 binary digits: v - v mod 2^(digits - 7).
QUALITY_RULES = "WITH " + QUALITY_BASE + r""",
long AS (SELECT lang, source, metric, v FROM (SELECT lang, source, symbols, word_len, dup_lines, repeats FROM m WHERE NOT base_failed)
         UNPIVOT (v FOR metric IN (symbols, word_len, dup_lines, repeats))),
bins AS (SELECT lang, source, metric,
                CASE WHEN v < 128 THEN v ELSE v - v % (2 ** (length(bin(v)) - 7))::BIGINT END AS bin FROM long),
floors(metric, least) AS (VALUES ('symbols', 500), ('word_len', 50), ('dup_lines', 1500), ('repeats', 1200)),
own AS (SELECT lang, source, metric, count(*) AS n, quantile_disc(bin, 0.25) AS q1, quantile_disc(bin, 0.75) AS q3 FROM bins GROUP BY ALL),
lng AS (SELECT lang, metric, quantile_disc(bin, 0.25) AS q1, quantile_disc(bin, 0.75) AS q3 FROM bins GROUP BY ALL),
f AS (SELECT own.lang, own.source, metric,
             trunc((n * (own.q1 - 3 * greatest(own.q3 - own.q1, least)) + 200 * (lng.q1 - 3 * greatest(lng.q3 - lng.q1, least)))::DOUBLE / (n + 200)) AS lower,
             trunc((n * (own.q3 + 3 * greatest(own.q3 - own.q1, least)) + 200 * (lng.q3 + 3 * greatest(lng.q3 - lng.q1, least)))::DOUBLE / (n + 200)) AS upper
      FROM own JOIN lng USING (lang, metric) JOIN floors USING (metric)),
lim AS (SELECT lang, source, max(upper) FILTER (metric = 'symbols') AS a, max(upper) FILTER (metric = 'word_len') AS b,
               max(lower) FILTER (metric = 'word_len') AS c, max(upper) FILTER (metric = 'dup_lines') AS d,
               max(upper) FILTER (metric = 'repeats') AS e FROM f GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(symbols <= a AND word_len <= b AND word_len >= c AND dup_lines <= d AND repeats <= e, true) AS kept
FROM m LEFT JOIN lim USING (lang, source)
"""

URL_FILTERS = r"""
WITH u AS (SELECT page_id, row_number() OVER () AS r,
                  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hp AS (SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
              regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                          ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
ruled AS (SELECT hp.r, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v FROM hp JOIN rules
          ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY hp.r),
t AS (SELECT hp.*, rule, v, CASE WHEN v = 'block' THEN 'bad' WHEN v = 'allow' THEN 'good' ELSE 'none' END AS label,
        list_transform(string_split(path, '/'), lambda s: CASE
          WHEN regexp_matches(s, '^[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}$')
            OR regexp_matches(s, '^[0-9a-f]{12,}$') AND regexp_matches(s, '[a-f]') THEN '<h>'
          ELSE regexp_replace(s, '[0-9]+', '<n>', 'g') END) AS segs
      FROM hp LEFT JOIN ruled USING (r)),
n AS (SELECT host, segs, label, i, array_to_string(segs[1:i - 1], '/') AS prefix, segs[i] AS seg, coalesce(segs[i + 1], '<end>') AS nxt
      FROM (SELECT host, segs, label, unnest(range(1, len(segs) + 1)) AS i FROM t)),
k AS (SELECT host, i, prefix, seg, nxt, label, count(*) AS c FROM n GROUP BY host, i, prefix, seg, nxt, label),
share AS (SELECT *, sum(c) OVER (PARTITION BY host, i, prefix, seg) AS b, sum(c) OVER (PARTITION BY host, i, prefix, nxt, label) AS pc,
                 sum(c) OVER (PARTITION BY host, i, prefix) AS pt FROM k),
tv AS (SELECT host, i, prefix, seg, sum(greatest(0, c * pt - pc * b)) / b / pt <= 0.1 + 1 / sqrt(b) AND b < pt AS merge
       FROM share GROUP BY host, i, prefix, seg, b, pt),
tmpl AS (SELECT host, segs, string_agg(CASE WHEN merge THEN '*' ELSE seg END, '/' ORDER BY i) AS template
         FROM (SELECT DISTINCT host, segs, i, prefix, seg FROM n) JOIN tv USING (host, i, prefix, seg) GROUP BY host, segs),
pur AS (SELECT host, template, (count(*) FILTER (label = 'bad') + 5 * 0.5) / (count(*) FILTER (label <> 'none') + 5) AS purity FROM t JOIN tmpl USING (host, segs) GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN purity >= 0.7 THEN 'block' ELSE 'allow' END) AS verdict
FROM t JOIN tmpl USING (host, segs) JOIN pur USING (host, template)
"""

# Lengths of the template: 12 for the opening mark, 1 for the line end after the role, 11 for the closing mark.
CHAT = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'))
                + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;')) + 24 AS size FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

SUBSTRINGS = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, r, unnest(range(1, len(ws) - 11)) AS i, ws FROM d WHERE len(ws) >= 13),
win AS (SELECT doc_id, r, i, array_to_string(ws[i:i + 12], ' ') AS w FROM s),
hit AS (SELECT r, i FROM (SELECT doc_id, r, i, min(doc_id) OVER (PARTITION BY w) AS first FROM win) WHERE first < doc_id),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM hit),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
         FROM (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM d) ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

DECONTAMINATION = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)),
bs AS (SELECT DISTINCT item_id, array_to_string(ws[i:i + 4], ' ') AS s FROM (SELECT item_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM b WHERE len(ws) >= 5)),
n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, count(*) AS n_shared, count(*) / n_shingles AS containment
FROM ds JOIN bs USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id, n_shingles HAVING count(*) / n_shingles >= 0.8
"""

COLLOCATIONS = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase
      FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS sizes(m) WHERE len(ws) >= m)),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND f >= 30),
cuts AS (SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS lp, array_to_string(ws[k + 1:m], ' ') AS rp
         FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
s AS (SELECT cuts.lang, cuts.phrase, a, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score, k
      FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lp JOIN f y ON y.lang = cuts.lang AND y.phrase = rp
      QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, k) = 1),
gone AS (SELECT DISTINCT s.lang, s.phrase FROM s JOIN c ON c.lang = s.lang AND c.phrase <> s.phrase AND 100 * c.a >= 80 * s.a
         AND contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' '))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM s ANTI JOIN gone USING (lang, phrase) JOIN totals USING (lang) QUALIFY rank <= 2000
"""

# crc32 bit by bit; the automaton as a recursion over the rows that carries, for each state, the cheapest edits with their
# letters and the repaired text (c, a, t), so that the least of equal costs is the least text.
REPAIR = r"""
WITH RECURSIVE
raw AS (SELECT conv_id, coalesce('c' || conv_id, '') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
crc AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(k, ''), lambda x:
               list_transform(range(8), lambda b: (ascii(x) >> b::INTEGER) & 1)))),
               lambda a, b: xor(a >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295) % 20 AS fault FROM raw),
hurt AS (SELECT conv, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
                CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy FROM crc WHERE fault <> 0),
num AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM hurt),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again, left(role, 1) AS r,
                lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) AS before,
                NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, regexp_matches(text, '[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*$') AS cut FROM num),
rows_ AS (SELECT *, blank OR again AS must, cut::INTEGER AS u, 1000000000 AS far FROM seen),
stat AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
                count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (cut AND NOT must) AS truncated,
                count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal FROM rows_ GROUP BY conv),
dp AS (
  SELECT conv, 0::BIGINT AS i, {'c': 0, 'a': '', 't': ''} AS v0, {'c': 1000000000, 'a': '', 't': ''} AS v1,
         {'c': 1000000000, 'a': '', 't': ''} AS v2, {'c': 1000000000, 'a': '', 't': ''} AS v3 FROM stat
  UNION ALL
  SELECT conv, i + 1, {'c': v0.c + 3, 'a': v0.a || 'D', 't': v0.t},
    list_min([{'c': v1.c + 3, 'a': v1.a || 'D', 't': v1.t},
              {'c': CASE WHEN must OR r <> 's' THEN far ELSE v0.c + u END, 'a': v0.a || 'K', 't': v0.t || kept}]),
    list_min(list_concat([{'c': w2.c + 3, 'a': w2.a || 'D', 't': w2.t}], flatten(list_transform([v0, v1, w3], lambda s: [
              {'c': CASE WHEN must OR r <> 'u' THEN far ELSE s.c + u END, 'a': s.a || 'K', 't': s.t || kept},
              {'c': CASE WHEN must THEN far ELSE s.c + u + 2 END, 'a': s.a || 'R', 't': s.t || 'user:' || line}])))),
    list_min([{'c': w3.c + 3, 'a': w3.a || 'D', 't': w3.t},
              {'c': CASE WHEN must OR r <> 'a' THEN far ELSE w2.c + u END, 'a': w2.a || 'K', 't': w2.t || kept},
              {'c': CASE WHEN must THEN far ELSE w2.c + u + 2 END, 'a': w2.a || 'R', 't': w2.t || 'assistant:' || line}])
  FROM (SELECT dp.*, x.must, x.u, x.r, x.far, x.role || ':' || x.text || chr(10) AS kept, x.text || chr(10) AS line,
          list_min(list_concat([v2], list_transform([v0, v1, v3], lambda s: {'c': s.c + 2, 'a': s.a || 'I', 't': s.t || 'user:' || chr(10)}))) AS w2,
          list_min(list_concat([v3, {'c': v2.c + 2, 'a': v2.a || 'I', 't': v2.t || 'assistant:' || chr(10)}], list_transform([v0, v1], lambda s:
              {'c': s.c + 4, 'a': s.a || 'II', 't': s.t || 'user:' || chr(10) || 'assistant:' || chr(10)}))) AS w3
        FROM dp JOIN rows_ x ON x.conv = dp.conv AND x.i = dp.i + 1)),
done AS (SELECT conv, list_min([v0, v3, {'c': v2.c + 2, 'a': v2.a || 'I', 't': v2.t || 'assistant:' || chr(10)},
                                {'c': v1.c + 4, 'a': v1.a || 'II', 't': v1.t || 'user:' || chr(10) || 'assistant:' || chr(10)}]) AS e
         FROM dp JOIN (SELECT conv, max(i) AS i FROM rows_ GROUP BY conv) USING (conv, i))
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.c, 0)::BIGINT AS cost, coalesce(e.a, '') AS audit,
       sha256(coalesce(left(e.t, greatest(length(e.t) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM raw) LEFT JOIN stat USING (conv) LEFT JOIN done USING (conv)
"""
