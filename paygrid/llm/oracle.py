"""DuckDB SQL for the queries of this subpackage that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op5_quality_rules"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), win AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM (
    SELECT rid, i, w[i:i+2] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w))
), rep AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM win WHERE n > 1) GROUP BY rid
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
         length(t) - length(replace(t, '!', '')) AS n_exclaim
  FROM w LEFT JOIN rep USING (rid)
), b AS (
  SELECT *, (n_words < 50) AS f0, (100 * n_repeat_words > 50 * n_words) AS f1, (10 * n_symbols > n_words) AS f2,
         (10 * n_dup_lines > 3 * n_lines) AS f3, (word_chars < 2 * n_words) AS f4, (word_chars > 20 * n_words) AS f5,
         (2 * n_exclaim > n_words) AS f6 FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f0 OR f1) AS base_failed,
       NOT (f0 OR f1 OR f2 OR f4 OR f5 OR f6) AS kept,
       (f0::BIGINT + 2 * f1::BIGINT + 4 * f2::BIGINT + 8 * f3::BIGINT + 16 * f4::BIGINT + 32 * f5::BIGINT
        + 64 * f6::BIGINT)::BIGINT AS fail_bits
FROM b
"""

ORACLE["op9_source_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, text, '')) AS h, row_number() OVER () AS rid FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid
  FROM d GROUP BY source
), c AS (
  SELECT *, (sid - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM s
), r AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::BIGINT AS rest,
         (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::BIGINT AS rest_weight
  FROM c WINDOW b AS (ORDER BY cap / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), lv AS (
  SELECT rest, rest_weight FROM r WHERE rest * weight <= cap * rest_weight ORDER BY cap / weight, sid LIMIT 1
), t AS (
  SELECT sid, source, source_size, least(cap::DOUBLE, coalesce(lv.rest * weight / lv.rest_weight, cap::DOUBLE)) AS target
  FROM c LEFT JOIN lv ON true
), o AS (
  SELECT d.rid, t.sid, d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS goal,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY h, d.doc_id, d.size, rid
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size)::BIGINT AS off
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), need AS (
  SELECT *, (upto - n_slots)::DOUBLE / total AS lo, upto::DOUBLE / total AS hi FROM (
    SELECT *, (sum(n_slots) OVER (ORDER BY sid))::BIGINT AS upto, (sum(n_slots) OVER ())::BIGINT AS total
    FROM (SELECT sid, (floor(target)::BIGINT + 511) // 512 AS n_slots FROM t) WHERE n_slots > 0)
), points AS (
  SELECT slot, (slot % 2147483648 * 1327217885 % 2147483648) / 2147483648::DOUBLE AS u
  FROM (SELECT unnest(range((SELECT coalesce(max(total), 0)::BIGINT FROM need))) AS slot)
), hit AS (
  SELECT sid, n_slots, slot, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS block FROM points JOIN need ON u >= lo AND u < hi
), slots AS (
  SELECT sid, slot, block FROM hit WHERE block < n_slots
  UNION ALL
  SELECT sid, total + upto - n_slots + block, block
  FROM (SELECT need.*, unnest(range((SELECT count(*) FROM hit WHERE hit.sid = need.sid), n_slots)) AS block FROM need)
), passes AS (
  SELECT rid, sid, size, goal, off + source_size * unnest(range((goal - 1 - off) // source_size + 1)) AS start
  FROM o WHERE size > 0 AND off < goal
), blocks AS (
  SELECT rid, sid, unnest(range(start // 512, (least(start + size, goal) - 1) // 512 + 1)) AS block FROM passes
), firsts AS (
  SELECT rid, min(slot) AS first_slot FROM blocks JOIN slots USING (sid, block) GROUP BY rid
)
SELECT doc_id, size, source_size, target, first_slot,
       CASE WHEN source_size = 0 THEN 0 ELSE
         (goal // source_size) * size + greatest(0, least(off + size, goal % source_size) - off) END::BIGINT AS taken
FROM o LEFT JOIN firsts USING (rid)
"""

# Link counts are over rows; the components are the fixpoint of the smallest reachable id.
ORACLE["op1_ngram_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d
), c AS (
  SELECT list_sort(g) AS g, min(doc_id) AS rep, count(*) AS copies, len(any_value(g)) AS n FROM s GROUP BY list_sort(g)
), p AS (
  SELECT rep, n, unnest(g) AS x FROM c WHERE n > 0
), f AS (
  SELECT x FROM p GROUP BY x HAVING count(*) > 1
), q AS (
  SELECT p.* FROM p JOIN f USING (x)
), links AS (
  SELECT a.rep AS a, b.rep AS b FROM q a JOIN q b ON a.x = b.x AND a.rep <> b.rep
  WHERE 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach(a, b) AS (
  SELECT rep, rep FROM c WHERE n > 0
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), comp AS (
  SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a
), n_links AS (
  SELECT l.a AS rep, sum(c.copies) AS k FROM links l JOIN c ON c.rep = l.b GROUP BY l.a
)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles,
       CASE WHEN len(s.g) = 0 THEN s.doc_id ELSE comp.component_id END AS component_id,
       CASE WHEN len(s.g) = 0 THEN 0 ELSE coalesce(k, 0) + copies - 1 END::BIGINT AS n_links
FROM s JOIN c ON list_sort(s.g) = c.g LEFT JOIN comp ON comp.rep = c.rep LEFT JOIN n_links ON n_links.rep = c.rep
"""

ORACLE["op12_phrases"] = r"""
WITH w AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents)
), total AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY lang
), g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT lang, w, unnest([1, 2, 3, 4, 5]) AS k FROM w))
), f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM g GROUP BY ALL HAVING count(*) >= 100
), cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS p FROM f WHERE k >= 2
), cut AS (
  SELECT c.lang, c.phrase, c.k, a, cut, x.f AS l, y.f AS r, n, (1000 * a * n) // (x.f * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(p[1:cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(p[cut + 1:], ' ')
  JOIN total t ON t.lang = c.lang
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_phrases AS (
  SELECT lang, array_to_string(p[i:i + m - 1], ' ') AS phrase, max(a) AS outer_a FROM (
    SELECT lang, p, a, k, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM cand)) GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN inner_phrases i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE outer_a IS NULL OR 100 * outer_a < 100 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a,
       l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""

# The cheapest edits run forwards here: for each state the least (cost, letters) with the repaired lines, row by row.
ORACLE["op13_conversation_repair"] = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)),
           lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END)) AS t
), src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations
), hit AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(s, ''), lambda ch: ascii(ch)::BIGINT)),
           lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295::BIGINT) % 20 AS kind FROM src, tab
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare FROM damaged
), rows AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS ini, bare = '' AS blank, bare <> '' AND again AS duplicate,
         bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM numbered
), counts AS (
  SELECT conv_id, count(*) AS n_rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id
), dp AS (
  SELECT conv_id, 0::BIGINT AS i, {'c': 0, 'a': '', 't': ''} AS s0, {'c': 1000000, 'a': '', 't': ''} AS s1,
         {'c': 1000000, 'a': '', 't': ''} AS s2, {'c': 1000000, 'a': '', 't': ''} AS s3 FROM counts
  UNION ALL
  SELECT conv_id, i,
    {'c': y0.c + 4, 'a': y0.a || 'D', 't': y0.t},
    least({'c': y1.c + 4, 'a': y1.a || 'D', 't': y1.t},
          {'c': CASE WHEN bad OR ini <> 's' THEN 1000000 ELSE y0.c + e END, 'a': y0.a || 'K', 't': y0.t || line}),
    least({'c': y2.c + 4, 'a': y2.a || 'D', 't': y2.t},
          {'c': CASE WHEN bad OR ini <> 'u' THEN 1000000 ELSE yu.c + e END, 'a': yu.a || 'K', 't': yu.t || line},
          {'c': CASE WHEN bad THEN 1000000 ELSE yu.c + e + 3 END, 'a': yu.a || 'R', 't': yu.t || chr(10) || 'user:' || text}),
    least({'c': y3.c + 4, 'a': y3.a || 'D', 't': y3.t},
          {'c': CASE WHEN bad OR ini <> 'a' THEN 1000000 ELSE y2.c + e END, 'a': y2.a || 'K', 't': y2.t || line},
          {'c': CASE WHEN bad THEN 1000000 ELSE y2.c + e + 3 END, 'a': y2.a || 'R', 't': y2.t || chr(10) || 'assistant:' || text})
  FROM (
    SELECT *, least(y0, y1, y3) AS yu FROM (
      SELECT d.conv_id, r.i, s0 AS y0, s1 AS y1,
        least(s2, {'c': z.c + 3, 'a': z.a || 'I', 't': z.t || chr(10) || 'user:'}) AS y2,
        least(s3, {'c': s2.c + 3, 'a': s2.a || 'I', 't': s2.t || chr(10) || 'assistant:'},
              {'c': x.c + 6, 'a': x.a || 'II', 't': x.t || chr(10) || 'user:' || chr(10) || 'assistant:'}) AS y3,
        r.blank OR r.duplicate AS bad, CASE WHEN r.truncated THEN 3 ELSE 0 END AS e, r.ini, r.text,
        chr(10) || r.role || ':' || r.text AS line
      FROM (SELECT *, least(s0, s1, s3) AS z, least(s0, s1) AS x FROM dp) d
      JOIN rows r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.i = d.i + 1))
), best AS (
  SELECT c.*, least(s0, s3, {'c': s2.c + 3, 'a': s2.a || 'I', 't': s2.t || chr(10) || 'assistant:'},
                    {'c': s1.c + 6, 'a': s1.a || 'II', 't': s1.t || chr(10) || 'user:' || chr(10) || 'assistant:'}) AS b
  FROM dp JOIN counts c ON c.conv_id IS NOT DISTINCT FROM dp.conv_id AND c.n_rows = dp.i
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0)::BIGINT AS cost,
       coalesce(b.a, '') AS audit, sha256(coalesce(substr(b.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id
"""
