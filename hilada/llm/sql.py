"""SQL that gives the same rows as queries of this subpackage, where SQL can express them."""

from __future__ import annotations

WORDS = r"""words AS (SELECT doc_id, batch_no, unnest(list_filter(regexp_split_to_array(lower(nfc_normalize(text)), '[^\p{L}\p{N}_]+'), lambda x: regexp_full_match(x, '[a-záéíóúüñ]{2,}'))) AS word FROM documents)"""
BY_BATCH = WORDS + """, counts AS (SELECT batch_no, word, sum(n)::BIGINT AS a, count(*)::BIGINT AS d FROM (SELECT doc_id, batch_no, word, count(*) AS n FROM words GROUP BY ALL) GROUP BY ALL)"""
TOKENS = r"""pieces AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[^\p{L}\p{N}_]+'), lambda x: x <> '') AS ps FROM (SELECT doc_id, lower(nfc_normalize(text)) AS t FROM documents)),
vocabulary AS (SELECT list(DISTINCT word) AS v FROM token_vocabulary WHERE regexp_full_match(word, '[a-záéíóúüñ]{2,}')),
tokens AS (SELECT doc_id, (length(regexp_replace(t, '[ \t\n\r\x{00a0}]', '', 'g')) - coalesce((SELECT sum(length(p) - 1) FROM (SELECT unnest(ps) AS p) WHERE p IN (SELECT unnest(v) FROM vocabulary)), 0))::BIGINT AS n_tokens FROM pieces)"""

FOUND_2 = (
    "WITH "
    + BY_BATCH
    + """, every AS (SELECT word, sum(d) AS df FROM counts GROUP BY word), stated AS (SELECT batch_no, w AS word, arg_max(s, s) AS s FROM (SELECT batch_no, lower(nfc_normalize(trim(word, ' ' || chr(9) || chr(10) || chr(13) || chr(160)))) AS w,
 {'e': exported_at, 'a': coalesce(absolute_frequency, -1), 'd': coalesce(document_frequency, -1)} AS s FROM lexical_frequency WHERE batch_no IS NOT NULL AND word IS NOT NULL) GROUP BY ALL)
SELECT 0::BIGINT AS batch_no, word, CASE WHEN df < 3 THEN 'rare' ELSE 'common' END AS mark FROM every WHERE df < 3 OR df > 0.2 * (SELECT count(*) FROM documents)
UNION ALL SELECT s.batch_no, s.word, 'miscounted' FROM stated s LEFT JOIN counts c USING (batch_no, word) WHERE (s.s.a >= 0 AND s.s.a <> coalesce(c.a, 0)) OR (s.s.d >= 0 AND s.s.d <> coalesce(c.d, 0))"""
)
TOTALS_4 = (
    "WITH "
    + TOKENS
    + """, st AS (SELECT document_id, arg_max(thematic_domain, {'u': updated_at, 't': coalesce(thematic_domain, '')}) AS thematic_domain, max({'u': updated_at, 't': coalesce(thematic_domain, '')}).t AS t FROM document GROUP BY document_id)
SELECT source AS source_code, lang AS language, nullif(lower(trim(st.t)), '') AS thematic_domain, count(*)::BIGINT AS n_documents, sum(n_tokens)::BIGINT AS n_tokens FROM tokens JOIN documents USING (doc_id) LEFT JOIN st USING (document_id) GROUP BY ALL"""
)
FOUND_8 = (
    "WITH "
    + TOKENS
    + """, s AS (SELECT source AS source_code, sum(n_tokens) AS n FROM tokens JOIN documents USING (doc_id) GROUP BY source), m AS (SELECT mix_id, source_code, target_share, max_repeats, coalesce(n, 0)::BIGINT AS n FROM mix_target LEFT JOIN s USING (source_code)),
 t AS (SELECT *, sum(n) OVER (PARTITION BY mix_id) AS whole FROM m) SELECT mix_id, source_code FROM t WHERE max_repeats * n < target_share * whole"""
)
CHECKS_8 = FOUND_8.partition(" SELECT mix_id, source_code FROM t")[0] + " SELECT mix_id, source_code, n AS tokens, max_repeats * n >= target_share * whole AS reachable, true AS within_repeats, true AS filled, true AS has_target FROM t"
BARE = r"list_filter(regexp_split_to_array(strip_accents(lower(regexp_replace(replace(replace(nfc_normalize({}), '_', ' '), chr(13), chr(10)), '([\p{{L}}\p{{N}}])-[^\S\n]*\n\s*([\p{{L}}\p{{N}}])', '\1\2', 'g'))), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
FOUND_7 = f"""WITH i AS (SELECT DISTINCT item_id, {BARE.format("passage")} AS ws FROM evaluation_item), d AS (SELECT doc_id, {BARE.format("text")} AS ws FROM documents),
 ig AS (SELECT item_id, len(ws) AS n, unnest(range(1, len(ws) - 5)) AS k, ws FROM i WHERE len(ws) >= 7), ik AS (SELECT item_id, n, k, array_to_string(ws[k:k + 6], ' ') AS g FROM ig),
 dg AS (SELECT doc_id, unnest(list_transform(range(1, len(ws) - 5), lambda k: array_to_string(ws[k:k + 6], ' '))) AS g FROM d WHERE len(ws) >= 7),
 hit AS (SELECT DISTINCT item_id, doc_id, n, k FROM ik JOIN dg USING (g)), cover AS (SELECT DISTINCT item_id, doc_id, n, k + j AS at FROM hit CROSS JOIN (SELECT unnest(range(0, 7)) AS j))
 SELECT item_id, doc_id FROM cover GROUP BY item_id, doc_id, n HAVING count(*) >= 0.5 * n"""

PHRASES_2 = r"""WITH ws AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(nfc_normalize(text)), '[^\p{L}\p{N}_]+'), lambda x: regexp_full_match(x, '[a-záéíóúüñ]{2,}')) AS w FROM documents),
 g AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS term FROM ws, (SELECT unnest([1, 2, 3]) AS k))
SELECT term, sum(n)::BIGINT AS absolute_frequency, count(*)::BIGINT AS document_frequency FROM (SELECT doc_id, term, count(*) AS n FROM g GROUP BY ALL) GROUP BY term HAVING count(*) >= 3"""

# What is left of each text: all that lies outside the words of the windows, found again by the lengths of words and gaps.
CLEANED_7 = f"""WITH i AS (SELECT DISTINCT item_id, {BARE.format("passage")} AS ws FROM evaluation_item), d AS (SELECT doc_id, {BARE.format("text")} AS ws, text FROM documents),
 ig AS (SELECT item_id, len(ws) AS n, unnest(range(1, len(ws) - 5)) AS k, ws FROM i WHERE len(ws) >= 7), ik AS (SELECT item_id, n, k, array_to_string(ws[k:k + 6], ' ') AS g FROM ig),
 dg AS (SELECT doc_id, unnest(range(1, len(ws) - 5)) AS pos, unnest(list_transform(range(1, len(ws) - 5), lambda k: array_to_string(ws[k:k + 6], ' '))) AS g FROM d WHERE len(ws) >= 7),
 hit AS (SELECT item_id, doc_id, n, k, pos FROM ik JOIN dg USING (g)), cover AS (SELECT DISTINCT item_id, doc_id, n, k + j AS p FROM hit CROSS JOIN (SELECT unnest(range(0, 7)) AS j)),
 leak AS (SELECT item_id, doc_id FROM cover GROUP BY item_id, doc_id, n HAVING count(*) >= 0.5 * n), gone AS (SELECT DISTINCT doc_id, pos + j AS w FROM hit JOIN leak USING (item_id, doc_id) CROSS JOIN (SELECT unnest(range(0, 7)) AS j)),
 pieces AS (SELECT doc_id, regexp_extract_all(replace(replace(text, '_', ' '), chr(13), chr(10)), '[\\p{{L}}\\p{{N}}\\x{{0300}}-\\x{{036f}}]+(?:-[^\\S\\n]*\\n\\s*[\\p{{L}}\\p{{N}}\\x{{0300}}-\\x{{036f}}]+)*|[^\\p{{L}}\\p{{N}}\\x{{0300}}-\\x{{036f}}]') AS ps FROM documents WHERE doc_id IN (SELECT doc_id FROM gone)),
 each AS (SELECT doc_id, unnest(ps) AS p, unnest(range(1, len(ps) + 1)) AS i FROM pieces), numbered AS (SELECT *, count(*) FILTER (regexp_matches(p, '^[\\p{{L}}\\p{{N}}\\x{{0300}}-\\x{{036f}}]')) OVER (PARTITION BY doc_id ORDER BY i) AS w, regexp_matches(p, '^[\\p{{L}}\\p{{N}}\\x{{0300}}-\\x{{036f}}]') AS word FROM each),
 cut AS (SELECT n.doc_id, sum(length(p)) AS lost FROM numbered n WHERE EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = n.doc_id AND g.w = n.w) AND (word OR EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = n.doc_id AND g.w = n.w + 1)) GROUP BY n.doc_id)
SELECT doc_id, (length(text) - coalesce(lost, 0))::BIGINT AS n_chars FROM documents LEFT JOIN cut USING (doc_id)"""

LINES = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{0085}\x{2028}\x{2029}]"
BLANKS = r"\x09-\x0d\x1c-\x20\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
STRIPPED = f"regexp_replace(l, '^[{BLANKS}]+|[{BLANKS}]+$', '', 'g')"
STATISTICS_5 = rf"""WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
 wl AS (SELECT doc_id, lang, text, regexp_extract_all(text, '\p{{L}}+') AS ws FROM t), one AS (SELECT doc_id, lang, unnest(list_distinct(list_transform(ws, lambda w: lower(w)))) AS word FROM wl WHERE lang <> ''),
 sizes AS (SELECT lang, count(*) AS texts FROM t WHERE lang <> '' AND text <> '' GROUP BY lang HAVING count(*) >= 2), common AS (SELECT lang, word FROM (SELECT lang, word, count(*) AS n FROM one GROUP BY ALL) JOIN sizes USING (lang) WHERE n >= 2 AND n >= 0.25 * texts),
 hits AS (SELECT doc_id, l, count(*) AS n FROM (SELECT doc_id, unnest(list_transform(ws, lambda w: lower(w))) AS word FROM wl) JOIN (SELECT lang AS l, word FROM common) USING (word) GROUP BY ALL), best AS (SELECT doc_id, max(n) AS n FROM hits GROUP BY doc_id),
 l0 AS (SELECT doc_id, list_transform(regexp_split_to_array(text, '{LINES}'), lambda l: {STRIPPED}) AS ls FROM t), l1 AS (SELECT doc_id, CASE WHEN ls[-1] = '' THEN ls[:-2] ELSE ls END AS ls FROM l0), l2 AS (SELECT *, list_filter(ls, lambda l: l <> '') AS fl FROM l1),
 rep AS (SELECT doc_id, sum(n) AS r FROM (SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(fl) AS line FROM l2) WHERE length(line) >= 5 GROUP BY ALL HAVING count(*) >= 3) GROUP BY doc_id),
 m AS (SELECT doc_id, length(text)::BIGINT AS character_count, len(ws)::BIGINT AS word_count, len(ls)::BIGINT AS line_count, len(fl)::BIGINT AS non_empty_line_count, len(regexp_extract_all(text, '\x{{fffd}}'))::BIGINT AS replacement_character_count,
 (length(text) - length(replace(text, chr(0), '')))::BIGINT AS null_character_count, len(regexp_extract_all(text, '[\x01-\x08\x0b\x0c\x0e-\x1f\x7f]'))::BIGINT AS control_character_count,
 len(regexp_extract_all(text, '(?i)\[\[P[ÁA]GINA[{BLANKS}]+\p{{Nd}}+\]\]'))::BIGINT AS page_marker_count, len(regexp_extract_all(text, '\p{{L}}-\r?\n'))::BIGINT AS hyphenated_line_break_count,
 len(list_filter(fl, lambda l: length(l) > 400))::BIGINT AS long_line_count, coalesce(len(regexp_extract_all(text, '[^\p{{L}}\p{{N}}_{BLANKS}.,;:¿?¡!()«»“”"''’—–…·\x{{0300}}-\x{{036f}}\-]'))::DOUBLE / nullif(length(text), 0), 0) AS symbol_ratio,
 coalesce(len(list_filter(fl, lambda l: regexp_full_match(l, '[{BLANKS}\p{{Nd}}\x{{00b2}}\x{{00b3}}\x{{00b9}}.,:;()–—\-]+') AND regexp_matches(l, '[\p{{Nd}}\x{{00b2}}\x{{00b3}}\x{{00b9}}]')))::DOUBLE / nullif(len(fl), 0), 0) AS numeric_line_ratio,
 coalesce(coalesce(r, 0)::DOUBLE / nullif(len(fl), 0), 0) AS repeated_line_ratio,
 coalesce(len(list_filter(fl, lambda l: len(regexp_extract_all(l, '\p{{L}}')) >= 5 AND len(regexp_extract_all(l, '\p{{Lu}}')) >= 0.9 * len(regexp_extract_all(l, '\p{{L}}'))))::DOUBLE / nullif(len(fl), 0), 0) AS uppercase_line_ratio,
 coalesce(len(list_filter(fl, lambda l: length(l) <= 25))::DOUBLE / nullif(len(fl), 0), 0) AS short_line_ratio, coalesce(list_sum(list_transform(ws, lambda w: length(w)))::DOUBLE / nullif(len(ws), 0), 0) AS mean_word_length,
 coalesce(len(regexp_extract_all(text, '[0-9]'))::DOUBLE / nullif(length(text), 0), 0) AS digit_ratio, coalesce(len(list_filter(fl, lambda l: regexp_matches(l, '[.!?…:;»”"]$')))::DOUBLE / nullif(len(fl), 0), 0) AS punctuated_line_ratio,
 coalesce(len(list_filter(fl, lambda l: regexp_matches(l, '^(?:[-*•·–]|[0-9]{{1,3}}[.)]|[a-z][.)])[ \t\x{{00a0}}]')))::DOUBLE / nullif(len(fl), 0), 0) AS bullet_line_ratio, coalesce(len(list_filter(fl, lambda l: regexp_matches(l, '(?:…|\.\.\.)$')))::DOUBLE / nullif(len(fl), 0), 0) AS ellipsis_line_ratio,
 coalesce((SELECT count(*) FILTER (regexp_matches(p, '\p{{L}}'))::DOUBLE / nullif(count(*), 0) FROM (SELECT unnest(regexp_split_to_array(text, '[{BLANKS}]+')) AS p) WHERE p <> ''), 0) AS alphabetic_word_ratio,
 CASE WHEN lang <> '' AND lang NOT IN (SELECT lang FROM common) THEN NULL ELSE coalesce(coalesce(best.n, 0)::DOUBLE / nullif(len(ws), 0), 0) END AS common_word_ratio,
 coalesce(100.0::DOUBLE * len(regexp_extract_all(text || ' ', '[.!?…][{BLANKS}"”»]')) / nullif(len(ws), 0), 0) AS sentences_per_100_words FROM wl JOIN l2 USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN best USING (doc_id))
SELECT *, CASE WHEN non_empty_line_count = 0 THEN '' ELSE array_to_string(list_filter([CASE WHEN mean_word_length < 3 OR mean_word_length > 10 THEN 'mean word length' END, CASE WHEN symbol_ratio > 0.1::DOUBLE THEN 'symbols' END, CASE WHEN alphabetic_word_ratio < 0.8::DOUBLE THEN 'words without letters' END,
 CASE WHEN bullet_line_ratio > 0.9::DOUBLE THEN 'bullets' END, CASE WHEN ellipsis_line_ratio > 0.3::DOUBLE THEN 'ellipses' END, CASE WHEN digit_ratio > 0.2::DOUBLE THEN 'digits' END, CASE WHEN repeated_line_ratio > 0.5::DOUBLE AND non_empty_line_count >= 3 THEN 'repeated lines' END,
 CASE WHEN numeric_line_ratio > 0.3::DOUBLE THEN 'numeric lines' END, CASE WHEN common_word_ratio < 0.12::DOUBLE THEN 'common words' END, CASE WHEN sentences_per_100_words < 2.5::DOUBLE THEN 'too few sentences' END, CASE WHEN sentences_per_100_words > 16 THEN 'too many sentence ends' END], lambda x: x IS NOT NULL), '; ') END AS failures FROM m"""

SQL = {
    "p5_statistics": STATISTICS_5,
    "p7_cleaned": CLEANED_7,
    "p2_phrases": PHRASES_2,
    "p2_found": FOUND_2,
    "p2_frequencies": "WITH " + BY_BATCH + " SELECT word, sum(a)::BIGINT AS absolute_frequency, sum(d)::BIGINT AS document_frequency FROM counts GROUP BY word",
    "p4_found": "WITH " + TOKENS + " SELECT doc_id, n_tokens FROM tokens",
    "p4_totals": TOTALS_4,
    "p7_found": FOUND_7,
    "p8_found": FOUND_8,
    "p8_checks": CHECKS_8,
}
