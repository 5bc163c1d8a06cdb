"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from segloom.llm.decontaminate import UNITS

LINE_DEDUP = r"""
WITH lines AS (
    SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), repeated AS (
    SELECT key, max(doc_id) AS keeper FROM keyed
    WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
    SELECT k.*, r.keeper IS NOT NULL AND k.doc_id < r.keeper AS gone
    FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id,
    count(*) AS n_lines,
    count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

DECONTAMINATION = r"""
WITH src AS (
    SELECT 'd' AS side, doc_id AS id, coalesce(text, '') AS text FROM documents
    UNION ALL SELECT 'b', item_id, coalesce(text, '') FROM benchmark
), parts AS (
    SELECT side, id, string_split(
        regexp_replace(regexp_replace(regexp_replace(text,
            '[^\p{L}\p{M}\p{N}.!?: \t\n\x0B\f\r]+', '', 'g'),
            '[ \t\x0B\f\r]*\n[ \t\n\x0B\f\r]*', '. ', 'g'),
            '[ \t\x0B\f\r]+', ' ', 'g'), ' ') AS words
    FROM src
), raw AS (
    SELECT side, id, generate_subscripts(words, 1) AS i, unnest(words) AS x FROM parts
), led AS (
    SELECT *, coalesce(lag(x) OVER (PARTITION BY side, id ORDER BY i), '') AS before FROM raw
), typed AS (
    SELECT side, id, i, lower(rtrim(x, '.!?:')) AS value,
        CASE WHEN x >= '0' AND x < ':' THEN '<num>'
            WHEN before >= '0' AND before < ':' AND lower(rtrim(x, '.!?:')) IN (UNITS) THEN '<unit>'
            WHEN right(before, 1) NOT IN ('', '.', '!', '?', ':') AND lower(substr(x, 1, 1)) <> substr(x, 1, 1)
                AND upper(substr(x, 2, 1)) <> substr(x, 2, 1) THEN '<name>' END AS kind
    FROM led
), tokens AS (
    SELECT side, id, row_number() OVER (PARTITION BY side, id ORDER BY i) - 1 AS pos,
        count(*) OVER (PARTITION BY side, id) AS n, kind, value, coalesce(kind, value) AS canon
    FROM typed WHERE value <> ''
), runs AS (
    SELECT side, id, pos, n,
        list(canon) OVER w AS canons, list(coalesce(kind, '')) OVER w AS kinds, list(value) OVER w AS vals
    FROM tokens
    WINDOW w AS (PARTITION BY side, id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)
), items AS (
    SELECT id AS item_id, pos AS item_pos, least(n, 8) AS width, canons[:least(n, 8)] AS run, kinds, vals
    FROM runs WHERE side = 'b' AND pos <= n - least(n, 8)
), widths AS (
    SELECT DISTINCT width FROM items
), texts AS (
    SELECT id AS doc_id, pos, width, canons[:width] AS run, vals
    FROM runs, widths WHERE side = 'd' AND pos <= n - width AND (width >= 4 OR n = width)
), met AS (
    SELECT DISTINCT doc_id, item_id, item_pos, pos - item_pos AS shift, i.kinds[: i.width] AS kinds,
        i.vals[: i.width] AS olds, t.vals[: i.width] AS news, i.width
    FROM texts t JOIN items i ON t.width = i.width AND t.run = i.run
    WHERE i.width >= 4 OR i.vals[: i.width] = t.vals[: i.width]
), slots AS (
    SELECT doc_id, item_id, shift, item_pos, kinds[k] AS kind, olds[k] AS old, news[k] AS new
    FROM (SELECT *, unnest(range(1, width + 1)) AS k FROM met) WHERE kinds[k] <> ''
), twisted AS (
    SELECT doc_id, item_id, shift, kind, old FROM slots GROUP BY ALL HAVING count(DISTINCT new) > 1
), bad AS (
    SELECT DISTINCT s.doc_id, s.item_id, s.shift, s.item_pos FROM slots s JOIN twisted t
    ON s.doc_id = t.doc_id AND s.item_id = t.item_id AND s.shift = t.shift AND s.kind = t.kind AND s.old = t.old
), good AS (
    SELECT DISTINCT doc_id, item_id, shift, item_pos FROM met EXCEPT SELECT * FROM bad
), counted AS (
    SELECT doc_id, item_id, count(DISTINCT item_pos) AS n_windows FROM good GROUP BY ALL
), changed AS (
    SELECT doc_id, item_id, count(*) AS n_slots, count(*) FILTER (WHERE old <> new) AS n_changed
    FROM (SELECT DISTINCT s.doc_id, s.item_id, kind, old, new FROM slots s JOIN good g
        ON s.doc_id = g.doc_id AND s.item_id = g.item_id AND s.shift = g.shift AND s.item_pos = g.item_pos)
    GROUP BY ALL
), islands AS (
    SELECT doc_id, item_id, shift, item_pos - row_number() OVER (PARTITION BY doc_id, item_id, shift ORDER BY item_pos) AS island
    FROM (SELECT DISTINCT doc_id, item_id, shift, item_pos FROM met WHERE olds = news)
), longest AS (
    SELECT doc_id, item_id, max(n) AS same
    FROM (SELECT doc_id, item_id, shift, island, count(*) AS n FROM islands GROUP BY ALL) GROUP BY ALL
), totals AS (
    SELECT item_id, count(*) AS item_windows FROM items GROUP BY ALL
)
SELECT m.doc_id, m.item_id, coalesce(n_windows, 0) AS n_windows, item_windows, coalesce(n_windows, 0) / item_windows AS coverage,
    coalesce(n_slots, 0) AS n_slots, coalesce(n_changed, 0) AS n_changed
FROM (SELECT DISTINCT doc_id, item_id FROM met) m
JOIN totals t ON m.item_id = t.item_id
LEFT JOIN counted c ON m.doc_id = c.doc_id AND m.item_id = c.item_id
LEFT JOIN changed h ON m.doc_id = h.doc_id AND m.item_id = h.item_id
LEFT JOIN longest l ON m.doc_id = l.doc_id AND m.item_id = l.item_id
WHERE coalesce(n_windows, 0) / item_windows >= 0.5 OR same >= 6
""".replace("UNITS", ", ".join(f"'{u}'" for u in UNITS))

PHRASES = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\n\x0B\f\r]')), '[ \t]+'), lambda w: w <> '') AS words
    FROM documents
), totals AS (
    SELECT lang, sum(len(words)) AS n FROM pieces GROUP BY lang
), places AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces
), grams AS (
    SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase
    FROM places, range(1, 6) AS sizes(k) WHERE i + k - 1 <= len(words)
), counts AS (
    SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r, n, j,
        (1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS score
    FROM (SELECT *, string_split(phrase, ' ') AS words, unnest(range(1, k)) AS j FROM counts WHERE k > 1) c
    JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(words[:j], ' ')
    JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(words[j + 1 :], ' ')
    JOIN totals t ON t.lang = c.lang
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), kept AS (
    SELECT * FROM best b WHERE NOT EXISTS (
        SELECT 1 FROM counts c WHERE c.lang = b.lang AND c.phrase <> b.phrase AND 100 * c.f >= 100 * b.a
            AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' '))
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""

PASSAGES = r"""
WITH parts AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS words
    FROM documents
), places AS (
    SELECT doc_id, generate_subscripts(words, 1) AS i, unnest(words) AS word, len(words) AS n FROM parts
), windows AS (
    SELECT doc_id, i, array_to_string(words[i : i + 49], ' ') AS body
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM parts WHERE len(words) >= 50)
), repeated AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY body) AS low FROM windows) WHERE low < doc_id
), judged AS (
    SELECT p.doc_id, p.i, p.word, max(r.i) OVER (PARTITION BY p.doc_id ORDER BY p.i) AS latest
    FROM places p LEFT JOIN repeated r ON r.doc_id = p.doc_id AND r.i = p.i
), summed AS (
    SELECT doc_id, count(*) FILTER (WHERE i < latest + 50) AS n_removed,
        string_agg(word, ' ' ORDER BY i) FILTER (WHERE latest IS NULL OR i >= latest + 50) AS kept
    FROM judged GROUP BY doc_id
)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM parts d LEFT JOIN summed s ON s.doc_id = d.doc_id
"""

ORACLE: dict[str, str] = {
    "op3_decontamination": DECONTAMINATION,
    "op4_line_dedup": LINE_DEDUP,
    "op12_phrases": PHRASES,
    "op13_passages": PASSAGES,
}
