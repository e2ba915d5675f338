"""SQL of the queries that SQL can express, over the same tables."""

from __future__ import annotations

from vinilo.llm.rules import (
    BYTES_PER_CHARACTER,
    LANGUAGES,
    LOWER,
    RULES,
    STOP_WORDS,
    SYMBOLS,
    UPPER,
)

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
ORACLE: dict[str, str] = {}

ORACLE["op1_nearest_codes"] = """
WITH codes AS (
    SELECT DISTINCT vec_id AS id, list_transform(embedding, lambda x: x > 0) AS code
    FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) = 64
), ranked AS (
    SELECT q.id AS query_id, c.id AS vec_id,
        len(list_filter(range(1, 65), lambda i: q.code[i] <> c.code[i])) AS distance
    FROM codes q JOIN codes c ON q.id <> c.id
    WHERE q.id % 100 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS "rank",
    vec_id, distance
FROM ranked QUALIFY "rank" <= 10
"""

_MEASURES = {
    "n_words": "n_words",
    "mean_word_chars": "coalesce(word_chars / nullif(n_words, 0), 0)",
    "symbol_ratio": "coalesce(n_symbols / nullif(n_words, 0), 0)",
    "stop_word_ratio": "coalesce(n_stop_words / nullif(n_words, 0), 0)",
    "repeat_ratio": "coalesce(n_repeat_words / nullif(n_words, 0), 0)",
    "dup_line_ratio": "coalesce(n_dup_lines / nullif(n_lines, 0), 0)",
}
_KEPT = " AND ".join(
    f"({_MEASURES[r.measure]} {sign} {bound}{' OR NOT covered' if r.covered_only else ''})"
    for r in RULES
    for sign, bound in ((">=", r.low), ("<=", r.high))
    if bound is not None
)
_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
_LANGUAGES = ", ".join(f"'{x}'" for x in LANGUAGES)
ORACLE["op2_quality_rules"] = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS w,
        coalesce(
            nullif(regexp_extract(lower(trim(lang)), '^[^-_]*'), '') IN ({_LANGUAGES}),
            text IS NULL OR text = '' OR strlen(text) < {BYTES_PER_CHARACTER} * length(text)
        ) AS covered
    FROM documents
), windows AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS times
    FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM texts)
), repeated AS (
    SELECT r, count(DISTINCT p) AS n
    FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE times > 1) GROUP BY r
), lines AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), measured AS (
    SELECT doc_id, covered, len(w) AS n_words,
        CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        length(text) - length(translate(text, '{SYMBOLS}', '')) AS n_symbols,
        coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n, 0) AS n_repeat_words,
        len(list_filter(w, lambda x: translate(x, '{UPPER}', '{LOWER}') IN ({_STOPS}))) AS n_stop_words
    FROM texts LEFT JOIN repeated USING (r) LEFT JOIN lines USING (r)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND {_KEPT} AS kept, n_stop_words
FROM judged
"""

ORACLE["op6_source_mix"] = rf"""
WITH sized AS (
    SELECT doc_id, source, len({WORDS}) AS size FROM documents
), numbered AS (
    SELECT source, sum(size) AS total, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n
    FROM sized GROUP BY source
), weighed AS (
    SELECT source, total, n, [5, 2, 1][n % 3 + 1] AS weight, 2 * total AS cap FROM numbered
), leveled AS (
    SELECT *, (1.5::DOUBLE * sum(total) OVER () - coalesce(sum(cap) OVER ahead, 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER ahead, 0)) AS level
    FROM weighed
    WINDOW ahead AS (ORDER BY cap / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), goals AS (
    SELECT source, total, n, least(cap::DOUBLE, coalesce(
        (SELECT level FROM leveled WHERE cap > level * weight ORDER BY cap / weight, n LIMIT 1)
        * weight, cap::DOUBLE)) AS target
    FROM leveled
), lines AS (
    SELECT doc_id, sized.source, size, total, target,
        floor(target)::BIGINT AS words,
        sum(size) OVER (PARTITION BY sized.source
            ORDER BY md5('mix:' || coalesce(doc_id::VARCHAR, '')), doc_id, size
            ROWS UNBOUNDED PRECEDING) - size AS place
    FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source
)
SELECT doc_id, size, total::BIGINT AS source_size, target,
    (greatest(least(place + size, words) - place, 0)
     + greatest(least(total + place + size, words) - total - place, 0))::BIGINT AS taken,
    source
FROM lines
"""

ORACLE["op7_minmax_neardup"] = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3
        THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM texts
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS MATERIALIZED (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, m.n, n.n
    HAVING 100 * count(*) >= 85 * (m.n + n.n - count(*))
), reached AS (
    SELECT doc_id, doc_id AS other FROM texts
    UNION
    SELECT reached.doc_id, y FROM reached JOIN links ON x = other
), lowest AS (
    SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM texts JOIN lowest USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

ORACLE["op10_repeated_windows"] = rf"""
WITH texts AS (
    SELECT doc_id, {WORDS} AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM texts)
), later AS (
    SELECT doc_id, i FROM windows
    QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1
), gone AS (
    SELECT doc_id, list(DISTINCT p) AS places
    FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM later) GROUP BY doc_id
), kept AS (
    SELECT doc_id, w, CASE WHEN places IS NULL THEN w ELSE
        list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(places, i)),
            lambda i: w[i]) END AS k
    FROM texts LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, len(w) AS n_words, len(w) - len(k) AS n_removed,
    sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256
FROM kept
"""

ORACLE["op12_infill"] = r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex,
        regexp_extract_all(
            coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+'
        ) AS units
    FROM documents
), drawn AS (
    SELECT *, len(units) AS n,
        list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(hex, i, 8) AS BIGINT)) AS h
    FROM texts
), cut AS (
    SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
        CASE
            WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR h[3] % 100 >= 50 THEN 'plain'
            WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm'
        END AS form
    FROM drawn
), parts AS (
    SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
        array_to_string(units[b + 1:], '') AS suffix
    FROM cut
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form
        WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""
