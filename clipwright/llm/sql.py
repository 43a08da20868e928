"""DuckDB twins of the queries that SQL can express on whole tables."""

from __future__ import annotations

_P1 = """
WITH RECURSIVE rows AS (
    SELECT CASE WHEN s IN ('', 'unknown') THEN NULL ELSE s END AS s, CASE WHEN speaker_idx = -1 THEN NULL ELSE speaker_idx END AS i
    FROM (SELECT lower(regexp_replace(source_speaker_id, '^\\s+|\\s+$', '', 'g')) AS s, speaker_idx FROM clips_split)
), pairs AS (SELECT DISTINCT s, i FROM rows WHERE s IS NOT NULL AND i IS NOT NULL),
steps AS (SELECT DISTINCT a.s AS x, b.s AS y FROM pairs a JOIN pairs b ON a.i = b.i),
reach(x, y) AS (SELECT x, y FROM steps UNION SELECT r.x, s.y FROM reach r JOIN steps s ON r.y = s.x)
SELECT x AS speaker_a, y AS speaker_b FROM reach WHERE x < y
"""

# a component's name is the smallest of its nodes; "index:" comes before "speaker:"
_P1_SPLITS = """
WITH RECURSIVE rows AS (
    SELECT row_id, CASE WHEN s IN ('', 'unknown') THEN NULL ELSE s END AS s, CASE WHEN speaker_idx = -1 THEN NULL ELSE speaker_idx END AS i
    FROM (SELECT row_id, lower(regexp_replace(source_speaker_id, '^\\s+|\\s+$', '', 'g')) AS s, speaker_idx FROM clips_split)
), pairs AS (SELECT DISTINCT s, i FROM rows WHERE s IS NOT NULL AND i IS NOT NULL),
steps AS (SELECT DISTINCT a.s AS x, b.s AS y FROM pairs a JOIN pairs b ON a.i = b.i),
reach(x, y) AS (SELECT x, y FROM steps UNION SELECT r.x, s.y FROM reach r JOIN steps s ON r.y = s.x),
roots AS (SELECT x, min('index:' || i) AS root FROM reach JOIN pairs ON s = y GROUP BY 1),
named AS (
    SELECT row_id, coalesce(a.root, CASE WHEN r.s IS NOT NULL THEN 'speaker:' || r.s END, b.root, 'index:' || r.i, 'record:' || row_id) AS component
    FROM rows r LEFT JOIN roots a ON r.s = a.x LEFT JOIN (SELECT i, min(root) AS root FROM pairs JOIN roots ON s = x GROUP BY 1) b ON r.i = b.i
), placed AS (SELECT *, ('0x' || substr(md5('42|' || component), 1, 8))::UBIGINT::DOUBLE / 4294967296 AS p FROM named)
SELECT row_id, component, CASE WHEN p < 0.8 THEN 'train' WHEN p < 0.9 THEN 'validation' ELSE 'test' END AS related_split FROM placed
"""

_CAPPED = """
WITH latest AS (SELECT * FROM clips_split QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY loaded_at DESC NULLS LAST, row_id DESC) = 1),
cap AS (SELECT floor(count(*) * 0.02 + 1e-9) AS c FROM latest),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY speaker_idx ORDER BY (quality_score IS NULL OR quality_score::VARCHAR = 'nan'), quality_score DESC, source_id) AS p
    FROM latest WHERE speaker_idx IS NOT NULL AND speaker_idx <> -1
)
"""

# shares by size never give a language more slots than it has clips, so one round of largest remainders deals all
_P2_STRATA = (
    _CAPPED
    + """, named AS (
    SELECT source_id, CASE WHEN speaker_idx <> -1 THEN speaker_idx END AS who, quality_score, speaker_idx, split_part(split_part(lower(trim(coalesce(language, ''))), '-', 1), '_', 1) AS l FROM latest
), rows AS (
    SELECT *, CASE WHEN l IN ('sn', 'sna') THEN 'sn' WHEN l IN ('nd', 'nde') THEN 'nd' WHEN l IN ('en', 'eng') THEN 'en' ELSE 'other' END AS stratum FROM named
), sizes AS (SELECT who, stratum, count(*) AS n, sum(count(*)) OVER (PARTITION BY who) AS every FROM rows WHERE who IS NOT NULL GROUP BY 1, 2),
shares AS (SELECT *, c * n / every - floor(c * n / every) AS part, floor(c * n / every) AS whole FROM sizes, cap WHERE every > c),
dealt AS (SELECT who, stratum, whole + (row_number() OVER (PARTITION BY who ORDER BY part DESC, stratum) <= c - sum(whole) OVER (PARTITION BY who))::INT AS quota FROM shares),
ranks AS (
    SELECT *, row_number() OVER (PARTITION BY who, stratum ORDER BY (quality_score IS NULL OR quality_score::VARCHAR = 'nan'), quality_score DESC, source_id) AS p FROM rows
)
SELECT source_id, speaker_idx, CASE WHEN quality_score::VARCHAR <> 'nan' THEN quality_score END AS quality_score
FROM ranks LEFT JOIN dealt USING (who, stratum) WHERE quota IS NULL OR p <= quota
"""
)

# words of a pair of texts become characters, so that the edit distance of strings is that of words; for pairs of at most 94 different words
_NEAR = """
WITH w AS (
    SELECT row_id, source_id, source_speaker_id, split, CASE WHEN split = 'train' THEN 0 ELSE 1 END AS side, regexp_extract_all(lower(strip_accents(transcription)), '[\\p{L}\\p{N}]+') AS ws
    FROM clips_split WHERE split IN ('train', 'validation', 'test')
), t AS (SELECT row_id, side, n, word, row_number() OVER (PARTITION BY row_id, word) AS k FROM (SELECT row_id, side, len(ws) AS n, unnest(ws) AS word FROM w)),
met AS (
    SELECT a.row_id AS ra, b.row_id AS rb, max(greatest(a.n, b.n)) AS n FROM t a JOIN t b ON a.word = b.word AND a.k = b.k
    WHERE a.side = 0 AND b.side = 1 AND abs(a.n - b.n) <= greatest(a.n, b.n) // 8 GROUP BY 1, 2 HAVING count(*) >= max(greatest(a.n, b.n)) - max(greatest(a.n, b.n)) // 8
), spelt AS (
    SELECT ra, rb, n, a.ws AS x, b.ws AS y, list_distinct(a.ws || b.ws) AS kinds FROM met JOIN w a ON a.row_id = ra JOIN w b ON b.row_id = rb
), near AS (
    SELECT ra, rb, x = y AS same FROM spelt
    WHERE levenshtein(array_to_string(list_transform(x, lambda e: chr(32 + list_position(kinds, e)::INT)), ''), array_to_string(list_transform(y, lambda e: chr(32 + list_position(kinds, e)::INT)), '')) <= n // 8
)
"""

_P5_REPORT = (
    _NEAR
    + """, hits AS (SELECT rb, max(same::INT) AS same_text, max((NOT same)::INT) AS near_text FROM near GROUP BY 1),
ids AS (SELECT DISTINCT source_id FROM w WHERE side = 0),
rows AS (
    SELECT split, CASE WHEN s IN ('', 'unknown') THEN NULL ELSE s END AS source, (ids.source_id IS NOT NULL)::INT AS i, coalesce(same_text, 0) AS s, coalesce(near_text, 0) AS n FROM (
        SELECT *, lower(regexp_replace(source_speaker_id, '^\\s+|\\s+$', '', 'g')) AS s FROM w WHERE side = 1) w LEFT JOIN hits ON rb = row_id LEFT JOIN ids ON ids.source_id = w.source_id
)
SELECT split, source, count(*) AS rows, sum(i)::BIGINT AS same_id, sum(s)::BIGINT AS same_text, sum(n)::BIGINT AS near_text, sum(greatest(i, s, n))::BIGINT AS overlapping FROM rows GROUP BY 1, 2
"""
)

_VOICES = """
WITH RECURSIVE v AS (
    SELECT source_id, list_transform(embedding, lambda e: e::DOUBLE) AS e FROM clip_voice
    WHERE coalesce(embedding_ok, true) AND embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0 AND source_id IS NOT NULL
), u AS (SELECT DISTINCT source_id, e FROM v WHERE list_dot_product(e, e) > 0),
steps AS (SELECT DISTINCT a.source_id AS x, b.source_id AS y FROM u a JOIN u b ON list_cosine_similarity(a.e, b.e) >= 0.8),
reach(x, y) AS (SELECT x, y FROM steps UNION SELECT r.x, s.y FROM reach r JOIN steps s ON r.y = s.x)
"""

_P6_CLUSTERS = (
    _VOICES
    + """, members AS (SELECT x AS source_id, min(y) AS cluster_key FROM reach GROUP BY 1),
once AS (SELECT DISTINCT source_id, list_transform(e, lambda x: (x / sqrt(list_dot_product(e, e)))::FLOAT::DOUBLE) AS e FROM u),
parts AS (SELECT cluster_key, d, sum(x) AS x FROM (SELECT cluster_key, unnest(range(64)) AS d, unnest(e) AS x FROM once JOIN members USING (source_id)) GROUP BY 1, 2),
centres AS (SELECT cluster_key, list(x ORDER BY d) AS c FROM parts GROUP BY 1),
scored AS (SELECT cluster_key, source_id, max(round(list_dot_product(e, c) / sqrt(list_dot_product(c, c)), 6)) AS cos FROM once JOIN members USING (source_id) JOIN centres USING (cluster_key) GROUP BY 1, 2),
ranks AS (SELECT *, row_number() OVER (PARTITION BY cluster_key ORDER BY cos DESC, source_id) AS r, count(*) OVER (PARTITION BY cluster_key) AS size FROM scored)
SELECT cluster_key, max(size) AS size, list(source_id ORDER BY r) AS typical FROM ranks WHERE r <= 3 GROUP BY 1
"""
)

SQL = {
    "p1_found": _P1,
    "p1_splits": _P1_SPLITS,
    "p2_found": _CAPPED + "SELECT source_id FROM placed, cap WHERE p > c",
    "p2_strata": _P2_STRATA,
    "p5_found": _NEAR + "SELECT least(ra, rb) AS row_id_a, greatest(ra, rb) AS row_id_b FROM near",
    "p5_report": _P5_REPORT,
    "p6_found": _VOICES + "SELECT x AS source_id, min(y) AS cluster_key FROM reach GROUP BY x HAVING count(*) > 1",
    "p6_clusters": _P6_CLUSTERS,
}
