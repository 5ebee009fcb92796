"""DuckDB SQL for the queries that SQL can express, written from the contracts."""

ORACLES: dict[str, str] = {}

ORACLES["op1_warc"] = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS body FROM pages
), d AS (
    SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha256(body) AS payload_digest FROM p
), g AS (
    SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS leader FROM d
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN leader IS NULL OR leader = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN leader <> page_id THEN leader END AS refers_to
FROM g
"""

ORACLES["op6_url_filters"] = r"""
WITH u AS (
    SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS pos FROM pages
), rest AS (
    SELECT page_id, CASE WHEN pos > 0 THEN substr(url, pos + 3) ELSE '' END AS rest FROM u
), parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest
), rules(top, prefix, rule, says) AS (
    VALUES ('org', '/', 'org/', 'allow'), ('example.org', '/es/', 'example.org/es/', 'block'),
           ('example.org', '/en/1', 'example.org/en/1', 'block'), ('com', '/fr/', 'com/fr/', 'allow'),
           ('com', '/de/', 'com/de/', 'block')
), fits AS (
    SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(says, length(rule)) AS says
    FROM parts JOIN rules ON starts_with(path, prefix) AND (host = top OR ends_with(host, '.' || top))
    GROUP BY page_id
), listed AS (
    SELECT name || '.example.' || top AS domain
    FROM unnest(['ads-track', 'free-bets', 'cheap-pills', 'spam-farm', 'casino-win', 'adult-x']) AS n(name),
         unnest(['com', 'net', 'org']) AS t(top)
), bad AS (
    SELECT DISTINCT page_id FROM parts JOIN listed ON host = domain OR ends_with(host, '.' || domain)
)
SELECT p.page_id, p.host, p.path, f.rule,
       coalesce(f.says, CASE WHEN b.page_id IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id LEFT JOIN bad b ON b.page_id = p.page_id
"""

ORACLES["op7_quality_rules"] = r"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text FROM documents
), w AS (
    SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
           string_split(text, chr(10)) AS lines
    FROM t
), f AS (
    SELECT doc_id, words, CAST(len(words) AS BIGINT) AS n_words, len(lines) AS n_lines,
           CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
           CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS full_lines
    FROM w
), triples AS (
    SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
    FROM (SELECT doc_id, words, unnest(range(1, n_words - 1)) AS i FROM f WHERE n_words >= 3)
), twice AS (
    SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM triples) WHERE n > 1
), r AS (
    SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM twice) GROUP BY 1
), g AS (
    SELECT f.doc_id, n_words, word_chars, n_symbols,
           CAST(len(full_lines) - len(list_distinct(full_lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, n_lines
    FROM f LEFT JOIN r ON r.doc_id = f.doc_id
), v AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM g
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 10 * n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 100 * n_dup_lines > 50 * n_lines) AS kept
FROM v
"""

ORACLES["op8_line_dedup"] = r"""
WITH d AS (
    SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), l AS (
    SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS pos FROM d
), seq AS (
    SELECT *, lead(line, 1) OVER o AS line2, lead(line, 2) OVER o AS line3,
           lead(pos, 1) OVER o AS pos2, lead(pos, 2) OVER o AS pos3
    FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
    WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
    SELECT doc_id, pos, pos2, pos3,
           row_number() OVER (PARTITION BY line, line2, line3 ORDER BY doc_id, pos) AS nth
    FROM seq WHERE line3 IS NOT NULL
), gone AS (
    SELECT DISTINCT doc_id, unnest([pos, pos2, pos3]) AS pos FROM later WHERE nth > 1
), kept AS (
    SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text
    FROM l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos WHERE g.pos IS NULL GROUP BY l.doc_id
), n AS (
    SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed, CAST(length(t.text) AS BIGINT) AS n_chars,
       sha256(t.text) AS text_sha256
FROM (SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
      FROM d LEFT JOIN kept k ON k.doc_id = d.doc_id) t
JOIN d ON d.doc_id = t.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

ORACLES["op12_ngram_join"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                               'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [words]
                        ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i:i + 2])) END AS grams
    FROM w
), n AS (
    SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, hash(list_sort(grams)) AS h FROM s
), reps AS (
    SELECT min(doc_id) AS doc_id, h, n_shingles FROM n WHERE n_shingles > 0 GROUP BY h, n_shingles
), g AS (
    SELECT doc_id, hash(unnest(grams)) AS gram FROM s WHERE doc_id IN (SELECT doc_id FROM reps)
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
    SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE 100 * k >= 90 * (x.n_shingles + y.n_shingles - k)
), edge AS (
    SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
    SELECT doc_id AS id, doc_id AS far FROM reps
    UNION
    SELECT r.id, e.b FROM reach r JOIN edge e ON e.a = r.far
), component AS (
    SELECT id, min(far) AS component_id FROM reach GROUP BY id
)
SELECT n.doc_id, n.n_shingles, coalesce(c.component_id, n.doc_id) AS component_id
FROM n LEFT JOIN reps r ON r.h = n.h AND r.n_shingles = n.n_shingles LEFT JOIN component c ON c.id = r.doc_id
"""
