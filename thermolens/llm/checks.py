"""SQL for DuckDB that gives the rows of the registered queries."""

CHECKS = {
    "op1_exact_dedup": r"""
        WITH d AS (
          SELECT doc_id, length(coalesce(text, '')) AS n,
                 sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
          FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, h AS text_sha256
        FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)""",
    "op3_quality_rules": r"""
        WITH d AS (
          SELECT doc_id, coalesce(text, '') AS t,
                 regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
          FROM documents),
        windows AS (
          SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
          FROM d, unnest(range(1, len(w) - 1)) AS r(i)),
        repeated AS (
          SELECT doc_id, count(DISTINCT i + k) AS n
          FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows),
               (VALUES (0), (1), (2)) AS v(k)
          WHERE c > 1 GROUP BY doc_id),
        lines AS (
          SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
          FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
        m AS (
          SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
                 length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                 length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                 coalesce(lines.dup, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
                 coalesce(lines.n, 0) AS n_lines
          FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
                    OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 6 * n_lines
                    OR word_chars < 2 * n_words OR word_chars > 25 * n_words) AS kept
        FROM m""",
    "op5_url_filters": r"""
        WITH RECURSIVE tags AS (
          SELECT url, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\b[^>]*>')) AS tag
          FROM pages),
        links AS (
          SELECT url, regexp_extract(
            tag, '(?i)(?:href\s*=\s*["'']?|url\s*=\s*)([^"''\s>]+)', 1) AS link
          FROM tags
          WHERE regexp_matches(
            lower(tag), 'rel\s*=\s*["'']?canonical|http-equiv\s*=\s*["'']?refresh')),
        edges AS (
          SELECT url, CASE
            WHEN contains(link, '://') THEN link
            WHEN starts_with(link, '//') THEN 'http:' || link
            WHEN starts_with(link, '/') THEN regexp_extract(url, '^(.*?://[^/?#]*)', 1) || link
            ELSE regexp_replace(regexp_extract(url, '^(.*?://[^/?#]*(?:/[^?#]*/|/)?)', 1),
                                '([^/])$', '\1/') || link END AS target
          FROM links WHERE link <> ''),
        urls AS (
          SELECT url FROM pages UNION SELECT target FROM edges),
        parts AS (
          SELECT url, contains(url, '://') AS has,
                 CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3)
                      ELSE '' END AS rest
          FROM urls),
        split AS (
          SELECT url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
                 regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS tail, has
          FROM parts),
        rules(verdict, h, p) AS (
          VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
                 ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'),
                 ('block', 'net', '/fr/')),
        own AS (
          SELECT url, host, path,
                 CASE WHEN has THEN host || CASE tail WHEN '' THEN '/' ELSE tail END END AS node,
                 arg_max(h || p, length(h || p)) AS rule,
                 arg_max(verdict, length(h || p)) AS verdict
          FROM split LEFT JOIN rules
            ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
          GROUP BY ALL),
        pairs AS (
          SELECT s.node AS a, t.node AS b
          FROM edges JOIN own s ON s.url = edges.url JOIN own t ON t.url = edges.target),
        sides AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
        reach(a, b) AS (
          SELECT a, a FROM sides
          UNION SELECT reach.a, sides.b FROM reach JOIN sides ON reach.b = sides.a),
        linked AS (
          SELECT url, node, verdict FROM own WHERE node IN (SELECT a FROM sides)
          AND (url IN (SELECT url FROM edges) OR url IN (SELECT target FROM edges))),
        spread AS (
          SELECT reach.a AS node, bool_or(verdict = 'block') AS blocked,
                 bool_or(verdict = 'allow') AS allowed
          FROM reach JOIN linked ON linked.node = reach.b GROUP BY reach.a)
        SELECT page_id, coalesce(own.host, '') AS host, coalesce(own.path, '') AS path, own.rule,
               coalesce(own.verdict, CASE WHEN blocked AND NOT coalesce(allowed, false) THEN 'block'
                                      ELSE 'allow' END) AS verdict
        FROM pages LEFT JOIN own ON own.url = pages.url
        LEFT JOIN spread ON spread.node = own.node""",
}
