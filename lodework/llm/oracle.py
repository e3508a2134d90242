"""Expected results of the queries as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from lodework.llm import urls

_WORDS = r"list_filter(regexp_split_to_array(coalesce({0}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

QUALITY = rf"""
WITH d AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS text,
         {_WORDS.format('text')} AS w, row_number() OVER () AS r FROM {{documents}}
), grams AS (
  SELECT r, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), twice AS (
  SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), repeats AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, range(3) AS t(k) GROUP BY r
), l AS (
  SELECT r, host, line, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm
  FROM (SELECT r, host, unnest(string_split(text, chr(10))) AS line FROM d)
), full_lines AS (
  SELECT r, host, line, md5(lower(norm)) AS h, length(norm) AS chars FROM l WHERE norm <> ''
), line_counts AS (
  SELECT r, count(*) - count(DISTINCT line) AS dup, sum(chars) AS chars FROM full_lines GROUP BY r
), frequent AS (
  SELECT l.host, h FROM full_lines l JOIN d USING (r) GROUP BY l.host, h HAVING count(DISTINCT md5(d.text)) > 20
), lost AS (
  SELECT r, count(*) AS n, sum(chars) AS chars FROM full_lines l
  JOIN frequent f ON l.h = f.h AND l.host IS NOT DISTINCT FROM f.host GROUP BY r
), counts AS (
  SELECT d.r, doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
         coalesce(repeats.n, 0) AS n_repeat_words, coalesce(line_counts.chars, 0) AS chars,
         coalesce(lost.chars, 0) AS lost, coalesce(lost.n, 0) AS n_removed_lines
  FROM d LEFT JOIN repeats USING (r) LEFT JOIN line_counts USING (r) LEFT JOIN lost USING (r)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * (chars - lost) < 30 * chars) AS kept,
       n_removed_lines::BIGINT AS n_removed_lines
FROM counts"""

_LETTERS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

CONTAMINATION = f"""
WITH items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, {_LETTERS} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), d AS (
  SELECT doc_id, {_LETTERS} AS w, row_number() OVER () AS r FROM {{documents}}
), placed AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows))
), hit AS (
  SELECT r, i, n, item FROM placed JOIN windows USING (n, g)
), words AS (
  SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT r, i, n FROM hit), range(13) AS t(k) WHERE k < n GROUP BY r
), named AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN named USING (r)"""

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS n FROM pages
), f AS (
  SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first FROM p
)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f"""


def _held(terms: tuple[str, ...]) -> str:
    """SQL for the terms of a list that stand alone in the lower-case url ``u``, joined by commas."""
    listed = ", ".join(f"('{t}')" for t in sorted(terms))
    return (f"coalesce((SELECT string_agg(t, ',' ORDER BY t) FROM (VALUES {listed}) AS v(t) "
            "WHERE regexp_matches(u, '(^|[^a-z0-9])' || t || '([^a-z0-9]|$)')), '')")


URLS = f"""
WITH s AS (
  SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM s
), r AS (
  SELECT *, '.' || host AS dotted, {_held(urls.STRICT)} AS strict_terms, {_held(urls.SOFT_TERMS)} AS soft_terms FROM h
), n AS (
  SELECT *, CASE WHEN dotted LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
                 WHEN dotted LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
                 WHEN dotted LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
                 WHEN dotted LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM r
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN strict_terms <> '' OR len(string_split(soft_terms, ',')) >= {urls.SOFT} THEN 'block' ELSE 'allow' END AS verdict,
       strict_terms, soft_terms
FROM n"""

# The checksum of an id's decimals goes byte by byte through the table of CRC-32, made from its polynomial.
TRIE = r"""
WITH steps AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM range(256) AS r(i))
), turns AS (
  SELECT conv_id, turn, left(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS digest,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(digest ORDER BY turn NULLS FIRST, digest) AS ds, list(words ORDER BY turn NULLS FIRST, digest) AS ws
  FROM turns GROUP BY conv_id
), asked AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                            lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 4 AS h
  FROM own, steps
), built AS (
  SELECT o.conv_id, list_concat(list_slice(coalesce(b.ds, []), 1, h), list_slice(o.ds, h + 1, len(o.ds))) AS ds,
         list_concat(list_slice(coalesce(b.ws, []), 1, h), list_slice(o.ws, h + 1, len(o.ws))) AS ws
  FROM asked o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
), paths AS (
  SELECT conv_id, d, d = len(ds) AS ends, md5(array_to_string(list_slice(ds, 1, d), ',')) AS name, coalesce(ws[d], 0) AS w,
         CASE WHEN d > 0 THEN md5(array_to_string(list_slice(ds, 1, d - 1), ',')) END AS parent
  FROM (SELECT *, unnest(range(len(ds) + 1)) AS d FROM built)
), nodes AS (
  SELECT name, d, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, min(w) AS w,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends) AS ended
  FROM paths GROUP BY name, d
), known AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN (SELECT parent, count(*) AS n FROM nodes GROUP BY parent) c ON c.parent = n.name
  LEFT JOIN nodes p ON p.name = n.parent
), totals AS (
  SELECT p.name, sum((k.n_children = 0)::BIGINT) AS n_leaves, sum((k.n_convs - 1) * k.w) AS saved
  FROM known k JOIN paths p ON p.conv_id = k.conv_id AND p.d <= k.d GROUP BY p.name
)
SELECT conv_id, d::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ended, '')) AS ends_sha256
FROM known JOIN totals USING (name)"""

STATEMENTS: dict[str, str] = {
    "op5_decontamination": CONTAMINATION.replace("{documents}", "documents"),
    "op6_url_filter": URLS,
    "op7_warc": WARC,
    "op10_quality_rules": QUALITY.replace("{documents}", "documents"),
    "op11_prefix_trie": TRIE,
}
