"""DuckDB SQL of the queries that SQL can express on whole tables.

The others have no such form: keyed pseudonyms, a learned language model, byte-pair merges, 219
signature rules, covariance steps, repeated byte strings, hashed draws, XXH64 fingerprints and checksums. They are tested against
brute force in tests/llm.
"""

from __future__ import annotations

import string

from subscriber_analytics.llm import decontaminate, phrases, urls

_LOWER = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"
_SPLIT = (r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), " + _LOWER + r"), "
          r"'[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '')")
_SIZE = decontaminate.WINDOW_WORDS

DECONTAMINATION = rf"""
WITH docs AS (SELECT doc_id, {_SPLIT} AS w FROM documents),
items AS (SELECT item_id, {_SPLIT} AS w FROM benchmark),
starts AS (SELECT item_id, w, least(len(w), {_SIZE}) AS n, unnest(range(1, len(w) - least(len(w), {_SIZE}) + 2)) AS k
  FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, k, k + n - 1), ' ') AS win FROM starts),
sizes AS (SELECT DISTINCT n FROM windows),
spots AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM docs, sizes WHERE len(w) >= n),
places AS (SELECT doc_id, n, k, array_to_string(list_slice(w, k, k + n - 1), ' ') AS win FROM spots),
found AS (SELECT doc_id, item_id, k, n FROM places JOIN windows USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS word FROM found) GROUP BY doc_id),
held AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)
"""


def _place(url: str) -> str:
    host = f"translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), {_LOWER})"
    path = f"regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
    query = f"regexp_extract({url}, '(?s)^.*?://[^?#]*(\\?[^#]*)', 1)"
    return f"{host} AS host, {path} AS path, {host} || {path} || {query} AS address"


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


_RULES = ", ".join(f"('{rule}', '{action}', '{rule.split('/', 1)[0]}', '{rule[len(rule.split('/', 1)[0]):]}')" for rule, action in urls.RULES)

URL_FILTER = rf"""
WITH RECURSIVE rules(rule, action, rule_host, rule_path) AS (VALUES {_RULES}),
own AS (SELECT page_id, html, {_place("coalesce(url, '')")} FROM pages),
tags AS (SELECT host, path, address, unnest(regexp_extract_all(coalesce(html, ''), '{_quoted(urls.TAGS)}')) AS tag FROM own WHERE host <> ''),
named AS (SELECT host, path, address, trim(CASE WHEN regexp_matches(tag, '{_quoted(urls.CANONICAL)}')
    THEN regexp_extract(tag, '{_quoted(urls.HREF)}', 1) || regexp_extract(tag, '{_quoted(urls.HREF)}', 2) || regexp_extract(tag, '{_quoted(urls.HREF)}', 3)
    WHEN regexp_matches(tag, '{_quoted(urls.REFRESH)}') THEN regexp_extract(tag, '{_quoted(urls.TARGET)}', 1) END) AS target FROM tags),
full_urls AS (SELECT host AS a_host, path AS a_path, address AS a, CASE WHEN regexp_matches(target, '(?i)^[a-z][a-z0-9+.-]*://') THEN target
    WHEN starts_with(target, '//') THEN 'http:' || target WHEN starts_with(target, '/') THEN 'http://' || host || target
    WHEN starts_with(target, '?') THEN 'http://' || host || path || target
    ELSE 'http://' || host || CASE WHEN path = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END || target END AS target
  FROM named WHERE target <> '' AND NOT starts_with(target, '#')),
aliases AS (SELECT DISTINCT a_host, a_path, a, host AS b_host, path AS b_path, address AS b FROM (
    SELECT a_host, a_path, a, {_place('target')} FROM full_urls) WHERE host <> ''),
places AS (SELECT DISTINCT host, path FROM own UNION SELECT b_host, b_path FROM aliases),
decided AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
  FROM places LEFT JOIN rules ON host <> '' AND (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path),
edges AS (SELECT a, b FROM aliases UNION SELECT b, a FROM aliases),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
nodes AS (SELECT a_host AS host, a_path AS path, a AS node FROM aliases UNION SELECT b_host, b_path, b FROM aliases),
spread AS (SELECT reach.a AS node, bool_or(action = 'block') AND NOT bool_or(action = 'allow') AS blocked
  FROM reach JOIN nodes ON reach.b = nodes.node JOIN decided ON nodes.host = decided.host AND nodes.path = decided.path
  WHERE action IS NOT NULL GROUP BY reach.a)
SELECT page_id, own.host, own.path, rule,
  coalesce(action, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM own JOIN decided ON own.host = decided.host AND own.path = decided.path
LEFT JOIN spread ON spread.node = own.address
"""


_COUNTS = " UNION ALL ".join(
    f"SELECT lang, {k} AS k, array_to_string(list_slice(w, i, i + {k - 1}), ' ') AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM pieces WHERE len(w) >= {k})"
    for k in range(1, phrases.LONGEST + 1))

PHRASES = rf"""
WITH lines AS (SELECT coalesce(lang, '{phrases.NO_LANG}') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '{phrases.PIECE_ENDS}')) AS piece FROM documents),
pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '{phrases.BLANKS}'), lambda w: w <> '') AS w FROM lines),
counted AS (SELECT lang, k, phrase, count(*) AS f FROM ({_COUNTS}) GROUP BY lang, k, phrase),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang),
found AS (SELECT * FROM counted WHERE f >= {phrases.LEAST_COUNT}),
chosen AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM found WHERE k > 1),
cuts AS (SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS cut FROM chosen),
sized AS (SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r,
    (CAST(c.a AS HUGEINT) * {phrases.SCALE} // (CAST(x.f AS HUGEINT) + y.f))::BIGINT AS score
  FROM cuts c JOIN found x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(c.w, 1, c.cut), ' ')
  JOIN found y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(c.w, c.cut + 1, c.k), ' ')),
best AS (SELECT * FROM sized QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT lang, a, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase
  FROM (SELECT lang, k, a, w, size, unnest(range(1, k - size + 2)) AS i FROM (
    SELECT *, unnest(range(2, k)) AS size FROM chosen WHERE k > 2))),
around AS (SELECT lang, phrase, max(a) AS around FROM inside GROUP BY lang, phrase),
remaining AS (SELECT best.* FROM best LEFT JOIN around USING (lang, phrase)
  WHERE around IS NULL OR CAST(around AS HUGEINT) * 100 < CAST(a AS HUGEINT) * {phrases.COVER_PERCENT})
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM remaining JOIN totals USING (lang)
QUALIFY rank <= {phrases.TOP}
"""

EXACT_DEDUP = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS body, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal FROM documents),
placed AS (SELECT *, row_number() OVER longest AS place, first_value(doc_id) OVER longest AS keep_id,
    count(*) OVER (PARTITION BY normal) AS group_size
  FROM texts WINDOW longest AS (PARTITION BY normal ORDER BY length(body) DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(normal) AS text_sha256 FROM placed
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": DECONTAMINATION, "op5_url_filter": URL_FILTER, "op11_phrases": PHRASES,
            "op12_exact_dedup": EXACT_DEDUP}
