"""DuckDB SQL for the queries: the same results from the same tables."""

from __future__ import annotations

from pressloom import vocab

from .queries import AS_OF, SUFFIX_RULES

ORACLE: dict[str, str] = {}


def _list(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


# --- shared parts ---------------------------------------------------------------

CANON = "'http://' || rtrim(regexp_extract(url, '^[a-z]+://([^?#]*)', 1), '/')"
HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"

#: page_id, url, netloc, domain, tld, subdomain, fqdn, website_name, website_url
SITE = f"""
hosts AS (SELECT page_id, url, {HOST} AS netloc FROM pages),
labels AS (SELECT *, string_split(netloc, '.') AS l FROM hosts),
parts AS (SELECT page_id, url, netloc, l[len(l) - 1] AS domain, l[len(l)] AS tld,
                 array_to_string(l[1:len(l) - 2], '.') AS subdomain FROM labels),
site AS (SELECT *,
    CASE WHEN subdomain IN ('', 'www') THEN '' ELSE replace(subdomain || '.', 'www.', '') END
      || domain || '.' || tld AS fqdn,
    upper(domain[1]) || lower(domain[2:]) AS website_name,
    'http://' || netloc AS website_url FROM parts),
sites AS (SELECT min(page_id) AS website_id, fqdn,
                 arg_min(website_name, page_id) AS website_name,
                 arg_min(website_url, page_id) AS website_url,
                 arg_min(subdomain, page_id) AS subdomain, arg_min(tld, page_id) AS tld
          FROM site GROUP BY fqdn),
websites AS (SELECT *, CASE website_id % 3 WHEN 0 THEN 'Philippines' WHEN 1 THEN 'Singapore'
                       ELSE 'United States' END AS country,
             website_id % 7 = 0 AS is_aggregator FROM sites)
"""

#: The derived crawl queue and the derived store.
QUEUE = f"""
links AS (SELECT page_id AS link_id, CASE WHEN page_id % 17 <> 0 THEN url END AS original_url,
    CASE page_id % 5 WHEN 2 THEN 'Processing@h1' WHEN 3 THEN 'Done' WHEN 4 THEN 'Error'
                     ELSE 'Queued' END AS status,
    CASE page_id % 4 WHEN 2 THEN 'JS_link' WHEN 3 THEN 'JS_lazy' ELSE 'System' END AS created_by,
    TIMESTAMP '2024-01-01' + to_minutes(page_id) AS date_created FROM pages),
stored AS (SELECT page_id AS article_id, {CANON} AS article_url,
    CASE page_id % 4 WHEN 0 THEN 'Queued' WHEN 2 THEN 'Done' ELSE 'Error' END AS article_status,
    CASE page_id % 3 WHEN 0 THEN 'System' ELSE 'JS_link' END AS created_by,
    TIMESTAMP '2024-01-01' + to_minutes(page_id) AS date_created FROM pages WHERE page_id % 6 = 0)
"""

TOKEN = r"[\p{L}\p{N}_]+(?:[-''.][\p{L}\p{N}_]+)*|[^\p{L}\p{N}_\s]"
SPACE = r"[\t\n\x0b\x0c\r\x1c-\x20\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def tokens(text: str) -> str:
    return f"regexp_extract_all({text}, '{TOKEN}')"


def content_tokens(text: str, stop: str) -> str:
    return (f"list_filter({tokens(f'lower({text})')}, "
            rf"lambda t: NOT list_contains({stop}, t) AND regexp_matches(t, '[\p{{L}}\p{{N}}_]'))")


def strip(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '^{SPACE}+', ''), '{SPACE}+$', '')"


def ascii_text(text: str) -> str:
    """Accents removed; the letters without a base letter spelled out."""
    out = f"strip_accents({text})"
    for letter, plain in (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"), ("ø", "o"),
                          ("Ø", "O"), ("’", "''"), ("‘", "''"), ("“", '"'), ("”", '"'), ("–", "-"),
                          ("—", "--"), ("…", "...")):
        out = f"replace({out}, '{letter}', '{plain}')"
    return out


def grams(value: str) -> str:
    upper = f"upper(replace('  ' || {value} || '  ', 'ß', 'SS'))"
    return f"list_transform(range(1, length({upper}) - 1), lambda i: substr({upper}, i, 3))"


def matches(value_grams: str, word_grams: str) -> str:
    return f"len(list_filter({value_grams}, lambda g: list_contains({word_grams}, g)))"


EN = _list(vocab.STOPWORDS_EN)
EN_ES = _list(vocab.stopwords_for("es"))

# --- urls and sites ---------------------------------------------------------------

ORACLE["canonical_url"] = f"SELECT page_id, {CANON} AS canonical_url FROM pages"

ORACLE["media_url_clean"] = """
WITH h AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages),
e AS (SELECT page_id, unnest(l) AS href, unnest(range(0, len(l))) AS pos FROM h)
SELECT page_id, pos, href,
  CASE WHEN href LIKE '//%' THEN 'http:' ELSE '' END || regexp_replace(href, '[?#;].*$', '') AS link FROM e
"""

ORACLE["netloc"] = f"SELECT page_id, {HOST} AS netloc FROM pages"

ORACLE["site_identity"] = ORACLE["site_identity_suffix_table"] = f"""
WITH {SITE} SELECT page_id, domain, tld, subdomain, netloc, fqdn, website_name, website_url FROM site
"""

ORACLE["site_identity_national"] = f"""
WITH hosts AS (SELECT page_id, regexp_replace({HOST}, '\\.(com|net|org)$', '') AS stem, {HOST} AS h FROM pages),
named AS (SELECT page_id, h <> stem AS moved, CASE WHEN h <> stem THEN h || CASE WHEN page_id % 2 = 0 THEN '.ph' ELSE '.sg' END ELSE h END AS netloc,
  string_split(stem, '.') AS l, substr(h, length(stem) + 2) || CASE WHEN page_id % 2 = 0 THEN '.ph' ELSE '.sg' END AS moved_tld FROM hosts),
parts AS (SELECT page_id, netloc, l[len(l) - CASE WHEN moved THEN 0 ELSE 1 END] AS domain,
  CASE WHEN moved THEN moved_tld ELSE l[len(l)] END AS tld,
  array_to_string(l[1:len(l) - CASE WHEN moved THEN 1 ELSE 2 END], '.') AS subdomain FROM named)
SELECT page_id, domain, tld, subdomain, netloc,
  CASE WHEN subdomain IN ('', 'www') THEN '' ELSE replace(subdomain || '.', 'www.', '') END || domain || '.' || tld AS fqdn,
  upper(domain[1]) || lower(domain[2:]) AS website_name, 'http://' || netloc AS website_url FROM parts
"""

ORACLE["public_suffix_rules"] = f"""
WITH moved AS (SELECT page_id, regexp_extract(lower({HOST}), '^(.*)\\.', 1) || '.'
    || ['ck', 'www.ck', 'x.kobe.jp', 'city.kobe.jp', 'ac.jp', 'com'][page_id % 6 + 1] AS host FROM pages),
hosts AS (SELECT page_id, CASE WHEN page_id % 10 = 3 THEN regexp_extract(host, '([^.]*\\.[^.]*)$', 1) ELSE host END AS host FROM moved),
labels AS (SELECT *, string_split(host, '.') AS l FROM hosts),
tails AS (SELECT page_id, k, array_to_string(l[k:], '.') AS tail, array_to_string(l[k + 1:], '.') AS after, len(l) - k + 1 AS n
  FROM labels, unnest(range(1, len(l) + 1)) r(k)),
rules AS (SELECT unnest({_list(SUFFIX_RULES)}) AS rule),
hits AS (SELECT page_id, CASE WHEN rule[1] = '!' THEN after ELSE tail END AS suffix, rule[1] = '!' AS spared, n
  FROM tails JOIN rules ON rule = tail OR rule = '!' || tail OR (rule = '*.' || after AND after <> '')),
best AS (SELECT page_id, arg_max(suffix, (spared::INT, n)) AS suffix FROM hits GROUP BY page_id),
found AS (SELECT page_id, host, coalesce(suffix, '') AS suffix,
  string_split(CASE WHEN suffix <> host THEN substr(host, 1, length(host) - length(suffix) - 1) ELSE '' END, '.') AS l
  FROM hosts LEFT JOIN best USING (page_id))
SELECT page_id, host, suffix, CASE WHEN l[len(l)] = '' THEN '' ELSE suffix END AS tld, l[len(l)] AS domain,
  array_to_string(l[1:len(l) - 1], '.') AS subdomain FROM found
"""

_NAMED = """
first AS (SELECT *, row_number() OVER (PARTITION BY website_name ORDER BY website_id) = 1 AS keeps1 FROM cand),
second AS (SELECT *, CASE WHEN keeps1 OR subdomain IN ('', 'www') THEN website_name
    ELSE upper(subdomain[1]) || lower(subdomain[2:]) || ' ' || website_name END AS name2 FROM first),
third AS (SELECT *, NOT keeps1 AND name2 NOT IN (SELECT website_name FROM second WHERE keeps1)
    AND row_number() OVER (PARTITION BY keeps1, name2 ORDER BY website_id) = 1 AS keeps2 FROM second),
named AS (SELECT website_id, fqdn, website_url, CASE WHEN keeps1 OR keeps2 THEN name2
    ELSE name2 || ' ' || array_to_string(list_transform(string_split(tld, '.'),
         lambda w: upper(w[1]) || lower(w[2:])), ' ') END AS website_name FROM third)
"""

ORACLE["site_name_disambiguation"] = f"""
WITH {SITE}, cand AS (SELECT * FROM sites), {_NAMED}
SELECT website_id AS candidate_id, fqdn, website_name FROM named
"""

_KNOWN = """
known AS (SELECT website_id, 'Site ' || website_id AS website_name, website_url,
    CASE WHEN website_id % 4 = 0 THEN 'old.' || fqdn ELSE fqdn END AS fqdn
    FROM sites WHERE website_id % 2 = 0),
hit AS (SELECT s.*,
    (SELECT CASE WHEN count(*) = 1 THEN min(website_id) WHEN count(*) > 1 THEN -1 END
       FROM known k WHERE k.website_name = s.website_name) AS by_name,
    (SELECT CASE WHEN count(*) = 1 THEN min(website_id) WHEN count(*) > 1 THEN -1 END
       FROM known k WHERE k.fqdn = s.fqdn) AS by_fqdn,
    (SELECT CASE WHEN count(*) = 1 THEN min(website_id) WHEN count(*) > 1 THEN -1 END
       FROM known k WHERE k.website_url = s.website_url) AS by_url FROM sites s),
found AS (SELECT *, nullif(coalesce(by_name, by_fqdn, by_url), -1) AS existing_id FROM hit),
decided AS (SELECT f.*, CASE WHEN k.website_id IS NULL THEN 'INSERT'
    WHEN k.website_url <> f.website_url AND k.fqdn <> f.fqdn THEN 'INSERT'
    WHEN k.website_url = f.website_url AND k.fqdn <> f.fqdn THEN 'UPDATE_FQDN'
    ELSE 'KEEP' END AS action FROM found f LEFT JOIN known k ON k.website_id = f.existing_id)
"""

ORACLE["site_reconciliation"] = f"""
WITH {SITE}, {_KNOWN} SELECT website_id AS candidate_id, fqdn, existing_id, action FROM decided
"""

ORACLE["site_registry_insert"] = f"""
WITH {SITE}, {_KNOWN}, cand AS (SELECT * FROM decided WHERE action = 'INSERT'), {_NAMED}
SELECT website_id, website_name, website_url || '/favicon.ico' AS website_icon_url, website_url,
  CAST(300 AS DOUBLE) AS website_cost, 'INTERNATIONAL_NEWS' AS website_type, 'Unknown' AS country,
  'NoC' AS country_code, fqdn, 'Python' AS programming_language, 'pressloom' AS created_by FROM named
"""

ORACLE["site_registry_fixes"] = f"""
WITH {SITE}, {_KNOWN} SELECT existing_id AS website_id, arg_min(fqdn, website_id) AS fqdn
FROM decided WHERE action = 'UPDATE_FQDN' GROUP BY existing_id
"""

ORACLE["site_eligibility"] = f"""
WITH {SITE} SELECT s.page_id AS link_id, s.fqdn, w.website_id,
  w.country IN ('Philippines', 'Singapore') AND NOT w.is_aggregator AND s.fqdn <> 'philstar.com' AS is_eligible,
  CASE WHEN w.country = 'Philippines' THEN 'tl' ELSE 'en' END AS site_lang
FROM site s LEFT JOIN websites w ON w.fqdn = s.fqdn
"""

ORACLE["lazy_site_flag"] = rf"""
SELECT page_id, {HOST} AS netloc, regexp_matches({HOST}, '^(www\.scmp\.com$|m\.)') AS is_lazy FROM pages
"""

ORACLE["blocklist_anti"] = rf"""
SELECT page_id, url FROM pages WHERE NOT regexp_matches({HOST},
  '^(hg\.mozilla\.org|www\.youtube\.com|www\.facebook\.com|www\.twitter\.com|spam-farm\.example\.org)$')
"""

ORACLE["country_type"] = """
SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey,
  CASE WHEN n_nationkey = 24 THEN 'USA' WHEN n_nationkey % 7 <> 0 THEN
    CASE WHEN upper(n_name[1:2]) = 'US' THEN 'USA' ELSE upper(n_name[1:2]) END END AS country_code,
  CASE WHEN n_nationkey % 5 = 0 OR lower(n_name) = 'philippines' THEN 'LOCAL_NEWS'
       ELSE 'INTERNATIONAL_NEWS' END AS website_type
FROM nation
"""

ORACLE["country_override"] = f"""
WITH {SITE}, o AS (SELECT website_id,
  CASE WHEN website_id % 4 = 0 THEN 'Japan' END AS given, CASE WHEN website_id % 4 = 0 THEN 'JPN' END AS code,
  CASE WHEN website_id % 5 <> 0 THEN country END AS known,
  CASE WHEN website_id % 5 <> 0 THEN upper(country[1:3]) END AS known_code FROM websites)
SELECT website_id, coalesce(given, known, 'Unknown') AS country, coalesce(code, known_code, 'NoC') AS country_code,
  CASE WHEN known = 'Philippines' THEN 'Unknown' ELSE coalesce(given, known, 'Unknown') END AS country_ignoring,
  CASE WHEN known = 'Philippines' THEN 'NoC' ELSE coalesce(code, known_code, 'NoC') END AS code_ignoring
FROM o
"""

ORACLE["media_value_input"] = f"""
WITH {SITE} SELECT s.page_id, coalesce(w.website_id * 100, 0) AS "global", coalesce(w.website_id * 10, 0) AS "local",
  CASE WHEN w.website_id IS NULL THEN CAST(0 AS DOUBLE) ELSE CAST(300 AS DOUBLE) END AS website_cost,
  CASE WHEN s.page_id % 3 <> 0 THEN s.url ELSE '' END AS text,
  CAST(CASE WHEN s.page_id % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_images, CAST(0 AS BIGINT) AS n_videos
FROM site s LEFT JOIN websites w ON w.fqdn = s.fqdn AND w.website_id % 3 <> 1
"""

# --- queue and stores ---------------------------------------------------------------

ORACLE["url_duplicates"] = f"""
SELECT page_id AS link_id, {CANON} AS article_url FROM pages
WHERE page_id % 17 <> 0 AND {CANON} IN (SELECT {CANON} FROM pages WHERE page_id % 6 = 0)
"""

ORACLE["new_articles"] = f"""
SELECT min(page_id) AS page_id, {CANON} AS article_url FROM pages GROUP BY 2
HAVING {CANON} NOT IN (SELECT {CANON} FROM pages WHERE page_id % 6 = 0)
"""

ORACLE["find_links"] = f"""
WITH {QUEUE} SELECT link_id, original_url, status, created_by FROM links
WHERE status = 'Queued' AND created_by IN ('JS_link', 'JS_lazy') AND original_url IS NOT NULL
"""

ORACLE["get_one_link"] = f"WITH {QUEUE} SELECT link_id, original_url FROM links WHERE link_id = 42"

ORACLE["get_one_website"] = f"""
WITH {SITE} SELECT website_id, fqdn, country FROM websites WHERE fqdn = 'cheap-pills.example.com'
"""

ORACLE["count_links"] = f"WITH {QUEUE} SELECT count(*) AS n FROM links WHERE status = 'Error'"

ORACLE["count_websites"] = f"WITH {SITE} SELECT nullif(count(*), 0) AS n FROM websites WHERE country = 'Atlantis'"

ORACLE["queue_count_by_mode"] = f"""
WITH {QUEUE}
SELECT 'static_link' AS mode, count(*) AS n FROM links
  WHERE status = 'Queued' AND created_by = 'System' AND original_url IS NOT NULL
UNION ALL SELECT 'js_link', count(*) FROM links
  WHERE status = 'Queued' AND created_by IN ('JS_link', 'JS_lazy') AND original_url IS NOT NULL
UNION ALL SELECT 'static_article', count(*) FROM stored WHERE article_status = 'Queued' AND created_by = 'System'
UNION ALL SELECT 'js_article', count(*) FROM stored
  WHERE article_status = 'Queued' AND created_by IN ('JS_link', 'JS_lazy')
"""

ORACLE["queue_view"] = f"""
WITH {QUEUE} SELECT link_id AS id, original_url AS url, status, 'link' AS mode FROM links
UNION ALL SELECT article_id, article_url, article_status, 'article' FROM stored
"""

ORACLE["claim_newest"] = f"""
WITH {QUEUE} SELECT article_id, article_url, 'Processing@h1' AS article_status FROM stored
WHERE article_status = 'Queued' AND created_by = 'System' ORDER BY date_created DESC, article_id LIMIT 20
"""

ORACLE["split_batches"] = "SELECT page_id AS link_id, ntile(7) OVER (ORDER BY page_id) AS part FROM pages"

ORACLE["shuffle_queue"] = "SELECT page_id AS link_id FROM pages"

ORACLE["requeue_stale"] = f"""
WITH {QUEUE} SELECT link_id, 'Queued' AS status FROM links
WHERE status = 'Processing@h1' AND created_by = 'System'
"""

ORACLE["patch_update"] = f"""
WITH {QUEUE} SELECT article_id, CASE WHEN article_id % 4 = 0 THEN 'Done' ELSE article_status END AS article_status,
  CASE WHEN article_id % 8 = 0 THEN 'editor' WHEN article_id % 4 = 0 THEN 'pressloom' END AS updated_by,
  strftime(CASE WHEN article_id % 4 = 0 THEN TIMESTAMP '{AS_OF}' ELSE date_created END, '%Y-%m-%d %H:%M:%S') AS date_updated
FROM stored
"""

ORACLE["latest_status"] = f"""
WITH {QUEUE} SELECT link_id, CASE WHEN link_id % 3 = 0 THEN 'Done' ELSE status END AS status FROM links
"""


def _quiet(windows: str) -> str:
    return " OR ".join(f"(CAST(ts AS TIME) > TIME '{a}' AND CAST(ts AS TIME) < TIME '{b}')"
                       for a, b in (w.split("-") for w in windows.split()))


ORACLE["quiet_hours"] = f"""
SELECT event_id, {_quiet('03:00:00-03:30:00 09:00:00-09:30:00 15:00:00-15:30:00 21:00:00-21:30:00')} AS links_quiet,
  {_quiet('06:00:00-06:30:00 12:00:00-12:30:00 18:00:00-18:30:00')}
  OR CAST(ts AS TIME) > TIME '23:00:00' OR CAST(ts AS TIME) < TIME '00:30:00' AS articles_quiet FROM events
"""

# --- similarity -----------------------------------------------------------------------

_WORDS = vocab.CONTENT_KEYS + vocab.AUTHOR_KEYS + vocab.DATE_KEYS + ["example", "pills", "other"]

ORACLE["trigram_similarity"] = rf"""
WITH v AS (SELECT DISTINCT unnest(string_split_regex(lower({HOST}), '[.-]')) AS value FROM pages),
d AS (SELECT unnest({_list(_WORDS)}) AS word, unnest(range(0, {len(_WORDS)})) AS ord),
m AS (SELECT value, word, ord, {matches(grams('value'), grams('word'))} AS matches, length(word) + 2 AS n FROM v, d)
SELECT value, row_number() OVER (PARTITION BY value ORDER BY matches DESC, ord) - 1 AS rank, word,
  matches, CAST(round_even(matches * 100.0::DOUBLE / n, 0) AS BIGINT) AS similarity
FROM m WHERE matches * 100.0::DOUBLE / n >= 49
"""

ORACLE["trigram_similarity_join"] = f"""
WITH v AS (SELECT DISTINCT unnest({content_tokens("regexp_extract(html, '<title>(.*?)</title>', 1)", EN)}) AS value FROM pages),
w AS (SELECT DISTINCT unnest({content_tokens('text', EN)}) AS word FROM benchmark),
vg AS (SELECT value, gram, count(*) AS times FROM (SELECT value, unnest({grams('value')}) AS gram FROM v) GROUP BY ALL),
wg AS (SELECT DISTINCT word, unnest({grams('word')}) AS gram FROM w),
m AS (SELECT value, word, sum(times) AS matches, any_value(len({grams('word')})) AS n FROM vg JOIN wg USING (gram) GROUP BY value, word)
SELECT value, word, CAST(matches AS BIGINT) AS matches,
  CAST(round_even(matches * 100.0::DOUBLE / n, 0) AS BIGINT) AS similarity
FROM m WHERE matches * 100.0::DOUBLE / n >= 49
"""

_TYPE = ("CASE page_id % 4 WHEN 0 THEN 'text/html; charset=UTF-8' WHEN 1 THEN 'text/html' "
         "WHEN 2 THEN 'application/json' END")
ORACLE["content_type_html"] = f"""
WITH f AS (SELECT page_id, {_TYPE} AS kind FROM pages)
SELECT page_id, CASE WHEN kind IS NOT NULL
  THEN {matches(grams('kind'), grams("'text/html'"))} * 100.0 / 11 >= 49.5 END AS is_html FROM f
"""

ORACLE["fetch_status_class"] = """
SELECT page_id, CASE WHEN page_id % 10 IN (0, 1, 2) THEN 'Error' ELSE 'OK' END AS fetch FROM pages
"""

ORACLE["decode_bytes"] = "SELECT page_id, md5(html) AS html_md5 FROM pages"

# --- text -----------------------------------------------------------------------------

ORACLE["transliterate"] = f"SELECT doc_id, {strip(ascii_text('text'))} AS text FROM documents"


def one_line(text: str) -> str:
    return f"regexp_replace(replace({text}, '’', ''), '{SPACE}+', ' ', 'g')"


ORACLE["normalize_text"] = f"SELECT doc_id, trim({ascii_text(one_line('text'))}) AS text FROM documents"

ORACLE["tokens_no_stopwords"] = f"""
WITH t AS (SELECT doc_id, CASE WHEN lang = 'es' THEN {content_tokens('text', EN_ES)}
  ELSE {content_tokens('text', EN)} END AS t FROM documents)
SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM t
"""

ORACLE["new_tokens"] = f"""
WITH s AS (SELECT doc_id, {content_tokens("string_split(text, chr(10))[1]", EN)} AS h,
  {content_tokens("array_to_string(string_split(text, chr(10))[2:], chr(10))", EN)} AS r FROM documents),
n AS (SELECT doc_id, list_filter(r, lambda t: NOT list_contains(h, t)) AS n FROM s)
SELECT doc_id, len(n) AS n_new, md5(array_to_string(n, ' ')) AS new_md5 FROM n
"""

ORACLE["string_block_quality"] = f"""
WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: {strip('x')}),
  lambda x: x <> '') AS l FROM documents)
SELECT doc_id, len(l) AS n_lines, len(list_filter(l, lambda x: length(x) >= 30)) AS n_long,
  len(list_filter(l, lambda x: length(x) >= 100)) > 0 OR (len(l) > 0 AND 2 * len(list_filter(l, lambda x: length(x) >= 30)) >= len(l)
    AND length(array_to_string(l, chr(10) || chr(10))) >= 100) AS is_admitted FROM l
"""

ORACLE["date_mentions"] = f"""
SELECT o_orderkey, CAST(CASE o_orderkey % 11 WHEN 4 THEN 2 WHEN 5 THEN 0 ELSE 1 END AS BIGINT) AS n_dates,
  CASE WHEN o_orderkey % 11 <> 5 AND o_orderdate < TIMESTAMP '{AS_OF}'
       THEN strftime(o_orderdate, '%Y-%m-%d') END AS first_date FROM orders
"""

ORACLE["publish_date"] = f"""
SELECT o_orderkey, strftime(coalesce(least(
    CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END,
    CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate - INTERVAL 1 DAY END),
  TIMESTAMP '{AS_OF}'), '%Y-%m-%d %H:%M:%S') AS publish_date FROM orders
"""

_SAID = r"""
said AS (SELECT conv_id, turn, regexp_extract(text, '^(\S+)', 1) AS name FROM conversations),
firsts AS (SELECT conv_id, name, min(turn) AS turn FROM said GROUP BY conv_id, name),
ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM firsts)
"""
ORACLE["author_cap"] = f"""
WITH {_SAID} SELECT conv_id, string_agg(name, '|' ORDER BY turn) AS authors FROM ranked WHERE r <= 2 GROUP BY conv_id
"""

ORACLE["author_verification"] = f"""
WITH {_SAID}, people AS (SELECT DISTINCT name FROM said WHERE length(name) > 4),
listed AS (SELECT f.*, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r
           FROM firsts f SEMI JOIN people USING (name)),
kept AS (SELECT conv_id, string_agg(name, '|' ORDER BY turn) AS authors FROM listed WHERE r <= 2 GROUP BY conv_id),
every AS (SELECT conv_id, string_agg(name, '|' ORDER BY turn) AS names FROM said GROUP BY conv_id)
SELECT conv_id, coalesce(authors, names) AS authors FROM every LEFT JOIN kept USING (conv_id)
"""

# --- nodes ------------------------------------------------------------------------------

BARE = "regexp_replace(html, '(?s)<script>.*?</script>', '', 'g')"

ORACLE["tag_histogram"] = """
WITH t AS (SELECT unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)', 1)) AS tag
           FROM (SELECT regexp_replace(html, '(?s)(<script>).*?</script>', '\\1', 'g') AS html FROM pages))
SELECT tag, count(*) AS n FROM t GROUP BY tag
"""

_CUT = (r"regexp_replace(regexp_replace(regexp_replace(html, '(?s)<nav>.*?</nav>', '', 'g'), "
        r"'(?s)<style>.*?</style>', '', 'g'), '(?s)<script>.*?</script>', '', 'g')")
ORACLE["strip_tags"] = f"""
SELECT page_id, len(regexp_extract_all({_CUT}, '<[a-z]')) AS n_nodes,
  len(regexp_extract_all({_CUT}, '<a[ >]')) AS n_links FROM pages
"""


def unescaped(text: str) -> str:
    for name, character in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("#x27", "''"),
                            ("copy", "©"), ("middot", "·"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', '{character}', 'g')"
    return text


def strings(inner: str) -> str:
    """Stripped non-blank strings of a fragment, cut at its tags and comments."""
    cut = f"string_split_regex({inner}, '<[^>]*>')"
    return f"list_filter(list_transform({cut}, lambda x: {strip(unescaped('x'))}), lambda x: x <> '')"


ARTICLE = "regexp_extract(html, '(?s)<article>(.*?)</article>', 1)"
NAV = "regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1)"

ORACLE["text_blocks"] = f"""
WITH b AS (SELECT page_id, 'article' AS tag, {ARTICLE} AS inner_html FROM pages
           UNION ALL SELECT page_id, 'nav', {NAV} FROM pages),
s AS (SELECT page_id, tag, {strings('inner_html')} AS s, len(regexp_extract_all(inner_html, '<a href')) AS n_links FROM b)
SELECT page_id, tag, len(s) AS n_strings, n_links,
  len(s) = 0 OR n_links > 10 OR (n_links > 5 AND n_links::DOUBLE / len(s) > 0.6) AS is_link_heavy,
  md5(array_to_string(s, chr(10))) AS text_md5 FROM s
"""

BODY = f"regexp_extract({BARE}, '(?s)<body>(.*)', 1)"
ORACLE["link_density"] = f"""
WITH s AS (SELECT page_id, {strings(BODY)} AS s, len(regexp_extract_all({BODY}, '<a href')) AS n_links FROM pages)
SELECT page_id, n_links, len(s) = 0 OR n_links > 10 OR (n_links > 5 AND n_links::DOUBLE / len(s) > 0.6) AS is_link_heavy
FROM s
"""

ORACLE["page_language"] = """SELECT page_id, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS language FROM pages"""

ORACLE["meta_map"] = """
SELECT page_id, len(regexp_extract_all(html, '<meta ')) AS n_meta,
  regexp_extract(html, '<meta charset="([^"]*)"', 1) AS charset FROM pages
"""

# --- extraction ---------------------------------------------------------------------------

_OVERLAP = f"""
titles AS (SELECT page_id, url, html, {strip(unescaped("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"))} AS tag,
  {strip(unescaped("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))} AS h1 FROM pages),
tok AS (SELECT *, {tokens("upper(regexp_replace(tag, '[^\\p{L}\\p{N}]\\s', ' ', 'g'))")} AS tt, {tokens('upper(h1)')} AS ht FROM titles),
picked AS (SELECT *, CASE WHEN len(ht) >= 3 AND len(ht)::DOUBLE / len(tt) > 0.5
    AND len(list_filter(ht, lambda t: list_contains(tt, t)))::DOUBLE / len(ht) >= 0.75 THEN h1 ELSE tag END AS headline FROM tok),
titled AS (SELECT *, CASE WHEN regexp_matches(lower({ascii_text('headline')}),
    'page not found|attention required!|pagina no encontrada') OR headline = '' THEN NULL
    ELSE trim({ascii_text('headline')}) END AS title FROM picked)
"""

ORACLE["extract_title"] = f"WITH {_OVERLAP} SELECT page_id, title FROM titled"

ORACLE["page_identity"] = f"""
WITH {SITE}, {_OVERLAP} SELECT t.page_id, {CANON.replace('url', 't.url')} AS url, s.fqdn, t.title
FROM titled t JOIN site s USING (page_id)
"""

#: Body of a page: the article as one string if it is long enough and some token
#: of the headline resembles it, else the same for the block beside it.
_CONTENT = f"""
blocks AS (SELECT page_id, headline, title, html, url, {strings(ARTICLE)} AS a,
  {strings("regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1)")} AS d FROM titled),
bodies AS (SELECT *, array_to_string(a, chr(10)) AS atext, array_to_string(d, chr(10)) AS dtext,
  {content_tokens('headline', EN)} AS words FROM blocks),
spelled AS (SELECT *, string_split(upper('  ' || replace(atext, 'ß', 'SS') || '  '), '') AS ac,
  string_split(upper('  ' || replace(dtext, 'ß', 'SS') || '  '), '') AS dc FROM bodies),
judged AS (SELECT *, list_transform(range(1, len(ac) - 1), lambda i: ac[i] || ac[i + 1] || ac[i + 2]) AS ag,
  list_transform(range(1, len(dc) - 1), lambda i: dc[i] || dc[i + 1] || dc[i + 2]) AS dg,
  list_transform(words, lambda w: {grams('w')}) AS wg FROM spelled),
hits AS (SELECT *,
  len(list_filter(wg, lambda w: len(list_filter(ag, lambda g: list_contains(w, g))) * 100.0 / len(w) >= 49)) > 0 AS a_hit,
  len(list_filter(wg, lambda w: len(list_filter(dg, lambda g: list_contains(w, g))) * 100.0 / len(w) >= 49)) > 0 AS d_hit
  FROM judged),
content AS (SELECT page_id, title, url, html,
  trim({ascii_text(one_line("CASE WHEN length(atext) >= 100 AND a_hit THEN atext WHEN len(d) > len(a) AND length(dtext) >= 100 AND d_hit THEN dtext END"))}) AS content
  FROM hits)
"""

ORACLE["extract_content"] = f"WITH {_OVERLAP}, {_CONTENT} SELECT page_id, content FROM content"

ORACLE["news_record"] = f"""
WITH {_OVERLAP}, {_CONTENT}
SELECT page_id AS article_id, title AS article_title, {CANON} AS article_url,
  regexp_extract(html, '<html lang="([a-z]+)"', 1) AS article_language, 'web' AS article_media_type,
  '' AS authors, '{AS_OF}' AS published, CAST(0 AS BIGINT) AS n_images, CAST(0 AS BIGINT) AS n_videos,
  CAST(0 AS DOUBLE) AS article_ad_value, CAST(0 AS DOUBLE) AS article_pr_value, 'Done' AS article_status,
  'pressloom' AS created_by, md5(coalesce(content, '')) AS content_md5 FROM content
"""

_BY = f"""
byl AS (SELECT page_id, page_id % 4 AS form, date '2020-01-01' + CAST(page_id % 1000 AS INTEGER) AS day,
  regexp_extract({HOST}, '^([a-z]+)', 1) AS label FROM pages),
who AS (SELECT page_id, form, day, upper(label[1]) || lower(label[2:]) AS name FROM byl)
"""
ORACLE["extract_author"] = f"""
WITH {_BY} SELECT page_id, CASE form WHEN 0 THEN ltrim(name || ' Cruz') WHEN 1 THEN ltrim(name || ' Santos')
  WHEN 2 THEN nullif(name, '') END AS author FROM (SELECT page_id, form,
    CASE WHEN list_contains({EN}, lower(name)) THEN '' ELSE name END AS name FROM who)
"""
ORACLE["extract_date"] = f"""
WITH {_BY} SELECT page_id, CASE WHEN form <> 3 THEN strftime(day, '%Y-%m-%d') END AS published FROM who
"""
ORACLE["invalid_tag_prune"] = rf"""
WITH n AS (SELECT page_id, page_id % 4 AS form,
  len(regexp_extract_all({BARE}, '<[a-z]')) AS n FROM pages)
SELECT page_id, CAST(CASE form WHEN 1 THEN 1 ELSE 0 END AS BIGINT) AS n_removed,
  n + CASE form WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 2 ELSE 2 END AS n_left FROM n
"""

_OUTCOME = f"""
entry AS (SELECT c.page_id AS link_id, {CANON.replace('url', 'c.url')} AS article_url, c.title, c.content, c.html,
  coalesce(w.country IN ('Philippines', 'Singapore') AND NOT w.is_aggregator AND s.fqdn <> 'philstar.com', false) AS ok
  FROM content c JOIN site s USING (page_id) LEFT JOIN websites w ON w.fqdn = s.fqdn WHERE c.page_id % 17 <> 0),
tried AS (SELECT *, article_url IN (SELECT {CANON} FROM pages WHERE page_id % 6 = 0) AS is_stored FROM entry),
winner AS (SELECT article_url, min(link_id) AS first_id FROM tried
  WHERE ok AND NOT is_stored AND coalesce(title, '') <> '' AND coalesce(content, '') <> '' GROUP BY article_url),
outcome AS (SELECT t.*, CASE WHEN NOT ok THEN 'Website not for scraping'
  WHEN is_stored OR link_id > first_id THEN 'Duplicate article'
  WHEN coalesce(content, '') = '' THEN 'No Content' WHEN coalesce(title, '') = '' THEN 'No Title'
  ELSE 'Article Scraped' END AS outcome FROM tried t LEFT JOIN winner USING (article_url)),
reason AS (SELECT *, CASE outcome WHEN 'Website not for scraping' THEN 'Unverified Website'
  WHEN 'No Content' THEN 'Invalid Content' WHEN 'No Title' THEN 'Invalid article title' END AS error_status FROM outcome)
"""
_HARVEST = f"WITH {SITE}, {_OVERLAP}, {_CONTENT}, {_OUTCOME}"

ORACLE["harvest"] = f"{_HARVEST} SELECT link_id, article_url, outcome, error_status FROM reason"
ORACLE["harvest_articles"] = f"""{_HARVEST}
SELECT link_id AS article_id, article_url, title AS article_title,
  regexp_extract(html, '<html lang="([a-z]+)"', 1) AS article_language, md5(content) AS content_md5
FROM reason WHERE outcome = 'Article Scraped'"""
ORACLE["outcome_tally"] = f"{_HARVEST} SELECT outcome, count(*) AS n FROM reason GROUP BY outcome"
ORACLE["link_status_updates"] = f"""{_HARVEST}
SELECT link_id, CASE WHEN outcome = 'Article Scraped' THEN 'Done' ELSE 'Error' END AS status,
  CASE WHEN outcome = 'Duplicate article' THEN 'Duplicate Article Found in Database' ELSE error_status END AS error_status,
  CASE WHEN outcome NOT IN ('Article Scraped', 'No Content', 'No Title') THEN 'JS_Error' END AS created_by FROM reason"""

ORACLE["harvest_media"] = f"""{_HARVEST}
SELECT link_id AS article_id, w.website_id * 100 AS "global", w.website_id * 10 AS "local", 300.0::DOUBLE AS website_cost,
  md5(content) AS text_md5
FROM reason r JOIN site s ON s.page_id = r.link_id JOIN websites w ON w.fqdn = s.fqdn WHERE outcome = 'Article Scraped'"""

ORACLE["mapped_pages"] = "SELECT page_id, length(html) AS n_chars FROM pages"

ORACLE["candidate_lists"] = f"""
WITH {_OVERLAP}, {_CONTENT}
SELECT page_id, CAST(CASE WHEN length(atext) >= 100 THEN 1 END AS BIGINT) AS n_first,
  CAST(CASE WHEN len(d) > len(a) AND length(dtext) >= 100 THEN 1 END AS BIGINT) AS n_second FROM bodies
"""

ORACLE["largest_block"] = f"""
WITH b AS (SELECT page_id, 'article' AS tag, split_part({BARE}, '<article>', 1) AS head, {strings(ARTICLE)} AS s FROM pages
  UNION ALL SELECT page_id, 'div', split_part({BARE}, '<div class="ad">', 1),
    {strings("regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1)")} FROM pages)
SELECT page_id, tag, len(regexp_extract_all(head, '<[a-z]')) AS node_id, len(s) AS n_strings FROM b
"""

_STORED = f"article_url IN (SELECT {CANON} FROM pages WHERE page_id % 6 = 0) AS is_stored"
assert _STORED in _HARVEST

#: The stream starts with an empty store. Requeued links are read again, with the same
#: states: what was stored at first is a duplicate then.
ORACLE["stream_harvest"] = f"""{_HARVEST.replace(_STORED, "false AS is_stored")}
SELECT link_id, CASE WHEN outcome IN ('Article Scraped', 'Duplicate article') THEN 'Done' ELSE 'Error' END AS status,
  error_status FROM (SELECT * FROM reason UNION ALL SELECT * FROM reason WHERE link_id % 10 = 3)"""

#: Stored articles are read again whether or not others have the same URL.
ORACLE["stored_article_reread"] = f"""
WITH {SITE}, {_OVERLAP}, {_CONTENT},
firsts AS (SELECT {CANON} AS article_url, min(page_id) AS page_id FROM pages GROUP BY 1),
entry AS (SELECT p.page_id AS link_id, c.title, c.content,
  coalesce(w.country IN ('Philippines', 'Singapore') AND NOT w.is_aggregator AND s.fqdn <> 'philstar.com', false) AS ok
  FROM pages p JOIN firsts f ON f.article_url = {CANON.replace('url', 'p.url')} JOIN content c ON c.page_id = f.page_id
  JOIN site s ON s.page_id = p.page_id LEFT JOIN websites w ON w.fqdn = s.fqdn WHERE p.page_id % 6 = 0)
SELECT link_id, CASE WHEN NOT ok THEN 'Website not for scraping' WHEN coalesce(content, '') = '' THEN 'No Content'
  WHEN coalesce(title, '') = '' THEN 'No Title' ELSE 'Article Scraped' END AS outcome FROM entry
"""

#: The page that an entry reads decides its fault.
_FAULT = "CASE f.page_id % 11 WHEN 1 THEN 'No Title' WHEN 2 THEN 'No Content' WHEN 3 THEN 'Error' END"
ORACLE["article_status_updates"] = f"""
WITH {SITE}, {_OVERLAP}, {_CONTENT},
firsts AS (SELECT {CANON} AS article_url, min(page_id) FILTER (WHERE page_id % 11 <> 3) AS good_id, min(page_id) AS page_id
  FROM pages GROUP BY 1),
entry AS (SELECT p.page_id AS article_id, f.article_url, c.title, {_FAULT} AS fault, c.content,
  coalesce(w.country IN ('Philippines', 'Singapore') AND NOT w.is_aggregator AND s.fqdn <> 'philstar.com', false) AS ok
  FROM pages p JOIN firsts f ON f.article_url = {CANON.replace('url', 'p.url')} JOIN content c ON c.page_id = f.page_id
  JOIN site s ON s.page_id = p.page_id LEFT JOIN websites w ON w.fqdn = s.fqdn WHERE p.page_id % 6 = 0),
told AS (SELECT *, CASE WHEN NOT ok THEN 'Unverified Website' WHEN fault = 'Error' THEN 'no page source'
  WHEN fault = 'No Content' THEN 'Invalid Content' WHEN fault = 'No Title' THEN 'Invalid article title'
  WHEN coalesce(content, '') = '' THEN 'Invalid Content' WHEN coalesce(title, '') = '' THEN 'Invalid article title' END AS message FROM entry)
SELECT article_id, article_url, CASE WHEN message IS NULL THEN 'Done' ELSE 'Error' END AS article_status,
  message AS article_error_status, CASE WHEN message IS NULL THEN title ELSE 'old title' END AS article_title,
  'pressloom' AS updated_by, '2024-06-01' AS updated FROM told
"""

ORACLE["harvest_outcomes"] = f"""
WITH {SITE}, {_OVERLAP}, {_CONTENT},
firsts AS (SELECT url, min(page_id) AS page_id FROM pages GROUP BY 1),
entry AS (SELECT p.page_id AS link_id, {CANON.replace('url', 'p.url')} AS article_url, {_FAULT} AS fault, c.title, c.content,
  coalesce(w.country IN ('Philippines', 'Singapore') AND NOT w.is_aggregator AND s.fqdn <> 'philstar.com', false) AS ok
  FROM pages p JOIN firsts f ON f.url = p.url JOIN content c ON c.page_id = f.page_id
  JOIN site s ON s.page_id = p.page_id LEFT JOIN websites w ON w.fqdn = s.fqdn WHERE p.page_id % 17 <> 0),
tried AS (SELECT *, article_url IN (SELECT {CANON} FROM pages WHERE page_id % 6 = 0) AS is_stored,
  coalesce(fault, CASE WHEN coalesce(content, '') = '' THEN 'No Content' WHEN coalesce(title, '') = '' THEN 'No Title' END) AS bad FROM entry),
winner AS (SELECT article_url, min(link_id) AS first_id FROM tried WHERE ok AND NOT is_stored AND bad IS NULL GROUP BY article_url),
outcome AS (SELECT link_id, CASE WHEN NOT ok THEN 'Website not for scraping'
  WHEN is_stored OR link_id > first_id THEN 'Duplicate article' ELSE coalesce(bad, 'Article Scraped') END AS outcome
  FROM tried LEFT JOIN winner USING (article_url))
SELECT link_id, outcome, CASE outcome WHEN 'Website not for scraping' THEN 'Unverified Website' WHEN 'No Content' THEN 'Invalid Content'
  WHEN 'No Title' THEN 'Invalid article title' WHEN 'Error' THEN 'no page source' END AS error_status FROM outcome
"""

#: The pages with a byline and a date written into the article.
_BYLINED = f"""
{_BY}, bylined AS (SELECT p.page_id, p.url, replace(p.html, '<article>', '<article>' || CASE form
  WHEN 0 THEN '<span class="cse_author">By ' || name || ' Cruz</span><time class="entry-date">' || strftime(day, '%B %-d, %Y') || '</time>'
  WHEN 1 THEN '<div class="comments"><span class="author">Nobody</span></div><p class="byline">' || name
    || ', <b>Santos</b></p><span id="pubdate">Posted ' || strftime(day, '%Y-%m-%d') || '</span>'
  WHEN 2 THEN '<a rel="author" href="/x">' || name || '</a><p class="template">' || strftime(day, '%-d %b %Y') || '</p>'
  ELSE '<div id="a-very-long-author-marker">Nobody</div><time class="date">2099-01-01</time>' END) AS html
  FROM pages p JOIN who USING (page_id))
"""
ORACLE["rendered_record"] = f"""
WITH {_BYLINED}, {_OVERLAP.replace('FROM pages)', 'FROM bylined)')}, {_CONTENT},
by_author AS ({ORACLE['extract_author'].split(_BY)[1]}), by_date AS ({ORACLE['extract_date'].split(_BY)[1]})
SELECT c.page_id AS article_id, c.title AS article_title, coalesce(a.author, '') AS authors,
  coalesce(d.published, '{AS_OF[:10]}') AS published, length(nullif(c.content, '')) AS n_chars
FROM content c JOIN by_author a USING (page_id) JOIN by_date d USING (page_id)
"""
