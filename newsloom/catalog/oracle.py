"""The expected result of each query as DuckDB SQL over the same tables."""

from newsloom.sources.feeds import PROFILES

_SPACE = (
    r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_BLANK_LINE = "chr(10) || chr(10)"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def _unescape(x: str) -> str:
    for entity, raw in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"),
                        ("&copy;", "'©'"), ("&middot;", "'·'")):
        x = f"replace({x}, '{entity}', {raw})"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def _norm(url: str) -> str:
    """Normal form of the addresses in the pages table (no escapes, no repeats)."""
    kept = (
        f"array_to_string(list_filter(string_split(regexp_extract({url}, '\\?([^#]*)', 1), '&'), "
        "lambda x: x <> '' AND split_part(x, '=', 1) NOT IN ('utm_source', 'utm_medium', "
        "'utm_campaign', 'utm_term', 'utm_content', 'at_medium', 'at_campaign', 'at_custom1', "
        "'ns_mchannel', 'ns_source', 'ns_campaign')), '&')"
    )
    return (
        f"lower(regexp_extract({url}, '^[^:]+://[^/?#]*')) "
        f"|| rtrim(regexp_extract({url}, '^[^:]+://[^/?#]*([^?#]*)', 1), '/') "
        f"|| CASE WHEN {kept} = '' THEN '' ELSE '?' || {kept} END"
    )


def _id(url: str) -> str:
    return f"substring(sha1({url}), 1, 12)"


def _hash(title: str, content: str) -> str:
    return f"sha1({title} || '|' || {content})"


def _pieces(html: str, glue: str) -> str:
    """Text pieces between tags, stripped, joined by ``glue``, then unescaped."""
    return _unescape(
        f"array_to_string(list_filter(list_transform(string_split_regex({html}, '<[^>]*>'), "
        f"lambda s: {_strip('s')}), lambda s: s <> ''), '{glue}')"
    )


def _joined(texts: str) -> str:
    kept = f"list_filter({texts}, lambda t: length(t) >= 3)"
    return _strip(f"array_to_string({kept}, {_BLANK_LINE})")


# The pages table: every page has one h1 and one article.
_PAGES = f"""
parts AS (
  SELECT page_id, url, html,
         regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1, 's') AS h1,
         string_split(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '<p>')[2:] AS ps
  FROM pages),
texts AS (
  SELECT page_id, {_norm('url')} AS url, {_pieces('h1', '')} AS title,
         list_transform(ps, lambda p: {_pieces('p', ' ')}) AS ps
  FROM parts),
extracted AS (
  SELECT page_id, url, {_id('url')} AS id_article, title, content,
         {_hash('title', 'content')} AS content_hash,
         regexp_extract(url, '^[^:]+://[^/?#]*/([^/?#]+)', 1) AS category
  FROM (SELECT page_id, url, title, {_joined('ps')} AS content FROM texts))
"""


def _walk(keys: str) -> str:
    """Sequential two-key rule over ``keys(ord, id, hash)``; one row per key row."""
    return f"""
ranked AS (SELECT row_number() OVER (ORDER BY ord) AS n, ord, id, hash FROM ({keys})),
walk AS (
  SELECT 0::BIGINT AS n, false AS kept, false AS id_seen,
         []::VARCHAR[] AS ids, []::VARCHAR[] AS hashes
  UNION ALL
  SELECT r.n, r.ok, r.id_seen,
         CASE WHEN r.ok THEN list_append(r.ids, r.id) ELSE r.ids END,
         CASE WHEN r.ok THEN list_append(r.hashes, r.hash) ELSE r.hashes END
  FROM (SELECT k.n, k.id, k.hash, w.ids, w.hashes, list_contains(w.ids, k.id) AS id_seen,
               NOT list_contains(w.ids, k.id) AND NOT list_contains(w.hashes, k.hash) AS ok
        FROM walk w JOIN ranked k ON k.n = w.n + 1) r),
decided AS (
  SELECT ranked.ord, walk.kept,
         CASE WHEN walk.kept THEN 'accepted' WHEN walk.id_seen THEN 'dup_id'
              ELSE 'dup_hash' END AS outcome
  FROM walk JOIN ranked USING (n))
"""


_GOOD_PAGES = "SELECT page_id AS ord, id_article AS id, content_hash AS hash FROM extracted WHERE length(content) >= 200"

_FIRST_LABEL = (
    "upper(substring({h}, 1, 1)) || lower(substring({h}, 2))".replace(
        "{h}", "split_part(replace(host, 'www.', ''), '.', 1)"
    )
)



def _configured() -> str:
    """The configured feeds as rows of SQL."""
    def text(x: str | None) -> str:
        return "NULL" if x is None else "'" + x.replace("'", "''") + "'"

    return ", ".join(
        f"({text(profile)}, {i}, {len(feeds)}, {text(category)}, {text(url)}, {text(policy)}, {text(value)})"
        for profile, (policy, value, _, feeds) in PROFILES.items()
        for i, (category, url) in enumerate(feeds)
    )


# --- rendered pages -----------------------------------------------------------

_LINES = _joined(f"list_transform(string_split(text, chr(10)), lambda s: {_strip('s')})")
_FIRST_LINE = _joined(f"[{_strip('split_part(text, chr(10), 1)')}]")
_TWICE = _strip("text || ' ' || text")
_REQUEST = (
    "'https://www.news.example.com/' || lang || '/' || doc_id || '?id=' || doc_id"
)


def _tag_list(text: str) -> str:
    cut = (
        f"list_filter(list_transform(string_split({text}, ','), lambda s: lower({_strip('s')})), "
        "lambda s: s <> '')"
    )
    return f"nullif(array_to_string({cut}, ', '), '')"


_LISTED = "lower(lang) || ', ' || source || ', ' || lower(lang)"
_AUTHOR = "CASE doc_id % 5 WHEN 0 THEN source WHEN 1 THEN lang WHEN 3 THEN '' END"
_IMAGE = "CASE WHEN doc_id % 2 = 0 THEN 'https://img.example.com/' || doc_id || '.jpg?a=1&b=2' END"
_TAGS = (
    f"CASE doc_id % 5 WHEN 0 THEN {_LISTED} WHEN 2 THEN 'a, b c' WHEN 4 THEN {_tag_list('text')} END"
)
_YMD = (
    "'2025-' || lpad((doc_id % 12 + 1)::VARCHAR, 2, '0') || '-' || "
    "lpad((doc_id % 28 + 1)::VARCHAR, 2, '0')"
)
_CLOCK = (
    "lpad((doc_id % 24)::VARCHAR, 2, '0') || ':' || lpad((doc_id % 60)::VARCHAR, 2, '0') || ':05'"
)
_DATE = f"""CASE doc_id % 7
  WHEN 0 THEN {_YMD} || 'T' || {_CLOCK} || '+00:00'
  WHEN 1 THEN '2025-12-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') || 'T' || {_CLOCK} || '+02:00'
  WHEN 2 THEN {_YMD} || 'T00:00:00'
  WHEN 5 THEN {_YMD} || 'T' || {_CLOCK} || '.250000-03:30' END"""

# --- feeds --------------------------------------------------------------------

_LINK = """CASE WHEN doc_id % 13 = 3 THEN NULL WHEN doc_id % 13 = 5 THEN ''
  WHEN doc_id % 13 = 7 THEN 'http://[broken/' || doc_id
  ELSE 'https://News.example.com/' || target || '/?at_medium=rss#x' END"""
_ENTRIES = f"""
entries AS (
  SELECT *, {_LINK} AS link,
         CASE feed_ord % 3 WHEN 0 THEN 'constant' WHEN 1 THEN 'host' ELSE 'label' END AS profile,
         'c' || (feed_ord % 4) AS category
  FROM (SELECT doc_id, lang, source, (doc_id // 100)::INTEGER AS feed_ord,
               CASE WHEN doc_id % 9 = 4 THEN doc_id - 1 ELSE doc_id END AS target,
               row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) - 1 AS entry_ord
        FROM documents)
  WHERE feed_ord % 10 <> 8)
"""

# Newest loaded landing per entry target, and its article.
_CRAWL = f"""
{_ENTRIES},
landed AS (
  SELECT doc_id AS target, lang AS title, {_AUTHOR} AS author, {_IMAGE} AS image, {_TAGS} AS tags,
         {_DATE} AS published_date,
         CASE WHEN doc_id % 11 NOT IN (6, 8) THEN {_LINES} ELSE 'old landing' END AS content
  FROM documents WHERE doc_id % 11 NOT IN (6, 8) OR doc_id % 3 = 1),
visited AS (
  SELECT e.profile, e.feed_ord, e.entry_ord, e.category, l.title, l.author, l.image, l.tags,
         l.published_date, l.content, 'https://news.example.com/' || e.target AS url,
         CASE WHEN e.link LIKE 'http://[%' THEN 'bad_link' WHEN l.target IS NULL THEN 'no_page'
              WHEN length(l.content) < 200 THEN 'thin' END AS reason,
         lpad(e.feed_ord::VARCHAR, 9, '0') || '-' || lpad(e.entry_ord::VARCHAR, 9, '0') AS ord
  FROM entries e LEFT JOIN landed l USING (target)
  WHERE e.link <> ''),
{_walk(f'''SELECT ord, profile || {_id('url')} AS id, profile || {_hash('title', 'content')} AS hash
           FROM visited WHERE reason IS NULL''')}
"""

# Configured feeds that give no entry.
_FAILED = """
SELECT CASE feed_ord % 3 WHEN 0 THEN 'constant' WHEN 1 THEN 'host' ELSE 'label' END AS profile, feed_ord,
       'c' || (feed_ord % 4) AS category, outcome
FROM (SELECT DISTINCT (doc_id // 100)::INTEGER AS feed_ord, 'bad_feed' AS outcome FROM documents
      WHERE doc_id // 100 % 10 = 8
      UNION ALL SELECT DISTINCT (doc_id // 100)::INTEGER + 500000, 'no_feed' FROM documents
      WHERE doc_id // 100 % 10 = 0)
"""

_STORED = f"""
rows AS (
  SELECT doc_id, lang, source, text, {_id("'https://news.example.com/' || (doc_id // 3)")} AS id_article,
         'https://news.example.com/' || (doc_id // 3) AS url,
         {_hash('lang', 'text')} AS content_hash
  FROM documents)
"""
_ROW_TAGS = "CASE WHEN doc_id % 2 = 0 THEN lang || ', ' || source END"
_ROW_AUTHOR = "CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'say \"' || lang || '\", \\' END"

ORACLE: dict[str, str] = {
    "articles": f"""
WITH RECURSIVE {_PAGES}, {_walk(_GOOD_PAGES)}
SELECT e.id_article, e.title, NULL::VARCHAR AS tags, e.content, e.url, e.category,
       replace(regexp_extract(e.url, '//([^/?#]*)', 1), 'www.', '') AS source,
       NULL::VARCHAR AS author, NULL::VARCHAR AS image, NULL::VARCHAR AS published_date,
       e.content_hash
FROM extracted e JOIN decided d ON d.ord = e.page_id WHERE d.kept""",
    "articles_full": f"""
WITH RECURSIVE {_PAGES},
whole AS (
  SELECT page_id, url, id_article, title, category, content, {_hash('title', 'content')} AS content_hash
  FROM (SELECT e.* EXCLUDE (content, content_hash),
               CASE WHEN length(main) < 800 AND length(content) > length(main) THEN content ELSE main END AS content
        FROM extracted e JOIN (SELECT page_id, {_pieces("regexp_extract(html, '<article>(.*?)</article>', 1, 's')", ' ')} AS main
                               FROM pages) USING (page_id))),
{_walk("SELECT page_id AS ord, id_article AS id, content_hash AS hash FROM whole WHERE length(content) >= 200")}
SELECT id_article, title, NULL::VARCHAR AS tags, content, url, category, {_FIRST_LABEL} AS source,
       NULL::VARCHAR AS author, NULL::VARCHAR AS image, NULL::VARCHAR AS published_date, content_hash
FROM (SELECT *, regexp_extract(url, '//([^/?#]*)', 1) AS host FROM whole) JOIN decided ON ord = page_id WHERE kept""",
    "normalize_url": f"SELECT page_id, {_norm('url')} AS norm_url FROM pages",
    "normalize_url_encoded": """
SELECT doc_id, 'http://user@x.example.com:80/' || lang || '?b=' || source || '&text='
       || replace(url_encode(text), '%20', '+') || '&blank=' AS norm_url
FROM documents""",
    "source_name": f"""
SELECT page_id, policy AS source_policy,
       CASE policy WHEN 'constant' THEN 'Wire' WHEN 'host' THEN replace(host, 'www.', '')
            ELSE {_FIRST_LABEL} END AS source
FROM (SELECT page_id, lower(regexp_extract(url, '//([^/?#]*)', 1)) AS host FROM pages),
     (SELECT unnest(['constant', 'host', 'first_label']) AS policy)""",
    "article_ids": f"SELECT page_id, {_id(_norm('url'))} AS id_article FROM pages",
    "content_hash": f"WITH {_PAGES} SELECT page_id, content_hash FROM extracted",
    "content_hash_documents": f"SELECT doc_id, {_hash('lang', 'text')} AS content_hash FROM documents",
    "pages_ok": """
SELECT page_id, url FROM pages
WHERE NOT contains(url, 'utm_source') AND (contains(url, '?page=') OR NOT ends_with(url, '/'))""",
    "articles_loaded": f"""
WITH {_PAGES}
SELECT e.page_id AS entry_ord, id_article, content_hash FROM extracted e JOIN pages p USING (page_id)
WHERE length(content) >= 200 AND NOT contains(p.url, 'utm_source')
  AND (contains(p.url, '?page=') OR NOT ends_with(p.url, '/'))""",
    "dom_nodes": """
SELECT page_id, length(regexp_extract_all(html, '<h1[ >]')) AS n_h1,
       length(regexp_extract_all(html, '<p[ >]')) AS n_p,
       length(regexp_extract_all(html, '<a[ >]')) AS n_a,
       length(regexp_extract_all(html, '<li[ >]')) AS n_li
FROM pages""",
    "titles": f"WITH {_PAGES} SELECT page_id, title FROM texts",
    "paragraphs": f"""
WITH {_PAGES}
SELECT page_id, pos - 1 AS pos, ps[pos] AS text
FROM (SELECT page_id, ps, unnest(range(1, length(ps) + 1)) AS pos FROM texts)""",
    "clean_paragraphs": f"WITH {_PAGES} SELECT page_id, content FROM extracted",
    "main_content": f"""
SELECT page_id, {_pieces("regexp_extract(html, '<article>(.*?)</article>', 1, 's')", ' ')} AS main_text FROM pages""",
    "main_content_split": f"""
SELECT doc_id AS page_id, array_to_string(list_filter([once, once, once, once, once], lambda x: x <> ''), ' ') AS main_text
FROM (SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda s: {_strip('s')}),
                                                 lambda t: t <> ''), ' ') AS once FROM documents)""",
    "configured_sources": f"""
SELECT doc_id, profile, feed_ord, category, feed_url,
       CASE policy WHEN 'constant' THEN value WHEN 'host' THEN host
            ELSE upper(substring(host, 1, 1)) || substring(split_part(host, '.', 1), 2) END AS source
FROM (SELECT doc_id, 'site' || lower(source) || '.example' AS host FROM documents) d
JOIN (VALUES {_configured()}) f(profile, feed_ord, n, category, feed_url, policy, value) ON doc_id % n = feed_ord""",
    "not_thin": f"""
WITH {_PAGES} SELECT page_id, length(content) AS n_chars FROM extracted WHERE length(content) >= 200""",
    "dedup_articles": f"""
WITH RECURSIVE {_PAGES}, {_walk(_GOOD_PAGES)}
SELECT e.page_id AS entry_ord, e.id_article, e.content_hash
FROM extracted e JOIN decided d ON d.ord = e.page_id WHERE d.kept""",
    "dedup_repeated": f"""
WITH RECURSIVE {_STORED},
{_walk("SELECT DISTINCT lpad((doc_id // 2)::VARCHAR, 12, '0') || id_article || content_hash AS ord, id_article AS id, content_hash AS hash FROM rows")}
SELECT DISTINCT doc_id // 2 AS entry_ord, id_article, content_hash
FROM rows JOIN decided ON ord = lpad((doc_id // 2)::VARCHAR, 12, '0') || id_article || content_hash WHERE kept""",
    "dedup_profiles": f"""
WITH RECURSIVE {_STORED},
{_walk("SELECT doc_id AS ord, source || id_article AS id, source || content_hash AS hash FROM rows")}
SELECT source AS profile, doc_id AS entry_ord, id_article, content_hash
FROM rows JOIN decided ON ord = doc_id WHERE kept""",
    "run_report": f"""
WITH RECURSIVE {_PAGES}, {_walk(_GOOD_PAGES)}
SELECT 'default' AS profile, e.category, coalesce(d.outcome, 'thin') AS outcome, count(*) AS n
FROM extracted e LEFT JOIN decided d ON d.ord = e.page_id GROUP BY ALL""",
    "feed_entries": f"""
WITH {_ENTRIES}
SELECT profile, feed_ord, entry_ord, category, link FROM entries WHERE link <> ''""",
    "feed_landings": f"""
WITH {_ENTRIES}
SELECT profile, feed_ord, entry_ord, category, link FROM entries WHERE link <> ''""",
    "entries_capped": f"""
WITH {_ENTRIES}
SELECT profile, feed_ord, entry_ord, nullif(link, '') AS link FROM entries WHERE entry_ord < 25""",
    "entries_capped_table": f"""
SELECT lang AS profile, doc_id AS entry_ord, {_LINK} AS link
FROM (SELECT *, CASE WHEN doc_id % 9 = 4 THEN doc_id - 1 ELSE doc_id END AS target,
             row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS pos FROM documents)
WHERE pos <= 60""",
    "entries_linked": f"""
SELECT doc_id AS entry_ord, {_LINK} AS link
FROM (SELECT *, CASE WHEN doc_id % 9 = 4 THEN doc_id - 1 ELSE doc_id END AS target FROM documents)
WHERE {_LINK} <> ''""",
    "entry_pages": f"""
WITH e AS (
  SELECT doc_id, {_LINK} AS link, target
  FROM (SELECT *, CASE WHEN doc_id % 9 = 4 THEN doc_id - 1 ELSE doc_id END AS target FROM documents)),
landed AS (
  SELECT doc_id AS target, CASE WHEN doc_id % 11 NOT IN (6, 8) THEN doc_id * 2 + 1 ELSE doc_id * 2 END AS page_id
  FROM documents WHERE doc_id % 11 NOT IN (6, 8) OR doc_id % 3 = 1)
SELECT e.doc_id AS entry_ord,
       CASE WHEN e.link LIKE 'http://[%' THEN NULL ELSE 'https://news.example.com/' || target END AS norm_url,
       CASE WHEN e.link LIKE 'http://[%' THEN NULL ELSE l.page_id END AS page_id,
       CASE WHEN e.link LIKE 'http://[%' THEN 'bad_link' WHEN l.page_id IS NULL THEN 'no_page' END AS reject_reason
FROM e LEFT JOIN landed l USING (target) WHERE e.link <> ''""",
    "canonical_url": f"""
SELECT page_id, url, norm_url, {_id('url')} AS id_article
FROM (SELECT doc_id AS page_id, {_REQUEST} AS norm_url,
             CASE doc_id % 4 WHEN 0 THEN 'https://canon.example.org/' || source || '/' || doc_id
                             WHEN 3 THEN '/' || source || '/' || doc_id ELSE {_REQUEST} END AS url
      FROM documents)""",
    "meta_fields": f"""
SELECT doc_id AS page_id,
       CASE doc_id % 3 WHEN 0 THEN 'Title' || doc_id || '&' WHEN 1 THEN text
            ELSE '' END AS title,
       {_AUTHOR} AS author, {_IMAGE} AS image
FROM documents""",
    "tags": f"SELECT doc_id AS page_id, {_TAGS} AS tags FROM documents",
    "published_date": f"""
SELECT page_id, published_date,
       epoch_us((CASE WHEN regexp_matches(published_date, '[+-]..:..$') THEN published_date
                      ELSE published_date || '+00:00' END)::TIMESTAMPTZ) AS published_us
FROM (SELECT doc_id AS page_id, {_DATE} AS published_date FROM documents)""",
    "jsonld_body": f"""
SELECT doc_id AS page_id,
       CASE doc_id % 6 WHEN 1 THEN {_strip('text')} WHEN 3 THEN {_TWICE} ELSE '' END AS jsonld_text
FROM documents
UNION ALL SELECT -doc_id - 1, '' FROM documents WHERE doc_id % 6 IN (2, 4)""",
    "amp_body": f"""
SELECT doc_id AS page_id, CASE WHEN doc_id % 6 = 2 THEN {_LINES} ELSE '' END AS amp_text
FROM documents
UNION ALL SELECT -doc_id - 1, '' FROM documents WHERE doc_id % 6 IN (2, 4)""",
    "article_body": f"""
SELECT doc_id AS page_id,
       CASE doc_id % 6
         WHEN 1 THEN json_text
         WHEN 2 THEN CASE WHEN length(first_line) < 800 AND length(lines) > length(first_line)
                          THEN lines ELSE first_line END
         WHEN 3 THEN CASE WHEN length(lines) < 800 AND length(text || ' ' || text) > length(lines)
                          THEN twice ELSE lines END
         WHEN 4 THEN first_line ELSE lines END AS body
FROM (SELECT *, {_LINES} AS lines, {_FIRST_LINE} AS first_line, {_TWICE} AS twice,
             {_strip('text')} AS json_text FROM documents)
UNION ALL SELECT -doc_id - 1, {_LINES} FROM documents WHERE doc_id % 6 IN (2, 4)""",
    "existing_keys": f"WITH {_STORED} SELECT id_article, content_hash FROM rows WHERE source < 'src15'",
    "new_by_id": f"""
WITH {_STORED}
SELECT doc_id AS entry_ord, id_article FROM rows
WHERE source >= 'src15' AND id_article NOT IN (SELECT id_article FROM rows WHERE source < 'src15')""",
    "new_by_hash": f"""
WITH {_STORED}
SELECT doc_id AS entry_ord, id_article, content_hash FROM rows
WHERE source >= 'src15' AND id_article NOT IN (SELECT id_article FROM rows WHERE source < 'src15')
  AND content_hash NOT IN (SELECT content_hash FROM rows WHERE source < 'src15')""",
    "append_roundtrip": f"""
WITH {_STORED}
SELECT id_article, lang AS title, {_ROW_TAGS} AS tags, text AS content, url, lang AS category, source,
       {_ROW_AUTHOR} AS author, NULL::VARCHAR AS image,
       '2025-12-01T10:00:00+02:00' AS published_date, content_hash, lang AS profile,
       0::INTEGER AS feed_ord, doc_id AS entry_ord,
       epoch_us(TIMESTAMP '2025-12-01 08:00:00') AS published_us
FROM rows""",
    "csv_roundtrip": f"""
WITH {_STORED}
SELECT id_article, lang AS title, {_ROW_TAGS} AS tags, nullif(text, '') AS content, url,
       lang AS category, source, nullif({_ROW_AUTHOR}, '') AS author, NULL::VARCHAR AS image,
       '2025-12-01T10:00:00+02:00' AS published_date, content_hash
FROM rows""",
    "ingest_twice": f"""
WITH RECURSIVE {_STORED},
scoped AS (SELECT *, CASE WHEN lang = 'en' THEN 'en' ELSE 'other' END AS profile FROM rows),
{_walk('''SELECT (CASE WHEN source < 'src15' THEN '0' ELSE '1' END) || lpad(doc_id::VARCHAR, 12, '0') AS ord,
                 profile || id_article AS id, profile || content_hash AS hash FROM scoped''')}
SELECT profile, doc_id AS entry_ord, id_article, content_hash
FROM scoped JOIN decided ON substring(ord, 2)::BIGINT = doc_id WHERE kept""",
    "incremental_ingest": f"""
WITH RECURSIVE {_PAGES},
{_walk('''SELECT (CASE WHEN url LIKE 'https:%' THEN '0' ELSE '1' END) || lpad(page_id::VARCHAR, 12, '0') AS ord,
                 id_article AS id, content_hash AS hash FROM extracted WHERE length(content) >= 200''')}
SELECT e.page_id AS entry_ord, e.id_article, e.content_hash, e.category
FROM extracted e JOIN decided d ON substring(d.ord, 2)::BIGINT = e.page_id WHERE d.kept""",
    "stream_report": f"""
WITH RECURSIVE {_PAGES}, {_walk(_GOOD_PAGES)}
SELECT 'default' AS profile, e.category, coalesce(d.outcome, 'thin') AS outcome, count(*) AS n
FROM extracted e LEFT JOIN decided d ON d.ord = e.page_id GROUP BY ALL""",
    "late_twins": f"""
WITH texts AS (
  SELECT doc_id, lang, {_LINES} AS lines, {_FIRST_LINE} AS first_line FROM documents),
landed AS (
  SELECT doc_id AS entry_ord, doc_id::VARCHAR AS title, {_REQUEST} AS url,
         CASE WHEN doc_id % 4 <> 3 AND length(first_line) < 800 AND length(lines) > length(first_line)
              THEN lines ELSE first_line END AS content
  FROM texts
  UNION ALL
  SELECT -doc_id - 1, 'amp ' || doc_id, 'https://amp.example.com/' || lang || '/' || doc_id, lines
  FROM texts WHERE doc_id % 4 <> 3)
SELECT entry_ord, {_id('url')} AS id_article, {_hash('title', 'content')} AS content_hash, title
FROM landed WHERE length(content) >= 200""",
    "crawl_articles": f"""
WITH RECURSIVE {_CRAWL}
SELECT {_id('url')} AS id_article, title, tags, content, url, category,
       CASE profile WHEN 'constant' THEN 'Wire' WHEN 'host' THEN 'news.example.com' ELSE 'News' END AS source,
       author, image, published_date, {_hash('title', 'content')} AS content_hash, profile, feed_ord, entry_ord
FROM visited JOIN decided USING (ord) WHERE kept""",
    "crawl_report": f"""
WITH RECURSIVE {_CRAWL}
SELECT profile, category, outcome, count(*) AS n
FROM (SELECT profile, category, coalesce(reason, outcome) AS outcome FROM visited LEFT JOIN decided USING (ord)
      UNION ALL SELECT profile, category, outcome FROM ({_FAILED}))
GROUP BY ALL""",
    "rejects": f"""
WITH RECURSIVE {_CRAWL}
SELECT profile, feed_ord, entry_ord, coalesce(reason, outcome) AS outcome
FROM visited LEFT JOIN decided USING (ord) WHERE NOT coalesce(kept, false)
UNION ALL SELECT profile, feed_ord, NULL, outcome FROM ({_FAILED})""",
}
