"""The same queries as SQL for DuckDB, written from the rules, not from the Spark code.

RE2 has no look-around; its ``\\b`` is ASCII, which is what the word rules want.
"""

from __future__ import annotations

from checks import views as V
from pressmill.functions.sentences import ABBREVIATIONS

_WS = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_NL = "chr(10)"


def _trim(x: str) -> str:
    return f"trim({x}, {_WS})"


def _squeeze(x: str) -> str:
    return rf"regexp_replace({x}, '[ \t\n]+', ' ', 'g')"


def _in(values) -> str:
    return "(" + ", ".join(map(V.quoted, values)) + ")"


# -- F -------------------------------------------------------------------------

_RULE = r"""
CASE
  WHEN source = 'Reuters' AND regexp_matches(url, '\b(MW|BW)\b') THEN 'reuters_url'
  WHEN source = 'Reuters' AND (regexp_matches(content, '\bPRNewswire\b')
       OR regexp_matches(content, '\b(Reuters Life!)\b')) THEN 'reuters_content'
  WHEN source = 'Reuters' AND (regexp_matches(title, '\b(UPDATE|REFILE)\b')
       OR starts_with(title, 'REG ') OR starts_with(title, 'RCS ')
       OR starts_with(title, 'DIARY')) THEN 'reuters_title'
  WHEN source = 'UPI' AND (
       regexp_matches(title, '\b(COL|NBA |NHL|MLB|NFL|Nadal|UPI NewsTrack)\b')
       OR regexp_matches(content, '\b(COL|NBA |NHL|MLB|NFL|Nadal|UPI NewsTrack)\b'))
       THEN 'upi_words'
  WHEN source = 'XNA' AND starts_with(upper(title), 'FLASH:') THEN 'xna_flash'
  WHEN source = 'BBC' AND (contains(title, 'World News for Schools')
       OR contains(url, 'magazine')) THEN 'bbc_section'
  ELSE 'kept'
END"""

_RULED = f"{V.ARTICLES_SQL}, ruled AS (SELECT *, {_RULE} AS rule FROM articles)"

# -- N -------------------------------------------------------------------------


def _ascii(x: str) -> str:
    """Covers the characters the views hold."""
    pairs = (
        ("ß", "ss"), ("“", '"'), ("”", '"'), ("…", "..."), ("—", "--"), ("£", "PS"), ("*", ""), ("#", ""),
    )
    for a, b in pairs:
        x = f"replace({x}, {V.quoted(a)}, {V.quoted(b)})"
    return f"strip_accents({x})"


def _boilerplate(x: str) -> str:
    rules = (
        (r"(?i-s)^.*? TYPE: O?CN\s*\)\)", "''", ""),
        (r"(?i-s)^.*?new lede,\s+\d+\)\)", "''", ""),
        (r"(?is)_Some information for this report.*", "''", ""),
        (r"[\n\r]+", _NL, "g"),
        (r"(?s)_NEW:.+", "''", ""),
        (r"_WikiLeaks_", "'WikiLeaks'", "g"),
        (r"(?i)Please turn on JavaScript\. Media requires JavaScript to play\.", "''", "g"),
    )
    for pattern, to, how in rules:
        x = f"regexp_replace({x}, {V.quoted(pattern)}, {to}, '{how}')"
    return x


def _cleaned(rows: str) -> str:
    return f"""
cleaned AS (
  SELECT doc_id, source, query, date, url, {_ascii('title')} AS title,
         {_boilerplate(_ascii('content'))} AS content
  FROM {rows}
)"""


# -- G -------------------------------------------------------------------------


def _split(rows: str, column: str) -> str:
    """``sentences(doc_id, place, sentence)``: candidates, then one step per piece that
    either closes the open text or goes on; ``place`` orders a document's sentences."""
    abbreviations = _in(ABBREVIATIONS)
    return rf"""
cut AS (
  SELECT doc_id, string_split(regexp_replace({column}, '([.?!])(\s+)([A-Z"\d+(])',
         '\1' || chr(1) || '\2\3', 'g'), chr(1)) AS pieces
  FROM {rows}
),
piece AS (
  SELECT doc_id, len(pieces) AS n, unnest(pieces) AS piece,
         unnest(range(1, len(pieces) + 1)) AS i
  FROM cut
),
step AS (
  SELECT doc_id, n, 0::BIGINT AS i, '' AS open_text, FALSE AS ended, NULL::VARCHAR AS sentence
  FROM (SELECT DISTINCT doc_id, n FROM piece)
  UNION ALL
  SELECT doc_id, n, i, CASE WHEN ended THEN '' ELSE p END, ended,
         CASE WHEN (ended OR i = n) AND len > 20 AND len < 512 THEN {_trim('p')} END
  FROM (
    SELECT *, i < n AND NOT initial AND NOT abbreviated AND brackets AND quotes AS ended,
           length(p) - (i < n)::INT AS len
    FROM (
      SELECT *, regexp_matches(p, ' [A-Z]\.$') AS initial,
             length(p) - length(word) - 1 > 0 AND lower(word) IN {abbreviations} AS abbreviated,
             length(replace(p, '(', '')) = length(replace(p, ')', '')) AS brackets,
             (length(p) - length(replace(p, '"', ''))) % 2 = 0 AS quotes
      FROM (
        SELECT *, string_split(p, ' ')[-1] AS word
        FROM (
          SELECT step.doc_id, step.n, step.i + 1 AS i,
                 CASE WHEN step.ended THEN ltrim(piece.piece, {_WS})
                      ELSE step.open_text || piece.piece END AS p
          FROM step JOIN piece ON piece.doc_id = step.doc_id AND piece.i = step.i + 1
        )
      )
    )
  )
),
any_kept AS (SELECT doc_id, count(sentence) > 0 AS found FROM step GROUP BY doc_id),
sentences AS (
  SELECT doc_id, i AS place, CASE WHEN found THEN sentence ELSE {_trim('open_text')} END AS sentence
  FROM step JOIN any_kept USING (doc_id)
  WHERE sentence IS NOT NULL OR (NOT found AND i = n)
)"""


#: G10-G12, F10, F11 on ``sentences``: numbered rows of the articles that remain.
_KEPT = rf"""
quoted_out AS (
  SELECT doc_id, place, sentence FROM sentences
  WHERE sentence <> '' AND NOT regexp_matches(sentence, '(?s)^(''.*''|".*")')
    AND NOT contains(sentence, 'View the slide show')
),
numbered AS (
  SELECT doc_id, sentence,
         CAST(row_number() OVER (PARTITION BY doc_id ORDER BY place) AS INTEGER) AS sentence_no
  FROM quoted_out
),
kept AS (
  SELECT doc_id, sentence_no,
         CASE WHEN sentence_no = 1 AND regexp_matches(sentence, '(?-s)^.*?Reuters -')
              THEN regexp_replace(sentence, '(?-s).*?Reuters -', '', 'g')
              ELSE sentence END AS sentence
  FROM numbered
  WHERE doc_id NOT IN (SELECT doc_id FROM numbered WHERE sentence_no = 1
                       AND contains(sentence, 'NEW YORK (Hollywood Reporter)'))
)"""

_SPLIT_ARTICLES = (
    f"WITH RECURSIVE {V.ARTICLES_SQL}, {_cleaned('articles')}, {_split('cleaned', 'content')}, {_KEPT}"
)

_NUMBERED = f"""
WITH RECURSIVE {_RULED}, passed AS (SELECT * FROM ruled WHERE rule = 'kept'),
{_cleaned('passed')}, {_split('cleaned', 'content')}, {_KEPT},
article AS (
  SELECT cleaned.*, row_number() OVER (PARTITION BY source ORDER BY date, doc_id) AS article_no
  FROM cleaned WHERE doc_id IN (SELECT doc_id FROM kept)
)"""


def _rid(sentence_no: str) -> str:
    return f"date || ' ' || source || '-' || format('{{:07d}}', article_no) || '-' || {sentence_no}"


_LEAD = _trim(f"replace(replace(sentence, {_NL}, ''), chr(13), '')")

_SENTENCE_LINE = f"{_rid('sentence_no')} || {_NL} || replace(sentence, {_NL}, '') || {_NL}"
_LEAD_LINE = f"{_rid('1')} || {_NL} || {_LEAD} || {_NL}"
_QUOTE = "chr(39)"
_INDEX_LINE = (
    f"{_rid('1')} || ' ' || {_QUOTE} || replace(replace(replace(title, {_QUOTE}, chr(92) || {_QUOTE}), "
    f"'- Xinhua ', ''), {_NL}, '') || {_QUOTE} || ' ' || url"
)

# -- L -------------------------------------------------------------------------

_ALL_LINKS = rf"""
hrefs AS (
  SELECT url AS page_url, unnest(h) AS href, unnest(range(0, len(h))) AS pos
  FROM (SELECT url, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) AS h FROM pages)
),
resolved AS (
  SELECT page_url, pos,
         CASE WHEN regexp_matches(href, '^[A-Za-z]+:') THEN href
              WHEN starts_with(href, '/') THEN regexp_extract(page_url, '^https?://[^/?#]*') || href
              ELSE 'unexpected' END AS url
  FROM hrefs
)"""

_HOST = "lower(regexp_extract(url, '^https?://([^/:?#]*)', 1))"

_RESULTS = rf"""
listed AS (
  SELECT page_id, unnest(h) AS slug, unnest(range(0, len(h))) AS place
  FROM (SELECT page_id, regexp_extract_all(html, '<a href="/([^"]*)"', 1) AS h FROM pages)
),
result_links AS (
  SELECT {V.pick_sql(V.LIST_SOURCES, 'page_id')} AS source,
         {V.pick_sql(V.LIST_HOSTS, 'page_id')} || '/search/' || page_id || '.html?p=1' AS page_url,
         'article' AS link_kind, place AS pos, '2014-05-' || lpad(CAST((page_id + place) % 28 + 1 AS VARCHAR), 2, '0') AS day,
         {V.pick_sql(V.LIST_HOSTS, 'page_id')} || '/' || {V.pick_sql(V.SECTIONS, '(page_id + place)')}
           || '/2014/05/' || lpad(CAST((page_id + place) % 28 + 1 AS VARCHAR), 2, '0') || '/' || slug AS url
  FROM listed WHERE page_id % 12 <> 6
  UNION ALL
  SELECT 'BBC', 'http://www.bbc.co.uk/search/' || page_id || '.html?p=1', 'follow', 0, NULL,
         'http://www.bbc.co.uk/search/' || page_id || '.html?page=2&q=x'
  FROM pages WHERE page_id % 6 = 1
  UNION ALL
  SELECT 'Reuters', 'http://www.reuters.com/search/' || page_id || '.html?p=1', 'follow', 0, NULL,
         'http://www.reuters.com/archive/20140501.html'
  FROM pages WHERE page_id % 6 = 2
)"""

_REACHABLE = f"""
WITH RECURSIVE stored AS (
  SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'http://www.bbc.co.uk/search?list=' || page_id
    ELSE 'http://www.reuters.com/us/' || page_id || '.html' END AS url FROM pages
), leads AS (
  SELECT page_id, CASE WHEN page_id % {2 * V.LIST_LENGTH} = {2 * V.LIST_LENGTH - 2}
    THEN page_id - {2 * V.LIST_LENGTH - 2} ELSE page_id + 2 END AS target FROM pages WHERE page_id % 2 = 0
  UNION ALL SELECT page_id, 2 * page_id + 3 FROM pages WHERE page_id % 2 = 1
  UNION ALL SELECT page_id, 3 * page_id FROM pages WHERE page_id % 2 = 1
  UNION ALL SELECT page_id, 1 FROM pages WHERE page_id % 2 = 1
), reached AS (
  SELECT page_id FROM pages WHERE page_id % {2 * V.LIST_LENGTH * V.LIST_STARTS} = 0 OR page_id = 5
  UNION
  SELECT target FROM reached JOIN leads USING (page_id) WHERE target IN (SELECT page_id FROM pages)
)
SELECT url FROM stored JOIN reached USING (page_id)"""

_SITES = f"""
WITH paged AS (
  SELECT doc_id, CASE WHEN doc_id < 2 THEN 'alone' || doc_id ELSE 'site' || doc_id % {V.SITES} END AS site,
         string_split(text, chr(10)) AS lines FROM documents
), blocks AS (
  SELECT doc_id, site, place, trim(regexp_replace(line, '[ \\t\\r\\f\\v]+', ' ', 'g')) AS block
  FROM (SELECT doc_id, site, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM paged)
  UNION ALL SELECT doc_id, site, 0, {V.quoted(V.SITE_SPECIAL)} FROM paged WHERE (doc_id // {V.SITES}) % 10 = 0
), sized AS (
  SELECT site, count(*) AS pages FROM paged GROUP BY site
), template AS (
  SELECT site, block FROM blocks JOIN sized USING (site) GROUP BY site, block, pages
  HAVING count(DISTINCT doc_id) >= 3 AND count(DISTINCT doc_id) >= pages * 0.3
), stories AS (
  SELECT b.doc_id, string_agg(b.block, chr(10) ORDER BY b.place) AS story
  FROM blocks b LEFT JOIN template t ON t.site = b.site AND t.block = b.block
  WHERE t.block IS NULL AND length(b.block) >= 25 GROUP BY b.doc_id
)
SELECT 'http://' || site || '.example.com/' || doc_id AS url, pages >= 3 AS by_site,
       CASE WHEN pages >= 3 THEN coalesce(story, '') END AS story
FROM paged JOIN sized USING (site) LEFT JOIN stories USING (doc_id)"""

# -- E -------------------------------------------------------------------------

_MOMENT = V.MOMENT_SQL
#: Page text as the reader gives it: inner whitespace squeezed, one blank line
#: between paragraphs, two newlines at the end.
_PLAIN = (
    rf"regexp_replace(regexp_replace({{}}, '[ \t]+', ' ', 'g'), ' *\n[ \n]*', {_NL} || {_NL}, 'g')"
)


def _plain(x: str) -> str:
    return f"({_trim(_PLAIN.format(x))} || {_NL} || {_NL})"


def _space_out(x: str) -> str:
    return f"""translate({x}, chr(9) || {_NL} || '"', '   ')"""


def _after(x: str, mark: str) -> str:
    """Text after the first mark with the other marks gone."""
    return f"array_to_string(string_split({x}, '{mark}')[2:], '')"


def _cut_upi(x: str) -> str:
    return _space_out(_trim(_after(x, "(UPI) --")))


def _cut_xna(x: str) -> str:
    return f"coalesce({_space_out(_trim(f'''string_split({x}, '--')[2]'''))}, {x})"


def _cut_reuters(x: str) -> str:
    parts = f"string_split({x}, '(Reuters) -')"
    return (
        f"CASE len({parts}) WHEN 1 THEN {x} WHEN 2 THEN {parts}[2] "
        f"ELSE {x} || array_to_string({parts}[2:], '') END"
    )


_REUTERS_BODY = _squeeze(_plain("'PARIS (Reuters) - ' || text"))
_KEYWORD = " OR ".join(f"contains({_REUTERS_BODY}, {V.quoted(k)})" for k in V.KEYWORDS)
#: The first line is loose text, the others are paragraphs; empty ones have no text.
_PARAGRAPHS = "list_filter(string_split(text, chr(10))[2:], lambda x: x <> '')"
_PAGES = rf"""
page AS (
  SELECT doc_id, {V.pick_sql(V.PAGE_HOSTS, 'doc_id')} || doc_id AS url,
         {V.pick_sql(V.PAGE_SOURCES, 'doc_id')} AS layout,
         {V.pick_sql(V.PAGE_LABELS, 'doc_id')} AS source,
         strftime({_MOMENT}, '%Y%m%d') AS date,
         string_split(text, chr(10))[1] AS headline, text
  FROM documents
),
drafts AS (
  SELECT url, source, date,
         CASE WHEN layout IN ('AP', 'Reuters', 'UPI') THEN headline 
              WHEN layout = 'XNA untitled' THEN {_trim("string_split(headline || '_ News', '_')[1]")}
              ELSE {_trim('headline')} END AS title,
         CASE layout
           WHEN 'AP' THEN {_squeeze(_plain("'PARIS ' || text"))}
           WHEN 'BBC' THEN {_squeeze("'Lead one.' || chr(10) || text")}
           WHEN 'BBC inner' THEN {_squeeze("'Heading' || chr(10) || text")}
           WHEN 'BBC old' THEN {_squeeze("'Lead.' || chr(10) || text")}
           WHEN 'Reuters' THEN CASE WHEN {_KEYWORD} THEN {_cut_reuters(_REUTERS_BODY)} END
           WHEN 'UPI' THEN {_cut_upi(_plain("'PARIS, June 3 (UPI) -- ' || text"))}
           WHEN 'VOA' THEN regexp_replace({_plain('text')}, '[*\t\n]+', ' ', 'g')
           WHEN 'BBC loose' THEN CASE WHEN len({_PARAGRAPHS}) > 1
             THEN {_squeeze(f"array_to_string({_PARAGRAPHS}, chr(10))")}
             ELSE {_space_out(_plain('text'))} END
           ELSE {_cut_xna(_plain("'BEIJING, June 3 (Xinhua) -- ' || text"))}
         END AS content
  FROM page
),
judged AS (
  SELECT *, CASE WHEN title = '' THEN 'no title'
                 WHEN content IS NULL OR (content = '' AND source <> 'Reuters') THEN 'no content'
            END AS reason
  FROM drafts
)"""


def _raw_dates() -> str:
    moment = (
        "(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))"
        " + to_minutes(CAST(o_orderkey % 60 AS INTEGER)))"
    )
    rows = []
    for style, (_, fmt) in V.DATE_STYLES.items():
        raw = f"strftime({moment}, {V.quoted(fmt)})"
        if style == "UPI short":
            raw = f"replace({raw}, 'Sep.', 'Sept.')"
        with_clock = style not in ("AP", "BBC", "BBC inner")
        time = f"strftime({moment}, '%H:%M:00')" if with_clock else "'00:00:00'"
        rows.append(
            f"SELECT o_orderkey, '{style}' AS style, {raw} AS raw, "
            f"strftime(o_orderdate, '%Y%m%d') AS date, {time} AS time FROM orders"
        )
    return " UNION ALL ".join(rows)


def _simple(x: str) -> str:
    """Inner HTML as squeezed text, tags gone and entities decoded."""
    x = rf"regexp_replace({x}, '(?i)<br\b[^>]*>|</?(p|div|h[1-6]|li|ul|ol|tr)\b[^>]*>', {_NL}, 'g')"
    x = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for entity, text in (
        ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"),
    ):
        x = f"replace({x}, {V.quoted(entity)}, {V.quoted(text)})"
    return _trim(_squeeze(x))


_SIMPLE = rf"""
bare AS (
  SELECT url, regexp_replace(html,
    '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<noscript\b.*?</noscript\s*>|<!--.*?-->',
    '', 'g') AS html FROM pages
),
simple AS (
  SELECT url, {_simple(r"regexp_extract(html, '(?is)<h1\b[^>]*>(.*?)</h1\s*>', 1)")} AS title,
         {_simple(r"regexp_extract(html, '(?is)<article\b[^>]*>(.*?)</article\s*>', 1)")} AS content
  FROM bare
)"""


def _caption_cut() -> str:
    """The page text rebuilt with the notice and the caption left out."""
    x = "text"
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        x = f"replace({x}, '{raw}', '{entity}')"
    cases = []
    for i, name in enumerate(V.PAGE_SOURCES):
        before, middle, after, end = V.PAGE_PARTS[name]
        if name == "BBC":
            after = (
                after.replace('<p class="caption">Please turn on JavaScript', "")
                .replace("<noscript>Old <b>notice</b></noscript>", "")
            )
        parts = [
            V.quoted(V._NAV + before),
            f"string_split({x}, chr(10))[1]",
            V.quoted(middle),
            f"strftime({_MOMENT}, {V.quoted(V.date_style(name)[1])})",
            V.quoted(after),
            f"replace({x}, chr(10), '</p>' || chr(10) || '<p>')",
            V.quoted(end + V._END),
        ]
        cases.append(f"WHEN {i} THEN " + " || ".join(parts))
    return (
        f"SELECT {V.pick_sql(V.PAGE_HOSTS, 'doc_id')} || doc_id AS url, "
        f"CASE doc_id % {len(V.PAGE_SOURCES)} {' '.join(cases)} END AS html FROM documents"
    )


ORACLE = {
    "article_filter": f"WITH {_RULED} SELECT doc_id, source, url, title FROM ruled WHERE rule = 'kept'",
    "reject_reasons": f"WITH {_RULED} SELECT source, rule, count(*) AS articles FROM ruled GROUP BY ALL",
    "clean_text": (
        f"WITH {V.ARTICLES_SQL}, {_cleaned('articles')} SELECT doc_id, title, content FROM cleaned"
    ),
    "split_documents": (
        f"WITH RECURSIVE ascii AS (SELECT doc_id, {_ascii('text')} AS text FROM documents), "
        f"{_split('ascii', 'text')} "
        "SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY place) AS INTEGER)"
        " AS sentence_no, sentence FROM sentences"
    ),
    "sentence_filters": f"{_SPLIT_ARTICLES} SELECT doc_id, sentence_no, sentence FROM kept",
    "lead_sentences": (
        f"{_SPLIT_ARTICLES} SELECT doc_id, {_LEAD} AS sentence FROM kept WHERE sentence_no = 1"
    ),
    "article_numbers": (
        f"WITH {V.ARTICLES_SQL} SELECT doc_id, source, date, row_number() OVER "
        "(PARTITION BY source ORDER BY date, doc_id) AS article_no FROM articles"
    ),
    "sentence_lines": (
        f"{_NUMBERED} SELECT source, article_no, sentence_no, {_SENTENCE_LINE} AS value "
        "FROM article JOIN kept USING (doc_id)"
    ),
    "lead_lines": (
        f"{_NUMBERED} SELECT source, article_no, {_LEAD_LINE} AS value "
        "FROM article JOIN kept USING (doc_id) WHERE sentence_no = 1"
    ),
    "index_lines": f"{_NUMBERED} SELECT source, article_no, {_INDEX_LINE} AS value FROM article",
    "scrape_times": (
        "SELECT o_orderkey, strftime(o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS INTEGER)), "
        "'%Y-%m-%d %H:%M:%S') AS scraped FROM orders"
    ),
    "stored_articles": (
        f"WITH {V.ARTICLES_SQL} SELECT url, source, query, title, date, "
        "'2014-07-01 00:00:00' AS dateScraped, content, NULL::VARCHAR AS reason FROM articles"
    ),
    "array_articles": (
        f"WITH {V.ARTICLES_SQL}, named AS (SELECT *, source || '-' || doc_id // 500 AS search FROM articles) "
        "SELECT url, source, search AS query, title, date, content, "
        "row_number() OVER (PARTITION BY search ORDER BY doc_id) AS place FROM named"
    ),
    "reject_files": (
        f"WITH {V.ARTICLES_SQL} SELECT 'read' AS stage, "
        "CASE doc_id % 4 WHEN 1 THEN 'no url' WHEN 2 THEN 'no title' ELSE 'no content' END AS reason, "
        "source, CASE WHEN doc_id % 4 <> 2 THEN title END AS title, "
        "CASE WHEN doc_id % 4 <> 1 THEN url END AS url FROM articles WHERE doc_id % 4 <> 0"
    ),
    "record_files": (
        f"{_NUMBERED} SELECT file, source, 'talks' AS query, unnest(string_split(line, {_NL})) AS value "
        f"FROM (SELECT 'lead' AS file, source, {_LEAD_LINE} AS line "
        "FROM article JOIN kept USING (doc_id) WHERE sentence_no = 1 UNION ALL "
        f"SELECT 'sentences', source, {_SENTENCE_LINE} FROM article JOIN kept USING (doc_id) "
        f"UNION ALL SELECT 'index', source, {_INDEX_LINE} FROM article)"
    ),
    "published_records": (
        f"{_NUMBERED}, line AS (SELECT 'lead' AS file, date, source, {_LEAD_LINE} AS line "
        "FROM article JOIN kept USING (doc_id) WHERE sentence_no = 1 UNION ALL "
        f"SELECT 'sentences', date, source, {_SENTENCE_LINE} FROM article JOIN kept USING (doc_id) "
        f"UNION ALL SELECT 'index', date, source, {_INDEX_LINE} FROM article) "
        "SELECT file, CASE WHEN date < '20140601' THEN 'may' ELSE 'june' END AS run, source, 'talks' AS query, "
        f"unnest(string_split(line, {_NL})) AS value FROM line"
    ),
    "rejected_articles": (
        f"WITH {V.ARTICLES_SQL} SELECT 'read' AS stage, "
        "CASE doc_id % 4 WHEN 1 THEN 'no url' WHEN 2 THEN 'no title' ELSE 'no content' END AS reason, "
        "source, CASE WHEN doc_id % 4 <> 2 THEN title END AS title, "
        "CASE WHEN doc_id % 4 <> 1 THEN url END AS url FROM articles WHERE doc_id % 4 <> 0"
    ),
    "page_links": f"WITH {_ALL_LINKS} SELECT page_url, CAST(pos AS INTEGER) AS pos, url FROM resolved",
    "link_domains": (
        f"WITH {_ALL_LINKS} SELECT DISTINCT url FROM resolved WHERE {_HOST} IN "
        "('example.com', 'blog.ththan.example.net') OR ends_with("
        f"{_HOST}, '.example.com') OR ends_with({_HOST}, '.blog.ththan.example.net')"
    ),
    "fresh_links": (
        f"WITH {_ALL_LINKS} SELECT DISTINCT url FROM resolved WHERE url NOT IN "
        "(SELECT regexp_extract(url, '^https?://[^/]*') || '/the' FROM pages)"
    ),
    "remembered_links": (
        f"WITH {_ALL_LINKS}, first_run AS (SELECT DISTINCT url FROM resolved WHERE md5(page_url) < '8') "
        "SELECT 'first' AS run, url FROM first_run UNION ALL "
        "SELECT DISTINCT 'second', url FROM resolved WHERE url NOT IN (SELECT url FROM first_run)"
    ),
    "url_date_window": (
        "WITH found AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, "
        f"{V.pick_sql(V.LIST_SOURCES, 'o_orderkey')} AS source, "
        f"{V.pick_sql(V.SECTIONS, 'o_orderkey')} AS section, "
        f"{V.pick_sql(V.LIST_HOSTS, 'o_orderkey')} || '/' || {V.pick_sql(V.SECTIONS, 'o_orderkey')} "
        "|| '/' || strftime(o_orderdate, '%Y/%m/%d') || '/id' || o_orderkey AS url FROM orders) "
        "SELECT o_orderkey, url, day AS link_date FROM found WHERE o_orderkey % 9 <> 0 "
        "AND day BETWEEN DATE '1995-03-10' AND DATE '1996-10-20' AND year(day) BETWEEN 1996 AND 1997 "
        "AND NOT (source = 'BBC' AND section IN ('magazine', 'school_report')) "
        "AND NOT (source IN ('Reuters', 'XNA') AND section = 'video')"
    ),
    "result_links": f"WITH {_RESULTS} SELECT source, page_url, link_kind, pos, url FROM result_links",
    "links_to_fetch": (
        f"WITH {_RESULTS} SELECT DISTINCT source, url FROM result_links WHERE link_kind = 'follow' OR ("
        "NOT (source = 'BBC' AND (contains(url, '/school_report/') OR contains(url, 'magazine'))) "
        "AND NOT (source = 'Reuters' AND contains(url, 'video')) "
        "AND NOT (source = 'XNA' AND contains(url, '/video/')) "
        "AND (source NOT IN ('Reuters', 'UPI') OR day BETWEEN '2014-05-05' AND '2014-05-20'))"
    ),
    "reachable_pages": _REACHABLE,
    "simple_pages": f"WITH {_SIMPLE} SELECT url, title, content FROM simple",
    "page_articles": (
        f"WITH {_PAGES} SELECT url, source, title, date, content FROM judged WHERE reason IS NULL"
    ),
    "page_rejects": (
        f"WITH {_PAGES} SELECT 'extract' AS stage, reason, source, url FROM judged "
        "WHERE reason IS NOT NULL"
    ),
    "site_stories": _SITES,
    "raw_dates": _raw_dates(),
    "dateline_cut": (
        f"WITH {V.ARTICLES_SQL} SELECT doc_id, {_cut_upi('content')} AS upi, "
        f"{_cut_xna('content')} AS xna, {_cut_reuters('content')} AS reuters FROM articles"
    ),
    "keyword_match": (
        "SELECT doc_id FROM documents WHERE "
        + " OR ".join(f"contains(text, {V.quoted(k)})" for k in V.KEYWORDS)
    ),
    "keyword_index": (
        f"WITH {V.KEYWORDS_SQL} SELECT doc_id, keyword FROM documents, listed "
        "WHERE keyword <> '' AND contains(text, keyword)"
    ),
    "whitespace_rules": (
        f"WITH {V.ARTICLES_SQL} SELECT doc_id, {_squeeze('content')} AS squeezed, "
        f"{_space_out('content')} AS spaced, "
        r"regexp_replace(content, '[*\t\n]+', ' ', 'g') AS unmarked, "
        "translate(content, chr(9) || chr(10), '  ') AS unlined FROM articles"
    ),
    "complete_articles": (
        f"WITH {_SIMPLE} SELECT url, title, CASE WHEN {_HOST} = 'example.com' OR "
        f"ends_with({_HOST}, '.example.com') THEN 'example.com' WHEN {_HOST} = 'example.net' OR "
        f"ends_with({_HOST}, '.example.net') THEN 'example.net' ELSE 'other' END AS source "
        "FROM simple WHERE title <> '' AND content <> ''"
    ),
    "missing_fields": (
        f"WITH {V.ARTICLES_SQL} SELECT doc_id, CASE WHEN doc_id % 4 = 1 OR title = '' THEN 'no title' "
        "WHEN doc_id % 4 = 2 THEN 'no date' "
        "WHEN doc_id % 4 = 3 AND source <> 'Reuters' THEN 'no content' END AS reason FROM articles"
    ),
    "caption_cut": _caption_cut(),
}
