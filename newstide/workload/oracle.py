"""Independent SQL for the registered queries, run by DuckDB on the same parquet tables."""

from __future__ import annotations

from newstide.config import (
    BOILERPLATE_KEYWORDS,
    CATEGORY_WEIGHTS,
    ENGLISH_STOP_WORDS,
    INVALID_SENTIMENTS,
    INVALID_TOPICS,
    TOPICS,
    UNWANTED_SNIPPETS,
    WHITESPACE,
)
from newstide.workload.views import AS_OF, TEST_SOURCE_WEIGHTS


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lits(values) -> str:
    return ", ".join(lit(v) for v in values)


def values(pairs: dict) -> str:
    return ", ".join(f"({lit(k)}, {v}::double)" for k, v in pairs.items())


def strip(expr: str) -> str:
    return f"trim({expr}, {lit(WHITESPACE)})"


STOPS = f"[{lits(ENGLISH_STOP_WORDS)}]"
DAY = "('2025-08-1' || (doc_id % 5))"

ARTICLES = f"""
articles AS (
  SELECT d.doc_id AS article_id,
         CASE WHEN lang <> 'es' THEN nullif({strip("split_part(text, chr(10), 1)")}, '') END AS title,
         'https://www.src' || (n_chars % 20) || '.example.com/' || md5(text) AS url,
         text, lang, source,
         TIMESTAMP '2025-08-10 00:00:00' + to_hours(d.doc_id % 120) AS scraped_at,
         CASE WHEN lang <> 'de' THEN TIMESTAMP '2025-08-10 00:00:00' + to_hours(d.doc_id % 120) - to_hours(n_chars % 48) END AS published_at,
         TIMESTAMP '2025-08-10 00:00:00' + to_hours(d.doc_id % 120) + to_minutes(d.doc_id % 60) AS created_at,
         ([{lits(CATEGORY_WEIGHTS)}])[(n_chars % 9) + 1] AS category,
         (d.doc_id % 2 + 1)::int AS batch,
         coalesce(([{lits(TOPICS)}])[(n_chars % 13) + 1], 'unknown') AS topic,
         CASE toxic WHEN 1 THEN 'NEGATIVE' WHEN 0 THEN 'POSITIVE' ELSE 'unknown' END AS sentiment,
         quality = 1 AS isCleaned,
         quality = 1 AS isProcessed,
         (d.doc_id % 2 + 1) || '-2025-08-1' || (d.doc_id % 5) AS sample
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""

CLEAN = (
    ARTICLES
    + f""",
clean AS (
  SELECT *, {strip("text")} AS summary,
         list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'),
                     lambda w: regexp_full_match(w, '\\p{{L}}+') AND NOT list_contains({STOPS}, w)) AS nouns,
         lower(regexp_extract(url, '^[a-z]+://([^/]+)', 1)) AS source_domain
  FROM articles WHERE {strip("text")} <> ''
)"""
)

OCCURRENCES = (
    CLEAN
    + f""",
occ AS (
  SELECT sample,
         CASE WHEN lower({strip("topic")}) NOT IN ({lits(INVALID_TOPICS)}) THEN lower({strip("topic")}) END AS topic,
         CASE WHEN lower({strip("sentiment")}) NOT IN ({lits(INVALID_SENTIMENTS)}) THEN lower({strip("sentiment")}) END AS sentiment,
         unnest(nouns) AS word
  FROM clean
)"""
)

CONTEXT = (
    OCCURRENCES
    + """,
labels_long AS (
  SELECT sample, word, 'topic' AS kind, topic AS label FROM occ WHERE topic IS NOT NULL
  UNION ALL
  SELECT sample, word, 'sentiment', sentiment FROM occ WHERE sentiment IS NOT NULL
),
label_n AS (SELECT sample, word, kind, label, count(*) AS n FROM labels_long GROUP BY ALL),
context AS (
  SELECT *, round_even(n::double / (sum(n) OVER (PARTITION BY sample, word, kind))::double * 100, 0)::int AS percentage
  FROM label_n
)"""
)


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()} {body}"


def words() -> dict[str, str]:
    return {
        "word_occurrences": with_(
            OCCURRENCES,
            "SELECT sample, word, topic, sentiment, count(*) AS cnt FROM occ GROUP BY ALL",
        ),
        "word_counts": with_(OCCURRENCES, "SELECT sample, word, count(*) AS cnt FROM occ GROUP BY ALL"),
        "word_metrics": with_(
            OCCURRENCES,
            "SELECT sample, count(*) AS total_words, count(DISTINCT word) AS distinct_words FROM occ GROUP BY sample",
        ),
        "word_metrics_sketched": with_(
            OCCURRENCES,
            """SELECT regexp_extract(sample, '^[0-9]+')::int AS batch, count(*) AS total_words, count(DISTINCT word) AS distinct_words, true AS "close"
               FROM occ GROUP BY 1""",
        ),
        "word_context": with_(CONTEXT, "SELECT sample, word, kind, label, n, percentage FROM context"),
        "daily_trends_words": with_(
            CONTEXT
            + """,
counts AS (SELECT sample, word, count(*) AS cnt FROM occ GROUP BY ALL),
top AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY cnt DESC, word) AS rank FROM counts)
  WHERE rank <= 15
)""",
            """SELECT t.sample, t.rank::int AS rank, t.word, t.cnt, coalesce(c.kind, 'none') AS kind,
                      c.label, c.n, c.percentage
               FROM top t LEFT JOIN context c ON t.sample = c.sample AND t.word = c.word""",
        ),
    }



PAGE_TEXT_STEPS = [
    (r"(?is)<!--.*?-->", "''"),
    (r"(?is)<(script|style|nav|aside|footer|noscript)\b[^>]*>.*?</(script|style|nav|aside|footer|noscript)>", "''"),
    (r"(?i)<br\s*/?>|</(p|div|li|h[1-6]|tr|blockquote)>", "chr(10)"),
    (r"(?s)<[^>]*>", "''"),
]
ENTITY_STEPS = [
    ("&nbsp;", " "), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&copy;", "©"),
    ("&middot;", "·"), ("&ndash;", "–"), ("&mdash;", "—"), ("&hellip;", "…"), ("&euro;", "€"), ("&amp;", "&"),
]


def plain(html: str) -> str:
    e = html
    for pattern, by in PAGE_TEXT_STEPS:
        e = f"regexp_replace({e}, {lit(pattern)}, {by}, 'g')"
    for name, char in ENTITY_STEPS:
        e = f"replace({e}, {lit(name)}, {lit(char)})"
    e = f"regexp_replace({e}, '[ \\t]+', ' ', 'g')"
    return strip(f"regexp_replace({e}, ' ?\\n[ \\n]*', chr(10), 'g')")


def cards(href: str, title: str) -> str:
    """Links of the navigation by their address, straight from the stored pages."""
    anchor = '<a href="(/[^"]*)">([^<]*)</a>'
    return f"""
            WITH a AS (SELECT page_id, url AS base, unnest(regexp_extract_all(html, '{anchor}', 1)) AS href, unnest(regexp_extract_all(html, '{anchor}', 2)) AS inside,
                         generate_subscripts(regexp_extract_all(html, '{anchor}', 1), 1) AS n FROM pages)
            SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY n) - 1)::int AS pos, regexp_extract(base, '^[a-z]+://[^/?#]+') || href AS url, {plain(title)} AS title
            FROM a WHERE regexp_matches(href, '{href}') AND {plain(title)} <> ''"""


PAGE_TEXT = f"""nullif({plain("regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1)")}, '')"""
PAGE_TITLE = f"""nullif({plain("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")}, '')"""

def main_text() -> str:
    e = "regexp_replace(html, '</?article>', '', 'g')"
    for pattern, by in (
        ("(?is)<!--.*?-->", "''"),
        (r"(?is)<(head|script|style|nav|aside|footer|noscript)\b[^>]*>.*?</(head|script|style|nav|aside|footer|noscript)>", "''"),
        (r"(?i)<br\s*/?>|</?(p|div|li|ul|ol|h[1-6]|tr|table|section|blockquote)\b[^>]*>", "chr(10)"),
        (r"(?i)<a\b[^>]*>", "chr(1)"), ("(?i)</a>", "chr(2)"), ("(?s)<[^>]*>", "''"),
    ):
        e = f"regexp_replace({e}, {lit(pattern)}, {by}, 'g')"
    for name, char in ENTITY_STEPS:
        e = f"replace({e}, {lit(name)}, {lit(char)})"
    bare = "replace(replace({0}, chr(1), ''), chr(2), '')"
    outside = bare.format("regexp_replace(line, chr(1) || '[^' || chr(2) || ']*' || chr(2), '', 'g')")
    # The best run ends where the running sum lies highest above the least one before, the latest of equally low ones.
    return f"""
        WITH cut AS (SELECT page_id, string_split(regexp_replace({e}, '[ \\t]+', ' ', 'g'), chr(10)) AS l FROM pages),
        lines AS (SELECT page_id, {strip("unnest(l)")} AS line, generate_subscripts(l, 1) AS i FROM cut),
        b AS (SELECT page_id, i, {bare.format("line")} AS t, 2 * length({outside}) - length({bare.format("line")}) - 40 AS score FROM lines),
        n AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY i) AS pos FROM b WHERE {strip("t")} <> ''),
        p AS (SELECT *, sum(score) OVER (PARTITION BY page_id ORDER BY pos) AS high FROM n),
        q AS (SELECT *, least(0, coalesce(min(high * 1000000 - pos) OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS low FROM p),
        r AS (SELECT page_id, pos AS last, ceil(low / 1000000.0)::bigint AS base, (ceil(low / 1000000.0) * 1000000 - low)::bigint AS prior, high FROM q),
        run AS (SELECT page_id, max(prior) AS prior, max(last) AS last FROM (
                  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY high - base DESC, last) AS k FROM r) WHERE k = 1 GROUP BY 1),
        x AS (SELECT n.page_id, nullif({strip("string_agg(t, chr(10) ORDER BY pos)")}, '') AS text
              FROM n JOIN run ON run.page_id = n.page_id AND n.pos > prior AND n.pos <= last GROUP BY 1)
        SELECT pages.page_id, length(text)::int AS n, md5(text) AS text_md5 FROM pages LEFT JOIN x ON x.page_id = pages.page_id"""


MAIN_TEXT = main_text()

RAW = (
    ARTICLES
    + f""",
raw AS (
  SELECT 0 AS source_ord, article_id AS pos, title, CASE WHEN source <> 'src19' THEN url END AS url, text, source FROM articles
  UNION ALL
  SELECT 1, page_id, {PAGE_TITLE}, url, {PAGE_TEXT}, 'pages' FROM pages
  UNION ALL
  SELECT 2, conv_id * 1000 + turn, role, 'https://chat.example.com/' || conv_id, text, 'chat' FROM conversations
),
candidates AS (
  SELECT source_ord, pos, url, coalesce(nullif({strip("title")}, ''), '(untitled)') AS title, {strip("text")} AS text
  FROM raw WHERE url <> '' AND {strip("text")} <> ''
)"""
)

POOL = (
    ARTICLES
    + """,
pool AS (
  SELECT url, bool_or(isProcessed) AS is_articles_processed,
         max(CASE WHEN sentiment = 'NEGATIVE' THEN sample END) AS in_sample, min(scraped_at) AS created_at
  FROM articles WHERE sentiment <> 'unknown' GROUP BY url
),
done AS (SELECT url FROM pool WHERE is_articles_processed OR in_sample <> '')"""
)

META = (
    ARTICLES
    + """,
ids AS (SELECT DISTINCT sample FROM articles UNION SELECT DISTINCT source || '-2025-08-10' FROM articles),
meta AS (
  SELECT sample, try_cast(string_split(sample, '-')[1] AS int) AS batch,
         CASE WHEN len(string_split(sample, '-')) >= 4
              THEN try_cast(array_to_string(string_split(sample, '-')[2:4], '-') AS date) END AS date
  FROM ids
),
good AS (SELECT * FROM meta WHERE batch IS NOT NULL AND date IS NOT NULL)"""
)

POOL_OUT = "url, is_articles_processed, in_sample, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at"


def filters() -> dict[str, str]:
    snippets = " OR ".join(
        f"contains(text, {lit(s)})" for s in UNWANTED_SNIPPETS + ["All rights reserved.", "MIT License"]
    )
    keyword = " OR ".join(f"contains(lower(x), {lit(k)})" for k in BOILERPLATE_KEYWORDS)
    return {
        "candidate_filter": with_(RAW, "SELECT source_ord, pos, url, title, md5(text) AS text_md5 FROM candidates"),
        "union_sources": with_(RAW, "SELECT source_ord, pos, url, title, source, length(text)::int AS n FROM raw"),
        "unwanted_filter": with_(ARTICLES, f"SELECT article_id, sample FROM articles WHERE NOT ({snippets})"),
        "published_on": with_(
            ARTICLES,
            """SELECT sample, CASE WHEN lang = 'fr' OR published_at IS NULL THEN NULL
                                   WHEN published_at::date = DATE '2025-08-12' THEN 'kept' ELSE 'skipped' END AS status,
                      count(*) AS cnt FROM articles GROUP BY ALL""",
        ),
        "valid_samples": """
            WITH t AS (SELECT doc_id, (n_chars % 7) || '-' || (n_chars % 90 + 2015) || '-' || lpad((n_chars % 14)::varchar, 2, '0')
                              || '-' || lpad((n_chars % 33)::varchar, 2, '0') AS sample, n_chars % 90 + 2015 AS y FROM documents)
            SELECT doc_id, sample, y BETWEEN 2025 AND 2099 AND try_cast(substr(sample, 3) AS date) IS NOT NULL AS is_valid FROM t""",
        "photo_credit": with_(ARTICLES, "SELECT article_id, isCleaned IS NOT NULL AS is_credit FROM articles"),
        "boilerplate_lines": with_(
            ARTICLES,
            f"""SELECT article_id, len(list_filter(string_split(text, chr(10)), lambda x: {keyword}))::int AS dropped,
                       md5(array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT ({keyword})), chr(10))) AS kept_md5
                FROM articles""",
        ),
        "coerce_text": f"""
            SELECT doc_id, md5({strip("text")}) AS raw_md5, md5({strip("text")}) AS doc_md5,
                   md5({strip(f"array_to_string(list_transform(string_split(text, chr(10)), lambda x: {strip('x')}), chr(10))")}) AS lines_md5,
                   CASE WHEN lang <> 'es' THEN n_chars::varchar ELSE '' END AS size_text FROM documents""",
        "join_paragraphs": f"""
            SELECT doc_id, md5({strip("array_to_string(list_filter(list_transform(list_filter(string_split(text, '.'), lambda s: length(s) > 8), lambda s: "
                                      + strip("s") + "), lambda s: s <> ''), chr(10))")}) AS joined_md5 FROM documents""",
        "min_chars": f"""
            SELECT doc_id, CASE WHEN lang = 'es' THEN false ELSE length({strip("text")}) >= 500 END AS long_enough,
                   CASE WHEN lang = 'es' THEN 0 ELSE length(text) END::int AS n FROM documents""",
        "source_domain": """
            SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)) AS domain,
                   regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)), '^www\\.', '') AS bare FROM pages""",
        "sentences": """
            WITH t AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?]) +', '\\1' || chr(1), 'g'), chr(1)) AS p FROM documents)
            SELECT doc_id, len(p)::int AS n, md5(array_to_string(p, '|')) AS parts_md5 FROM t""",
        "chunk_text": f"""
            WITH t AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?]) +', '\\1' || chr(1), 'g'), chr(1)) AS p FROM documents),
            z AS (SELECT doc_id, p, list_transform(p, lambda s: len(regexp_extract_all(s, '[^ \\t\\n\\r\\f\\v]+'))::int) AS sizes FROM t),
            r AS (SELECT doc_id, p, list_reduce(list_transform(sizes, lambda x: {{'n': x, 'c': 0, 'cs': [0]}}), lambda a, x:
                         CASE WHEN a.n + x.n > 512 THEN {{'n': x.n, 'c': a.c + 1, 'cs': list_append(a.cs, a.c + 1)}}
                              ELSE {{'n': a.n + x.n, 'c': a.c, 'cs': list_append(a.cs, a.c)}} END).cs AS cs FROM z),
            s AS (SELECT doc_id, unnest(p) AS sentence, unnest(cs) AS c, unnest(range(len(p))) AS pos FROM r),
            k AS (SELECT doc_id, c, string_agg(sentence, ' ' ORDER BY pos) AS own FROM s GROUP BY ALL HAVING own <> '')
            SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY c) - 1)::int AS chunk_no,
                   len(regexp_extract_all({strip("own")}, '[^ \\t\\n\\r\\f\\v]+'))::int AS tokens, md5({strip("own")}) AS chunk_md5 FROM k""",
        "length_budget": """
            WITH t AS (SELECT doc_id, len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\v]+'))::int AS tokens FROM documents),
            b AS (SELECT *, CASE WHEN tokens < 200 THEN greatest(floor(tokens * 0.8::double)::int, 20) ELSE 200 END AS longest FROM t)
            SELECT doc_id, tokens, longest, CASE WHEN tokens < 200 THEN least(10, longest // 2) ELSE 80 END AS shortest FROM b""",
        "normalize_vectors": """
            WITH e AS (SELECT vec_id, unnest(list_transform(embedding, lambda x: x::double * 3)) AS x,
                              unnest(range(len(embedding))) AS pos FROM embeddings),
            n AS (SELECT vec_id, sqrt(sum(x * x)) + 1e-9 AS n FROM e GROUP BY vec_id)
            SELECT e.vec_id, e.pos::int AS pos, round(e.x / n.n, 6) AS x FROM e JOIN n ON e.vec_id = n.vec_id""",
        "jaccard_pairs": """
            WITH w AS (SELECT conv_id, turn, unnest(string_split(lower(text), ' ')) AS w FROM conversations),
            s AS (SELECT DISTINCT * FROM w WHERE w <> ''),
            p AS (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations),
            n AS (SELECT conv_id, turn, count(*) AS n FROM s GROUP BY ALL),
            x AS (SELECT p.conv_id, p.turn, count(*) AS both FROM p JOIN s a ON a.conv_id = p.conv_id AND a.turn = p.turn
                  JOIN s b ON b.conv_id = p.conv_id AND b.turn = p.before AND a.w = b.w GROUP BY ALL)
            SELECT p.conv_id, p.turn,
                   round(CASE WHEN coalesce(na.n, 0) + coalesce(nb.n, 0) = 0 THEN 0
                        ELSE coalesce(x.both, 0) / (coalesce(na.n, 0) + coalesce(nb.n, 0) - coalesce(x.both, 0)) END, 6)::double AS overlap
            FROM p LEFT JOIN n na ON na.conv_id = p.conv_id AND na.turn = p.turn
                   LEFT JOIN n nb ON nb.conv_id = p.conv_id AND nb.turn = p.before
                   LEFT JOIN x ON x.conv_id = p.conv_id AND x.turn = p.turn""",
        "harvest_links": f"""
            WITH a AS (SELECT page_id, url AS base,
                         unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1)) AS href,
                         unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 2)) AS inside,
                         generate_subscripts(regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1), 1) - 1 AS pos
                       FROM pages)
            SELECT page_id, pos::int AS pos,
                   CASE WHEN starts_with(href, '/') THEN regexp_extract(base, '^[a-z]+://[^/?#]+') || href ELSE href END AS url,
                   {plain("inside")} AS title
            FROM a WHERE href <> ''""",
        "harvest_inner_links": cards("^/t", "inside"),
        "harvest_attribute_links": cards("^/[a-z]", "inside || ' (teaser)'"),
        "extract_main_text": MAIN_TEXT,
        "extract_article_text": f"SELECT page_id, length(t)::int AS n, md5(t) AS text_md5 FROM (SELECT page_id, {PAGE_TEXT} AS t FROM pages)",
    }


def samples() -> dict[str, str]:
    return {
        "scan_sample": with_(ARTICLES, "SELECT article_id, url, topic FROM articles WHERE sample = '1-2025-08-12'"),
        "find_one_sorted": with_(
            ARTICLES,
            """SELECT sample, article_id, url FROM (
                 SELECT *, row_number() OVER (PARTITION BY sample ORDER BY created_at DESC, article_id DESC) AS r FROM articles)
               WHERE r = 1""",
        ),
        "distinct_samples": with_(ARTICLES, "SELECT DISTINCT sample FROM articles WHERE contains(lower(sample), '2025-08-12')"),
        "next_batch": with_(
            META,
            """SELECT strftime(d.date, '%Y-%m-%d') AS date, (coalesce(max(g.batch), 0) + 1)::int AS next_batch,
                      (coalesce(max(g.batch), 0) + 1) || '-' || strftime(d.date, '%Y-%m-%d') AS next_sample
               FROM (SELECT DISTINCT published_at::date AS date FROM articles WHERE published_at IS NOT NULL) d
               LEFT JOIN good g ON g.date = d.date GROUP BY d.date""",
        ),
        "latest_sample": with_(META, "SELECT sample FROM good ORDER BY date DESC, batch DESC LIMIT 1"),
        "latest_samples": with_(
            META, "SELECT sample, strftime(date, '%Y-%m-%d') AS date, batch FROM good ORDER BY good.date DESC, batch DESC LIMIT 5"
        ),
        "sample_chain": with_(
            META,
            """SELECT sample, lag(sample) OVER (ORDER BY date, batch) AS prev, lead(sample) OVER (ORDER BY date, batch) AS next
               FROM good""",
        ),
        "date_spine": with_(
            ARTICLES
            + """,
n AS (SELECT published_at::date AS date, count(*) AS cnt FROM articles WHERE published_at IS NOT NULL GROUP BY ALL),
days AS (SELECT unnest(generate_series((SELECT min(date) FROM n)::timestamp, (SELECT max(date) FROM n)::timestamp, INTERVAL 1 DAY))::date AS date)""",
            "SELECT strftime(days.date, '%Y-%m-%d') AS date, coalesce(cnt, 0) AS cnt FROM days LEFT JOIN n ON n.date = days.date",
        ),
        "backfill_dates": with_(
            ARTICLES, "SELECT sample, array_to_string(string_split(sample, '-')[2:4], '-') AS date, count(*) AS cnt FROM articles GROUP BY ALL"
        ),
        "move_sample": with_(
            ARTICLES,
            """SELECT CASE sample WHEN '2-2025-08-11' THEN '2-2025-08-10' ELSE sample END AS sample, count(*) AS cnt
               FROM articles GROUP BY 1""",
        ),
    }


def counts() -> dict[str, str]:
    return {
        "sample_distributions": with_(
            ARTICLES
            + """,
l AS (SELECT sample, 'topic' AS kind, topic AS label FROM articles UNION ALL SELECT sample, 'sentiment', sentiment FROM articles),
n AS (SELECT sample, kind, label, count(*) AS n FROM l GROUP BY ALL)""",
            "SELECT *, round_even(n / sum(n) OVER (PARTITION BY sample, kind) * 100, 2) AS percentage FROM n",
        ),
        "outcome_counts": with_(
            POOL
            + """,
st AS (SELECT a.*, CASE WHEN row_number() OVER (PARTITION BY a.url ORDER BY article_id) > 1
                          OR a.url IN (SELECT url FROM done) THEN 'skipped'
                        WHEN lang = 'es' THEN 'failed' ELSE 'ok' END AS status FROM articles a)""",
            """SELECT sample, count(*) FILTER (status = 'ok') AS successfully, count(*) FILTER (status = 'failed') AS unsuccessfully,
                      count(*) FILTER (status = 'skipped') AS skipped FROM st GROUP BY sample""",
        ),
        "per_sample_counts": with_(
            META,
            f"""SELECT ids.sample, count(a.sample) AS articles, count(a.sample) FILTER (a.isCleaned AND {strip("a.text")} <> '') AS clean_articles
               FROM ids LEFT JOIN articles a ON a.sample = ids.sample GROUP BY ids.sample""",
        ),
        "backlog_counts": with_(
            ARTICLES,
            """SELECT count(*) FILTER (isCleaned IS NOT TRUE) AS to_clean,
                      count(*) FILTER ((isCleaned OR lang = 'fr') AND isProcessed IS NOT TRUE) AS to_mark_processed FROM articles""",
        ),
        "top_sources": "SELECT source, count(*) AS cnt FROM documents GROUP BY source ORDER BY cnt DESC, source LIMIT 10",
    }


def upkeep() -> dict[str, str]:
    stale_pool = f"in_sample IS NULL AND is_articles_processed IS NOT TRUE AND created_at < TIMESTAMP '{AS_OF}' - INTERVAL 3 DAY"
    return {
        "link_pool_gate": with_(POOL, "SELECT article_id, url FROM articles WHERE url NOT IN (SELECT url FROM done)"),
        "ensure_tracked": with_(
            POOL
            + """,
grown AS (SELECT * FROM pool UNION ALL
          SELECT url, NULL, NULL, min(created_at) FROM articles WHERE url NOT IN (SELECT url FROM pool) GROUP BY url)""",
            f"SELECT {POOL_OUT} FROM grown",
        ),
        "mark_processed": with_(
            POOL
            + """,
fr AS (SELECT url, arg_max(sample, (created_at, sample)) AS sample, min(created_at) AS t FROM articles WHERE lang = 'fr' GROUP BY url),
marked AS (SELECT coalesce(p.url, fr.url) AS url, CASE WHEN fr.url IS NOT NULL THEN true ELSE is_articles_processed END AS is_articles_processed,
                  coalesce(fr.sample, in_sample) AS in_sample, coalesce(created_at, t) AS created_at
           FROM pool p FULL JOIN fr ON p.url = fr.url)""",
            f"SELECT {POOL_OUT} FROM marked",
        ),
        "dedup_in_run": with_(
            RAW,
            """SELECT url, source_ord, pos, title FROM (
                 SELECT *, row_number() OVER (PARTITION BY url ORDER BY source_ord, pos) AS r FROM candidates) WHERE r = 1""",
        ),
        "duplicate_groups": with_(
            ARTICLES,
            f"""SELECT coalesce({strip("sample")}, '') AS key_sample, coalesce({strip("url")}, '') AS key_url, count(*) AS cnt
                FROM articles GROUP BY 1, 2 HAVING count(*) > 1""",
        ),
        "duplicate_groups_first": with_(
            ARTICLES, "SELECT url AS key_url, count(*) AS cnt FROM articles GROUP BY 1 HAVING count(*) > 1 ORDER BY 1 LIMIT 10"
        ),
        "dedupe_keep": with_(
            ARTICLES,
            """SELECT article_id, sample, url FROM (
                 SELECT *, row_number() OVER (PARTITION BY url ORDER BY created_at DESC, article_id DESC) AS r FROM articles) WHERE r = 1""",
        ),
        "dedupe_report": with_(
            ARTICLES + ", g AS (SELECT url, count(*) AS n FROM articles GROUP BY 1 HAVING count(*) > 1), h AS (SELECT * FROM g ORDER BY url LIMIT 5)",
            """SELECT (SELECT count(*) FROM g) AS groups_found, count(*) AS groups_handled, count(*) AS kept,
                      coalesce(sum(n - 1), 0)::bigint AS deleted FROM h""",
        ),
        "uniqueness_violations": with_(
            ARTICLES, "SELECT sample, url, count(*) AS cnt FROM articles GROUP BY 1, 2 HAVING count(*) > 1"
        ),
        "prune_stale": with_(
            POOL,
            f"""SELECT (SELECT count(*) FROM pool WHERE {stale_pool}) AS link_pool_deleted,
                       count(*) FILTER (lang = 'es' AND scraped_at < TIMESTAMP '{AS_OF}' - INTERVAL 3 DAY) AS articles_deleted,
                       count(*) FILTER (isProcessed AND scraped_at < TIMESTAMP '{AS_OF}' - INTERVAL 3 DAY) AS clean_deleted,
                       '2025-08-12 00:00:00' AS cutoff FROM articles""",
        ),
        "prune_stale_pool": with_(POOL, f"SELECT {POOL_OUT} FROM pool WHERE NOT coalesce({stale_pool}, false)"),
    }


WEIGHTS = (
    CLEAN
    + f""",
sw(k, w) AS (VALUES {values(TEST_SOURCE_WEIGHTS)}),
cw(k, w) AS (VALUES {values(CATEGORY_WEIGHTS)}),
weights AS (
  SELECT c.*, coalesce(sw.w, 0.7::double) AS source_weight, coalesce(cw.w, 1.0::double) AS category_weight,
         exp(-coalesce((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(published_at)) / 3.6e9, 72.0) / 42.0) AS recency_weight
  FROM clean c LEFT JOIN sw ON sw.k = regexp_replace(source_domain, '^www\\.', '') LEFT JOIN cw ON cw.k = c.category
)"""
)


def scores() -> dict[str, str]:
    return {
        "article_weights": with_(
            WEIGHTS,
            """SELECT article_id, round(source_weight, 6) AS source_weight, round(recency_weight, 6) AS recency_weight,
                      round(category_weight, 6) AS category_weight,
                      round(0.5::double * source_weight + 0.3::double * recency_weight + 0.2::double * category_weight, 6) AS article_weight
               FROM weights""",
        ),
    }



CLUSTERS = (
    WEIGHTS
    + """,
firsts AS (SELECT sample, lang, min(article_id) AS first FROM clean GROUP BY ALL),
ids AS (SELECT sample, lang, sample || '-' || (row_number() OVER (PARTITION BY sample ORDER BY first) - 1) AS cluster_id FROM firsts),
members AS (SELECT i.cluster_id, w.* FROM weights w JOIN ids i ON i.sample = w.sample AND i.lang = w.lang)"""
)

TERMS = (
    CLUSTERS
    + f""",
tok AS (SELECT cluster_id, article_id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
               lambda w: NOT list_contains({STOPS}, w)) AS t FROM members),
uni AS (SELECT cluster_id, article_id, unnest(t) AS a, unnest(range(len(t))) AS pos FROM tok),
grams AS (
  SELECT cluster_id, article_id, a AS term FROM uni
  UNION ALL
  SELECT x.cluster_id, x.article_id, x.a || ' ' || y.a FROM uni x JOIN uni y ON x.article_id = y.article_id AND y.pos = x.pos + 1
),
tf AS (SELECT cluster_id, article_id, term, count(*) AS tf FROM grams GROUP BY ALL),
sizes AS (SELECT cluster_id, count(*) AS n FROM members GROUP BY ALL),
df AS (SELECT tf.cluster_id, term, count(*) AS df, any_value(n) AS n FROM tf JOIN sizes ON sizes.cluster_id = tf.cluster_id GROUP BY ALL),
w AS (SELECT tf.cluster_id, article_id, tf.term, n, tf * (ln((1 + n) / (1 + df)) + 1) AS w
      FROM tf JOIN df ON tf.cluster_id = df.cluster_id AND tf.term = df.term WHERE df <= 0.9::double * n),
len AS (SELECT cluster_id, article_id, sqrt(sum(w * w)) AS l FROM w GROUP BY ALL),
score AS (SELECT w.cluster_id, term, round(sum(w / l) / max(n), 9) AS score
          FROM w JOIN len ON len.cluster_id = w.cluster_id AND len.article_id = w.article_id GROUP BY w.cluster_id, term),
top_terms AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY score DESC, term) AS rank FROM score) WHERE rank <= 8)"""
)

ENTITIES = (
    CLUSTERS
    + """,
ent AS (SELECT cluster_id, lower(e) AS entity, count(*) AS cnt FROM (SELECT cluster_id, unnest(nouns) AS e FROM members) GROUP BY ALL),
top_ent AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY cnt DESC, entity) AS rank FROM ent) WHERE rank <= 6)"""
)

PAIRS = """
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b,
                 round(1 - list_dot_product(a.embedding::double[], b.embedding::double[])
                       / ((sqrt(list_dot_product(a.embedding::double[], a.embedding::double[])) + 1e-9)
                          * (sqrt(list_dot_product(b.embedding::double[], b.embedding::double[])) + 1e-9)), 9) AS d
          FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
near AS (SELECT * FROM pairs WHERE d < 0.6)"""

DAYS = """
days AS (SELECT ts::date AS date, event_type || '/' || json_extract_string(props, '$.k') AS thread_id, count(*) / 10.0::double AS score,
                list_sort(list_distinct(list('u' || user_id))) AS ents FROM events GROUP BY ALL),
runs AS (SELECT *, date - (row_number() OVER (PARTITION BY thread_id ORDER BY date))::int AS run FROM days),
seg AS (SELECT *, min(date) OVER (PARTITION BY thread_id, run) AS segment,
               row_number() OVER (PARTITION BY thread_id, run ORDER BY date) AS i FROM runs)"""

EMA = (
    "RECURSIVE "
    + DAYS.strip()
    + """,
ema AS (
  SELECT thread_id, segment, date, i, score AS ema FROM seg WHERE i = 1
  UNION ALL
  SELECT s.thread_id, s.segment, s.date, s.i, 0.7::double * s.score + (1 - 0.7::double) * e.ema
  FROM ema e JOIN seg s ON s.thread_id = e.thread_id AND s.segment = e.segment AND s.i = e.i + 1
)"""
)

NOVELTY = """,
today AS (SELECT thread_id, segment, date, unnest(ents) AS e FROM seg),
size AS (SELECT thread_id, segment, date, count(*) AS n FROM today GROUP BY ALL),
past AS (SELECT DISTINCT s.thread_id, s.segment, s.date, t.e FROM seg s JOIN today t
         ON t.thread_id = s.thread_id AND t.segment = s.segment AND t.date < s.date AND t.date >= s.date - 7),
past_n AS (SELECT thread_id, segment, date, count(*) AS n FROM past GROUP BY ALL),
both_n AS (SELECT p.thread_id, p.segment, p.date, count(*) AS n FROM past p JOIN today t
           ON t.thread_id = p.thread_id AND t.date = p.date AND t.e = p.e GROUP BY ALL),
novelty AS (
  SELECT s.thread_id, s.segment, s.date,
         CASE WHEN s.date = s.segment THEN 1.0::double
              ELSE greatest(0, 1 - coalesce(b.n, 0) / (s2.n + coalesce(p.n, 0) - coalesce(b.n, 0))) END AS novelty
  FROM seg s JOIN size s2 ON s2.thread_id = s.thread_id AND s2.date = s.date
  LEFT JOIN past_n p ON p.thread_id = s.thread_id AND p.date = s.date
  LEFT JOIN both_n b ON b.thread_id = s.thread_id AND b.date = s.date
)"""


def clusters() -> dict[str, str]:
    return {
        "cluster_scores": with_(
            CLUSTERS
            + """,
m AS (SELECT cluster_id, sum(0.5::double * source_weight + 0.3::double * recency_weight + 0.2::double * category_weight) AS s,
             0.5::double * ln(1 + count(DISTINCT CASE WHEN source_weight >= 0.9 THEN source_domain END)) AS b FROM members GROUP BY 1)""",
            """SELECT cluster_id, round(s, 6) AS sum_article_weight, round(b, 6) AS diversity_bonus, round(s + b, 6) AS cluster_score_today FROM m""",
        ),
        "clusters_by_score": with_(
            CLUSTERS
            + """,
m AS (SELECT cluster_id, sum(0.5::double * source_weight + 0.3::double * recency_weight + 0.2::double * category_weight) AS s,
             0.5::double * ln(1 + count(DISTINCT CASE WHEN source_weight >= 0.9 THEN source_domain END)) AS b FROM members GROUP BY 1),
r AS (SELECT cluster_id, round(s + b, 6) AS cluster_score_today FROM m)""",
            """SELECT row_number() OVER (ORDER BY cluster_score_today DESC, cluster_id)::int AS rank, cluster_id, cluster_score_today
               FROM r ORDER BY 1 LIMIT 5""",
        ),
        "clusters_by_size": with_(
            CLUSTERS + ", z AS (SELECT cluster_id, count(*) AS size FROM members GROUP BY 1)",
            "SELECT row_number() OVER (ORDER BY size DESC, cluster_id)::int AS rank, cluster_id, size FROM z ORDER BY 1 LIMIT 5",
        ),
        "cluster_terms": with_(TERMS, "SELECT cluster_id, term, round(score, 6) AS score, rank::int AS rank FROM top_terms"),
        "cluster_entities": with_(ENTITIES, "SELECT cluster_id, entity, cnt, rank::int AS rank FROM top_ent"),
        "cluster_labels": with_(
            ENTITIES
            + """,
topic AS (SELECT cluster_id, topic FROM (
            SELECT cluster_id, topic, row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, topic) AS r
            FROM members WHERE topic <> '' AND lower(topic) <> 'unknown' GROUP BY cluster_id, topic) WHERE r = 1),
two AS (SELECT cluster_id, string_agg(entity, ' – ' ORDER BY rank) AS e FROM top_ent WHERE rank <= 2 GROUP BY 1)""",
            """SELECT DISTINCT m.cluster_id, coalesce(nullif(concat_ws(' – ', topic.topic, two.e), ''), 'misc') AS topic_label
               FROM members m LEFT JOIN topic ON topic.cluster_id = m.cluster_id LEFT JOIN two ON two.cluster_id = m.cluster_id""",
        ),
        "cluster_summary": with_(
            CLUSTERS
            + """,
t AS (SELECT cluster_id, md5(title) AS value, row_number() OVER (PARTITION BY cluster_id ORDER BY article_id) AS n FROM members WHERE title <> '')""",
            """SELECT cluster_id, 'size' AS kind, NULL AS value, count(*) AS n FROM members GROUP BY 1
               UNION ALL SELECT cluster_id, 'title', value, n FROM t WHERE n <= 6
               UNION ALL SELECT cluster_id, 'domain', source_domain, count(*) FROM members GROUP BY 1, 3
               UNION ALL SELECT cluster_id, 'topic', topic, count(*) FROM members WHERE lower(topic) <> 'unknown' GROUP BY 1, 3""",
        ),
        "cluster_centroids": """
            WITH e AS (SELECT label, unnest(embedding)::double AS x, unnest(range(len(embedding))) AS pos FROM embeddings)
            SELECT label AS cluster_id, pos::int AS pos, round(avg(x), 6) AS x FROM e GROUP BY label, pos""",
        "similar_vectors": with_(
            PAIRS, "SELECT a AS vec_id, count(*) AS n_within, arg_min(b, (d, b)) AS nearest_id, round(min(d), 6) AS dist FROM near GROUP BY a"
        ),
        "cluster_components": with_(
            "RECURSIVE "
            + PAIRS.strip()
            + """,
reach(v, r) AS (SELECT a, a FROM near UNION SELECT reach.v, near.b FROM reach JOIN near ON near.a = reach.r)""",
            "SELECT v AS vec_id, min(r) AS component FROM reach GROUP BY v",
        ),
        "resolve_vectors": """
            WITH v AS (SELECT vec_id, label, CASE WHEN embedding[1]::double <= 0.2::double OR label >= 5 THEN embedding END AS stored, embedding FROM embeddings),
            f AS (SELECT label, bool_and(stored IS NOT NULL) AS reuse FROM v GROUP BY 1),
            r AS (SELECT vec_id, v.label::varchar AS sample, reuse, CASE WHEN reuse THEN embedding ELSE list_reverse(embedding) END::double[] AS e,
                         sqrt(list_dot_product(embedding::double[], embedding::double[])) + 1e-9 AS n
                  FROM v JOIN f ON f.label = v.label),
            u AS (SELECT vec_id, sample, reuse, n, unnest(e) AS y, unnest(range(len(e)))::int AS pos FROM r)
            SELECT vec_id AS article_id, sample, reuse, pos, round(y / n, 6) AS x FROM u""",
        "link_threads": """
            WITH e AS (SELECT vec_id, label, unnest(embedding)::double AS x, unnest(range(len(embedding))) AS pos FROM embeddings),
            c AS (SELECT label, pos, avg(x) AS x FROM e GROUP BY ALL),
            cn AS (SELECT label, sqrt(sum(x * x)) + 1e-9 AS n FROM c GROUP BY 1),
            u AS (SELECT c.label, pos, x / n AS x FROM c JOIN cn ON cn.label = c.label),
            un AS (SELECT label, sqrt(sum(x * x)) + 1e-9 AS n FROM u GROUP BY 1),
            en AS (SELECT vec_id, sqrt(sum(x * x)) + 1e-9 AS n FROM e GROUP BY 1),
            s AS (SELECT e.vec_id, u.label, round(1 - sum(e.x * u.x) / (any_value(en.n) * any_value(un.n)), 9) AS d
                  FROM e JOIN u ON u.pos = e.pos JOIN en ON en.vec_id = e.vec_id JOIN un ON un.label = u.label GROUP BY e.vec_id, u.label),
            b AS (SELECT vec_id, arg_min('t' || label, (d, 't' || label)) AS thread_id, min(d) AS d FROM s WHERE d <= 0.7 GROUP BY 1)
            SELECT 'c' || v.vec_id AS cluster_id, thread_id, round(1 - d, 6) AS similarity FROM embeddings v LEFT JOIN b ON b.vec_id = v.vec_id""",
        "embed_text": with_(
            CLEAN, "SELECT article_id, 1.0::double AS length FROM clean WHERE regexp_matches(text, '[\\p{L}\\p{N}_]{2}')"
        ),
    }


def text_vectors() -> dict[str, str]:
    unit = CLEAN + f""",
cells AS (SELECT article_id, batch, unnest({WORDS_IN.format("coalesce(nullif(summary, ''), text)")}) AS w FROM clean),
tf AS (SELECT article_id, batch, (('0x' || md5(w)[1:8])::bigint % 262144)::int AS slot, count(*) AS tf FROM cells GROUP BY ALL),
idf AS (SELECT slot, ln((1 + (SELECT count(*) FROM clean)) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY 1),
cell AS (SELECT article_id, batch, tf.slot, tf * idf AS x FROM tf JOIN idf ON idf.slot = tf.slot),
size AS (SELECT article_id, sqrt(sum(x * x)) + 1e-9 AS n FROM cell GROUP BY 1),
unit AS (SELECT cell.article_id, batch, slot, x / n AS x FROM cell JOIN size ON size.article_id = cell.article_id)"""
    pairs = ",\nnear AS (SELECT l.article_id AS a, r.article_id AS b, round(1 - sum(l.x * r.x), 9) AS d FROM unit l JOIN unit r ON r.slot = l.slot AND {0} GROUP BY 1, 2 HAVING d {1})"
    return {
        "embed_slots": with_(
            unit,
            """SELECT article_id, count(*) AS slots, round(max(x), 6) AS top, sum(slot)::bigint AS slot_sum, round(sum(x), 6) AS total
               FROM unit GROUP BY 1""",
        ),
        "similar_texts": with_(
            "RECURSIVE " + unit.strip() + pairs.format("l.article_id <> r.article_id", "< 0.3")
            + ",\nreach(v, r) AS (SELECT a, a FROM near UNION SELECT reach.v, near.b FROM reach JOIN near ON near.a = reach.r)",
            """SELECT n.*, r.component FROM (SELECT a AS article_id, arg_min(b, (d, b)) AS nearest_id, round(min(d), 6) AS dist FROM near GROUP BY 1) n
               JOIN (SELECT v, min(r) AS component FROM reach GROUP BY 1) r ON r.v = n.article_id""",
        ),
        "link_text_threads": with_(
            unit + pairs.format("r.batch = 2", "<= 0.2"),
            """SELECT 'c' || a AS cluster_id, arg_min('t' || b, (d, 't' || b)) AS thread_id, round(1 - min(d), 6) AS similarity FROM near GROUP BY a""",
        ),
    }


def threads() -> dict[str, str]:
    day = "strftime({0}, '%Y-%m-%d') AS {0}"
    return {
        "thread_ema": with_(
            EMA, f"SELECT thread_id, {day.format('segment')}, {day.format('date')}, round(ema, 6) AS ema FROM ema"
        ),
        "thread_novelty": with_(
            DAYS + NOVELTY, f"SELECT thread_id, {day.format('segment')}, {day.format('date')}, round(novelty, 6) AS novelty FROM novelty"
        ),
        "top_threads": with_(
            EMA + NOVELTY,
            """SELECT e.thread_id || '/' || strftime(e.date, '%Y-%m-%d') AS cluster_id, round(e.ema + n.novelty, 6) AS trend_score
               FROM ema e JOIN novelty n ON n.thread_id = e.thread_id AND n.date = e.date ORDER BY 2 DESC, 1 LIMIT 10""",
        ),
        "upsert_threads": with_(
            DAYS
            + """,
late AS (SELECT * FROM days WHERE date >= DATE '2024-01-24')""",
            f"""SELECT {day.format('date')}, thread_id, round(CASE WHEN days.date >= DATE '2024-01-24' THEN score * 2 ELSE score END, 6) AS cluster_score_today FROM days
                UNION ALL SELECT strftime(late.date, '%Y-%m-%d'), split_part(thread_id, '/', 1), round(sum(score), 6) FROM late GROUP BY 1, 2""",
        ),
        "mark_rows": with_(
            CLEAN,
            """SELECT article_id, CASE WHEN article_id IN (SELECT article_id FROM clean WHERE lang = 'en') THEN true ELSE isCleaned END AS isCleaned
               FROM articles""",
        ),
    }


WORDS_IN = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"
TOPIC_LEX = (
    CLEAN
    + f""",
lex AS (SELECT DISTINCT unnest({WORDS_IN.format("text")}) AS word, ([{lits(TOPICS)}])[(item_id % 12) + 1] AS topic FROM benchmark)"""
)


def models() -> dict[str, str]:
    return {
        "extract_terms": with_(
            CLEAN,
            f"""SELECT a.article_id, coalesce(len(nouns), 0)::int AS n, md5(coalesce(array_to_string(nouns, ' '), '')) AS nouns_md5
                FROM articles a LEFT JOIN clean c ON c.article_id = a.article_id""",
        ),
        "extract_terms_lexicon": with_(
            TOPIC_LEX
            + """,
known AS (SELECT DISTINCT word, lower(substr(word, 1, (length(word) * 2 // 3)::int)) AS lemma FROM lex WHERE length(word) > 3),
tok AS (SELECT article_id, unnest(nouns) AS word, unnest(range(len(nouns))) AS pos FROM clean),
hit AS (SELECT article_id, count(*) AS n, string_agg(lemma, ' ' ORDER BY pos) AS x FROM tok JOIN known ON known.word = tok.word GROUP BY 1)""",
            "SELECT a.article_id, coalesce(n, 0)::int AS n, md5(coalesce(x, '')) AS nouns_md5 FROM articles a LEFT JOIN hit ON hit.article_id = a.article_id",
        ),
        "classify_topic": with_(
            TOPIC_LEX
            + f""",
tok AS (SELECT article_id, unnest({WORDS_IN.format("summary")}) AS word FROM clean),
sc AS (SELECT article_id, topic, count(*) AS n FROM tok JOIN lex ON lex.word = tok.word GROUP BY ALL),
best AS (SELECT article_id, topic, row_number() OVER (PARTITION BY article_id ORDER BY n DESC, topic) AS r FROM sc)""",
            """SELECT c.article_id, coalesce(b.topic, 'unknown') AS topic FROM clean c LEFT JOIN best b ON b.article_id = c.article_id AND b.r = 1""",
        ),
        "classify_sentiment": with_(
            CLEAN
            + f""",
cw AS (SELECT unnest({WORDS_IN.format("text")}) AS word, CASE role WHEN 'user' THEN 1 ELSE -1 END AS p FROM conversations),
pol AS (SELECT word, CASE WHEN sum(p) > 0 THEN 1.0::double ELSE -1.0::double END AS p FROM cw GROUP BY 1),
tok AS (SELECT article_id, unnest({WORDS_IN.format("summary")}) AS word FROM clean),
hit AS (SELECT article_id, sum(p) AS p, count(*) AS n FROM tok JOIN pol ON pol.word = tok.word GROUP BY 1)""",
            """SELECT c.article_id, CASE WHEN h.n IS NULL THEN 'unknown' WHEN h.p >= 0 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS label,
                      round(coalesce(abs(h.p) / h.n, 0.0), 6)::double AS score FROM clean c LEFT JOIN hit h ON h.article_id = c.article_id""",
        ),
        "choose_summary": with_(
            ARTICLES,
            """SELECT article_id, CASE WHEN lang = 'fr' AND title IS NOT NULL THEN 'stored' ELSE 'text or summary' END AS kind,
                      CASE WHEN lang = 'fr' AND title IS NOT NULL THEN md5(title) WHEN length(text) <= 200 THEN md5(text) END AS summary_md5,
                      CASE WHEN length(text) <= 200 THEN coalesce(CASE WHEN lang = 'fr' THEN title END, text) = text END AS short_kept
               FROM articles""",
        ),
    }


PLUGGED = "SELECT url, title, source, md5(text) AS text_md5, count(*) AS cnt FROM articles GROUP BY ALL"
FEED_ROWS = "url, coalesce({title}, '') AS title, source, md5(body) AS text_md5{more}, count(*) AS cnt"


def landed() -> dict[str, str]:
    bodies = ", bodies AS (SELECT url AS u, arg_min(text, article_id) AS body FROM articles GROUP BY 1)"
    return {
        "ingest_feed_json": with_(
            ARTICLES + bodies, f"SELECT {FEED_ROWS.format(title='title', more='')} FROM articles JOIN bodies ON u = url GROUP BY 1, 2, 3, 4"
        ),
        "ingest_mixed_json": with_(
            ARTICLES,
            f"""SELECT url, title, source, md5(t) AS text_md5, count(*) AS cnt FROM (
                  SELECT url, source, CASE article_id % 5 WHEN 1 THEN article_id::varchar WHEN 3 THEN {strip("coalesce(title, '') || chr(10) || coalesce(title, '')")}
                                      ELSE {strip("title")} END AS title,
                         CASE WHEN article_id % 5 IN (0, 2) THEN {strip("text")}
                              ELSE {strip(f"array_to_string(list_transform(string_split(text, chr(10)), lambda x: {strip('x')}), chr(10))")} END AS t
                  FROM articles WHERE text IS NOT NULL) GROUP BY ALL""",
        ),
        "ingest_category_json": with_(
            ARTICLES + bodies,
            f"""SELECT {FEED_ROWS.format(title='title', more=", category, strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') AS published_at")}
                FROM articles JOIN bodies ON u = url WHERE published_at::date = DATE '2025-08-12' AND category IS NOT NULL
                GROUP BY 1, 2, 3, 4, 5, 6""",
        ),
        "ingest_rss_xml": with_(
            ARTICLES, "SELECT url, title, 'wire' AS source, md5(source) AS text_md5, count(*) AS cnt FROM articles WHERE title IS NOT NULL GROUP BY 1, 2, 4"
        ),
        "ingest_plugged_source": with_(ARTICLES, PLUGGED),
        "stream_plugged_source": with_(ARTICLES, PLUGGED),
        # A link that is let through is followed by the first one more than seven days later, up to the first mark.
        "stream_link_pool": """
            WITH RECURSIVE links AS (
              SELECT 'u' || user_id AS url, ts, min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (PARTITION BY user_id) AS done_at, event_type
              FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
            open_links AS (SELECT DISTINCT url, ts FROM links WHERE coalesce(event_type <> 'purchase', true) AND (done_at IS NULL OR ts <= done_at)),
            chain AS (SELECT url, ts, min(ts) OVER (PARTITION BY url ORDER BY ts RANGE BETWEEN INTERVAL 604800000001 MICROSECONDS FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM open_links),
            through AS (
              SELECT url, min(ts) AS ts, arg_min(after, ts) AS after FROM chain GROUP BY url
              UNION ALL
              SELECT c.url, c.ts, c.after FROM through t JOIN chain c ON c.url = t.url AND c.ts = t.after)
            SELECT url, epoch_us(ts) AS at_us FROM through""",
        "stream_intake": "SELECT source, lang, count(*) AS cnt, sum(length(text))::bigint AS chars FROM documents GROUP BY ALL",
        "stream_url_dedup": "SELECT DISTINCT lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)) AS url FROM pages",
    }


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for part in (words, filters, samples, counts, upkeep, scores, clusters, text_vectors, threads, models, landed):
        out.update(part())
    return out
