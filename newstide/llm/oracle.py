"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from newstide.llm import secret_scan, urlfilter


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secret_spans(rule: secret_scan.Rule, order: int) -> str:
    """List of {start, ord, end, kind} of a rule's matches; lower-casing A to Z keeps positions."""
    text, pattern = "t", rule.pattern
    if rule.any_case:
        text, pattern = "translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')", pattern.replace("A-Za-z", "a-z")
    p = _quote(pattern)
    return f"""(
      SELECT list({{'start': s, 'ord': {order}, 'end': s + len(m), 'kind': '{rule.kind}'}})
      FROM (
        SELECT m, k, CAST(sum(len(g) + len(m)) OVER (ORDER BY i) - len(m) AS INTEGER) AS s
        FROM (
          SELECT unnest(regexp_extract_all({text}, {p}, 0)) AS m, unnest(regexp_extract_all({text}, {p}, {rule.group})) AS k,
            unnest(regexp_split_to_array({text}, {p})[:-2]) AS g, generate_subscripts(regexp_extract_all({text}, {p}, 0), 1) AS i
        )
      ) WHERE len(k) >= {rule.least}
    )"""


def _secrets_sql() -> str:
    rules = secret_scan.BASE + secret_scan.EXTRA
    base = ", ".join(_quote(r.kind) for r in secret_scan.BASE)
    spans = ", ".join(f"coalesce({_secret_spans(r, i)}, [])" for i, r in enumerate(rules))
    listed = "array_to_string(list_transform({}, lambda x: x.kind || ':' || x.start || ':' || x.end), ',')"
    counts = ", ".join(f"CAST(len(list_filter(spans, lambda x: x.kind = '{r.kind}')) AS BIGINT) AS n_{r.kind}" for r in secret_scan.BASE)
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    found AS (SELECT doc_id, list_sort(flatten([{spans}])) AS spans FROM d)
    SELECT doc_id, {counts},
      sha256({listed.format(f"list_filter(spans, lambda x: x.kind IN ({base}))")}) AS base_sha256,
      {listed.format("spans")} AS spans
    FROM found"""


def _url_sql() -> str:
    rules = sorted(urlfilter.HOST_RULES, key=lambda r: -len(r.name))
    fits = [f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))" for r in rules]
    name = " ".join(f"WHEN {f} THEN '{r.name}'" for f, r in zip(fits, rules, strict=True))
    verdict = " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in zip(fits, rules, strict=True))
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH cut AS (
      SELECT page_id, {low.format("coalesce(url, '')")} AS url_low,
        CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
    p AS (
      SELECT page_id, url_low, {low.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
      FROM cut)
    SELECT page_id, host, path, CASE {name} END AS rule, CASE {verdict} ELSE {urlfilter.verdict_sql()} END AS verdict FROM p"""


def _search_sql() -> str:
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    terms = f"unnest(regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term"
    return f"""
    WITH o AS (SELECT doc_id, {terms} FROM documents),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM o GROUP BY ALL),
    n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
    t AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
    m AS (SELECT doc_id, 50 + (50 * n * docs) // terms AS m FROM n, t),
    i AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {terms} FROM benchmark)),
    w AS (
      SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), t),
    s AS (
      SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM i JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
    WHERE rank <= 50"""


#: Every pair of a label is compared; reachable rows by recursion. The given tables are small enough for both.
_LINKS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = len(embedding)
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
link AS (
  SELECT p.vec_id AS u, q.vec_id AS w FROM v p JOIN v q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
  WHERE list_cosine_similarity(p.x, q.x) >= 0.93),
reach AS (SELECT vec_id AS u, vec_id AS w FROM embeddings UNION SELECT reach.u, link.w FROM reach JOIN link ON reach.w = link.u),
c AS (SELECT u, min(w) AS component_id FROM reach GROUP BY u),
n AS (SELECT u, count(*) AS n_links FROM link GROUP BY u)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.u = vec_id LEFT JOIN n ON n.u = vec_id"""


def oracle_sql() -> dict[str, str]:
    return {"op13_projection_passes": _LINKS_SQL, "op11_treap_search": _search_sql(), "op6_trigram_secrets": _secrets_sql(), "op8_url_rules": _url_sql()}
