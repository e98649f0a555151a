"""Check SQL (DuckDB) of the corpus queries that SQL can express."""

from __future__ import annotations

from marketloom.llm import licenses as lic
from marketloom.llm import quality as q
from marketloom.llm import urls as u
from marketloom.llm.words import LOWER, UPPER

_WORD = r"[^\x20\x09-\x0D]+"


def quality() -> str:
    def bucket(v: str) -> str:
        top = f"(length(bin({v})) - 1)"
        return f"CASE WHEN {v} < 64 THEN {v} ELSE 64 + ({top} - 6) * 32 + ({v} >> ({top} - 5)) - 32 END"

    value = lambda b: f"CASE WHEN {b} < 64 THEN {b} ELSE (({b} - 64) % 32 + 32) << (({b} - 64) // 32 + 1) END"
    metrics = {
        "symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"),
        "repeats": ("n_repeat_words", "n_words"), "word_length": ("word_chars", "n_words"),
    }
    shares = {k: f"({a} * {q.SCALE} // greatest({b}, 1))" for k, (a, b) in metrics.items()}
    stacked = " UNION ALL ".join(
        f"SELECT lang, source, '{k}' AS metric, {v} AS v FROM base WHERE NOT base_failed" for k, v in shares.items())
    least = "CASE metric " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in q.METRICS.items()) + " END"
    quart = lambda name, keys: f"""
      {name} AS (
        SELECT {keys} metric, max(total) AS total, min(b) FILTER (4 * upto >= total) AS qb1,
               min(b) FILTER (4 * upto >= 3 * total) AS qb3
        FROM (SELECT {keys} metric, b, sum(n) OVER (PARTITION BY {keys} metric) AS total,
                     sum(n) OVER (PARTITION BY {keys} metric ORDER BY b) AS upto
              FROM (SELECT {keys} metric, b, sum(n) AS n FROM sketch GROUP BY ALL))
        GROUP BY ALL)"""  # noqa: E731
    pick = lambda c: f"CASE WHEN f.total >= {q.MIN_GROUP} THEN f.{c} WHEN l.total >= {q.MIN_GROUP} THEN l.{c} ELSE a.{c} END"
    inside = " AND ".join(
        f"coalesce({v} <= (SELECT fence FROM fences x WHERE x.lang IS NOT DISTINCT FROM base.lang "
        f"AND x.source IS NOT DISTINCT FROM base.source AND x.metric = '{k}'), true)" for k, v in shares.items())
    return f"""
    WITH split AS (
      SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS body,
             regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines
      FROM documents),
    windows AS (
      SELECT rid, p, [w[p], w[p + 1], w[p + 2]] AS win
      FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS p FROM split)),
    repeated AS (
      SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, win) AS n FROM windows) WHERE n > 1),
    covered AS (
      SELECT rid, count(*) AS n FROM (
        SELECT DISTINCT rid, p + d AS at FROM repeated, (VALUES (0), (1), (2)) t(d)) GROUP BY rid),
    counts AS (
      SELECT doc_id, lang, source, len(w)::BIGINT AS n_words,
             length(array_to_string(w, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(body, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             len(lines)::BIGINT AS n_lines,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(n, 0)::BIGINT AS n_repeat_words
      FROM split LEFT JOIN covered USING (rid)),
    base AS (
      SELECT *, (n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEATED_PCT} * n_words) AS base_failed
      FROM counts),
    sketch AS (
      SELECT lang, source, metric, {bucket('v')} AS b, count(*) AS n FROM ({stacked}) GROUP BY ALL),
    {quart('fine', 'lang, source,')}, {quart('by_lang', 'lang,')}, {quart('overall', '')},
    picked AS (
      SELECT f.lang, f.source, f.metric, {pick('qb1')} AS b1, {pick('qb3')} AS b3
      FROM fine f JOIN by_lang l ON l.lang IS NOT DISTINCT FROM f.lang AND l.metric = f.metric
      JOIN overall a ON a.metric = f.metric),
    fences AS (
      SELECT lang, source, metric, ({value('b3')}) + {q.REACH} * greatest(({value('b3')}) - ({value('b1')}), {least}) AS fence
      FROM picked)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND {inside} AS kept
    FROM base"""


def urls() -> str:
    lower = lambda x: f"translate({x}, '{UPPER}', '{LOWER}')"
    fits = " UNION ALL ".join(
        f"SELECT rid, '{r.host}{r.path}' AS rule, '{r.verdict}' AS ruled FROM parts "
        f"WHERE ends_with('.' || host, '.{r.host}') AND starts_with(path, '{r.path}')" for r in u.RULES)
    keep, pass_on = 1 - u.DAMPING, u.DAMPING
    steps = "".join(f"""
    rank{i} AS MATERIALIZED (
      SELECT host, coalesce(t0, 0) + {pass_on} * coalesce(t, 0) AS t, coalesce(d0, 0) + {pass_on} * coalesce(d, 0) AS d
      FROM seed FULL JOIN (
        SELECT host, sum(t) AS t, sum(d) AS d FROM (
          SELECT dst AS host, n / n_out * r.t AS t, 0 AS d FROM weights JOIN rank{i - 1} r ON r.host = src
          UNION ALL
          SELECT src, 0, n / n_in * r.d FROM weights JOIN rank{i - 1} r ON r.host = dst) GROUP BY host) USING (host)),"""
                    for i in range(1, u.STEPS + 1))
    href = u.HREF.replace("'", "''")
    return f"""
    WITH parts AS MATERIALIZED (
      SELECT row_number() OVER () AS rid, page_id, html,
             coalesce({lower("regexp_extract(url, '://([^/?#]*)', 1)")}, '') AS host,
             coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
      FROM pages),
    fits AS ({fits}),
    best AS (SELECT rid, arg_max(rule, length(rule)) AS rule, arg_max(ruled, length(rule)) AS ruled FROM fits GROUP BY rid),
    judged AS MATERIALIZED (SELECT * FROM parts LEFT JOIN best USING (rid)),
    seed AS MATERIALIZED (
      SELECT host, {keep} * avg(coalesce(ruled = 'allow', false)::INT) AS t0,
             {keep} * avg(coalesce(ruled = 'block', false)::INT) AS d0
      FROM judged WHERE host <> '' GROUP BY host),
    links AS MATERIALIZED (
      SELECT src, dst, count(*) AS n FROM (
        SELECT DISTINCT rid, host AS src, {lower("unnest(regexp_extract_all(html, '" + href + "', 1))")} AS dst
        FROM parts WHERE host <> '') WHERE src <> dst GROUP BY ALL),
    weights AS MATERIALIZED (
      SELECT *, sum(n) OVER (PARTITION BY src) AS n_out, sum(n) OVER (PARTITION BY dst) AS n_in FROM links),
    rank0 AS MATERIALIZED (SELECT host, t0 AS t, d0 AS d FROM seed),{steps}
    ranks AS (SELECT * FROM rank{u.STEPS})
    SELECT page_id, j.host, path, rule,
           coalesce(ruled, CASE WHEN d > t AND d > {keep} * {u.SHARE} THEN 'block' ELSE 'allow' END) AS verdict
    FROM judged j LEFT JOIN ranks USING (host)"""


def licenses() -> str:
    lower = lambda x: f"translate({x}, '{UPPER}', '{LOWER}')"
    term = r"[a-z0-9]+(?:\.[0-9]+)*"
    templates = ", ".join(f"('{k}', '{v}')" for k, v in lic.TEMPLATES.items())
    return f"""
    WITH doc AS MATERIALIZED (
      SELECT doc_id, coalesce(text, '') AS body, source, lang,
             array_to_string(list_filter(string_split({lower("coalesce(text, '')")}, chr(10)),
                                         lambda x: regexp_matches(x, '{lic.CUES}')), chr(10)) AS head
      FROM documents),
    named AS MATERIALIZED (
      SELECT *, concat_ws('/', coalesce(source, 'none'), coalesce(lang, 'none'), doc_id // 1000) AS folder,
             3 * length(head) >= length(body) AND body <> '' AS is_license FROM doc),
    files AS MATERIALIZED (
      SELECT doc_id, folder, is_license,
             folder || '/' || CASE WHEN is_license THEN 'LICENSE-' || doc_id ELSE doc_id || '.txt' END AS path,
             CASE WHEN is_license THEN {lower("body")} ELSE head END AS header FROM named),
    tpl AS (SELECT k, unnest(regexp_extract_all({lower("v")}, '{term}')) AS term FROM (VALUES {templates}) t(k, v)),
    tpl_tf AS (SELECT k, term, count(*) AS tf FROM tpl GROUP BY ALL),
    tpl_w AS (SELECT k, term, tf, ln({1.0 + len(lic.TEMPLATES)} / count(*) OVER (PARTITION BY term)) AS idf FROM tpl_tf),
    unit AS MATERIALIZED (
      SELECT k, term, idf, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY k)) AS weight FROM tpl_w),
    idfs AS (SELECT term, max(idf) AS idf FROM unit GROUP BY term),
    tf AS (SELECT doc_id, term, count(*) AS tf
           FROM (SELECT doc_id, unnest(regexp_extract_all(header, '{term}')) AS term FROM files) GROUP BY ALL),
    w AS MATERIALIZED (SELECT doc_id, term, tf * coalesce(idf, ln({1.0 + len(lic.TEMPLATES)})) AS w FROM tf LEFT JOIN idfs USING (term)),
    norm AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id),
    cos AS (SELECT doc_id, k, round(sum(w * weight) / any_value(norm), {lic.PLACES}) AS cosine
            FROM w JOIN unit USING (term) JOIN norm USING (doc_id) GROUP BY doc_id, k),
    best AS (SELECT doc_id, k AS own, cosine FROM cos WHERE cosine >= {lic.MIN_COSINE}
             QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, k) = 1),
    found AS MATERIALIZED (SELECT * FROM files LEFT JOIN best USING (doc_id)),
    near AS (SELECT folder, arg_min(own, path) AS l FROM found WHERE is_license AND own IS NOT NULL GROUP BY folder),
    inherits AS (
      SELECT f.folder, arg_max(n.l, length(n.folder)) AS near
      FROM (SELECT DISTINCT folder FROM files) f JOIN near n ON f.folder = n.folder OR starts_with(f.folder, n.folder || '/')
      GROUP BY f.folder)
    SELECT doc_id, path, own, cosine, coalesce(own, near) AS license,
           CASE WHEN own IS NOT NULL THEN 'own' WHEN near IS NOT NULL THEN 'inherited' END AS origin
    FROM found LEFT JOIN inherits USING (folder)"""
