"""The registered queries written again as DuckDB SQL, independent of the operators' code."""

from __future__ import annotations

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


_LEVELS = 6  # more than the segments of any path in the test tables; the statement ends with an error beyond them


def _url_levels(depth: int = _LEVELS) -> str:
    """Template tree of the URL filter, one block of common table expressions per level."""
    raws = [f"r{i}" for i in range(1, depth + 1)]
    shape = (
        "CASE WHEN seg = '' THEN '' WHEN regexp_matches(stem, '^[0-9]+$') OR regexp_matches(stem, '^[0-9A-Fa-f-]{8,}$')"
        " OR (length(stem) >= 12 AND regexp_matches(stem, '[0-9]')) OR length(stem) >= 40 THEN '{}' || ext ELSE seg END"
    )
    cols = []
    for i in range(1, depth + 1):
        seg = f"coalesce(segs[{i}], '')"
        stem = f"regexp_replace({seg}, '\\.[A-Za-z]{{1,5}}$', '')"
        ext = f"regexp_extract({seg}, '(\\.[A-Za-z]{{1,5}})$', 1)"
        cols.append(shape.replace("seg", seg).replace("stem", stem).replace(" ext ", f" {ext} ") + f" AS r{i}")
    sql = f"""
    shaped AS (SELECT *, {", ".join(cols)} FROM (
      SELECT *, string_split(regexp_replace(path, '^/', ''), '/') AS segs FROM ruled)),
    t0 AS (SELECT host, {", ".join(raws)}, '' AS tpl, 1 AS n, count(bad) AS lab, coalesce(sum(bad), 0) AS bad
      FROM shaped WHERE CASE WHEN len(segs) > {depth} THEN error('a path is too deep') ELSE true END GROUP BY ALL)"""
    for i, r in enumerate(raws):
        sql += f""",
    c{i} AS (SELECT host, tpl, {r}, sum(n) AS n, sum(lab) AS lab, sum(bad) AS bad FROM t{i} GROUP BY ALL),
    p{i} AS (SELECT *, count(*) OVER w AS kids, sum(n) OVER w AS pn, sum(lab) OVER w AS pl, sum(bad) OVER w AS pb
      FROM c{i} WINDOW w AS (PARTITION BY host, tpl)),
    s{i} AS (SELECT host, tpl, {r}, CASE WHEN {r} = '' THEN ''
      WHEN kids > 16 AND kids >= pn * 0.5 THEN '/*'
      WHEN lab > 0 AND pl - lab > 0 AND abs(bad / lab - (pb - bad) / (pl - lab))
        <= 1.96 * sqrt((pb / pl) * (1 - pb / pl) * (1 / lab + 1 / (pl - lab))) THEN '/*'
      ELSE '/' || {r} END AS step FROM p{i}),
    t{i + 1} AS (SELECT t.* REPLACE (t.tpl || s.step AS tpl) FROM t{i} t
      JOIN s{i} s ON t.host = s.host AND t.tpl = s.tpl AND t.{r} = s.{r})"""
    return sql + f""",
    pri AS (SELECT (sum(bad) + 1.0) / (sum(lab) + 2.0) AS prior FROM t{depth}),
    pur AS (SELECT host, tpl, CASE WHEN sum(lab) > 0 THEN (sum(bad) + 4.0 * any_value(prior)) / (sum(lab) + 4.0) END AS purity
      FROM t{depth}, pri GROUP BY host, tpl),
    fin AS (SELECT t.host, {", ".join("t." + r for r in raws)}, purity FROM t{depth} t JOIN pur USING (host, tpl))"""


URLS = f"""
WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
    parts AS (SELECT page_id, {_FOLD.format("regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1)")} AS host,
      regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    ruled AS (SELECT *, CASE rule WHEN 'example.net/en/' THEN 0 WHEN 'org/fr/' THEN 0 WHEN 'example.com/de/' THEN 1
        WHEN 'net/' THEN 1 END AS bad FROM (
      SELECT *, CASE
        WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts)),
    {_url_levels()}
SELECT page_id, s.host AS host, path, rule, CASE WHEN bad = 1 THEN 'block' WHEN bad = 0 THEN 'allow'
    WHEN purity >= 0.8 THEN 'block' ELSE 'allow' END AS verdict
FROM shaped s LEFT JOIN fin f
  ON s.host = f.host AND {" AND ".join(f"s.r{i} = f.r{i}" for i in range(1, _LEVELS + 1))}
"""

_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_FOLD.format("coalesce(text, '')"))

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    wins AS (SELECT DISTINCT item_id, win FROM (
      SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 8, 2)), lambda k: w[k:k + 9])) AS win
      FROM i WHERE len(w) > 0)),
    lens AS (SELECT DISTINCT len(win) AS l FROM wins),
    spots AS (SELECT doc_id, l, w, unnest(range(1, len(w) - l + 2)) AS p FROM d, lens WHERE len(w) >= l),
    hit AS (SELECT doc_id, p, l, item_id FROM spots JOIN wins ON w[p:p + l - 1] = win),
    per AS (SELECT doc_id, list(DISTINCT item_id::VARCHAR) AS items FROM hit GROUP BY doc_id),
    pos AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (
      SELECT doc_id, unnest(range(p, p + l)) AS q FROM (SELECT DISTINCT doc_id, p, l FROM hit)) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(len(items), 0)::BIGINT AS n_items,
    sha256(coalesce(array_to_string(list_sort(items), ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN pos USING (doc_id)
"""

MIXING = r"""
WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
      md5('17-' || doc_id) AS shuffle FROM documents),
    per AS (SELECT source, sum(size)::BIGINT AS source_size,
      [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
      FROM s GROUP BY source),
    lev AS (SELECT *, 3.0::DOUBLE * source_size AS cap, (sum(source_size) OVER ()::DOUBLE
        - coalesce(sum(3.0::DOUBLE * source_size) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM per),
    tgt AS (SELECT source, source_size, least(coalesce(water * weight, cap), cap) AS target FROM (
      SELECT *, max(CASE WHEN lvl * weight <= cap THEN lvl END) OVER () AS water FROM lev)),
    q AS (SELECT doc_id, size, source_size, target, shuffle,
      sum(size) OVER (PARTITION BY s.source ORDER BY shuffle, doc_id ROWS UNBOUNDED PRECEDING)::BIGINT AS sent
      FROM s JOIN tgt ON s.source IS NOT DISTINCT FROM tgt.source),
    e AS (SELECT doc_id, size, shuffle, turn, (turn * source_size + sent) / target AS finish
      FROM q, (SELECT unnest([0, 1, 2]) AS turn) WHERE size > 0
        AND (turn * source_size + sent) / target - size / target <= 1.0),
    m AS (SELECT doc_id, sum(size) OVER (ORDER BY finish, shuffle, doc_id, turn ROWS UNBOUNDED PRECEDING) AS mixed FROM e),
    k AS (SELECT doc_id, count(*) AS copies FROM m, (SELECT sum(target) AS budget FROM tgt) WHERE mixed <= budget GROUP BY doc_id)
SELECT doc_id, size, source_size, target, (coalesce(copies, 0) * size)::BIGINT AS taken FROM q LEFT JOIN k USING (doc_id)
"""

_NORMAL = _FOLD.format(r"trim(regexp_replace(part, '[\x20\x09-\x0D]+', ' ', 'g'))")

LINES = f"""
WITH p AS (SELECT doc_id, list_filter(regexp_extract_all(text, '(?s).*?(?:\\n|[.!?]+[ \\t]|[。！？]|\\z)'), lambda x: x <> '') AS parts FROM documents),
    q AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS u FROM p),
    n AS (SELECT doc_id, u, length(part) AS len, {_NORMAL} AS norm FROM q),
    c AS (SELECT *, count(*) OVER (PARTITION BY norm) AS copies, row_number() OVER (PARTITION BY norm ORDER BY doc_id, u) AS rank,
      sum(len) OVER (PARTITION BY doc_id ORDER BY u) - len AS start FROM n),
    v AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY u) AS place FROM c WHERE norm <> ''),
    -- Neighbouring repeated units have the same difference of place and number among the repeated ones.
    g AS (SELECT *, place - row_number() OVER (PARTITION BY doc_id ORDER BY u) AS run FROM v WHERE copies > 1),
    r AS (SELECT * FROM (SELECT *, sum(length(norm)) OVER (PARTITION BY doc_id, run) AS chars FROM g) WHERE chars >= 200),
    d AS (SELECT doc_id, count(*) AS n_repeated, count(*) FILTER (rank > 1) AS n_removed,
      string_agg(start::BIGINT || '-' || (start + len)::BIGINT, ',' ORDER BY u) FILTER (rank > 1) AS spans FROM r GROUP BY doc_id)
SELECT p.doc_id AS doc_id, coalesce(len(parts), 0)::BIGINT AS n_units, coalesce(n_repeated, 0)::BIGINT AS n_repeated,
    coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(spans, '') AS removed_spans
FROM p LEFT JOIN d ON p.doc_id = d.doc_id
"""

JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda k: array_to_string(w[k:k + 2], ' ')) END) AS g FROM w),
    n AS (SELECT doc_id, len(g)::BIGINT AS n FROM s),
    e AS (SELECT doc_id, unnest(g) AS x FROM s),
    f AS (SELECT x FROM e GROUP BY x HAVING count(*) > 1),
    e2 AS (SELECT e.* FROM e JOIN f USING (x)),
    o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM e2 a JOIN e2 b ON a.x = b.x AND a.doc_id < b.doc_id
      GROUP BY ALL),
    l AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * common >= 90 * (p.n + q.n - common)),
    u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r(doc_id, root) AS (SELECT doc_id, doc_id FROM n UNION SELECT u.b, r.root FROM r JOIN u ON u.a = r.doc_id WHERE r.root < u.b)
SELECT n.doc_id AS doc_id, n AS n_shingles, low AS component_id
FROM n JOIN (SELECT doc_id, min(root) AS low FROM r GROUP BY doc_id) m ON n.doc_id = m.doc_id
"""
