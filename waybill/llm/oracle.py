"""DuckDB SQL for those queries of this subpackage that SQL can express."""

WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP2 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents
), wins AS (
  SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE doc_id IS NOT NULL)
), least AS (SELECT k, min(doc_id) AS m FROM wins GROUP BY k),
gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM wins JOIN least USING (k) WHERE doc_id > m
), words AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT r, string_agg(x, ' ' ORDER BY p) AS s, count(*) AS n FROM words ANTI JOIN gone USING (r, p) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP4 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""

OP9 = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents
), s AS (
  SELECT r, doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS g
  FROM d
), x AS MATERIALIZED (SELECT r, len(g) AS n, unnest(g) AS k FROM s),
p AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM x a JOIN x b ON a.k = b.k AND a.r <> b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT r AS a, r AS b FROM s
  UNION
  SELECT reach.a, p.b FROM reach JOIN p ON reach.b = p.a
)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, m.component_id
FROM s JOIN (SELECT reach.a, min(s.doc_id) AS component_id FROM reach JOIN s ON s.r = reach.b GROUP BY 1) m ON m.a = s.r
"""

OP10 = r"""
WITH c AS (
  SELECT page_id, url,
         make_timestamp(1000000 * (1704067200 +
           ('0x' || substr(md5(concat_ws('|', url, page_id::VARCHAR)), 1, 7))::BIGINT % (366 * 86400))) AS fetched_at,
         nullif(lower(regexp_replace(regexp_extract(trim(url),
           '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '\.$', '')), '') AS host,
         regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), h AS (
  SELECT host, n, to_timestamp(1704067200 + n % (200 * 86400))::TIMESTAMP AS a,
         to_timestamp(1704067200 + n % (200 * 86400) + (n % 97 + 1) * 86400)::TIMESTAMP AS b,
         string_split(host, '.') AS l
  FROM (SELECT DISTINCT host, ('0x' || substr(md5(host), 1, 7))::BIGINT % 134217728 AS n FROM c WHERE host IS NOT NULL)
), log AS (
  SELECT 'hosts' AS list, 'block' AS action, 'host' AS kind, host AS pattern, a AS since, 0 AS removed FROM h WHERE n % 3 = 0
  UNION ALL SELECT 'hosts', 'block', 'host', host, b, 1 FROM h WHERE n % 6 = 0
  UNION ALL SELECT 'domains', 'block', 'domain', array_to_string(l[-2:], '.'), a, 0 FROM h WHERE n % 4 = 0 AND len(l) > 1
  UNION ALL SELECT 'domains', 'block', 'domain', array_to_string(l[-2:], '.'), b, 1 FROM h WHERE n % 2 = 0 AND len(l) > 1
  UNION ALL SELECT 'paths', 'allow', 'prefix', host || '/en/', b, 0 FROM h WHERE n % 5 < 2
), each AS (
  SELECT list, action, kind, pattern, since, max(removed) AS removed FROM log GROUP BY ALL
), changes AS (
  SELECT * FROM (
    SELECT *, lag(removed, 1, 1) OVER (PARTITION BY list, action, kind, pattern ORDER BY since) AS before FROM each
  ) WHERE removed <> before
), held AS (
  SELECT * FROM (
    SELECT *, lead(since) OVER (PARTITION BY list, action, kind, pattern ORDER BY since) AS until FROM changes
  ) WHERE removed = 0
), met AS (
  SELECT c.page_id, c.url, c.fetched_at, held.list, held.action, held.kind, held.pattern,
         CASE held.kind WHEN 'domain' THEN len(string_split(held.pattern, '.')) WHEN 'host' THEN 1000000
           ELSE 2000000 + len(string_split(held.pattern, '/')) - 1 END AS weight
  FROM c JOIN held ON fetched_at >= since AND (until IS NULL OR fetched_at < until) AND CASE held.kind
    WHEN 'host' THEN c.host = held.pattern
    WHEN 'domain' THEN c.host = held.pattern OR ends_with(c.host, '.' || held.pattern)
    ELSE starts_with(c.host || c.path, held.pattern) END
), best AS (
  SELECT *, row_number() OVER (
    PARTITION BY page_id, url ORDER BY weight DESC, action DESC, kind DESC, pattern DESC, list DESC
  ) AS place FROM met
)
SELECT c.page_id, c.url, c.fetched_at, coalesce(best.action, 'unlisted') AS verdict, best.list, best.kind, best.pattern
FROM c LEFT JOIN best ON best.page_id = c.page_id AND best.url = c.url AND place = 1
"""

OP3 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS t,
         {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents
), tok AS MATERIALIZED (
  SELECT r, coalesce(t, false) AS mine, unnest(list_append(w, ' ')) AS w, unnest(list_prepend(' ', w)) AS v
  FROM d WHERE len(w) > 0
), n AS (SELECT count(*) FILTER (mine) AS nt, count(*) FILTER (NOT mine) AS nb, count(DISTINCT w) AS vocabulary FROM tok),
ow AS (SELECT r, w, count(*) AS c FROM tok GROUP BY ALL),
o2 AS (SELECT r, v, w, count(*) AS c FROM tok GROUP BY ALL),
cw AS (SELECT w, count(*) FILTER (mine) AS ct, count(*) FILTER (NOT mine) AS cb FROM tok GROUP BY w),
c2 AS (SELECT v, w, count(*) FILTER (mine) AS ct, count(*) FILTER (NOT mine) AS cb FROM tok GROUP BY v, w),
e AS (
  SELECT tok.r,
    cw.ct - CASE WHEN mine THEN ow.c ELSE 0 END AS wt, cw.cb - CASE WHEN mine THEN 0 ELSE ow.c END AS wb,
    cv.ct - CASE WHEN mine THEN ov.c ELSE 0 END AS vt, cv.cb - CASE WHEN mine THEN 0 ELSE ov.c END AS vb,
    c2.ct - CASE WHEN mine THEN o2.c ELSE 0 END AS bt, c2.cb - CASE WHEN mine THEN 0 ELSE o2.c END AS bb,
    greatest(nt - CASE WHEN mine THEN len(d.w) + 1 ELSE 0 END, 1) AS nt,
    greatest(nb - CASE WHEN mine THEN 0 ELSE len(d.w) + 1 END, 1) AS nb, vocabulary
  FROM tok JOIN d USING (r) JOIN ow ON ow.r = tok.r AND ow.w = tok.w JOIN ow ov ON ov.r = tok.r AND ov.w = tok.v
  JOIN o2 ON o2.r = tok.r AND o2.v = tok.v AND o2.w = tok.w
  JOIN cw ON cw.w = tok.w JOIN cw cv ON cv.w = tok.v JOIN c2 ON c2.v = tok.v AND c2.w = tok.w, n
), loss AS (
  SELECT r,
    sum(round_even(-ln(0.6::DOUBLE * CASE WHEN vt > 0 THEN bt / vt ELSE wt / nt END + 0.3::DOUBLE * (wt / nt)
      + 0.1::DOUBLE / vocabulary) * 1000000, 0)::BIGINT)::BIGINT AS a,
    sum(round_even(-ln(0.6::DOUBLE * CASE WHEN vb > 0 THEN bb / vb ELSE wb / nb END + 0.3::DOUBLE * (wb / nb)
      + 0.1::DOUBLE / vocabulary) * 1000000, 0)::BIGINT)::BIGINT AS b
  FROM e GROUP BY r
)
SELECT doc_id, coalesce(t, false) AS in_target, CASE WHEN len(w) > 0 THEN len(w) + 1 ELSE 0 END::BIGINT AS n_tokens, coalesce(a, 0) AS target_loss,
       coalesce(b, 0) AS background_loss, (a - b)::DOUBLE / (len(w) + 1) / 1000000 AS score
FROM d LEFT JOIN loss USING (r)
"""

OP12 = r"""
WITH t AS MATERIALIZED (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
  ), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, p, role, text FROM c JOIN t ON t.conv_id = c.base AND t.p <= c.h
  UNION ALL
  SELECT c.conv_id, p - c.h + (SELECT count(*) FROM t b WHERE b.conv_id = c.base AND b.p <= c.h), role, text
  FROM c JOIN t ON t.conv_id = c.conv_id AND t.p > c.h
), l AS MATERIALIZED (
  SELECT c.conv_id, list([role, text] ORDER BY p) FILTER (p IS NOT NULL) AS turns FROM c LEFT JOIN r USING (conv_id) GROUP BY 1
), s AS MATERIALIZED (
  SELECT conv_id, d, coalesce(turns, [])[:d] AS k, len(coalesce(turns, [])) = d AS last
  FROM (SELECT conv_id, turns, unnest(range(0, len(coalesce(turns, [])) + 1)) AS d FROM l)
), n AS MATERIALIZED (
  SELECT min(conv_id) AS conv_id, d, k, count(*) AS n_convs,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last) AS ended,
         (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE
           len(list_filter(regexp_split_to_array(k[d][2], '[\x20\x09-\x0D]+'), lambda w: w <> '')) END AS own
  FROM s GROUP BY d, k
), m AS MATERIALIZED (
  SELECT s.conv_id AS member, n.d, n.conv_id FROM s JOIN n USING (d, k)
), e AS MATERIALIZED (
  SELECT n.*, m.conv_id AS parent_conv_id FROM n LEFT JOIN m ON m.member = n.conv_id AND m.d = n.d - 1
), kids AS (SELECT d - 1 AS d, parent_conv_id AS conv_id, count(*) AS n_children FROM e WHERE d > 0 GROUP BY ALL),
f AS MATERIALIZED (SELECT e.*, coalesce(n_children, 0) AS n_children FROM e LEFT JOIN kids USING (d, conv_id)),
sub AS (
  SELECT m.d, m.conv_id, count(*) FILTER (f.n_children = 0) AS n_leaves, sum(f.own) AS saved_tokens
  FROM f JOIN m ON m.member = f.conv_id AND m.d <= f.d GROUP BY ALL
)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens,
       sha256(coalesce(ended, '')) AS ends_sha256
FROM f JOIN sub USING (d, conv_id)
"""

TERMS = (
    r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

OP13 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         {TERMS.format("coalesce(text, '')")} AS w
  FROM documents
), q AS (
  SELECT DISTINCT item_id, unnest({TERMS.format("text")}) AS t
  FROM benchmark
), s AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS all_terms FROM d WHERE len(w) > 0),
p AS (
  SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM d)
  WHERE t IN (SELECT t FROM q) GROUP BY ALL
), f AS (SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY t, docs),
g AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // all_terms))))::BIGINT AS score
  FROM p JOIN f USING (t) JOIN q USING (t), s GROUP BY item_id, r, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM g WHERE score > 0
) WHERE rank <= 50
"""
