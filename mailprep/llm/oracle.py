"""The same results as DuckDB statements, where SQL can express them."""

ORACLE: dict[str, str] = {}

ORACLE["op1_topk_search"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id,
             coalesce(list_sum(list_transform(list_zip(q.v, d.v), lambda p: coalesce(p[1] * p[2], 0))), 0)::BIGINT AS score
      FROM v q JOIN v d ON q.vec_id % 20 = 0 AND d.vec_id <> q.vec_id),
r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""

LINK = r"""(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b"""
RULES = """(VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                   ('block', 'net', '/es/'), ('block', 'net', '/fr/'))"""

# The given pages name neither a canonical page nor a redirect, so nothing spreads; a page that did would show up as an
# error here instead of as a wrong verdict.
ORACLE["op6_url_filters"] = rf"""
WITH p AS (SELECT page_id, html, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
                  row_number() OVER () AS n FROM pages),
r AS (SELECT p.n, arg_max(h || b, length(h || b)) AS rule, arg_max(v, length(h || b)) AS verdict
      FROM p JOIN {RULES} t(v, h, b) ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, b) GROUP BY p.n)
SELECT page_id, host, path, rule,
       CASE WHEN verdict IS NULL AND regexp_matches(html, '{LINK}') THEN error('an alias')
            ELSE coalesce(verdict, 'allow') END AS verdict
FROM p LEFT JOIN r USING (n)"""

# Sizes, targets and takes as in the operator's contract; the place along the curriculum inverts the integral of a
# weight that runs from 1 + slope to 1 - slope.
ORACLE["op7_source_mix"] = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  md5(concat_ws('|', doc_id::VARCHAR, md5(coalesce(text, '')))) AS mark FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS place FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][place] AS weight, [0.5, 0.0, -0.5][place]::DOUBLE AS slope, 200 * source_size AS most,
             200 * source_size / [3, 1, 2][place] AS met, 150 * sum(source_size) OVER () AS total FROM s),
c AS (SELECT *, coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done,
             sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_over
      FROM w WINDOW o AS (ORDER BY met, source NULLS LAST)),
l AS (SELECT *, ((total - done)::BIGINT / left_over::BIGINT)::DOUBLE AS level FROM c),
t AS (SELECT source, source_size, slope,
             least(most::DOUBLE, weight * coalesce((SELECT arg_min(level, met) FROM l WHERE level <= met), 0)) / 100 AS target
      FROM l),
a AS (SELECT d.*, source_size, slope, target,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY mark ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                      0)::DOUBLE AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, greatest(0, least(size, floor(target - start)))::BIGINT AS once,
             greatest(0, least(size, floor(target - start - source_size)))::BIGINT AS twice FROM a)
SELECT doc_id, size, source_size, target, once + twice AS taken,
       CASE WHEN once + twice = 0 THEN NULL WHEN slope = 0 THEN start / target
            ELSE start / target * 2 / (slope + 1 + sqrt(greatest((slope + 1) * (slope + 1) - slope * (start / target) * 4, 0.0)))
       END AS position
FROM k"""

CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''),
    lambda c: ascii(c)::BIGINT)), lambda c, x: list_reduce(list_concat([xor(c, x)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda v, _: xor(v >> 1, 3988292384 * (v & 1)))))"""


def _part(c: str) -> str:
    return f"coalesce(octet_length(encode(({c})::VARCHAR))::VARCHAR || ':' || ({c})::VARCHAR, '-')"


ROW = " || ".join(_part(c) for c in ("doc_id", "source", "lang", "n_chars"))
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# One tree per source by rounds of sixteen, one over the sources; then every row's siblings level by level.
ORACLE["op11_merkle_manifest"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, sha256({ROW} || {_part("text")}) AS leaf,
         CASE WHEN {CRC} % 5 = 0 THEN sha256({ROW} || {_part(LOWERED)}) END AS changed FROM documents),
s AS (SELECT source, (row_number() OVER (ORDER BY source NULLS FIRST) - 1)::BIGINT AS grp, count(*) AS k FROM d GROUP BY source),
p AS (SELECT d.*, grp, k, (row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, changed) - 1)::BIGINT AS pos
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
n(lv, grp, pos, h, k) AS (SELECT 0, grp, pos, leaf, k FROM p
      UNION ALL SELECT lv + 1, grp, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(k) + 15) // 16
      FROM n WHERE k > 1 GROUP BY lv, grp, pos // 16),
r AS (SELECT grp, h AS subroot FROM n WHERE k = 1),
m(lv, pos, h, k) AS (SELECT 0, grp, subroot, (SELECT count(*) FROM r) FROM r
      UNION ALL SELECT lv + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(k) + 15) // 16
      FROM m WHERE k > 1 GROUP BY lv, pos // 16),
ns AS (SELECT *, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') || '|' ||
       coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS beside
       FROM n WINDOW w AS (PARTITION BY grp, lv, pos // 16 ORDER BY pos)),
ms AS (SELECT *, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') || '|' ||
       coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS beside
       FROM m WINDOW w AS (PARTITION BY lv, pos // 16 ORDER BY pos)),
w AS (SELECT p.grp, p.pos, 0 AS tree, ns.lv, ns.beside FROM p JOIN ns ON ns.grp = p.grp AND ns.k > 1 AND ns.pos = p.pos // (16 ** ns.lv)::BIGINT
      UNION ALL SELECT p.grp, p.pos, 1, ms.lv, ms.beside FROM p JOIN ms ON ms.k > 1 AND ms.pos = p.grp // (16 ** ms.lv)::BIGINT),
f AS (SELECT grp, pos, list(beside ORDER BY tree, lv) AS way FROM w GROUP BY grp, pos),
o AS (SELECT doc_id, leaf, subroot, (SELECT h FROM m WHERE k = 1) AS root, coalesce(way, []) AS way, coalesce(changed, leaf) AS own
      FROM p JOIN r USING (grp) LEFT JOIN f USING (grp, pos)),
e AS (SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(way, ''), '|', '')) AS proof_sha256,
      list_reduce(list_concat([own], way), lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) AS folded_root FROM o)
SELECT *, folded_root = root AS verified FROM e"""

# Places of equal words at every distance, in stretches; of stretches with the same ends the smallest distance counts.
ORACLE["op13_word_runs"] = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {CRC} AS h,
              coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
a AS (SELECT *, h // 10 AS g, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
t AS (SELECT doc_id, r, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w
      FROM p),
u AS (SELECT r, n, unnest(w) AS word, unnest(range(n)) AS i FROM t),
m AS (SELECT x.r, x.i, y.i - x.i AS q FROM u x JOIN u y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND (y.i - x.i) * 3 <= x.n),
b AS (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM m),
s AS (SELECT r, q, min(i) AS s, count(*) + q AS l FROM b GROUP BY r, q, k HAVING count(*) + q >= greatest(24, 3 * q)),
v AS (SELECT r, s, l, min(q) AS q FROM s GROUP BY r, s, l),
z AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY l::DOUBLE / q DESC, s, q) AS place FROM v),
c AS (SELECT r, count(*) AS n_runs, max(s) FILTER (place = 1) AS start, max(l) FILTER (place = 1) AS length, max(q) FILTER (place = 1) AS period,
      string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM z GROUP BY r),
g AS (SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM v),
k AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS words FROM u ANTI JOIN g USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
       (1000 * length // period)::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM t LEFT JOIN c USING (r) LEFT JOIN k USING (r)"""
