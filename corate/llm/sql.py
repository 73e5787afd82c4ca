"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

SPACES = r"'[\x20\x09-\x0D]+'"

OP4 = f"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), {SPACES}, '', 'g')) AS text_sha256,
         regexp_replace(coalesce(text, ''), {SPACES}, '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER g AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id IS NOT DISTINCT FROM first_value(doc_id) OVER g AS kept,
       text_sha256
FROM t
WINDOW g AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""

OP2 = r"""
WITH lines AS (
  SELECT doc_id, no, line,
         trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS no
        FROM documents)),
solid AS (
  SELECT doc_id, no, t, row_number() OVER w AS k, count(*) OVER (PARTITION BY doc_id) AS n,
         lead(no, 1) OVER w AS no2, lead(no, 2) OVER w AS no3, lead(t, 1) OVER w AS l2, lead(t, 2) OVER w AS l3
  FROM lines WHERE t <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY no)),
windows AS (  -- three lines, or all of a shorter text
  SELECT doc_id, no AS b, coalesce(no3, no2, no) AS e, [t, l2, l3] AS key FROM solid WHERE l3 IS NOT NULL OR (k = 1 AND n < 3)),
later AS (
  SELECT doc_id, b, e, first FROM (
    SELECT doc_id, b, e, row_number() OVER w AS nth, first_value({'d': doc_id, 'b': b, 'e': e}) OVER w AS first
    FROM windows WINDOW w AS (PARTITION BY key ORDER BY doc_id, b))
  WHERE nth > 1),
marked AS (
  SELECT l.doc_id, l.no, l.line, l.t,
         l.t <> '' AND EXISTS (SELECT 1 FROM later x WHERE x.doc_id = l.doc_id AND l.no BETWEEN x.b AND x.e)
         AND NOT EXISTS (SELECT 1 FROM later x WHERE x.doc_id = l.doc_id AND x.first.d = l.doc_id AND x.b <= x.first.e
                         AND l.no BETWEEN x.first.b AND x.first.e) AS gone
  FROM lines l)
SELECT doc_id, count(*) FILTER (t <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone), '') AS text
FROM marked GROUP BY doc_id
"""

OP8 = r"""
WITH RECURSIVE
words AS (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM words
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM words w JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = w.doc_id
LEFT JOIN sizes s ON s.doc_id = w.doc_id
"""

OP9 = r"""
WITH u AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
rules(verdict, h, q) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fit AS (
  SELECT page_id, h || q AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(h || q) DESC, length(h) DESC) AS nth
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q))
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN fit ON fit.page_id = p.page_id AND nth = 1
"""


def _seats(name: str, rows: str, group: str, item: str, weight: str, seats: str, cols: str) -> str:
    """Highest quotients: each item's quotients up to one more than it can win, ranked in its group."""
    return f"""
{name}_q AS (
  SELECT {group} AS g, {item} AS i, unnest(range(0, CAST(floor({weight} * ({seats} + n / 2.0) / w + 0.5) AS BIGINT) + 2)) AS k,
         {weight} AS weight, {seats} AS seats
  FROM (SELECT *, CAST(sum({weight}) OVER (PARTITION BY {group}) AS DOUBLE) AS w, count(*) OVER (PARTITION BY {group}) AS n FROM {rows})
  WHERE w > 0 AND {weight} > 0),
{name}_w AS (
  SELECT g, i, count(*) AS won FROM (
    SELECT g, i, seats, row_number() OVER (PARTITION BY g ORDER BY weight / (2 * k + 1) DESC, i, k) AS r FROM {name}_q)
  WHERE r <= seats GROUP BY g, i),
{name} AS (
  SELECT {cols}, coalesce(won, 0) AS quota FROM {rows} r LEFT JOIN {name}_w x ON x.g = r.{group} AND x.i = r.{item})"""


OP3 = rf"""
WITH docs AS (
  SELECT doc_id, source, md5('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS spot,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
ranked AS (
  SELECT source, source_size, nth, CASE nth % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 0 AS one
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               row_number() OVER (ORDER BY source IS NULL, source) - 1 AS nth
        FROM docs GROUP BY source)),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER f, 0) AS DOUBLE)
            / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER f, 0) AS DOUBLE) AS level
  FROM ranked
  WINDOW f AS (ORDER BY source_size / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, nth, one,
         CAST(round(sum(source_size) OVER () / 16) AS BIGINT) AS blocks,
         CASE WHEN level * weight >= 3 * source_size THEN 3.0::DOUBLE * source_size
              ELSE max(level) FILTER (level * weight < 3 * source_size) OVER () * weight END AS target
  FROM levels),
{_seats("sources", "targets", "one", "nth", "target", "blocks", "source, source_size, nth, target")},
placed AS (
  SELECT doc_id, size, spot, s.nth, s.source_size, s.target, s.quota,
         CAST('0x' || substr(spot, 1, 12) AS BIGINT) % greatest(1, CAST(ceil(s.source_size / 250000) AS BIGINT)) AS shard
  FROM docs d JOIN sources s ON s.source IS NOT DISTINCT FROM d.source),
shards AS (
  SELECT nth, shard, shard // 1024 AS band, nth || '/' || shard // 1024 AS nth_band,
         CAST(sum(size) AS BIGINT) AS words, any_value(quota) AS source_quota
  FROM placed GROUP BY nth, shard),
bands AS (
  SELECT nth, band, nth_band, CAST(sum(words) AS BIGINT) AS words, any_value(source_quota) AS source_quota
  FROM shards GROUP BY nth, band, nth_band),
{_seats("band_quotas", "bands", "nth", "band", "words", "source_quota", "nth_band")},
shard_rows AS (SELECT s.*, b.quota AS band_quota FROM shards s JOIN band_quotas b USING (nth_band)),
{_seats("shard_quotas", "shard_rows", "nth_band", "shard", "words", "band_quota", "nth, shard, words")},
laid AS (
  SELECT p.*, q.words, q.quota AS shard_quota, CAST(ceil(q.words / 16) AS BIGINT) AS blocks,
         sum(size) OVER (PARTITION BY p.nth, p.shard ORDER BY spot, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto,
         CAST('0x' || substr(md5('42:' || p.nth || ':' || p.shard), 1, 12) AS BIGINT) AS spin
  FROM placed p JOIN shard_quotas q USING (nth, shard)),
runs AS (
  SELECT *, CASE WHEN blocks > 0 THEN least(shard_quota, 3 * blocks) // blocks ELSE 0 END AS passes,
         spin % greatest(blocks, 1) AS first
  FROM laid),
cut AS (
  SELECT *, first * 16 AS b, (first + least(shard_quota, 3 * blocks) - passes * blocks) * 16 AS e,
         (first + least(shard_quota, 3 * blocks) - passes * blocks - blocks) * 16 AS wrapped
  FROM runs)
SELECT doc_id, size, source_size, target,
       CAST(passes * size + greatest(0, least(upto, e) - greatest(upto - size, b))
            + greatest(0, least(upto, wrapped) - greatest(upto - size, 0)) AS BIGINT) AS taken
FROM cut
"""

OP12 = r"""
WITH turns AS (
  SELECT conv_id, sha256(strlen(role) || ':' || role || text) AS id,
         CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) AS words,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS i
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL)),
heads AS (  -- CRC-32 bit by bit: a byte, then eight shifts (-1)
  SELECT conv_id, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
             lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END)) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT h.conv_id, t.i, t.id, t.words FROM heads h JOIN turns t ON t.conv_id = h.conv_id - h.conv_id % 20 AND t.i <= h.h
  UNION ALL
  SELECT conv_id, 1000000 + i, id, words FROM heads JOIN turns USING (conv_id) WHERE i > h),
paths AS (
  SELECT conv_id, words, count(*) OVER c AS depth, string_agg(id, '') OVER c AS path
  FROM rebuilt WINDOW c AS (PARTITION BY conv_id ORDER BY i)
  UNION ALL SELECT conv_id, 0, 0, '' FROM heads),
lengths AS (SELECT conv_id, max(depth) AS n FROM paths GROUP BY conv_id),
nodes AS (
  SELECT path, depth, any_value(words) AS words, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) = depth AS leaf,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM paths JOIN lengths USING (conv_id) GROUP BY path, depth),
under AS (
  SELECT v.path, count(*) FILTER (u.depth = v.depth + 1) AS n_children, count(*) FILTER (u.leaf) AS n_leaves,
         CAST(sum((u.n_convs - 1) * u.words) AS BIGINT) AS saved_tokens
  FROM nodes v JOIN nodes u ON starts_with(u.path, v.path) GROUP BY v.path)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, n_children, n_leaves, saved_tokens, v.ends_sha256
FROM nodes v JOIN under USING (path) LEFT JOIN nodes p ON v.depth > 0 AND p.path = left(v.path, -64)
"""

OP13 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 49), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM windows) WHERE first < doc_id),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM later),
each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY i) AS s
  FROM each ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(s, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

ORACLE: dict[str, str] = {
    "op2_line_dedup": OP2,
    "op3_mixing": OP3,
    "op4_exact_dedup": OP4,
    "op8_near_dedup": OP8,
    "op9_url_filter": OP9,
    "op12_prefix_trie": OP12,
    "op13_substring_dedup": OP13,
}
