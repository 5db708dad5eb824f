"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

WORDS = "list_filter(regexp_split_to_array({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

LINE_RULES = f"""WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host, coalesce('t' || text, 'n') AS content,
    {WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d) x),
repeated AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM (
    SELECT doc_id, i, unnest([0, 1, 2]) AS j FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times FROM windows) t WHERE times > 1) u GROUP BY doc_id),
lines AS (
  SELECT * FROM (SELECT doc_id, host, content, line, len({WORDS.format('line')}) AS words,
      trim(regexp_replace(lower(line), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS normal
    FROM (SELECT doc_id, host, content, unnest(string_split(text, chr(10))) AS line FROM d) x) y WHERE words > 0),
often AS (
  SELECT host, normal FROM (SELECT host, normal, count(DISTINCT content) AS n FROM lines GROUP BY host, normal) a
  JOIN (SELECT host, count(DISTINCT content) AS docs FROM d GROUP BY host) b USING (host) WHERE n > greatest(20, 0.01 * docs)),
gone AS (
  SELECT doc_id, sum(words) AS words, count(*) AS lines FROM lines JOIN often USING (host, normal) GROUP BY doc_id),
per_doc AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words, coalesce(g.words, 0) AS gone, coalesce(g.lines, 0) AS removed_lines, g.words IS NOT NULL AS cut
  FROM d LEFT JOIN per_doc USING (doc_id) LEFT JOIN repeated r USING (doc_id) LEFT JOIN gone g USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (cut AND (n_words - gone < 20 OR n_words - gone < 0.3 * n_words)) AS kept,
  CAST(n_words - gone AS BIGINT) AS left_words, removed_lines
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted) t"""

TOP_K = """WITH e AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score,
    row_number() OVER (PARTITION BY q.row ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id) AS rank
  FROM e q JOIN e c ON q.row <> c.row WHERE q.vec_id % 100 = 0) t
WHERE rank <= 10"""

URL_FILTERS = """WITH rules(host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
p AS (
  SELECT page_id, row_number() OVER () AS row,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path FROM pages),
best AS (
  SELECT p.row, max({'size': length(r.host || r.path), 'host': length(r.host), 'verdict': r.verdict, 'rule': r.host || r.path}) AS b
  FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY p.row)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict FROM p LEFT JOIN best USING (row)"""

# The CRC-32 of a decimal number's text, a byte and a bit at a time (fixed value: the polynomial).
CRC32 = """xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i::INT, 1))::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                             lambda x, y: xor((x >> 1), ((x & 1) * 3988292384)))))"""

CONVERSATION_TRIE = f"""WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '')), md5(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, {CRC32.format("c::VARCHAR")} % 6 AS h, c - ((c % 100) + 100) % 100 AS b FROM (SELECT DISTINCT c FROM t) x),
heads AS (SELECT ids.c, t.pos AS depth, t.role, t.text FROM ids JOIN t ON t.c = ids.b AND t.pos <= ids.h),
had AS (SELECT c, count(*) AS n FROM heads GROUP BY c),
turns AS (
  SELECT * FROM heads UNION ALL
  SELECT t.c, t.pos - ids.h + coalesce(had.n, 0), t.role, t.text FROM t JOIN ids USING (c) LEFT JOIN had USING (c) WHERE t.pos > ids.h),
p AS (
  SELECT c, depth, length(text) AS chars, sha256(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY c ORDER BY depth)) AS k FROM turns
  UNION ALL SELECT c, 0, 0, '' FROM ids),
node AS (SELECT depth, k, min(c) AS top, count(*) AS n, max(chars) AS chars FROM p GROUP BY depth, k),
m AS (SELECT p.c, p.depth, node.top, node.n, node.chars FROM p JOIN node USING (depth, k)),
tree AS (
  SELECT v.top, v.depth, v.n, v.chars, up.top AS parent FROM m v LEFT JOIN m up ON up.c = v.c AND up.depth = v.depth - 1 WHERE v.c = v.top),
kids AS (SELECT parent AS top, depth - 1 AS depth, count(*) AS n_children FROM tree WHERE depth > 0 GROUP BY parent, depth),
own AS (
  SELECT tree.*, coalesce(n_children, 0) AS n_children, (n_children IS NULL)::INT AS leaf, (n - 1) * chars AS saving
  FROM tree LEFT JOIN kids USING (top, depth)),
below AS (
  SELECT up.top, up.depth, sum(own.leaf) AS n_leaves, sum(own.saving) AS saved FROM own JOIN m up ON up.c = own.top AND up.depth <= own.depth
  GROUP BY up.top, up.depth),
ends AS (
  SELECT top, depth, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS sha FROM m
  JOIN (SELECT c, max(depth) AS depth FROM p GROUP BY c) l USING (c, depth) GROUP BY top, depth)
SELECT top AS conv_id, CAST(depth AS BIGINT) AS depth, parent AS parent_conv_id, n AS n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
FROM own JOIN below USING (top, depth) LEFT JOIN ends USING (top, depth)"""

FILTER_AUDIT = f"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, part, t, {WORDS.format("t")} AS words, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper_chars, first
  FROM d JOIN (SELECT t, min(doc_id) AS first FROM d GROUP BY t) x USING (t)),
named AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
cell AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM (
    SELECT part, doc_id, CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
      || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
      || CASE WHEN 100 * upper_chars > 3 * length(t) THEN 'C' ELSE '' END
      || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails FROM w) x
  LEFT JOIN named USING (doc_id) GROUP BY part, fails),
f(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a JOIN f b ON b.f <> a.f JOIN f c ON c.f NOT IN (a.f, b.f)
  JOIN f d ON d.f NOT IN (a.f, b.f, c.f) JOIN f e ON e.f NOT IN (a.f, b.f, c.f, d.f)),
steps AS (
  SELECT filter_order, step::INT AS step, substr(filter_order, step::INT, 1) AS f, substr(filter_order, 1, step::INT - 1) AS earlier
  FROM orders, range(1, 6) r(step)),
seen AS (
  SELECT part, filter_order, step, f, n, good, toxic, contains(fails, f) AS fail, fails = f AS sole,
    length(translate(fails, earlier, '')) = length(fails) AS alive FROM cell, steps),
counted AS (
  SELECT part, filter_order, step, f, sum(CASE WHEN alive AND NOT fail THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN alive AND fail THEN n ELSE 0 END) AS removed, sum(CASE WHEN NOT alive AND fail THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN sole THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN alive AND fail THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN alive AND fail THEN toxic ELSE 0 END) AS toxic_lost
  FROM seen GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM counted"""

ORACLE_SQL = {"op3_line_rules": LINE_RULES, "op7_top_k": TOP_K, "op8_url_filters": URL_FILTERS,
              "op11_conversation_trie": CONVERSATION_TRIE, "op13_filter_audit": FILTER_AUDIT}
