"""DuckDB twins of the text queries that SQL can express.

They share the stated lists (phrases, templates, common words, character
classes) with the operators and nothing else.
"""

from __future__ import annotations

from barspark.llm.licenses import PHRASES, TEMPLATES
from barspark.llm.quality import CLASSES, COMMON_WORDS


def _lower(text: str = "coalesce(text, '')") -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


_SPLIT = r"'[^\x20\x09-\x0D]+'"
_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_PHRASES = ", ".join(f"('{p}', '{label}')" for p, label in PHRASES.items())
_TEMPLATES = ", ".join(f"('{label}', '{t}')" for label, t in TEMPLATES)
_COMMON = "[" + ", ".join(f"'{w}'" for w in COMMON_WORDS) + "]"
_TAKEN = ", ".join("length(regexp_replace(t, '[^" + c.replace("'", "''") + "]+', '', 'g'))" for c in CLASSES.values())


def _distance(p: str, q: str) -> str:
    """Jensen-Shannon distance of two lists of counts."""
    mid = "((x[1] + x[2]) / 2)"
    return f"""CASE WHEN list_sum({p}) > 0 AND list_sum({q}) > 0 THEN sqrt(greatest(0.0, list_sum(list_transform(
      list_zip(list_transform({p}, lambda v: v / list_sum({p})), list_transform({q}, lambda v: v / list_sum({q}))),
      lambda x: (CASE WHEN x[1] > 0 THEN x[1] * log2(x[1] / {mid}) ELSE 0 END
               + CASE WHEN x[2] > 0 THEN x[2] * log2(x[2] / {mid}) ELSE 0 END) / 2)))) END"""


# The list of the query is dated by rule from the hosts, parent domains and first path segments that the
# pages have: two thirds of these patterns are listed, lifted later, and half of them listed again.
OP1 = r"""
WITH c AS (
  SELECT page_id, url, CAST(CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 6) AS BIGINT) % 365 AS BIGINT) AS fetch_day,
         nullif(regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '') AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda x: x <> '') AS parts
  FROM pages),
asked AS (
  SELECT page_id, url, fetch_day, host, 1000 + i AS rank, array_to_string(string_split(host, '.')[i:], '.') AS pattern
  FROM c, unnest(range(1, 20)) AS t(i) WHERE host IS NOT NULL AND i <= len(string_split(host, '.'))
  UNION ALL
  SELECT page_id, url, fetch_day, host, 1000 - i, host || '/' || array_to_string(parts[:i], '/')
  FROM c, unnest([1, 2]) AS t(i) WHERE host IS NOT NULL AND i <= len(parts)),
names AS (
  SELECT DISTINCT pattern, CAST('0x' || substr(md5(pattern), 1, 6) AS BIGINT) AS x FROM asked
  WHERE rank = 999 OR pattern = host OR len(string_split(pattern, '.')) = 3 AND rank > 1000),
entries AS (
  SELECT pattern, x % 300 AS day, CASE WHEN (x // 7) % 4 = 0 THEN 'allow' ELSE 'block' END AS action FROM names WHERE x % 3 <> 0
  UNION ALL SELECT pattern, x % 300 + 20 + x % 50, 'lift' FROM names WHERE x % 3 <> 0
  UNION ALL SELECT pattern, x % 300 + 50 + x % 50, 'block' FROM names WHERE x % 3 <> 0 AND x % 2 = 0),
held AS (SELECT pattern, day AS from_day, lead(day) OVER (PARTITION BY pattern ORDER BY day) AS to_day, action FROM entries),
hit AS (
  SELECT a.page_id, a.url, row_number() OVER (PARTITION BY a.page_id, a.url ORDER BY rank) AS n, a.pattern, from_day, action
  FROM asked a JOIN held h ON a.pattern = h.pattern AND a.fetch_day >= from_day AND (to_day IS NULL OR a.fetch_day < to_day)
  WHERE action <> 'lift')
SELECT c.page_id, c.url, c.fetch_day, coalesce(h.action, 'none') AS verdict, h.pattern, CAST(h.from_day AS BIGINT) AS listed_since
FROM c LEFT JOIN hit h ON c.page_id = h.page_id AND c.url = h.url AND h.n = 1
"""

OP4 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_lower()} AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, {_WORD}) AS w FROM d),
phrase AS (SELECT string_split(p, ' ') AS p, label FROM (VALUES {_PHRASES}) AS v(p, label)),
place AS (SELECT r, label, i - 1 AS pos FROM w, unnest(range(1, len(w) + 1)) AS u(i), phrase
          WHERE contains(t, 'license') AND w[i] = p[1] AND w[i:i + len(p) - 1] = p),
base AS (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word FROM place GROUP BY r),
tem AS (SELECT label, list_distinct(string_split(s, ' ')) AS s, len(string_split(s, ' ')) * 5 // 4 AS n FROM (VALUES {_TEMPLATES}) AS v(label, s)),
may AS (SELECT r, w, label, s, n FROM w, tem WHERE 10 * len(list_intersect(list_distinct(w), s)) >= 9 * len(s)),
run AS (SELECT r, label, len(list_intersect(list_distinct(w[i:i + n - 1]), s)) AS n_both, len(s) AS size
        FROM may, unnest(range(1, len(w) + 1)) AS u(i) WHERE list_contains(s, w[i])),
hit AS (SELECT r, label, n_both / size AS c FROM run WHERE 10 * n_both >= 9 * size),
own AS (SELECT r, string_agg(label, ',' ORDER BY label) AS base_labels FROM (SELECT DISTINCT r, label FROM place) GROUP BY r),
every AS (SELECT r, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM place UNION SELECT r, label FROM hit) GROUP BY r),
best AS (SELECT r, max(c) AS score FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN own USING (r) LEFT JOIN every USING (r) LEFT JOIN best USING (r)"""

OP6 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, {_SPLIT}) AS w, regexp_extract_all({_lower('t')}, {_SPLIT}) AS lw FROM d),
win AS (SELECT r, i, md5(array_to_string(w[i:i + 2], ' ')) AS h FROM w, unnest(range(1, len(w) - 1)) AS u(i)),
twice AS (SELECT r, h FROM win GROUP BY r, h HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM win JOIN twice USING (r, h), unnest([0, 1, 2]) AS u(k) GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT x) AS n FROM d, unnest(string_split(t, chr(10))) AS u(x) WHERE regexp_matches(x, {_SPLIT}) GROUP BY r),
c AS (SELECT w.r, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, length(t) AS n, [{_TAKEN}] AS taken,
        list_transform({_COMMON}, lambda x: len(list_filter(lw, lambda y: y = x))) AS hits
      FROM w LEFT JOIN rep USING (r) LEFT JOIN lines USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        CAST(list_append(taken, greatest(0, n - list_sum(taken))) AS DOUBLE[]) AS chars,
        CAST(list_append(hits, n_words - list_sum(hits)) AS DOUBLE[]) AS commons FROM c),
ref AS (SELECT lang, list(chars) AS cs, list(commons) AS ws FROM f WHERE NOT base_failed AND 100 * n_symbols <= 5 * word_chars GROUP BY lang),
mean AS (SELECT lang,
    list_transform(range(1, {len(CLASSES) + 2}), lambda i: list_avg(list_transform(cs, lambda c: c[i] / list_sum(c)))) AS rc,
    list_transform(range(1, {len(COMMON_WORDS) + 2}), lambda i: list_avg(list_transform(ws, lambda c: c[i] / list_sum(c)))) AS rw FROM ref),
j AS (SELECT f.*, {_distance('chars', 'rc')} AS cd, {_distance('commons', 'rw')} AS wd FROM f LEFT JOIN mean ON f.lang IS NOT DISTINCT FROM mean.lang),
own AS (SELECT lang, cd, wd FROM j WHERE NOT base_failed AND 100 * n_symbols <= 5 * word_chars AND n >= 200),
near AS (SELECT lang, k, CAST(ceil(d * 10000) AS BIGINT) AS step, row_number() OVER (PARTITION BY lang, k ORDER BY d) AS place,
                count(*) OVER (PARTITION BY lang, k) AS n
         FROM (SELECT lang, 'c' AS k, cd AS d FROM own UNION ALL SELECT lang, 'w', wd FROM own)),
lim AS (SELECT lang, CAST(min(step) FILTER (k = 'c') AS DOUBLE) / 10000 AS c, CAST(min(step) FILTER (k = 'w') AS DOUBLE) / 10000 AS w
        FROM near WHERE 100 * place >= 90 * (n + 1) GROUP BY lang),
held AS (SELECT j.*, coalesce(least(0.33::DOUBLE, greatest(0.1::DOUBLE, 4.0::DOUBLE * lim.c)), 0.33::DOUBLE) AS cl,
                coalesce(least(0.75::DOUBLE, greatest(0.2::DOUBLE, 1.6::DOUBLE * lim.w)), 0.75::DOUBLE) AS wl
         FROM j LEFT JOIN lim ON j.lang IS NOT DISTINCT FROM lim.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (n >= 200 AND (coalesce(cd, 0) > cl OR coalesce(wd, 0) > wl)) AS kept,
       round(cd, 6) AS char_distance, round(wd, 6) AS word_distance, round(cl, 6) AS char_limit, round(wl, 6) AS word_limit FROM held"""

OP9 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM d, unnest(range(1, len(w) - 33)) AS t(i)),
again AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, i + k AS pos FROM win JOIN again USING (h), unnest(range(0, 35)) AS t(k)),
gone_of AS (SELECT r, count(*) AS n FROM gone GROUP BY r),
word AS (SELECT r, i, w[i] AS x FROM d, unnest(range(1, len(w) + 1)) AS t(i)),
kept AS (SELECT word.r, string_agg(x, ' ' ORDER BY word.i) AS k FROM word ANTI JOIN gone ON word.r = gone.r AND word.i = gone.pos GROUP BY word.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN gone_of g USING (r) LEFT JOIN kept USING (r)"""

OP10 = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_lower()},
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, md5(array_to_string(w[i:i + 4], ' ')) AS g FROM d, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
pair AS (SELECT a.r AS a, b.r AS b, count(*) AS inter FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r),
link AS (SELECT a, b FROM pair JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * inter >= 75 * (x.n + y.n - inter)),
both_ways AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (r) JOIN (SELECT reach.a AS r, min(x.doc_id) AS component_id FROM reach JOIN d x ON x.r = reach.b GROUP BY reach.a) m USING (r)"""


OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all({_lower()}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
own AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
every AS (SELECT lang, source, term, CAST(coalesce(own.n, 0) AS HUGEINT) AS c, kept.n AS l
          FROM g JOIN kept USING (lang) LEFT JOIN own USING (lang, source, term)),
p AS (SELECT *, 1 + 1000000000 * (c + 1) // (sum(c) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source)) AS p,
             1 + 1000000000 * (l + 1) // (sum(l) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source)) AS q FROM every),
two AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(two.value, 0) AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN two ON two.lang = a.lang AND two.source = a.source AND two.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pair UNION ALL SELECT * FROM term) QUALIFY part = 'pair' OR rank <= 200"""
