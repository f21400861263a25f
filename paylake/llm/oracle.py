"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP3 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
runs AS (
  SELECT doc_id, i, list_aggregate(w[i:i + 7], 'string_agg', ' ') AS run
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, run) AS n FROM runs) WHERE n > 1),
reps AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM twice, generate_series(0, 7) g(j) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN reps USING (doc_id)),
b AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 6 * n_words THEN 4 ELSE 0 END
    + CASE WHEN n_dup_lines >= 3 AND 200 * n_repeat_words > 30 * n_words THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END)::BIGINT AS fail_bits FROM m)
SELECT *, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept FROM b
"""

_KINDS = [
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
     "length(regexp_extract(m, '{p}', 2)) >= 12", "secret"),
    ("access", "AKIA[A-Z0-9]+", "length(m) >= 18", "id"),
    ("hex", "[0-9a-f]+", "length(m) >= 16", "secret"),
    ("ident", "[A-Z0-9]+", "length(m) >= 16 AND regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]')", "id"),
    ("opaque", "[A-Za-z0-9+/]+", "length(m) >= 32 AND regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]')", "secret"),
    ("endpoint", "[a-z][a-z0-9+.-]{0,15}://[A-Za-z0-9._-]+(:[0-9]{1,5})?", "true", "endpoint"),
]


def _op6() -> str:
    found = []
    for k, (name, p, cond, role) in enumerate(_KINDS):
        found.append(f"""
  SELECT doc_id, {k} AS kind, '{name}' AS name, '{role}' AS role, s, s + length(m) AS e FROM (
    SELECT doc_id, ms[k] AS m, (list_sum([length(x) FOR x IN gaps[1:k]]) + coalesce(list_sum([length(x) FOR x IN ms[1:k - 1]]), 0))::BIGINT AS s
    FROM (SELECT doc_id, ms, gaps, unnest(generate_series(1, len(ms))) AS k FROM (
      SELECT doc_id, regexp_extract_all(t, '{p}') AS ms, string_split_regex(t, '{p}') AS gaps FROM d)))
  WHERE {cond.format(p=p) if '{p}' in cond else cond}""")
    near = "EXISTS (SELECT 1 FROM parts o WHERE o.doc_id = p.doc_id AND o.role = '{}' AND greatest(o.s, p.s) - least(o.e, p.e) BETWEEN 0 AND 256)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
parts AS ({" UNION ALL ".join(found)}),
kept AS (
  SELECT * FROM parts p WHERE kind < 3
    OR (role = 'id' AND {near.format('secret')}) OR (role = 'secret' AND {near.format('id')})
    OR (role = 'endpoint' AND {near.format('secret')} AND {near.format('id')})),
text AS (
  SELECT doc_id, sum((kind = 0)::INT)::BIGINT AS n_assign, sum((kind = 1)::INT)::BIGINT AS n_access, sum((kind = 2)::INT)::BIGINT AS n_hex,
         string_agg(CASE WHEN kind < 3 THEN name || ':' || s || ':' || e END, ',' ORDER BY s, kind) AS base,
         string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind) AS spans
  FROM kept GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN text USING (doc_id)
"""


def mixing_ctes(docs: str = "documents") -> str:
    """CTEs up to ``taken`` (doc_id, size, source_size, target, copies) over a table of documents."""
    return rf"""
d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
             ('0x' || substr(sha256(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h FROM {docs}),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
              source_size * 2.0::DOUBLE AS most FROM s0),
s2 AS (SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS total,
              row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS n,
              coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
              sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM s1),
s3 AS (SELECT *, (total - before) / ws AS rate FROM s2),
s4 AS (SELECT *, min(CASE WHEN weight * rate <= most THEN n END) OVER () AS first_free FROM s3),
s5 AS (SELECT *, max(CASE WHEN n = first_free THEN rate END) OVER () AS common FROM s4),
t AS (SELECT source, source_size, CASE WHEN first_free IS NULL OR n < first_free THEN most ELSE weight * common END AS target FROM s5),
g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
hs AS (SELECT source, h, sum(size) AS words FROM d GROUP BY source, h),
cum AS (SELECT hs.*, sum(words) OVER (PARTITION BY source ORDER BY h) AS upto FROM hs),
edge AS (SELECT g.source, min(h) AS h FROM g JOIN cum ON g.source IS NOT DISTINCT FROM cum.source
         WHERE target - whole * source_size > 0 AND upto >= target - whole * source_size GROUP BY g.source),
lim AS (SELECT edge.source, edge.h + CASE WHEN 2 * (g.target - g.whole * g.source_size - (cum.upto - cum.words)) >= cum.words THEN 1 ELSE 0 END AS lim
        FROM edge JOIN cum ON edge.source IS NOT DISTINCT FROM cum.source AND edge.h = cum.h JOIN g ON g.source IS NOT DISTINCT FROM edge.source),
taken AS (SELECT d.doc_id, d.size, g.source_size, g.target, (g.whole + CASE WHEN d.h < coalesce(lim.lim, 0) THEN 1 ELSE 0 END)::BIGINT AS copies
          FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source LEFT JOIN lim ON lim.source IS NOT DISTINCT FROM d.source)"""


OP10 = f"WITH {mixing_ctes()} SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken FROM taken"

OP2 = rf"""
WITH lower_ AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), u, l), '{ALNUM}') AS w FROM benchmark, lower_),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), u, l), '{ALNUM}') AS w FROM documents, lower_),
bw AS (SELECT DISTINCT item, least(len(w), 13) AS size, list_aggregate(w[i:i + least(len(w), 13) - 1], 'string_agg', ' ') AS win
       FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, size, list_aggregate(w[i:i + size - 1], 'string_agg', ' ') AS win
       FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM d, (SELECT DISTINCT size FROM bw))),
hits AS (SELECT doc_id, i, size, item FROM dw JOIN bw USING (size, win)),
words AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit
          FROM (SELECT doc_id, i, unnest(generate_series(0, size - 1)) AS j FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

def near_dup_ctes(docs: str = "documents", k: int = 4) -> str:
    """CTEs up to ``labels`` (doc_id, n_shingles, component_id) over a table of documents."""
    return rf"""
lower_ AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), u, l), '{WORD}') AS w FROM {docs}, lower_),
sh AS (SELECT DISTINCT doc_id, list_aggregate(w[i:i + {k - 1}], 'string_agg', ' ') AS g
       FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - {k - 1}, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * n_both >= 80 * (na.n + nb.n - n_both)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS c FROM d UNION SELECT e.b, r.c FROM reach r JOIN edges e ON e.a = r.a AND r.c < e.b),
labels AS (SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c AS component_id
           FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(c) AS c FROM reach GROUP BY a) USING (doc_id))"""


OP7 = f"WITH RECURSIVE {near_dup_ctes()} SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM labels"

OP1 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
wins AS (SELECT doc_id, i, list_aggregate(w[i:i + 19], 'string_agg', ' ') AS win
         FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d)),
dups AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM wins) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM dups, generate_series(0, 19) g(j)),
ws AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM ws ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP9 = r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(suffix, prefix, seed) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fit AS (SELECT page_id, host, path, max(struct_pack(k := length(suffix) + length(prefix), rule := suffix || prefix, seed := seed)) AS best
        FROM u LEFT JOIN rules ON (host = suffix OR ends_with(host, '.' || suffix)) AND starts_with(path, prefix) GROUP BY ALL),
j AS (SELECT page_id, host, path, best.rule AS rule, best.seed AS seed,
             [x FOR x IN string_split(host, '.') IF x <> ''] AS labels,
             [regexp_replace(x, '[0-9]+', '#', 'g') FOR x IN string_split(path, '/') IF x <> ''] AS parts FROM fit),
t AS (SELECT page_id, seed, rule, list_sort(list_distinct(list_concat(
        [CASE WHEN i = len(labels) THEN 'top:' WHEN i = len(labels) - 1 THEN 'domain:' ELSE 'sub:' END || labels[i] FOR i IN generate_series(1, len(labels))],
        ['path:' || x FOR x IN parts]))) AS toks FROM j),
lab AS (SELECT * FROM t WHERE seed IS NOT NULL),
combos AS (SELECT rule, seed, [toks[i] FOR i IN generate_series(1, len(toks)) IF (m >> (i - 1)) & 1 = 1] AS k
           FROM (SELECT *, unnest(generate_series(1, (1 << len(toks)) - 1)) AS m FROM lab)),
each AS (SELECT k, rule, sum((seed = 'block')::INT) AS bad, count(*) AS n FROM combos GROUP BY k, rule),
least_ AS (SELECT ceil(0.005::DOUBLE * count(*)) AS c FROM lab),
mined AS (SELECT k FROM each, least_ GROUP BY k, c HAVING sum(bad) >= c AND sum(bad)::DOUBLE / sum(n) >= 0.8 AND sum((bad >= c)::INT) >= 2),
hit AS (SELECT DISTINCT page_id FROM t JOIN mined ON list_has_all(t.toks, mined.k) WHERE seed IS NULL)
SELECT page_id, host, path, rule, coalesce(seed, CASE WHEN hit.page_id IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN hit USING (page_id)
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP11 = rf"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term FROM documents),
q AS (SELECT item_id, term, count(*) AS q FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term FROM benchmark)
      GROUP BY ALL),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
g AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
m AS (SELECT doc_id, 100 - 25 + (25 * n * docs) // terms AS m FROM d, g),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t SEMI JOIN q USING (term) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, g GROUP BY term),
s AS (SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM tf JOIN m USING (doc_id) JOIN w USING (term) JOIN q USING (term) GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""

OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || doc_id) AS h FROM documents),
x AS (SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
             ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

SQL = {"op11_ranked_search": OP11, "op13_fill_in_middle": OP13, "op9_url_rules": OP9, "op1_substring_dedup": OP1, "op7_near_duplicates": OP7, "op2_benchmark_decontamination": OP2, "op3_quality_rules": OP3, "op6_secret_scan": _op6(), "op10_source_mixing": OP10}
