"""DuckDB SQL of the queries that SQL can express over whole tables."""

from __future__ import annotations

import re

from .license_scan import MIN_REACH, THRESHOLD
from .quality_rules import EDIT_WORDS, HOST_PERCENT, MAX_REPEAT_PERCENT, MIN_DOCS, MIN_LEFT_PERCENT, MIN_WORDS
from .url_filter import DAMPING, LOWER, MIN_DISTRUST, ROUNDS, TARGET, UPPER

_SPACE = r"[ \t-\r]"

NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_SPACE}+'), lambda w: w <> '') AS w FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM docs WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, m.n, n.n HAVING 100 * count(*) >= 80 * (m.n + n.n - count(*))
),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.y FROM reach r JOIN links l ON l.x = r.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, count(*) OVER (PARTITION BY component_id) AS class_size
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN sizes USING (doc_id)
"""

CHATS = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
shown AS (
    SELECT *, 14 + length(regexp_replace(role, '\\|###|</turn>|:', '\\\0', 'g')) + length(regexp_replace(text, '\\|###|</turn>', '\\\0', 'g')) AS chars FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id
"""

HARD_NEGATIVES = """
WITH vectors AS (
    SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.rid AS anchor, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM vectors a JOIN vectors b ON a.rid <> b.rid WHERE a.vec_id % 50 = 0
),
positives AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS k FROM scored WHERE same QUALIFY k <= 5)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""

QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (
    SELECT *, list_filter(regexp_split_to_array(text, '{_SPACE}+'), lambda x: x <> '') AS words,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS lines FROM d
),
grams AS (
    SELECT rid, i, array_to_string(words[i:i + 7], ' ') AS gram FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) > 7)
),
twice AS (SELECT rid, gram FROM grams GROUP BY rid, gram HAVING count(*) > 1),
repeated AS (
    SELECT rid, count(DISTINCT i + j) AS n FROM grams JOIN twice USING (rid, gram) CROSS JOIN (SELECT unnest(range(8)) AS j) GROUP BY rid
),
norms AS (
    SELECT rid, host, trim(lower(regexp_replace(line, '{_SPACE}+', ' ', 'g'))) AS norm FROM (SELECT rid, host, unnest(lines) AS line FROM w)
),
hashed AS (SELECT rid, host, norm, substr(md5(norm), 1, 16) AS h, string_split(norm, ' ') AS ws, len(string_split(norm, ' ')) AS n FROM norms),
copies AS (SELECT rid, array_to_string(list_sort(list_distinct(list(h))), ' ') AS copy FROM hashed GROUP BY rid),
held AS (SELECT DISTINCT host, copy, h, ws, n FROM hashed JOIN copies USING (rid)),
hosts AS (SELECT host, count(*) AS docs FROM d GROUP BY host),
common AS (
    SELECT host, h, count(*) AS n_docs FROM held JOIN hosts USING (host) GROUP BY host, h, docs
    HAVING count(*) > {MIN_DOCS} AND count(*) * 100 > docs * {HOST_PERCENT}
),
pages AS (SELECT DISTINCT host, copy FROM held SEMI JOIN common USING (host, h)),
sharing AS (SELECT * FROM held SEMI JOIN pages USING (host, copy) LEFT JOIN common USING (host, h)),
shared AS (SELECT DISTINCT host, ws, n, CAST(ceil(n / 3.0) AS INTEGER) AS t FROM sharing WHERE n_docs IS NOT NULL AND n >= {EDIT_WORDS}),
edited AS (
    SELECT DISTINCT o.host, o.copy, o.h FROM sharing o JOIN shared s ON o.host = s.host AND abs(o.n - s.n) <= 1
    WHERE o.n_docs IS NULL AND (o.ws[:s.n - s.t] = s.ws[:s.n - s.t] OR o.ws[o.n - s.n + s.t + 1:] = s.ws[s.t + 1:]
                                OR (o.ws[:s.t] = s.ws[:s.t] AND o.ws[o.n - s.t + 1:] = s.ws[s.n - s.t + 1:]))
),
own AS (SELECT host, copy, min(h) AS own FROM sharing ANTI JOIN edited USING (host, copy, h) WHERE n_docs IS NULL GROUP BY host, copy),
rarest AS (SELECT host, copy, min((n_docs, h)) AS r FROM sharing WHERE n_docs IS NOT NULL GROUP BY host, copy),
signed AS (
    SELECT s.host, s.h, coalesce(own, r[2]) AS sign FROM sharing s JOIN rarest USING (host, copy) LEFT JOIN own USING (host, copy) WHERE n_docs IS NOT NULL
),
often AS (
    SELECT host, h FROM signed JOIN hosts USING (host) GROUP BY host, h, docs
    HAVING count(DISTINCT sign) > {MIN_DOCS} AND count(DISTINCT sign) * 100 > docs * {HOST_PERCENT}
),
gone AS (SELECT rid, CAST(sum(n) AS BIGINT) AS n FROM hashed JOIN often USING (host, h) GROUP BY rid),
counted AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, length(array_to_string(words, '')) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(g.n, 0) AS removed_words
    FROM w LEFT JOIN repeated r USING (rid) LEFT JOIN gone g USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (removed_words > 0 AND (n_words - removed_words < {MIN_WORDS}
                                OR (n_words - removed_words) * 100 < n_words * {MIN_LEFT_PERCENT})) AS kept, removed_words
FROM (SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT} AS base_failed FROM counted)
"""


def license_scans(templates: list, phrases: list[tuple[str, str]]) -> str:
    words = lambda t: re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", t.translate(str.maketrans(UPPER, LOWER)))
    listed = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]::VARCHAR[]"
    values = ", ".join(f"({i}, '{t.label}', {listed(words(t.text))}, {listed(words(' '.join(t.needs)))}, {listed(words(' '.join(t.without)))})"
                       for i, t in enumerate(templates))
    sought = ", ".join(f"('{label}', {listed(words(p))})" for label, p in phrases)
    return f"""
WITH RECURSIVE given(id, label, words, needs, without) AS (VALUES {values}),
reaches(id, s) AS (SELECT id, {MIN_REACH} FROM given UNION ALL SELECT id, 2 * s FROM reaches JOIN given USING (id) WHERE s < len(words)),
templates AS (SELECT id, label, list_distinct(words) AS words, needs, without, max(s) AS s FROM given JOIN reaches USING (id) GROUP BY ALL),
phrases(label, words) AS (VALUES {sought}),
vocabulary AS (SELECT unnest(words) AS w FROM templates UNION SELECT unnest(without) FROM templates),
docs AS (
    SELECT row_number() OVER () AS rid, doc_id,
           list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS words
    FROM documents
),
tokens AS (SELECT rid, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS i FROM docs),
starts AS (
    SELECT t.rid, t.i, p.label FROM tokens t JOIN phrases p ON t.w = p.words[1] JOIN docs USING (rid)
    WHERE docs.words[t.i + 1:t.i + len(p.words)] = p.words
),
base AS (
    SELECT rid, count(*) AS n, min(i) AS first_word, max(i) AS last_word, list_sort(list_distinct(list(label))) AS labels FROM starts GROUP BY rid
),
known AS (SELECT * FROM tokens SEMI JOIN vocabulary USING (w)),
blocks AS (
    SELECT rid, s, i // s - back AS k, list(DISTINCT w) AS held
    FROM known CROSS JOIN (SELECT DISTINCT s FROM templates) CROSS JOIN (SELECT unnest([0, 1]) AS back) WHERE i // s >= back GROUP BY ALL
),
matched AS (
    SELECT rid, label, len(list_intersect(held, words)) / len(words) AS share FROM blocks JOIN templates USING (s)
    WHERE len(list_intersect(held, words)) >= {THRESHOLD} * len(words) - 1e-9 AND list_has_all(held, needs) AND NOT list_has_any(held, without)
),
more AS (SELECT rid, max(share) AS share, list_distinct(list(label)) AS labels FROM matched GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(b.n, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(b.labels, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ','), '') AS labels,
       CASE WHEN b.n > 0 THEN 1.0 ELSE coalesce(m.share, 0.0) END AS score
FROM docs LEFT JOIN base b USING (rid) LEFT JOIN more m USING (rid)
"""


def url_filters(rules: list[tuple[str, str]]) -> str:
    listed = ", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in rules)
    keep, pass_on = 1 - DAMPING, DAMPING
    rounds = "".join(f"""
flow{k} AS MATERIALIZED (
    SELECT host, sum(t) AS t, sum(d) AS d, sum(t1) AS t1, sum(d1) AS d1 FROM (
        SELECT dst AS host, p.t / out_n AS t, 0.0 AS d, p.t1 / out_n AS t1, 0.0 AS d1 FROM edges JOIN s{k - 1} p ON p.host = src
        UNION ALL SELECT src, 0.0, p.d / in_n, 0.0, p.d1 / in_n FROM edges JOIN s{k - 1} p ON p.host = dst) GROUP BY host
),
s{k} AS MATERIALIZED (
    SELECT host, {keep} * good + {pass_on} * coalesce(f.t, 0) AS t, {keep} * bad + {pass_on} * coalesce(f.d, 0) AS d,
           {keep} + {pass_on} * coalesce(f.t1, 0) AS t1, {keep} + {pass_on} * coalesce(f.d1, 0) AS d1 FROM seeds LEFT JOIN flow{k} f USING (host)
),""" for k in range(1, ROUNDS + 1))
    target = TARGET.replace("'", "''")
    by_rule = ("arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM {0} LEFT JOIN rules "
               "ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY ALL")
    share = "avg(CASE WHEN verdict = 'allow' THEN 1.0 ELSE 0.0 END) AS good, avg(CASE WHEN verdict = 'block' THEN 1.0 ELSE 0.0 END) AS bad"
    parts = (f"translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, "
             "regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path")
    return f"""
WITH cut AS (
    SELECT row_number() OVER () AS rid, page_id, html, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
),
parsed AS (SELECT rid, page_id, html, {parts} FROM cut),
rules(verdict, rule, rule_host, rule_path) AS (VALUES {listed}),
ruled AS MATERIALIZED (SELECT rid, page_id, host, path, {by_rule.format("(SELECT rid, page_id, host, path FROM parsed)")}),
found AS (SELECT DISTINCT host AS src, unnest(regexp_extract_all(html, '{target}', 1)) AS rest FROM parsed),
linked AS MATERIALIZED (SELECT DISTINCT src, host, path FROM (SELECT src, {parts} FROM found) WHERE src <> host AND src <> '' AND host <> ''),
far AS (SELECT DISTINCT host, path FROM linked ANTI JOIN parsed USING (host)),
judged_far AS (SELECT host, path, {by_rule.format("far")}),
seeds AS MATERIALIZED (SELECT host, {share} FROM ruled GROUP BY host UNION ALL SELECT host, {share} FROM judged_far GROUP BY host),
edges AS MATERIALIZED (
    SELECT src, dst, count(*) OVER (PARTITION BY src) AS out_n, count(*) OVER (PARTITION BY dst) AS in_n FROM (SELECT DISTINCT src, host AS dst FROM linked)
),
s0 AS MATERIALIZED (SELECT host, {keep} * good AS t, {keep} * bad AS d, {keep} AS t1, {keep} AS d1 FROM seeds),{rounds}
scores AS MATERIALIZED (SELECT host, t, d, t / t1 AS good, d / d1 AS bad FROM s{ROUNDS}),
bad_out AS (SELECT src AS host, avg(bad) AS bad_out FROM edges JOIN scores ON scores.host = dst GROUP BY src),
good_in AS (SELECT dst AS host, avg(good) AS good_in FROM edges JOIN scores ON scores.host = src GROUP BY dst),
judged AS (
    SELECT host, CASE WHEN host <> '' AND ((d >= {MIN_DISTRUST} AND d > t)
                                           OR (coalesce(bad_out, 0) >= {MIN_DISTRUST} AND coalesce(bad_out, 0) > coalesce(good_in, 0)))
                      THEN 'block' ELSE 'allow' END AS spread
    FROM scores LEFT JOIN bad_out USING (host) LEFT JOIN good_in USING (host)
)
SELECT page_id, host, path, rule, coalesce(verdict, spread) AS verdict FROM ruled JOIN judged USING (host)
"""
