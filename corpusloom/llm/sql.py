"""The same results in DuckDB SQL, where SQL can say it."""

from __future__ import annotations

OP3 = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS n FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(n) AS text_sha256
FROM t WINDOW w AS (PARTITION BY n)
"""

OP4 = r"""
WITH t AS (SELECT doc_id, string_split(text, chr(10)) AS w FROM documents),
o AS (SELECT doc_id, unnest(w) AS line, unnest(range(len(w))) AS pos FROM t),
n AS (SELECT * FROM o WHERE trim(translate(line, chr(9) || chr(13) || chr(11) || chr(12), '    ')) <> ''),
d AS (SELECT line, min((doc_id, pos)) AS f, length(line) AS k FROM n GROUP BY line),
-- levenshtein() counts bytes here, so it only narrows the pairs down: one character is four bytes at most
pairs AS (SELECT x.line, CASE WHEN x.k >= y.k THEN x.line ELSE y.line END AS p, CASE WHEN x.k >= y.k THEN y.line ELSE x.line END AS q
          FROM d x JOIN d y ON y.k BETWEEN x.k - 1 AND x.k + 1 AND y.f < x.f AND levenshtein(x.line, y.line) <= 4),
near AS (SELECT DISTINCT line FROM pairs
         WHERE len(list_filter(range(1, length(p) + 1), lambda i: p[:i - 1] || p[i + 1:] = q
                               OR length(p) = length(q) AND p[:i - 1] || p[i + 1:] = q[:i - 1] || q[i + 1:])) > 0),
keep AS (SELECT n.doc_id, n.pos FROM n JOIN d ON n.line = d.line AND (n.doc_id, n.pos) = d.f
         WHERE n.line NOT IN (SELECT line FROM near)),
left_over AS (SELECT o.doc_id, o.line, o.pos FROM o LEFT JOIN n USING (doc_id, pos) LEFT JOIN keep USING (doc_id, pos)
              WHERE n.doc_id IS NULL OR keep.doc_id IS NOT NULL),
j AS (SELECT doc_id, count(*) AS c, string_agg(line, chr(10) ORDER BY pos) AS s FROM left_over GROUP BY 1)
SELECT t.doc_id, len(w) AS n_lines, len(w) - coalesce(c, 0) AS n_dropped, sha256(coalesce(s, '')) AS text_sha256
FROM t LEFT JOIN j USING (doc_id)
"""

OP6 = r"""
WITH lw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bn AS (SELECT item_id, w, least(len(w), 13) AS k FROM bw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, w[s:s + k - 1] AS x FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM bn)),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS s FROM lw),
occ AS (SELECT doc_id, s, z.k, w[s:s + z.k - 1] AS x FROM pos, (SELECT DISTINCT k FROM win) z WHERE s + z.k - 1 <= len(w)),
hit AS (SELECT o.doc_id, o.s, o.k, win.item_id FROM occ o JOIN win ON o.k = win.k AND o.x = win.x),
np AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM hit) GROUP BY 1),
ni AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS l FROM hit GROUP BY 1)
SELECT lw.doc_id, len(w) AS n_words, coalesce(np.n, 0) AS n_hit, coalesce(ni.n, 0) AS n_items,
       sha256(coalesce(ni.l, '')) AS items_sha256,
       coalesce(np.n, 0) > 0 AND 20 * coalesce(np.n, 0) >= len(w) AS contaminated
FROM lw LEFT JOIN np USING (doc_id) LEFT JOIN ni USING (doc_id)
"""

OP8 = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                               '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i:i + least(3, len(w)) - 1] AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, link.b FROM reach r JOIN link ON r.b = link.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) c USING (doc_id)
"""

OP9 = r"""
WITH rules(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
u AS (SELECT page_id, url, translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
p AS (SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path FROM u),
m AS (SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
             row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS k
      FROM p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
"""

OP13 = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
p AS (SELECT lang, unnest(string_split_regex(x, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY 1),
g AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
      FROM g, (VALUES (1), (2), (3), (4)) AS v(k) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS (SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS j FROM c),
scored AS (SELECT cut.lang, cut.phrase, cut.a, cut.j, x.f AS l, y.f AS r, ((2000000::HUGEINT * cut.a) // (x.f + y.f))::BIGINT AS score
           FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(cut.w[1:j], ' ')
                    JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(cut.w[j + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
span AS (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM c, (VALUES (2), (3)) AS v(m) WHERE m < k),
longer AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS a FROM span GROUP BY 1, 2),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE longer.a IS NULL OR 100 * longer.a < 80 * lowest.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000
"""


def llm_sql() -> dict[str, str]:
    return {"op3_exact_dedup": OP3, "op4_line_dedup": OP4, "op6_decontamination": OP6, "op8_ngram_join": OP8, "op9_url_filters": OP9, "op13_phrases": OP13}
