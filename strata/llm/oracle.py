"""DuckDB SQL for the queries whose results plain SQL can state: equality of
word windows, Jaccard links and components, inner products, payload groups.
Tokenizer ids, permutations and learned models have none; their queries are
held against brute force in the tests."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(pattern: str, lower: bool) -> str:
    text = "coalesce(text, '')"
    text = f"translate({text}, '{_UPPER}', '{_LOWER}')" if lower else text
    return f"regexp_extract_all({text}, '{pattern}')"


_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLE_SQL = {
    "op3_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
last AS (SELECT h, max(page_id) AS m FROM p WHERE n >= 1000 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.h AS payload_digest,
       CASE WHEN page_id < m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < m THEN m END AS refers_to
FROM p LEFT JOIN last ON p.h = last.h AND n >= 1000""",
    "op6_near_duplicates": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words(_SPACED, True)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
          GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
          WHERE 100 * c >= 85 * (a.n + b.n - c)),
sides AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT x AS doc_id, x AS c FROM sides UNION SELECT b.y, r.c FROM reach r JOIN sides b ON b.x = r.doc_id),
low AS (SELECT doc_id, min(c) AS c FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(low.c, d.doc_id) AS component_id,
       coalesce(low.c, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN low ON low.doc_id = d.doc_id""",
    "op7_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_words(_SPACED, False)} AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
low AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN low ON win.g = low.g WHERE doc_id > m),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
each AS (SELECT d.doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d JOIN lost ON lost.doc_id = d.doc_id),
kept AS (SELECT e.doc_id, string_agg(e.w[e.p], ' ' ORDER BY e.p) AS t FROM each e
         LEFT JOIN gone ON gone.doc_id = e.doc_id AND gone.p = e.p WHERE gone.p IS NULL GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(lost.n, 0) AS n_removed,
       sha256(CASE WHEN lost.n IS NULL THEN coalesce(array_to_string(w, ' '), '') ELSE coalesce(kept.t, '') END) AS kept_sha256
FROM d LEFT JOIN lost ON lost.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id""",
    "op9_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q))
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 20""",
    "op10_decontaminate": f"""
WITH d AS (SELECT doc_id, {_words(_ALNUM, True)} AS w FROM documents),
b AS (SELECT item_id, {_words(_ALNUM, True)} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
             FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
             FROM d JOIN (SELECT DISTINCT k FROM iw) ks ON len(w) >= k)),
hits AS (SELECT doc_id, i, dw.k, item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.g = iw.g),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS j
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(cov.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
       sha256(coalesce(j, '')) AS items_sha256,
       coalesce(cov.n, 0) > 0 AND 20 * coalesce(cov.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov ON cov.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id""",
    "op11_phrases": f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS s FROM d),
w AS (SELECT lang, regexp_extract_all(s, '[^\\x20\\x09]+') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
            FROM w JOIN (VALUES (1), (2), (3), (4)) AS ks(k) ON len(w) >= k)),
f AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS v, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
cuts AS (SELECT lang, phrase, a, v, k, unnest(range(1, k)) AS j FROM f WHERE k > 1),
scored AS (SELECT c.lang, c.phrase, c.a, c.j, x.a AS l, y.a AS r,
                  (CAST(2000000 AS HUGEINT) * c.a) // (CAST(x.a AS HUGEINT) + y.a) AS score
           FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.v[:c.j], ' ')
           JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.v[c.j + 1:], ' ')),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM scored) WHERE o = 1),
inside AS (SELECT lang, array_to_string(v[i:i + m - 1], ' ') AS phrase, max(a) AS a
           FROM (SELECT lang, v, a, m, unnest(range(1, k - m + 2)) AS i FROM f JOIN (VALUES (2), (3)) AS ms(m) ON m < k)
           GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
         WHERE i.a IS NULL OR CAST(100 AS HUGEINT) * i.a < CAST(80 AS HUGEINT) * b.a)
SELECT k.lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) k
JOIN n ON n.lang = k.lang WHERE rank <= 2000""",
    "op12_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
win AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 200)) AS g
        FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 99)) AS i FROM d WHERE len(x) >= 200)),
hits AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS o FROM win) WHERE o > 1),
runs AS (SELECT doc_id, i, sum(CASE WHEN i <= p + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS k
         FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM hits)),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM runs GROUP BY doc_id, k),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM spans),
cut AS (SELECT g.doc_id, sum(b - a) AS gone, count(*) AS n, max(b) AS e,
               string_agg(substr(x, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS front
        FROM gaps g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       coalesce(n, 0) AS n_spans,
       sha256(unhex(CASE WHEN n IS NULL THEN x ELSE front || substr(x, 2 * e + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut ON cut.doc_id = d.doc_id""",
}
