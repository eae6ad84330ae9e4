"""DuckDB SQL of the queries that SQL can express."""

SQL = {
    "op2_line_dedup": r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs),
keyed AS (SELECT r, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
gone AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
marked AS (SELECT k.r, k.pos, k.line, g.key IS NOT NULL AS drop FROM keyed k LEFT JOIN gone g ON k.key = g.key),
made AS (SELECT r, count(*) AS n_lines, count(*) FILTER (drop) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT drop), '') AS kept FROM marked GROUP BY r)
SELECT d.doc_id, CAST(m.n_lines AS BIGINT) AS n_lines, CAST(m.n_dropped AS BIGINT) AS n_dropped, sha256(m.kept) AS kept_sha256
FROM docs d JOIN made m ON d.r = m.r""",
    "op6_decontamination": r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all(translate(coalesce(text, ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 13) AS n, list_slice(w, i, i + least(len(w), 13) - 1) AS key
        FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dwin AS (SELECT r, n, i, list_slice(w, i, i + n - 1) AS key
         FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM docs, sizes WHERE len(w) >= n)),
hit AS (SELECT d.r, d.i, d.n, x.item FROM dwin d JOIN win x ON d.n = x.n AND d.key = x.key),
cover AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY r),
spot AS (SELECT r, i, len(w) AS total, w[i] AS head, list_slice(w, greatest(1, i - 2), i + 14) AS around, least(i, 3) AS mid
       FROM (SELECT r, w, unnest(generate_series(1, len(w))) AS i FROM docs)),
near AS (SELECT DISTINCT d.r, x.item FROM spot d JOIN win x ON d.head = x.key[1]
         WHERE d.i + x.n - 1 <= d.total AND (x.n = 1 OR list_contains(d.around, x.key[2])) AND (x.n < 8 OR list_contains(d.around, x.key[8]))
               AND len(list_filter(generate_series(1, x.n),
               lambda o: list_contains(list_slice(d.around, greatest(1, d.mid + o - 3), d.mid + o + 1), x.key[o]))) = x.n),
close AS (SELECT r, count(*) AS n_near FROM (SELECT r, item FROM near EXCEPT SELECT r, item FROM hit) GROUP BY r),
owned AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hit GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(o.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(o.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated,
       CAST(coalesce(n.n_near, 0) AS BIGINT) AS n_near_items
FROM docs d LEFT JOIN close n ON n.r = d.r LEFT JOIN cover c ON c.r = d.r LEFT JOIN owned o ON o.r = d.r""",
    "op11_filter_audit": r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
              FROM documents),
least AS (SELECT t, min(doc_id) AS first FROM docs GROUP BY t),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
          FROM labels GROUP BY doc_id),
masks AS (SELECT d.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
          (CASE WHEN len(w) < 100 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END)
          + (CASE WHEN 100 * len(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 10 * len(d.t) THEN 4 ELSE 0 END)
          + (CASE WHEN regexp_matches(d.t, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN d.doc_id > l.first THEN 16 ELSE 0 END) AS mask
          FROM docs d JOIN least l ON d.t = l.t LEFT JOIN marks m ON m.doc_id = d.doc_id),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS b),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
           FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
           JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(list_slice(bits, 1, step - 1)), 0)::INTEGER AS before
          FROM (SELECT filter_order, bits, unnest([1, 2, 3, 4, 5]) AS step FROM orders)),
played AS (SELECT c.part, s.filter_order, s.step, s.own,
           sum(CASE WHEN c.mask & (s.before | s.own) = 0 THEN c.n ELSE 0 END) AS kept,
           sum(CASE WHEN c.mask & s.before = 0 AND c.mask & s.own > 0 THEN c.n ELSE 0 END) AS removed,
           sum(CASE WHEN c.mask & s.before > 0 AND c.mask & s.own > 0 THEN c.n ELSE 0 END) AS redundant,
           sum(CASE WHEN c.mask = s.own THEN c.n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN c.mask & s.before = 0 AND c.mask & s.own > 0 THEN c.good ELSE 0 END) AS good_lost,
           sum(CASE WHEN c.mask & s.before = 0 AND c.mask & s.own > 0 THEN c.toxic ELSE 0 END) AS toxic_lost
           FROM cells c, steps s GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM played""",
    "op12_topk_search": r"""
WITH rows AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
              FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS row,
           CAST(list_sum(list_transform(generate_series(1, len(q.v)), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
           FROM rows q JOIN rows c ON q.r <> c.r WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id ASC NULLS LAST, row) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10""",
    "op13_collocations": r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase, list_slice(w, i, i + size - 1) AS key
          FROM (SELECT lang, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM words, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size)),
f AS (SELECT lang, size, phrase, any_value(key) AS key, count(*)::HUGEINT AS f FROM grams GROUP BY lang, size, phrase),
total AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
cand AS (SELECT lang, size, phrase, key, f AS a FROM f WHERE size > 1 AND f >= 10),
cuts AS (SELECT c.lang, c.size, c.phrase, c.key, c.a, k, l.f AS l, r.f AS r, (1000000::HUGEINT * c.a * c.a) // (l.f * r.f) AS score
         FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM cand) c
         JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(c.key, 1, k), ' ')
         JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(c.key, k + 1, c.size), ' ')),
worst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM cuts) WHERE o = 1),
inner_of AS (SELECT lang, array_to_string(list_slice(key, i, i + 1), ' ') AS phrase, max(a) AS longer
             FROM (SELECT *, unnest([1, 2]) AS i FROM cand WHERE size = 3) GROUP BY ALL),
rest AS (SELECT w.* FROM worst w LEFT JOIN inner_of i ON i.lang = w.lang AND i.phrase = w.phrase
         WHERE i.longer IS NULL OR 100 * i.longer < 50 * w.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM rest)
SELECT r.lang, r.rank, r.phrase, CAST(r.a AS BIGINT) AS a, CAST(r.l AS BIGINT) AS l, CAST(r.r AS BIGINT) AS r, CAST(t.n AS BIGINT) AS n,
       CAST(r.score AS BIGINT) AS score
FROM ranked r JOIN total t ON t.lang = r.lang WHERE r.rank <= 2000""",
}
