"""DuckDB SQL for the queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# a table of the CRC of each byte, and the CRC of a column by it
CRC_TABLE = """
bits AS (SELECT i AS b, i::UBIGINT AS c, 0 AS k FROM range(256) r(i)
         UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8)"""


def crc(column: str) -> str:
    octets = f"list_transform(range(len(hex({column})) // 2), lambda i: ('0x' || substr(hex({column}), 2 * i + 1, 2))::UBIGINT)"
    full = "4294967295::UBIGINT"
    return f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, t[(xor(c & 255, b) + 1)::BIGINT]), {full}), {full})"


SQL = {
    "op2_substring_dedup": f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
p AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS run
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY run) AS n FROM p) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM r, (SELECT unnest(range(0, 35)) AS k)),
one AS (SELECT doc_id, w[i] AS word, i FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n
         FROM one ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op3_decontamination": rf"""
WITH i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(w[k:k + least(len(w), 13) - 1], ' ') AS run,
               least(len(w), 13) AS n
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS k FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
lens AS (SELECT DISTINCT n FROM win),
p AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS run
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, k, n, run FROM p SEMI JOIN win USING (run, n)),
words AS (SELECT doc_id, count(DISTINCT k + o) AS n_hit
          FROM (SELECT doc_id, k, unnest(range(0, n)) AS o FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hit JOIN win USING (run, n)) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w)) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op8_mixing": rf"""
WITH d AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size, text FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w,
             2.0::DOUBLE * source_size AS most FROM s),
t AS (SELECT *, 1.5::DOUBLE * (SELECT sum(source_size) FROM s)::DOUBLE AS total,
             (sum(most) OVER o - most)::DOUBLE AS given, (SELECT sum(w) FROM r) - (sum(w) OVER o - w) AS open
      FROM r WINDOW o AS (ORDER BY most / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (SELECT (total - given) / open AS level FROM t WHERE (total - given) / open * w <= most
      ORDER BY most / w, source NULLS LAST LIMIT 1),
g AS (SELECT source, source_size, least(w * level, most) AS target FROM r, l),
x AS (SELECT doc_id, size, source_size, target,
             CASE WHEN source_size = 0 THEN 0.0 ELSE target / source_size END AS rate,
             ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, text, '')), 1, 13))::BIGINT
               / 4503599627370496.0::DOUBLE AS draw
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM x
""",
    "op4_near_dedup": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 1], ' ') AS sh
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (sh)
      WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM x JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id
      WHERE 100 * shared >= 80 * (p.n + q.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(id, other) AS (SELECT DISTINCT a, a FROM e UNION SELECT reach.id, e.b FROM reach JOIN e ON reach.other = e.a),
c AS (SELECT id, min(other) AS c FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c, d.doc_id) AS component_id,
       coalesce(c, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.id = d.doc_id
""",
    "op11_spelling_variants": rf"""
WITH RECURSIVE {CRC_TABLE},
run AS (SELECT doc_id, r, count(*) AS n
        FROM (SELECT doc_id, unnest(regexp_extract_all({LOWER}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents) GROUP BY ALL),
hashed AS (SELECT r, n, {crc("(doc_id || ':' || r)")} AS h FROM run, tab),
spoilt AS (SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, (h % length(r))::BIGINT) || substr(r, (h % length(r))::BIGINT + 2)
                  ELSE r END AS word, n FROM hashed),
w AS (SELECT word, sum(n)::BIGINT AS n FROM spoilt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT DISTINCT word, n, k, substr(word, 1, k - 1) AS a, substr(word, k + 1) AS z
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM w)),
shorter AS (SELECT DISTINCT word, n, a || z AS other FROM cut),
less AS (SELECT s.word AS x, s.n AS nx, w.word AS y, w.n AS ny FROM shorter s JOIN w ON s.other = w.word),
pair AS (SELECT x AS word, y AS near, ny AS near_n FROM less UNION ALL SELECT y, x, nx FROM less
         UNION ALL SELECT p.word, q.word, q.n FROM cut p JOIN cut q USING (k, a, z) WHERE p.word <> q.word),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS most, arg_min(near, (-near_n, near)) AS near FROM pair GROUP BY word),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN near END AS form,
             CASE WHEN most >= 10 * n THEN most END AS form_n FROM w LEFT JOIN best USING (word)),
chain(word, last, depth) AS (SELECT word, word, 0 FROM f
                             UNION ALL SELECT chain.word, f.form, depth + 1 FROM chain JOIN f ON chain.last = f.word
                             WHERE f.form IS NOT NULL),
top AS (SELECT word, arg_max(last, depth) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN top USING (word)
""",
    "op12_importance_resampling": rf"""
WITH RECURSIVE {CRC_TABLE},
one AS (SELECT 'd' AS side, doc_id, unnest(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
        UNION ALL
        SELECT 'b', NULL, unnest(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
vocabulary AS (SELECT word, ({crc("word")} % 10000)::BIGINT AS bucket FROM (SELECT DISTINCT word FROM one), tab),
n AS (SELECT side, doc_id, bucket, count(*)::BIGINT AS n FROM one JOIN vocabulary USING (word) GROUP BY ALL),
total AS (SELECT coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t FROM n),
shares AS (SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t
         FROM n GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln((shares.t + 1) * (total.s + 10000) / ((shares.s + 1) * (total.t + 10000))))::BIGINT AS gain
         FROM shares, total),
w AS (SELECT doc_id, sum(n)::BIGINT AS n, sum(n * gain)::BIGINT AS weight FROM n JOIN gain USING (bucket) WHERE side = 'd' GROUP BY doc_id),
x AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
             ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT::DOUBLE AS h FROM documents LEFT JOIN w USING (doc_id)),
s AS (SELECT doc_id, n_features, weight,
             weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM x),
o AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS nth, 10 * count(*) OVER () // 100 AS most
      FROM s WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN nth <= most THEN nth END AS rank FROM s LEFT JOIN o USING (doc_id)
""",
    "op13_exact_dedup": r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)
""",
}
