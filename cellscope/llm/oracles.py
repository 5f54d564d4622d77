"""DuckDB SQL with the results of the queries that SQL can express."""

MIX = r"""
WITH d AS (
    SELECT doc_id, coalesce('=' || source, '') AS g,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5('42' || chr(31) || CAST(doc_id AS VARCHAR)) AS place
    FROM documents),
s AS (SELECT g, sum(size)::BIGINT AS source_size FROM d GROUP BY g),
w AS (
    SELECT *, row_number() OVER (ORDER BY g = '', g) - 1 AS turn, 2 * source_size AS full_at,
           1.5::DOUBLE * sum(source_size) OVER () AS wanted
    FROM s),
v AS (SELECT *, [3, 1, 2][(turn % 3 + 1)::INT] AS weight FROM w),
l AS (
    SELECT *, (wanted - coalesce(sum(full_at) OVER before, 0)::DOUBLE)
           / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
    FROM v
    WINDOW before AS (ORDER BY full_at::DOUBLE / weight, g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
    SELECT g, turn, source_size,
           CASE WHEN full_at <= weight * level THEN full_at::DOUBLE
                ELSE weight * max(CASE WHEN NOT full_at <= weight * level THEN level END) OVER () END AS target
    FROM l),
p AS (
    SELECT doc_id, size, source_size, target, turn % 3 AS curve,
           sum(size) OVER (PARTITION BY g ORDER BY place, size ROWS UNBOUNDED PRECEDING) - size + size / 2::DOUBLE AS middle
    FROM d JOIN t USING (g)),
c AS (
    SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE
        least(greatest(ceil((target - middle) / source_size::DOUBLE), 0), 2) END::INT AS copies
    FROM p),
k AS (SELECT *, [3, 1, 1][curve + 1]::DOUBLE AS a, [1, 1, 3][curve + 1]::DOUBLE AS b FROM c),
r AS (SELECT *, CASE WHEN copies > 0 THEN greatest(middle / target * ((a + b) / 2), 0) END AS asked FROM k)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies,
       CASE WHEN asked IS NULL THEN NULL WHEN asked <= 0 THEN 0
            ELSE least(2 * asked / (a + sqrt(a * a + 2 * (b - a) * asked)), 1) END AS position
FROM r
"""

LINES = r"""
WITH l AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
    FROM documents WHERE text IS NOT NULL),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h FROM l),
r AS (
    SELECT *, (lag(h, 1, 0) OVER w * 1000003 + h) % 2147483647 AS r, count(*) OVER (PARTITION BY doc_id) AS n
    FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
cuts AS (
    SELECT doc_id, i AS place FROM r WHERE r % 4 <> 0 OR i = n
    UNION ALL SELECT DISTINCT doc_id, 0 FROM r),
c AS (
    SELECT doc_id, place, CASE WHEN lead(place) OVER w - place >= 2 THEN lead(place) OVER w ELSE lead(place, 2) OVER w END AS stop
    FROM cuts WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
b AS (
    SELECT doc_id, place, stop, string_agg(line, chr(10) ORDER BY i) AS body,
           bool_or(regexp_matches(line, '[^\x20\x09-\x0D]')) AS worded
    FROM c JOIN l USING (doc_id) WHERE i > place AND i <= stop GROUP BY ALL),
g AS (
    SELECT *, worded AND row_number() OVER (PARTITION BY body ORDER BY doc_id, place) > 1 AS gone
    FROM b),
x AS (SELECT DISTINCT doc_id, i, true AS gone FROM g JOIN l USING (doc_id) WHERE gone AND i > place AND i <= stop),
s AS (
    SELECT doc_id, coalesce(string_agg(CASE WHEN gone IS NULL THEN line END, chr(10) ORDER BY i), '') AS text,
           count(*) AS n_lines, count(gone) AS n_removed_lines
    FROM l LEFT JOIN x USING (doc_id, i) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_chunks, count(*) FILTER (gone) AS n_removed_chunks FROM g GROUP BY doc_id)
SELECT doc_id, s.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_chunks, 0) AS n_chunks,
       coalesce(n_removed_lines, 0) AS n_removed_lines, coalesce(n_removed_chunks, 0) AS n_removed_chunks
FROM documents LEFT JOIN s USING (doc_id) LEFT JOIN t USING (doc_id)
"""

WINNOWING = r"""
WITH i AS (
    SELECT item_id::VARCHAR AS item_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL),
n AS (
    SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS span
    FROM (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p
          FROM i WHERE len(w) > 0)),
d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
s AS (
    SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS span
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
          FROM d, (SELECT DISTINCT size FROM n) z WHERE len(w) >= size)),
m AS (SELECT doc_id, p, n.size, item_id FROM s JOIN n ON s.size = n.size AND s.span = n.span),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM m) GROUP BY doc_id),
t AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items
    FROM m GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

RULES = r"""
WITH d AS (
    SELECT doc_id, coalesce('=' || source, '') AS g, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
v AS (
    SELECT doc_id, p, array_to_string(w[p:p + 7], ' ') AS span
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM d WHERE len(w) >= 8)),
o AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, span) AS n FROM v) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM o) GROUP BY doc_id),
m AS (
    SELECT doc_id, g, len(w)::BIGINT AS n_words, length(array_to_string(w, '')) AS word_chars,
           length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, len(lines)::BIGINT AS n_lines,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
           length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper
    FROM d LEFT JOIN r USING (doc_id)),
s AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
b AS (
    SELECT doc_id, g, base_failed, unnest([0, 1, 2, 3, 4, 5]) AS rule,
           unnest([n_symbols, n_dup_lines, n_repeat_words, n_upper, greatest(10 * n_words - word_chars, 0), word_chars]) AS part,
           unnest([word_chars, n_lines, n_words, word_chars, 10 * n_words, 40 * n_words]) AS whole
    FROM s),
k AS (
    SELECT doc_id, g, base_failed, rule,
           CASE WHEN whole > 0 THEN least(floor(part * 40 / whole::DOUBLE), 40)::INT ELSE 0 END AS bin
    FROM b),
l AS (
    SELECT doc_id, min(quality) AS good, min(quality) = 1 AND substr(md5(doc_id::VARCHAR), 1, 1) >= '4' AS tests
    FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = max(quality)),
h AS (
    SELECT rule, bin, count(*) AS docs, count(*) FILTER (good <> 1) AS bad
    FROM k LEFT JOIN l USING (doc_id) WHERE NOT base_failed AND NOT coalesce(tests, false) GROUP BY ALL),
t AS (
    SELECT rule, bin, sum(bad) OVER tail / (sum(docs) OVER tail)::DOUBLE AS share,
           sum(bad) OVER (PARTITION BY rule) / (sum(docs) OVER (PARTITION BY rule))::DOUBLE AS all_bad
    FROM h WINDOW tail AS (PARTITION BY rule ORDER BY bin DESC ROWS UNBOUNDED PRECEDING)),
f AS (SELECT rule, bin, dense_rank() OVER (ORDER BY share DESC) AS step FROM t WHERE share > all_bad),
-- a document's step: the first that rejects one of its measures, null if none does
e AS (
    SELECT k.doc_id, k.g, min(f.step) AS step FROM k LEFT JOIN f ON f.rule = k.rule AND f.bin <= k.bin
    WHERE NOT k.base_failed GROUP BY k.doc_id, k.g),
p AS (
    SELECT g, step, count(*) FILTER (good = 1) AS good, count(*) FILTER (good <> 1) AS bad
    FROM e JOIN l USING (doc_id) WHERE tests OR good <> 1 GROUP BY g, step),
n AS (SELECT g, sum(good)::BIGINT AS n FROM p GROUP BY g),
u AS (SELECT n, sum(count(*)) OVER (ORDER BY n DESC) + 1 AS strata FROM n GROUP BY n),
y AS (SELECT min(n) AS least, coalesce(max(strata), 1)::BIGINT AS strata FROM u WHERE n * ln(0.95) <= ln(0.05 / strata)),
q AS (
    SELECT CASE WHEN n.n >= y.least THEN g ELSE '*' END AS stratum, y.strata, step, sum(good)::BIGINT AS good, sum(bad)::BIGINT AS bad
    FROM p JOIN n USING (g), y GROUP BY ALL),
c AS (SELECT stratum, strata, sum(good)::BIGINT AS n FROM q GROUP BY ALL),
i AS (SELECT *, unnest(range(0, floor(n * 0.05)::BIGINT + 1)) AS i FROM c),
a AS (
    SELECT stratum, strata, i, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.05) + (n - i) * ln(0.95)))
           OVER (PARTITION BY stratum ORDER BY i ROWS UNBOUNDED PRECEDING) AS tail
    FROM i),
z AS (SELECT stratum, max(CASE WHEN tail <= 0.05 / strata THEN i ELSE -1 END) AS allowed FROM a GROUP BY stratum),
j AS (
    SELECT stratum, step, sum(good) OVER milder AS lost,
           sum(bad) OVER milder * sum(good) OVER whole - sum(good) OVER milder * sum(bad) OVER whole AS gain
    FROM q WINDOW milder AS (PARTITION BY stratum ORDER BY step NULLS LAST ROWS UNBOUNDED PRECEDING),
                  whole AS (PARTITION BY stratum)),
x AS (
    SELECT stratum, step AS last FROM j JOIN z USING (stratum)
    WHERE lost <= allowed AND gain > 0 AND step IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY gain DESC, step) = 1),
v2 AS (
    SELECT e.doc_id, e.step <= x.last AS worse
    FROM e LEFT JOIN c own ON own.stratum = e.g LEFT JOIN x ON x.stratum = coalesce(own.stratum, '*'))
SELECT s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(worse, false) AS kept
FROM s LEFT JOIN v2 USING (doc_id)
"""

# The root's parent is null, and clients read whole numbers with nulls as doubles.
# CRC-32 is a table of 256 numbers, made here from its polynomial, and a fold over the bytes.
TRIE = r"""
WITH z AS (
    SELECT list(v ORDER BY n) AS steps FROM (
        SELECT n, list_reduce(list_prepend(n, range(8)), lambda x, i:
            CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v FROM range(256) r(n))),
o AS (
    SELECT conv_id AS c, t, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, t) AS pos
    FROM (SELECT conv_id, turn, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS t,
                 len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS words
          FROM conversations WHERE conv_id IS NOT NULL)),
n AS (SELECT c, count(*) AS turns FROM o GROUP BY c),
h AS (
    SELECT n.c, n.c - n.c % 20 AS base, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(string_split(n.c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda a, b: xor(a >> 8, z.steps[(xor(a, b) & 255) + 1]))) % 4 AS h
    FROM n, z),
b AS (SELECT h.*, least(h.h, coalesce(n.turns, 0)) AS m FROM h LEFT JOIN n ON n.c = h.base),
r AS (
    SELECT b.c, o.pos AS i, o.t, o.words FROM b JOIN o ON o.c = b.base AND o.pos <= b.h
    UNION ALL SELECT b.c, o.pos - b.h + b.m, o.t, o.words FROM b JOIN o ON o.c = b.c AND o.pos > b.h
    UNION ALL SELECT c, 0, '', 0 FROM b),
p AS (
    SELECT c, i, words, string_agg(t, '') OVER (PARTITION BY c ORDER BY i) AS key, i = max(i) OVER (PARTITION BY c) AS ends
    FROM r),
v AS (
    SELECT key, i AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
           string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends) AS ends
    FROM p GROUP BY key, i),
k AS (SELECT left(key, 64 * (depth - 1)::INT) AS key, count(*) AS n_children FROM v WHERE depth > 0 GROUP BY 1),
s AS (
    SELECT p.key, sum((v.n_convs - 1) * v.words) AS saved, count(*) FILTER (NOT EXISTS (SELECT 1 FROM k WHERE k.key = v.key)) AS leaves
    FROM v JOIN p ON p.c = v.conv_id AND p.i <= v.depth GROUP BY p.key)
SELECT v.conv_id, v.depth::BIGINT AS depth, u.conv_id::DOUBLE AS parent_conv_id, v.n_convs, coalesce(n_children, 0) AS n_children,
       leaves AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM v JOIN s USING (key) LEFT JOIN k USING (key)
LEFT JOIN v u ON v.depth > 0 AND u.depth = v.depth - 1 AND u.key = left(v.key, 64 * (v.depth - 1)::INT)
"""

ORACLES = {"op1_curriculum_mix": MIX, "op3_line_chunks": LINES, "op6_quality_rules": RULES, "op7_winnowing": WINNOWING,
           "op11_prefix_trie": TRIE}
