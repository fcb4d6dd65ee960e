"""DuckDB SQL for the queries that SQL can express."""

CHAT = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
w AS (
    SELECT *, length('### : </turn>') + 1
        + length(replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t'), ':', '\c'))
        + length(replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t')) AS chars FROM t),
p AS (
    SELECT *, sum(chars) OVER o AS upto, row_number() OVER o AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM w
    WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
g AS (
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
        coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '') AS trained,
        CAST(sum(upto) FILTER (role = 'assistant' OR i = n) AS BIGINT) AS formatted_chars
    FROM p GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(trained) AS loss_chars, sha256(trained) AS loss_sha256, formatted_chars FROM g
"""

_BLANK = r"[\x20\x09-\x0D]+"

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
s AS (
    SELECT *, list_filter(string_split_regex(text, '{_BLANK}'), lambda x: x <> '') AS w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '{_BLANK}', '', 'g') <> '') AS lines FROM d),
u AS (SELECT k, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM s),
x AS (
    SELECT k, i, word, lead(word, 1) OVER o AS w1, lead(word, 2) OVER o AS w2 FROM u
    WINDOW o AS (PARTITION BY k ORDER BY i)),
c AS (SELECT k, i, count(*) OVER (PARTITION BY k, word, w1, w2) AS n FROM x WHERE w2 IS NOT NULL),
r AS (
    SELECT k, count(DISTINCT j) AS n_repeat_words
    FROM (SELECT k, unnest([i, i + 1, i + 2]) AS j FROM c WHERE n > 1) GROUP BY k),
m AS (
    SELECT doc_id, text, w, lines, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
    FROM s LEFT JOIN r USING (k)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed
        OR 100 * n_symbols > 30 * n_words
        OR 100 * len(regexp_extract_all(text, '!!+')) > 30 * n_words
        OR 100 * length(regexp_replace(text, '[\p{{L}}\s\x0B]', '', 'g')) > 40 * length(text)
        OR 100 * n_dup_lines > 50 * len(lines)
        OR NOT (word_chars BETWEEN 2 * n_words AND 15 * n_words)
        OR (100 * (n_words - len(list_distinct(w))) > 80 * n_words AND n_words < 400)
        OR 100 * len(regexp_extract_all(text, '(?m)(\.\.\.|…)$')) > 50 * len(lines)
        OR 100 * len(regexp_extract_all(text, '(?m)^[\x20\t]*[-•*]\x20')) > 90 * len(lines)) AS kept
FROM f
"""

#: Exact search, components added in order and in double precision.
NEAREST = """
WITH e AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (
    SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) AS score FROM e q JOIN e c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0),
r AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM d)
SELECT * FROM r WHERE rank <= 10
"""

#: All pairs that share a shingle, then the components by a recursive walk.
NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(
        string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_BLANK}'),
        lambda x: x <> '') AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS shingle FROM d),
n AS (SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (
    SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE 100 * shared >= 85 * (x.n_shingles + y.n_shingles - shared)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n_shingles, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""

ARCHIVE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest,
        CASE WHEN octet_length(payload) >= 1000 THEN max(page_id) OVER (PARTITION BY payload) END AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN original IS NOT NULL AND page_id IS DISTINCT FROM original THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN original IS NOT NULL AND page_id IS DISTINCT FROM original THEN original END AS refers_to FROM d
"""

_PII_KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    (
        "ip",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR CAST('0' || right(p, 3) AS INT) > 255)) = 0",
    ),
    (
        "card",
        r"[0-9]([\x20-]?[0-9])+",
        """length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda j: CASE
            WHEN j % 2 = 1 THEN CAST(reverse(digits)[j] AS INT) WHEN reverse(digits)[j] > '4' THEN 2 * CAST(reverse(digits)[j] AS INT) - 9
            ELSE 2 * CAST(reverse(digits)[j] AS INT) END)) % 10 = 0""",
    ),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(digits) BETWEEN 9 AND 15"),
    (
        "iban",
        r"[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]{4}){2,7}(\x20?[A-Z0-9]{1,3})?",
        """NOT regexp_matches(before, '[A-Za-z0-9]$') AND NOT regexp_matches(after, '^[A-Za-z0-9]')
            AND CAST(CAST(CAST(CAST(CAST(left(number, 30) AS HUGEINT) % 97 AS VARCHAR) || number[31:60] AS HUGEINT) % 97 AS VARCHAR)
                || number[61:] AS HUGEINT) % 97 = 1""",
    ),
    (
        "ssn",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        r"""NOT regexp_matches(before, '[0-9-]$') AND NOT regexp_matches(after, '^[0-9-]')
            AND NOT regexp_matches(m, '^(000|666|9)|-00-|-0000$') AND (regexp_matches(before, '(?i)\b(ssn|social\s+security)\b')
                OR regexp_matches(after, '(?i)\b(ssn|social\s+security)\b'))""",
    ),
]


def _pii_kind(at: int, kind: str, pattern: str, good: str) -> str:
    number = (
        "array_to_string(list_transform(string_split(substr(replace(m, ' ', ''), 5) || left(replace(m, ' ', ''), 4), ''), "
        "lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c ELSE CAST(ascii(c) - 55 AS VARCHAR) END), '')"
    )
    return rf"""
    SELECT k, {at} AS kind_no, '{kind}' AS kind, start, start + length(m) AS stop FROM (
        SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS digits, {number} AS number FROM (
            SELECT k, m, right(gap, 48) AS before, left(gaps[i + 1], 48) AS after,
                sum(length(gap)) OVER (o ROWS UNBOUNDED PRECEDING)
                    + coalesce(sum(length(m)) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
            FROM (
                SELECT k, gaps, unnest(found) AS m, unnest(gaps[1:len(found)]) AS gap, generate_subscripts(found, 1) AS i
                FROM (SELECT k, regexp_extract_all(text, '{pattern}', 0) AS found, string_split_regex(text, '{pattern}') AS gaps FROM d))
            WINDOW o AS (PARTITION BY k ORDER BY i)))
    WHERE {good}"""


PRIVATE = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(_pii_kind(i, *kind) for i, kind in enumerate(_PII_KINDS))}),
p AS (SELECT *, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS place FROM s),
g AS (
    SELECT k, string_agg(place, ',' ORDER BY kind_no, start) AS spans, string_agg(place, ',' ORDER BY kind_no, start) FILTER (kind_no < 4) AS base,
        {", ".join(f"count(*) FILTER (kind_no = {i}) AS n_{kind[0]}" for i, kind in enumerate(_PII_KINDS[:4]))}
    FROM p GROUP BY k)
SELECT doc_id, {", ".join(f"coalesce(n_{kind[0]}, 0) AS n_{kind[0]}" for kind in _PII_KINDS[:4])},
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (k)
"""

LINES = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT k, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
n AS (
    SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (
    SELECT key, max(doc_id) AS keeper FROM n WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (
    SELECT k, doc_id, line, i, f.key IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS dropped FROM n LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY k, doc_id
"""

#: CRC-32 bit by bit; near words share a form with one position left out or starred.
SPELLING = r"""
WITH r AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]{7,}')) AS run
    FROM documents),
l AS (
    SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM r GROUP BY ALL),
b AS (
    SELECT *, flatten(list_transform(string_split(id || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128
        THEN [CAST(unicode(c) AS BIGINT)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS bytes FROM l),
h AS (
    SELECT id, run, n, xor(list_reduce(list_concat([4294967295], bytes), lambda a, x: list_reduce(
        [xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) AS h FROM b),
w AS (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
        ELSE run END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
i AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
p AS (
    SELECT word, n, 'r' || left(word, CAST(i - 1 AS INT)) || '*' || substr(word, CAST(i + 1 AS INT)) AS key, 0 AS side FROM i
    UNION ALL SELECT word, n, 'd' || left(word, CAST(i - 1 AS INT)) || substr(word, CAST(i + 1 AS INT)), 1 FROM i
    UNION ALL SELECT word, n, 'd' || word, 2 FROM v),
e AS (
    SELECT DISTINCT a.word, b.word AS other, b.n AS m FROM p AS a JOIN p AS b USING (key)
    WHERE a.word <> b.word AND (a.side = 0 OR a.side <> b.side)),
g AS (
    SELECT word, count(*) AS n_near, max(m) AS m FROM e GROUP BY word),
f AS (
    SELECT v.word, v.n, coalesce(g.n_near, 0) AS n_near, CASE WHEN g.m >= 10 * v.n THEN g.m END AS form_n,
        CASE WHEN g.m >= 10 * v.n THEN (SELECT min(e.other) FROM e WHERE e.word = v.word AND e.m = g.m) END AS form
    FROM v LEFT JOIN g USING (word)),
t AS (
    WITH RECURSIVE t AS (
        SELECT word, word AS root, form AS next FROM f
        UNION ALL SELECT t.word, f.word, f.form FROM t JOIN f ON t.next = f.word)
    SELECT word, root FROM t WHERE next IS NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN t USING (word)
"""
