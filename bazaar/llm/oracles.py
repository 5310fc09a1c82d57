"""SQL for DuckDB that gives the rows of those queries that SQL can express."""

from bazaar.llm import licenses, line_dedup, phrases, ranked, search

# The control strings of the default chat template, in two patterns: a first character, and what
# follows it after any backslashes.
CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
    SELECT *, regexp_replace(regexp_replace(text,
            '(<)(\\*(?:\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>))', '\1\\\2', 'g'),
            '(\[)(\\*(?:INST\]|/INST\]))', '\1\\\2', 'g') AS shown,
        lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
        lead(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS after
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
        AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
        FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(12 + length(role) + 1 + length(shown) + 11) AS BIGINT) AS formatted_chars,
    bool_and(coalesce(CASE
        WHEN before IS NULL THEN role IN ('system', 'user')
        WHEN before = 'system' THEN role = 'user'
        WHEN before = 'user' THEN role = 'assistant'
        WHEN before = 'assistant' THEN role = 'user' END, FALSE)
        AND (after IS NOT NULL OR role = 'assistant')) AS valid
FROM marked GROUP BY conv_id
"""

LINES = f"""
WITH pages AS (
    SELECT doc_id, source, coalesce(text, '') AS text FROM documents
), lines AS (
    SELECT source, unnest(list_distinct(list_filter(
        list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> ''))) AS line
    FROM pages
), totals AS (
    SELECT source, count(*) AS total FROM pages GROUP BY source
), furniture AS (
    SELECT l.source, list(l.line) AS gone FROM (
        SELECT source, line, count(*) AS n FROM lines GROUP BY source, line
    ) l JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
    WHERE n >= {line_dedup.MIN_PAGES} AND n > {line_dedup.BOILERPLATE_RATIO} * total
    GROUP BY l.source
), cut AS (
    SELECT doc_id, string_split(text, chr(10)) AS old, list_filter(string_split(text, chr(10)),
        lambda x: trim(x) = '' OR NOT list_contains(coalesce(gone, []), trim(x))) AS new
    FROM pages p LEFT JOIN furniture f ON p.source IS NOT DISTINCT FROM f.source
)
SELECT doc_id, CAST(greatest(len(new), 1) AS BIGINT) AS n_kept,
    CAST(len(old) - len(new) AS BIGINT) AS n_dropped,
    sha256(array_to_string(new, chr(10))) AS text_sha256
FROM cut
"""

# Words in the order of the Python code's arithmetic, so that scores round alike.
SEARCH = f"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS terms
    FROM documents
), items AS (
    SELECT row_number() OVER () AS item, item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS terms
    FROM benchmark
), wanted AS (
    SELECT item, item_id, term, count(*) AS weight
    FROM (SELECT item, item_id, unnest(terms) AS term FROM items) GROUP BY ALL
), postings AS (
    SELECT row, doc_id, size, term, CAST(count(*) AS DOUBLE) AS tf
    FROM (SELECT row, doc_id, len(terms) AS size, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), corpus AS (
    SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(len(terms)) AS DOUBLE) / count(*) AS mean
    FROM docs
), frequency AS (
    SELECT term, ln(1 + (n - df + CAST(0.5 AS DOUBLE)) / (df + CAST(0.5 AS DOUBLE))) AS idf
    FROM (SELECT term, CAST(count(*) AS DOUBLE) AS df FROM postings GROUP BY term), corpus
), scored AS (
    SELECT row, doc_id, term, CAST(round(CAST({search.STEPS} AS DOUBLE) * idf * tf
        * CAST({search.K1 + 1} AS DOUBLE) / (tf + CAST({search.K1} AS DOUBLE) * (
            CAST({1 - search.B} AS DOUBLE) + CAST({search.B} AS DOUBLE) * size / mean))) AS BIGINT)
        AS score
    FROM postings JOIN frequency USING (term), corpus
), results AS (
    SELECT item, item_id, row, doc_id, CAST(sum(weight * score) AS BIGINT) AS score
    FROM wanted JOIN scored USING (term) GROUP BY ALL
)
SELECT item_id, rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
    FROM results WHERE score > 0
) WHERE rank <= {search.TOP}
"""



def _license_sql() -> str:
    templates = licenses.DEFAULT_TEMPLATES
    weights, norms = templates.weights(), templates.norms()
    idf = ", ".join(f"('{token}', {weight})" for token, weight in weights.items())
    entries = ", ".join(
        f"('{token}', {i}, '{licence}', {whole}, {weight}, {norms[i]})"
        for i, licence, whole, _ in templates.rows()
        for token, weight in templates.entries()[i].items()
    )
    return f"""
WITH weights(token, idf) AS (VALUES {idf}),
entries(token, template, license, is_file, weight, norm) AS (VALUES {entries}),
files AS (
    SELECT row_number() OVER () AS file, coalesce(text, '') AS text,
        concat_ws('/', source, lang, doc_id // 1000, CASE
            WHEN regexp_matches(string_split(text, chr(10))[1], '[Ll]icen[sc]e')
            THEN concat('LICENSE-', doc_id) ELSE concat_ws('/', doc_id // 50, doc_id) END) AS path
    FROM documents
), units AS (
    SELECT file, path, FALSE AS whole, unnest(string_split(text, chr(10))) AS text,
        generate_subscripts(string_split(text, chr(10)), 1) AS unit FROM files
    UNION ALL SELECT file, path, TRUE, text, 0 FROM files
), counts AS (
    SELECT file, path, whole, unit, token, count(*) AS n FROM (
        SELECT file, path, whole, unit, unnest(regexp_extract_all(
            translate(text, '{licenses.UPPER}', '{licenses.LOWER}'), '{licenses.TOKEN}')) AS token
        FROM units) GROUP BY ALL
), weighed AS (
    SELECT *, CAST(round(coalesce(idf, {templates.unknown()}) * (1 + ln(CAST(n AS DOUBLE)))) AS BIGINT)
        AS w
    FROM counts LEFT JOIN weights USING (token)
), lengths AS (
    SELECT file, unit, sum(w * w) AS square FROM weighed GROUP BY ALL
), dots AS (
    SELECT file, path, unit, template, license, norm, sum(w * weight) AS dot
    FROM weighed JOIN entries USING (token) WHERE whole = is_file GROUP BY ALL
), matches AS (
    SELECT file, path, license,
        CAST(dot AS DOUBLE) / sqrt(CAST(square AS DOUBLE) * CAST(norm AS DOUBLE)) AS cosine
    FROM dots JOIN lengths USING (file, unit)
), own AS (
    SELECT file, path, license, cosine FROM matches WHERE cosine >= {licenses.THRESHOLD}
    QUALIFY row_number() OVER (PARTITION BY file ORDER BY cosine DESC, license) = 1
), spoken AS (
    SELECT regexp_replace(path, '/?[^/]*$', '') AS above, license FROM own
    WHERE regexp_matches(path, '(^|/)LICENSE-[^/]*$')
    QUALIFY row_number() OVER (PARTITION BY above ORDER BY cosine DESC, license) = 1
), inherited AS (
    SELECT folder, s.license FROM (
        SELECT DISTINCT regexp_replace(path, '/?[^/]*$', '') AS folder FROM files WHERE path IS NOT NULL
    ) JOIN spoken s ON above = '' OR folder = above OR starts_with(folder, above || '/')
    QUALIFY row_number() OVER (PARTITION BY folder ORDER BY length(above) DESC) = 1
)
SELECT f.path, coalesce(o.license, i.license) AS license, o.cosine,
    CASE WHEN o.license IS NOT NULL THEN 'own' WHEN i.license IS NOT NULL THEN 'inherited' END AS basis
FROM files f LEFT JOIN own o USING (file)
LEFT JOIN inherited i ON regexp_replace(f.path, '/?[^/]*$', '') = i.folder
"""


# The same search for other queries: every document whose id is divisible by 20.
DOCUMENT_SEARCH = (
    SEARCH.replace("AS item, item_id, regexp", "AS item, doc_id AS query_id, regexp")
    .replace("FROM benchmark", "FROM documents WHERE doc_id % 20 = 0")
    .replace("item_id", "query_id")
)


RANKED = f"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
    FROM documents
), items AS (
    SELECT row_number() OVER () AS item, item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
    FROM benchmark
), wanted AS (
    SELECT item, item_id, term, count(*) AS times
    FROM (SELECT item, item_id, unnest(terms) AS term FROM items) GROUP BY ALL
), postings AS (
    SELECT row, doc_id, size, term, count(*) AS tf
    FROM (SELECT row, doc_id, len(terms) AS size, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), corpus AS (
    SELECT count(*) AS n, CAST(sum(len(terms)) AS BIGINT) AS total FROM docs WHERE len(terms) > 0
), weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE)))
        AS BIGINT) AS weight
    FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), corpus
), results AS (
    SELECT item, item_id, row, doc_id, CAST(sum(times * weight * ((1000000000 * tf)
        // (1000 * tf + 12 * (100 - 25 + (25 * size * n) // total)))) AS BIGINT) AS score
    FROM wanted JOIN postings USING (term) JOIN weights USING (term), corpus GROUP BY ALL
)
SELECT item_id, rank, doc_id, score FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INT)
        AS rank
    FROM results WHERE score > 0
) WHERE rank <= {ranked.TOP}
"""


PHRASES = f"""
WITH pieces AS (
    SELECT coalesce(lang, '{phrases.NO_LANGUAGE}') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), counts AS (
    SELECT lang, size, phrase, count(*) AS a FROM (
        SELECT lang, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase
        FROM words, unnest(range(1, {phrases.EDGE + 1})) s(size), unnest(range(1, len(w) - size + 2)) t(i)
    ) GROUP BY ALL HAVING count(*) >= {phrases.LEAST}
), kept AS (
    SELECT * FROM counts c WHERE size > 1 AND NOT EXISTS (
        SELECT 1 FROM counts o WHERE o.lang = c.lang AND o.size > c.size AND 100 * o.a >= 100 * c.a
            AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
    SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, n,
        CAST((CAST(1000 AS HUGEINT) * c.a * n) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
    FROM kept c JOIN totals USING (lang), unnest(range(1, c.size)) t(k)
    JOIN counts l ON l.lang = c.lang
        AND l.phrase = array_to_string(list_slice(string_split(c.phrase, ' '), 1, k), ' ')
    JOIN counts r ON r.lang = c.lang
        AND r.phrase = array_to_string(list_slice(string_split(c.phrase, ' '), k + 1, c.size), ' ')
), scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, n, score
FROM scored QUALIFY rank <= {phrases.TOP}
"""


ORACLES = {"op13_phrases": PHRASES, "op11_ranked_search": RANKED, "op2_license_scan": _license_sql(), "op1_search": SEARCH, "op5_chat_format": CHAT, "op8_line_dedup": LINES}
