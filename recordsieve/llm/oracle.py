"""SQL of the queries that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), '%s', '%s'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')" % (
    UPPER, LOWER
)

RANKED_SEARCH = f"""
    WITH held AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM held GROUP BY ALL),
    size AS (SELECT doc_id, count(*) AS n FROM held GROUP BY doc_id),
    whole AS (SELECT count(*) AS total, CAST(sum(n) AS BIGINT) AS length FROM size),
    norm AS (SELECT doc_id, 50 + (50 * n * total) // length AS m FROM size, whole),
    weight AS (SELECT term, CAST(floor(1000 * ln((2 * total + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
               FROM tf, whole GROUP BY term, total),
    asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
    scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
               FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN norm USING (doc_id) GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
               FROM scored WHERE score > 0)
    SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50"""

_GRAMS = " UNION ALL ".join(
    f"SELECT lang, {n} AS size, unnest(list_transform(range(1, len(ws) - {n - 2}), lambda i: list_slice(ws, i, i + {n - 1}))) AS p"
    f" FROM pieces WHERE len(ws) >= {n}"
    for n in range(1, 5)
)
_CUTS = " UNION ALL ".join(
    f"SELECT lang, p, a, {k} AS k, list_slice(p, 1, {k}) AS x, list_slice(p, {k + 1}, size) AS y FROM candidates WHERE size > {k}"
    for k in range(1, 4)
)
_INNER = " UNION ALL ".join(
    f"SELECT lang, a AS f, list_slice(p, {first}, {first + k - 1}) AS p FROM candidates WHERE size = {n}"
    for n in (3, 4) for k in range(2, n) for first in range(1, n - k + 2)
)

COLLOCATIONS = f"""
    WITH parts AS (SELECT coalesce(lang, 'und') AS lang,
                          unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                                       '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
    pieces AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM parts),
    grams AS ({_GRAMS}),
    counted AS (SELECT lang, size, p, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
    totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM pieces GROUP BY lang),
    candidates AS (SELECT lang, size, p, f AS a FROM counted WHERE size > 1),
    cuts AS ({_CUTS}),
    scores AS (SELECT c.lang, c.p, c.a, k, u.f AS l, v.f AS r,
                      CAST((CAST(2000000 AS HUGEINT) * c.a) // (CAST(u.f AS HUGEINT) + v.f) AS BIGINT) AS score
               FROM cuts c JOIN counted u ON u.lang = c.lang AND u.p = c.x JOIN counted v ON v.lang = c.lang AND v.p = c.y),
    lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS place FROM scores),
    longer AS (SELECT lang, p, max(f) AS most FROM ({_INNER}) GROUP BY ALL),
    kept AS (SELECT s.*, array_to_string(s.p, ' ') AS phrase FROM lowest s LEFT JOIN longer USING (lang, p)
             WHERE place = 1 AND (most IS NULL OR CAST(100 AS HUGEINT) * most < CAST(80 AS HUGEINT) * a)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

ORACLE: dict[str, str] = {"op12_ranked_search": RANKED_SEARCH, "op13_collocations": COLLOCATIONS}
