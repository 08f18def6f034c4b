"""SQL counterpart of the runs of repeated words."""

from tillworks.llm.sql_parts import CRC_STEPS, crc32

#: Words that come again p words later, per document and p as stretches; a stretch of at least
#: max(p, 12 - p) such words is a run, unless a smaller period has the same words.
RUNS = f"""WITH {CRC_STEPS},
    texts AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {crc32("CAST(doc_id AS VARCHAR)")} AS h
        FROM documents, crc_steps
    ),
    counted AS (SELECT doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN h // 10 END AS g FROM texts),
    planted AS (SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM counted),
    words AS (
        SELECT doc_id, n, CASE WHEN g IS NULL THEN w
            ELSE list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) END AS w
        FROM planted
    ),
    placed AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM words),
    again AS (
        SELECT x.doc_id, y.i - x.i AS p, x.i AS i
        FROM placed x JOIN placed y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 2 * (y.i - x.i) <= x.n
    ),
    stretches AS (
        SELECT doc_id, p, min(i) AS start, count(*) + p AS length
        FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS k FROM again) s
        GROUP BY doc_id, p, k HAVING count(*) >= greatest(p, 12 - p)
    ),
    runs AS (SELECT doc_id, start, length, min(p) AS period FROM stretches GROUP BY doc_id, start, length),
    told AS (
        SELECT doc_id, count(*) AS n_runs,
            arg_max({{'s': start, 'l': length, 'p': period}}, (length, -start, -period)) AS top,
            string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
        FROM runs GROUP BY doc_id
    ),
    kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM placed w
        WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = w.doc_id AND w.i >= r.start + r.period AND w.i < r.start + r.length)
        GROUP BY doc_id
    )
    SELECT doc_id, CAST(n AS BIGINT) AS n_words, coalesce(n_runs, 0) AS n_runs, top.s AS start, top.l AS length, top.p AS period,
        1000 * top.l // top.p AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
        sha256(coalesce(collapsed, '')) AS collapsed_sha256
    FROM words LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)"""
