"""DuckDB SQL of the queries on runs, repeated passages and conversation prefixes."""

from __future__ import annotations

#: Unsigned CRC-32 of a whole number's decimal digits, bit by bit with the reflected polynomial.
_BYTE = """list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"""


def crc32(number: str) -> str:
    digits = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda k: CAST(ascii(k) AS BIGINT))"
    return f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || {digits}, lambda c, b: {_BYTE}), 4294967295)"


def words(text: str) -> str:
    return rf"list_filter(string_split_regex(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _levels(last: int) -> str:
    """Hashes of the stretches of 1, 2, 4, ... words at each place, each from two of half the length."""
    parts = ["l0 AS (SELECT doc_id, i, n, hash(w) AS h FROM places)"]
    for k in range(1, last + 1):
        half = 2 ** (k - 1)
        parts.append(
            f"l{k} AS (SELECT doc_id, i, n, hash(h, lead(h, {half}) OVER (PARTITION BY doc_id ORDER BY i)) AS h FROM l{k - 1} WHERE n >= {4 * half})"
        )
    return ",\n        ".join(parts)


def _next_alike(last: int) -> str:
    """Distances to the next place with the same stretch of L words, as far as they are over L / 2 and at most L."""
    return "\n            UNION ALL ".join(
        f"SELECT doc_id, lead(i) OVER (PARTITION BY doc_id, h ORDER BY i) - i AS d, {2**k} AS size FROM l{k} WHERE i + {2**k} <= n"
        for k in range(last + 1)
    )


def periodic_runs(last: int = 15) -> str:
    """A run of period d holds stretches of L words, d <= L < 2d, whose next like is d words on.

    ``last`` bounds the power of two of L, and so the texts this SQL is right for: 2 ** 17 words.
    """
    return rf"""
        WITH hashed AS (SELECT doc_id, {words("text")} AS w, {crc32("doc_id")} AS c FROM documents),
        chosen AS (SELECT *, len(w) AS n, c // 10 AS g FROM hashed),
        planted AS (SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM chosen WHERE c % 10 = 0 AND n > 0),
        repeated AS (
            SELECT doc_id, n, list_transform(range(0, n), lambda i: w[1 + (CASE WHEN i < a THEN i ELSE a + (i - a) % p END)]) AS w FROM planted
            UNION ALL SELECT doc_id, n, w FROM chosen WHERE NOT (c % 10 = 0 AND n > 0)),
        places AS (SELECT doc_id, n, unnest(w) AS w, unnest(range(0, n)) AS i FROM repeated),
        {_levels(last)},
        candidates AS (
            SELECT DISTINCT doc_id, d FROM (
            {_next_alike(last)}) WHERE d <= size AND 2 * d > size),
        alike AS (
            SELECT d.doc_id, d.d, x.i, x.i - row_number() OVER (PARTITION BY d.doc_id, d.d ORDER BY x.i) AS island
            FROM candidates d JOIN places x ON x.doc_id = d.doc_id JOIN places y ON y.doc_id = d.doc_id AND y.i = x.i + d.d
            WHERE x.w = y.w),
        stretches AS (SELECT doc_id, d, min(i) AS s, count(*) + d AS len FROM alike GROUP BY doc_id, d, island HAVING count(*) + d >= greatest(6, 4 * d)),
        runs AS (
            SELECT * FROM stretches a WHERE NOT EXISTS (
                SELECT 1 FROM stretches b WHERE b.doc_id = a.doc_id AND b.d < a.d AND a.d % b.d = 0 AND b.s <= a.s AND b.s + b.len >= a.s + a.len)),
        summed AS (
            SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || d || chr(10), '' ORDER BY s, d) AS listed,
                   first(struct_pack(s := s, l := len, d := d) ORDER BY len DESC, s, d) AS best
            FROM runs GROUP BY doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s + d, s + len)) AS i FROM runs),
        kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t FROM places ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.l AS BIGINT) AS length,
               CAST(best.d AS BIGINT) AS period, CAST(1000 * best.l // best.d AS BIGINT) AS exponent_milli,
               sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
        FROM repeated LEFT JOIN summed USING (doc_id) LEFT JOIN kept USING (doc_id)"""


REPEATED_PASSAGES = """
        WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        starts AS (SELECT doc_id, i, md5_number(substr(x, 2 * i + 1, 200)) AS g FROM (SELECT *, unnest(range(0, len(x) // 2 - 99)) AS i FROM docs)),
        again AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM starts) WHERE k > 1),
        steps AS (SELECT *, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM again),
        numbered AS (SELECT *, sum(CASE WHEN gap <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM steps),
        spans AS (SELECT doc_id, min(i) AS s, max(i) + 100 AS e FROM numbered GROUP BY doc_id, span),
        cuts AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS f FROM spans),
        pieces AS (
            SELECT doc_id, f, substr(x, 2 * f + 1, 2 * (s - f)) AS piece FROM cuts JOIN docs USING (doc_id)
            UNION ALL
            SELECT doc_id, coalesce(e, 0), substr(x, 2 * coalesce(e, 0) + 1)
            FROM docs LEFT JOIN (SELECT doc_id, max(e) AS e FROM spans GROUP BY doc_id) USING (doc_id)),
        kept AS (SELECT doc_id, string_agg(piece, '' ORDER BY f) AS y FROM pieces GROUP BY doc_id),
        removed AS (SELECT doc_id, sum(e - s) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
        SELECT doc_id, len(x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(y)) AS kept_sha256
        FROM docs JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)"""

CONVERSATION_TRIE = rf"""
        WITH RECURSIVE turns AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i,
                   coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations),
        convs AS (SELECT conv_id, {crc32("conv_id")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM conversations)),
        rebuilt AS (
            SELECT c.conv_id, 0 AS part, t.i, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.i <= h
            UNION ALL SELECT c.conv_id, 1, t.i, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.i > h),
        steps AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS d,
                   sha256(len(role) || ':' || role || text) AS k, len({words("text")}) AS n FROM rebuilt),
        paths(conv_id, d, k, above, n) AS (
            SELECT conv_id, CAST(0 AS BIGINT), 'root', CAST(NULL AS VARCHAR), CAST(0 AS BIGINT) FROM convs
            UNION ALL SELECT p.conv_id, s.d, sha256(p.k || s.k), p.k, s.n FROM paths p JOIN steps s ON s.conv_id = p.conv_id AND s.d = p.d + 1),
        nodes AS (SELECT d, k, min(conv_id) AS conv_id, any_value(above) AS above, any_value(n) AS n, count(*) AS n_convs FROM paths GROUP BY d, k),
        children AS (SELECT above AS k, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above),
        subtrees AS (
            SELECT p.k, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * v.n) AS saved_tokens
            FROM nodes v LEFT JOIN children USING (k) JOIN paths p ON p.conv_id = v.conv_id AND p.d <= v.d GROUP BY p.k),
        ends AS (
            SELECT k, string_agg(conv_id, ',' ORDER BY conv_id) AS ids
            FROM (SELECT conv_id, k, d, max(d) OVER (PARTITION BY conv_id) AS last FROM paths) WHERE d = last GROUP BY k)
        SELECT v.conv_id, v.d AS depth, a.conv_id AS parent_conv_id, v.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
               CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
        FROM nodes v JOIN subtrees USING (k) LEFT JOIN children USING (k) LEFT JOIN ends USING (k) LEFT JOIN nodes a ON a.k = v.above"""
