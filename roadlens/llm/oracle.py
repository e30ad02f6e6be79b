"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

# Windows of 20 words, in order; a word goes if a window over it is not the first of its kind.
_SUBSTRING = rf"""
WITH docs AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
spots AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i FROM docs WHERE len(w) >= 20),
windows AS (SELECT a.doc_id, a.i, array_to_string(d.w[a.i : a.i + 19], ' ') AS k FROM spots a JOIN docs d USING (doc_id)),
again AS (
    SELECT doc_id, i FROM
    (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1
),
gone AS (SELECT doc_id, list(DISTINCT j) AS g FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM again) GROUP BY doc_id),
flat AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM docs),
kept AS (
    SELECT f.doc_id, string_agg(f.word, ' ' ORDER BY f.j) AS text
    FROM flat f LEFT JOIN (SELECT doc_id, unnest(g) AS j FROM gone) x ON f.doc_id = x.doc_id AND f.j = x.j
    WHERE x.j IS NULL GROUP BY f.doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(len(g), 0)::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN gone USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAMINATION = rf"""
WITH docs AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
cuts AS (
    SELECT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + 12], ' ') AS k
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM cuts),
places AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n),
hits AS (
    SELECT p.doc_id, p.i, p.n, c.item_id
    FROM places p JOIN docs d USING (doc_id) JOIN cuts c ON c.n = p.n AND c.k = array_to_string(d.w[p.i : p.i + p.n - 1], ' ')
),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(d.w), false) AS contaminated
FROM docs d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_TOPK = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

# crc32 of a short text, bit by bit; DuckDB has no function for it.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all({}, '.'), lambda c: ascii(c)::BIGINT)),
    lambda r, b: list_reduce(list_prepend(xor(r, b), [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]),
        lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""


def _runs_sql(scales: int = 14) -> str:
    """Runs by the lag to the next place with the same 8, 16, 32, … words; enough scales for 190,000 words."""
    steps, spots, names = [], [], "h0"
    for i in range(scales + 2):
        s, least = 1 << i, (1 << i) // 2 + 1 if i > 3 else 1
        if i >= 3:
            spots.append(
                f"SELECT doc_id, i, d, {s} AS s FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id, h ORDER BY i) - i AS d FROM {names}) "
                f"WHERE d BETWEEN {least} AND {s}"
            )
        steps.append(
            f"h{i + 1} AS MATERIALIZED (SELECT doc_id, i, hash(h, g) AS h FROM "
            f"(SELECT doc_id, i, h, lead(h, {s}) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM {names}) WHERE g IS NOT NULL)"
        )
        names = f"h{i + 1}"
    union = "\n    UNION ALL ".join(spots)
    return f"""
WITH docs AS (
    SELECT doc_id, w, len(w) AS n, h % 10 AS r, h // 10 AS g
    FROM (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w, {_CRC32.format("doc_id::VARCHAR")} AS h FROM documents)
),
places AS (SELECT *, CASE WHEN r = 0 AND n > 0 THEN g % n ELSE n END AS a FROM docs),
loops AS (SELECT doc_id, w, n, a, 1 + (n - a) // (3 + g % 8) AS p FROM places),
texts AS (
    SELECT doc_id, n, CASE WHEN a = n THEN w ELSE [w[CASE WHEN i < a THEN i + 1 ELSE a + (i - a) % p + 1 END] for i in range(n)] END AS w FROM loops
),
words AS MATERIALIZED (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM texts),
h0 AS (SELECT doc_id, i, hash(word) AS h FROM words),
{", ".join(steps)},
spots AS ({union}),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, s, d ORDER BY i) AS island FROM spots),
runs AS MATERIALIZED (
    SELECT doc_id, min(i) AS start, count(*) - 1 + d + s AS length, d AS period FROM islands GROUP BY doc_id, s, d, island
    HAVING count(*) - 1 + d + s >= greatest(24, 3 * d)
),
listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY doc_id
),
best AS (
    SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) = 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words WHERE (doc_id, i) NOT IN (SELECT (doc_id, i) FROM gone) GROUP BY doc_id
)
SELECT t.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
       (1000 * length // period)::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM texts t LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""


_WRITTEN = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(map(_WRITTEN.format, ["doc_id", "source", "lang", "{0}", "text"])) + ")"
_PAIRS = "[sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')) for i in range(0, len(nodes), 2)]"

# All levels of the trees as lists; a path takes from each level the node beside its own.
_MERKLE = f"""
WITH RECURSIVE leaves AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM (
        SELECT doc_id, lang, {_LEAF.format("n_chars")} AS leaf,
               CASE WHEN {_CRC32.format("doc_id::VARCHAR")} % 7 = 0 THEN {_LEAF.format("(n_chars + 1)")} END AS claimed
        FROM documents)
),
levels AS (
    SELECT lang, 0 AS level, list(leaf ORDER BY i) AS nodes FROM leaves GROUP BY lang
    UNION ALL SELECT lang, level + 1, {_PAIRS} FROM levels WHERE len(nodes) > 1
),
subroots AS (
    SELECT lang, level AS height, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS j
    FROM levels WHERE len(nodes) = 1
),
tops AS (
    SELECT 0 AS level, list(subroot ORDER BY j) AS nodes FROM subroots
    UNION ALL SELECT level + 1, {_PAIRS} FROM tops WHERE len(nodes) > 1
),
places AS (
    SELECT l.*, s.subroot, s.j, s.height FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
),
steps AS (
    SELECT doc_id, leaf, level AS step, (i >> level) % 2 AS odd, nodes[xor(i >> level, 1) + 1] AS beside
    FROM places p JOIN levels v ON p.lang IS NOT DISTINCT FROM v.lang WHERE len(nodes) > 1
    UNION ALL
    SELECT doc_id, leaf, height + level, (j >> level) % 2, nodes[xor(j >> level, 1) + 1] FROM places, tops WHERE len(nodes) > 1
),
paths AS (
    SELECT doc_id, leaf, coalesce(string_agg(beside, '' ORDER BY step), '') AS proof,
           list(CASE WHEN beside IS NULL THEN 'N' WHEN odd = 1 THEN 'L' || beside ELSE 'R' || beside END ORDER BY step) AS path
    FROM steps GROUP BY doc_id, leaf
),
folds AS (
    SELECT p.doc_id, p.leaf, subroot, t.nodes[1] AS root, sha256(coalesce(proof, '')) AS proof_sha256,
           list_reduce(list_prepend(coalesce(claimed, p.leaf), coalesce(path, [])),
               lambda a, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || a WHEN 'R' THEN a || s[2:] ELSE a END)) AS folded_root
    FROM places p LEFT JOIN paths q ON p.doc_id IS NOT DISTINCT FROM q.doc_id AND p.leaf = q.leaf, (SELECT * FROM tops WHERE len(nodes) = 1) t
)
SELECT *, folded_root = root AS verified FROM folds
"""

ORACLE = {
    "op1_substring_dedup": _SUBSTRING, "op3_decontamination": _DECONTAMINATION, "op4_topk_search": _TOPK, "op11_periodic_runs": _runs_sql(),
    "op13_merkle_manifest": _MERKLE,
}
