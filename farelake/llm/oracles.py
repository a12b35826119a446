"""DuckDB SQL for the queries of this subpackage that SQL can express over whole tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLES["op3_substring_dedup"] = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
),
earliest AS (SELECT h, min(doc_id) AS first_id FROM win GROUP BY h),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
    FROM win JOIN earliest USING (h) WHERE first_id < doc_id
),
pos AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS line, count(*) AS n
    FROM pos ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(line, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

# base32 by hand: each letter takes five bits, which lie in at most two hexadecimal digits of the SHA-1
_BITS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((strpos('0123456789abcdef', substr(h, {5 * i // 4 + 1}, 1)) - 1) * 16"
    f" + strpos('0123456789abcdef', substr(h, {5 * i // 4 + 2}, 1)) - 1) // {1 << (3 - 5 * i % 4)} % 32, 1)"
    for i in range(32)
)

ORACLES["op4_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last_id FROM p)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, {_BITS} AS payload_digest,
       CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last_id THEN last_id END AS refers_to
FROM g
"""

ORACLES["op5_threshold_search"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q, row_number() OVER () AS n
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
    SELECT a.n, a.vec_id AS query_id, b.vec_id,
           list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM v a JOIN v b ON a.n <> b.n WHERE a.vec_id % 100 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank, vec_id, score
FROM pairs QUALIFY rank <= 10
"""

ORACLES["op13_hard_negatives"] = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x, row_number() OVER () AS n
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
    SELECT a.n, b.n AS m, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike,
           list_sum(list_transform(list_zip(a.x, b.x), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM v a JOIN v b ON a.n <> b.n WHERE a.vec_id % 100 = 0
),
p AS (
    SELECT n, m, anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike
    QUALIFY row_number() OVER (PARTITION BY n ORDER BY score DESC, id NULLS LAST) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.n, p.m ORDER BY score DESC, id NULLS LAST)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.n = s.n AND NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

_BIN_SHIFT = "greatest(length(bin({0})) - 6, 0)"


def _bin(value: str) -> str:
    shift = _BIN_SHIFT.format(value)
    return f"(({value}) >> {shift}) + 32 * {shift}"


_MEASURES = {
    "word_length": ("1000 * word_chars // greatest(n_words, 1)", 2000),
    "symbol_share": ("1000000 * n_symbols // greatest(n_words, 1)", 100_000),
    "dup_line_share": ("1000000 * n_dup_lines // greatest(n_lines, 1)", 300_000),
    "repeat_share": ("1000000 * n_repeat_words // greatest(n_words, 1)", 200_000),
}
_VALUES = " UNION ALL ".join(
    f"SELECT lang, source, '{m}' AS measure, {_bin(f'({v})')} AS bin, {slack} AS slack FROM b WHERE NOT base_failed"
    for m, (v, slack) in _MEASURES.items()
)
_INSIDE = " AND ".join(
    f"({v}) BETWEEN max(lo) FILTER (measure = '{m}') AND max(hi) FILTER (measure = '{m}')" for m, (v, _) in _MEASURES.items()
)

ORACLES["op10_quality_rules"] = rf"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
marks AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS seen
    FROM (SELECT doc_id, i, w[i:i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) > 2))
),
rep AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM marks WHERE seen > 1) GROUP BY doc_id
),
l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS x FROM t),
m AS (
    SELECT t.doc_id, lang, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
           (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           len(l.x)::BIGINT AS n_lines, (len(l.x) - len(list_distinct(l.x)))::BIGINT AS n_dup_lines,
           coalesce(rep.n, 0)::BIGINT AS n_repeat_words
    FROM t JOIN l USING (doc_id) LEFT JOIN rep USING (doc_id)
),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
v AS ({_VALUES}),
lev AS (
    SELECT 2 AS level, lang, source, measure, bin, slack FROM v UNION ALL
    SELECT 1, lang, NULL, measure, bin, slack FROM v UNION ALL SELECT 0, NULL, NULL, measure, bin, slack FROM v
),
h AS (SELECT level, lang, source, measure, slack, bin, count(*) AS n FROM lev GROUP BY ALL),
c AS (
    SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY bin) AS upto,
           sum(n) OVER (PARTITION BY level, lang, source, measure) AS docs,
           CASE WHEN bin < 64 THEN bin ELSE ((bin - 32 * (bin // 32 - 1) + 1) << (bin // 32 - 1)) - 1 END AS top
    FROM h
),
q AS (
    SELECT level, lang, source, measure, max(docs) AS docs, max(slack) AS slack, min(top) FILTER (100 * upto >= 5 * docs) AS q05,
           min(top) FILTER (100 * upto >= 50 * docs) AS q50, min(top) FILTER (100 * upto >= 95 * docs) AS q95
    FROM c GROUP BY ALL
),
f AS (
    SELECT level, lang, source, measure, docs, q50 - greatest(4 * (q50 - q05), slack) AS lo, q50 + greatest(4 * (q95 - q50), slack) AS hi
    FROM q
),
pick AS (
    SELECT a.lang, a.source, a.measure,
           CASE WHEN a.docs >= 100 THEN a.lo WHEN o.docs >= 100 THEN o.lo ELSE z.lo END AS lo,
           CASE WHEN a.docs >= 100 THEN a.hi WHEN o.docs >= 100 THEN o.hi ELSE z.hi END AS hi
    FROM (SELECT * FROM f WHERE level = 2) a
    LEFT JOIN (SELECT * FROM f WHERE level = 1) o ON a.lang IS NOT DISTINCT FROM o.lang AND a.measure = o.measure
    LEFT JOIN (SELECT * FROM f WHERE level = 0) z ON a.measure = z.measure
),
verdict AS (
    SELECT b.doc_id, coalesce({_INSIDE}, false) AS inside
    FROM b JOIN pick ON b.lang IS NOT DISTINCT FROM pick.lang AND b.source IS NOT DISTINCT FROM pick.source
    WHERE NOT base_failed
    GROUP BY b.doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words
)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(inside, false) AS kept
FROM b LEFT JOIN verdict USING (doc_id)
"""
