"""SQL for the queries that SQL can express, for the second engine."""

from __future__ import annotations

from siltstone.llm.adaptive_rules import FENCES, MIN_DOCS, PERCENTS

_SPACE = r"\x20\x09-\x0D"

#: Contract columns of the quality rules: windows of five words are joined by a character no word holds.
_MEASURED = rf"""
texts AS (
    SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents
),
split AS (
    SELECT *, regexp_extract_all(t, '[^{_SPACE}]+') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{_SPACE}]')) AS lines
    FROM texts
),
grams AS (
    SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM split WHERE len(w) >= 5
),
keyed AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM grams),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM keyed) WHERE n > 1),
gaps AS (SELECT r, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 5) AS gap FROM twice),
covered AS (SELECT r, sum(least(gap, 5))::BIGINT AS n FROM gaps GROUP BY r),
measured AS (
    SELECT r, doc_id, lang, source, len(w)::BIGINT AS n_words,
        length(regexp_replace(t, '[{_SPACE}]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        len(lines)::BIGINT AS n_lines,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(c.n, 0)::BIGINT AS n_repeat_words
    FROM split LEFT JOIN covered c USING (r)
),
judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        n_symbols * 10000 // greatest(word_chars, 1) AS symbol_share,
        n_dup_lines * 10000 // greatest(n_lines, 1) AS dup_line_share,
        n_repeat_words * 10000 // greatest(n_words, 1) AS repeat_share,
        word_chars * 100 // greatest(n_words, 1) AS word_length
    FROM measured
)"""


def _binned(value: str) -> str:
    drop = f"greatest(length(bin({value})) - 6, 0)"
    return f"((({value}) >> ({drop})::BIGINT) << ({drop})::BIGINT)"


def _adaptive_rules() -> str:
    long = " UNION ALL ".join(
        f"SELECT lang, source, '{m}' AS measure, {_binned(m)} AS bin FROM judged WHERE NOT base_failed" for m in FENCES
    )

    def quartiles(name: str, keys: str) -> str:
        by = f"{keys}, " if keys else ""
        return f"""
{name} AS (
    SELECT {by}measure, max(docs) AS docs, {", ".join(f"min(bin) FILTER (upto * 100 >= docs * {p}) AS q{p}" for p in PERCENTS)}
    FROM (
        SELECT *, sum(n) OVER (PARTITION BY {by}measure ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY {by}measure) AS docs
        FROM (SELECT {by}measure, bin, count(*) AS n FROM long GROUP BY ALL)
    )
    GROUP BY {by}measure
)"""

    tests = []
    fences = []
    for m, f in FENCES.items():
        high = f"q{f.percent}"
        fences.append(f"max({high} + greatest(({high} - q25) * {f.reach}, {f.noise})) FILTER (measure = '{m}') AS {m}_high")
        tests.append(f"coalesce({m} <= {m}_high, true)")
        if f.lower:
            fences.append(f"max(q25 - greatest(({high} - q25) * {f.reach}, {f.noise})) FILTER (measure = '{m}') AS {m}_low")
            tests.append(f"coalesce({m} >= {m}_low, true)")
    return f"""
WITH {_MEASURED},
long AS ({long}),
{quartiles("by_own", "lang, source")},
{quartiles("by_lang", "lang")},
{quartiles("by_all", "")},
chosen AS (
    SELECT o.lang, o.source, measure,
        {", ".join(
            f"CASE WHEN o.docs >= {MIN_DOCS} THEN o.q{p} WHEN l.docs >= {MIN_DOCS} THEN l.q{p} ELSE a.q{p} END AS q{p}"
            for p in PERCENTS
        )}
    FROM by_own o
    JOIN by_lang l USING (measure) JOIN by_all a USING (measure)
    WHERE o.lang IS NOT DISTINCT FROM l.lang
),
fences AS (SELECT lang, source, {", ".join(fences)} FROM chosen GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND {" AND ".join(tests)} AS kept
FROM judged j
LEFT JOIN fences f ON j.lang IS NOT DISTINCT FROM f.lang AND j.source IS NOT DISTINCT FROM f.source
"""


#: Base32: five hexadecimal digits are four letters of five bits.
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, max(page_id) AS head, count(*) AS n, sha1(h) AS x FROM p GROUP BY h),
letters AS (
    SELECT h, string_agg('{_LETTERS}'[(five >> (15 - 5 * k)) % 32 + 1], '' ORDER BY i, k) AS digest
    FROM (SELECT h, i, ('0x' || x[5 * i + 1:5 * i + 5])::BIGINT AS five FROM g, range(8) AS r(i)), range(4) AS s(k)
    GROUP BY h
)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, digest AS payload_digest,
    CASE WHEN n > 1 AND page_id IS DISTINCT FROM head THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n > 1 AND page_id IS DISTINCT FROM head THEN head END AS refers_to, true AS digest_holds
FROM p JOIN g USING (h) JOIN letters USING (h)
"""

#: By comparing all pairs. A beam wider than a shard of the graph finds the same rows, so this holds for
#: small tables; at any size the tests measure recall.
_NEAREST = """
WITH v AS (
    SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
pairs AS (
    SELECT q.vec_id AS query_id, q.e, v.vec_id,
        sqrt(list_sum(list_transform(list_zip(q.e, v.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS score
    FROM v AS q JOIN v ON v.vec_id <> q.vec_id AND len(v.e) = len(q.e) WHERE q.vec_id % 100 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id, e ORDER BY score, vec_id))::INTEGER AS rank, vec_id, score
FROM pairs QUALIFY rank <= 10
"""

#: The checksum goes byte by byte through a table of 256 remainders; words one edit apart agree once the same
#: letter is left out of both, or one letter out of the longer.
_SPELLING = r"""
WITH RECURSIVE remainders AS (
    SELECT list_transform(range(256), lambda x: list_reduce(
        list_prepend(x, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
    )) AS t
),
runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    WHERE length(run) >= 5 GROUP BY ALL
),
bytes AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT)),
        lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])
    )) AS h
    FROM bytes, remainders
),
words AS (
    SELECT word, sum(n)::BIGINT AS n
    FROM (
        SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed
    )
    WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
),
shorter AS (
    SELECT word, n, i, word[:i] || word[i + 2:] AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
),
near AS (
    SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b USING (i, rest) WHERE a.word <> b.word
    UNION
    SELECT s.word, s.n, w.word, w.n FROM shorter s JOIN words w ON w.word = s.rest
    UNION
    SELECT w.word, w.n, s.word, s.n FROM shorter s JOIN words w ON w.word = s.rest
),
judged AS (
    SELECT word, n, count(*) AS n_near, min((-near_n, near)) AS best FROM near GROUP BY word, n
),
forms AS (
    SELECT word, n, n_near, CASE WHEN -best[1] >= 2 * n THEN best[2] END AS form, CASE WHEN -best[1] >= 2 * n THEN -best[1] END AS form_n
    FROM judged
),
steps AS (
    SELECT word, form AS root FROM forms WHERE form IS NOT NULL
    UNION ALL
    SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.root WHERE f.form IS NOT NULL
),
roots AS (
    SELECT word, root FROM steps WHERE root NOT IN (SELECT word FROM forms WHERE form IS NOT NULL)
)
SELECT w.word, f.form, coalesce(r.root, w.word) AS root, w.n, coalesce(f.n_near, 0)::BIGINT AS n_near, f.form_n
FROM words w LEFT JOIN forms f ON f.word = w.word LEFT JOIN roots r ON r.word = w.word
"""

ORACLE = {
    "op2_warc": _WARC,
    "op4_adaptive_rules": _adaptive_rules(),
    "op11_hnsw": _NEAREST,
    "op13_spelling_variants": _SPELLING,
}
