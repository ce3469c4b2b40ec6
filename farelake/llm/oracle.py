"""SQL for DuckDB that the queries must equal, where SQL can say it."""

from __future__ import annotations

from farelake.llm.common import LOWER, UPPER
from farelake.llm import gridcodes, secrets
from farelake.llm.decontaminate import WORD
from farelake.llm.lexical import TERM

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')"

_OP2 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
win AS (
    SELECT DISTINCT item, n, array_to_string(w[s : s + n - 1], ' ') AS t
    FROM sized, unnest(range(1, len(w) - n + 2)) AS u(s)
),
sizes AS (SELECT DISTINCT n FROM win),
spans AS (
    SELECT doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') AS t
    FROM (SELECT * FROM d, sizes WHERE len(w) >= n), unnest(range(1, len(w) - n + 2)) AS u(s)
),
occ AS (SELECT doc_id, s, n, item FROM spans JOIN win USING (n, t)),
hit AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT DISTINCT doc_id, s, n FROM occ), unnest(range(s, s + n)) AS u(p)
    GROUP BY doc_id
),
found AS (
    SELECT doc_id, count(DISTINCT item) AS n_items,
        string_agg(DISTINCT item, ',' ORDER BY item) AS ids
    FROM occ GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_OP8 = r"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents),
p AS (
    SELECT doc_id, i, a[i] AS line, len(regexp_extract_all(a[i], '[^\x20\x09-\x0D]+')) AS n
    FROM l, unnest(range(1, len(a) + 1)) AS u(i)
),
c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM p),
runs AS (
    SELECT doc_id, x.i AS s, y.i AS e, array_to_string(a[x.i : y.i], chr(10)) AS t
    FROM c AS x JOIN c AS y USING (doc_id) JOIN l USING (doc_id)
    WHERE x.i <= y.i AND y.upto - x.upto + x.n > 50
        AND (y.upto - y.n - x.upto + x.n <= 50 OR y.upto - x.upto <= 50)
),
firsts AS (SELECT *, min(row(doc_id, s)) OVER (PARTITION BY t) AS f FROM runs),
gone AS (
    SELECT DISTINCT doc_id, i
    FROM (SELECT * FROM firsts WHERE row(doc_id, s) > f), unnest(range(s, e + 1)) AS u(i)
),
kept AS (
    SELECT doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
        string_agg(line, chr(10) ORDER BY p.i) FILTER (WHERE g.i IS NULL) AS t
    FROM p LEFT JOIN gone AS g USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
    CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(t, '')) AS text_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""



def _spans(kind: int, pattern: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
    SELECT doc_id, {kind} AS kind, m[i] AS found,
        CAST(list_sum([len(x) FOR x IN gaps[1:i]]) + coalesce(list_sum([len(x) FOR x IN m[1:i-1]]), 0)
            AS BIGINT) AS s
    FROM (
        SELECT doc_id, regexp_extract_all(t, '{quoted}') AS m, string_split_regex(t, '{quoted}') AS gaps
        FROM d
    ), unnest(range(1, len(m) + 1)) AS u(i)"""


_LIMIT = f"""CASE WHEN regexp_full_match(found, '[0-9A-Fa-f]*') THEN {secrets.most_weight(secrets.LEAST_BITS["hex"])}
    WHEN regexp_full_match(found, '[^A-Z]*') OR regexp_full_match(found, '[^a-z]*')
        THEN {secrets.most_weight(secrets.LEAST_BITS["single"])}
    ELSE {secrets.most_weight(secrets.LEAST_BITS["mixed"])} END"""

_OP4 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
fixed AS (
    {_spans(0, secrets.ASSIGN)}
    UNION ALL {_spans(1, secrets.ACCESS)}
    UNION ALL {_spans(2, secrets.HEX)}
),
base AS (
    SELECT doc_id, kind, s, s + len(found) AS e FROM fixed
    WHERE kind > 0 OR len(regexp_extract(found, '{secrets.ASSIGN.replace("'", "''")}', 2))
        >= {secrets.LEAST_ASSIGNED}
),
cand AS (
    SELECT * FROM ({_spans(3, secrets.CANDIDATE)})
    WHERE NOT regexp_matches(found, '{secrets.ALLOWED}')
),
letters AS (
    SELECT doc_id, s, found, w, count(*) AS n
    FROM cand, unnest(range(1, len(found) - {secrets.WINDOW} + 2)) AS a(w),
        unnest(range(0, {secrets.WINDOW})) AS b(k)
    GROUP BY doc_id, s, found, w, substr(found, w + k, 1)
),
windows AS (
    SELECT doc_id, s, found, w, sum(CAST(round(n * log2(n) * 1e6) AS BIGINT)) AS total
    FROM letters GROUP BY doc_id, s, found, w
),
made AS (
    SELECT doc_id, 3 AS kind, s + min(w) - 1 AS s, s + max(w) - 1 + {secrets.WINDOW} AS e
    FROM windows AS w0 WHERE total <= {_LIMIT} GROUP BY doc_id, w0.s, found
),
added AS (
    SELECT * FROM made AS m WHERE NOT EXISTS (
        SELECT 1 FROM base AS b WHERE b.doc_id = m.doc_id AND b.s <= m.s AND m.e <= b.e)
),
every AS (SELECT * FROM base UNION ALL SELECT * FROM added),
named AS (SELECT *, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || s || ':' || e AS x FROM every),
g AS (
    SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n0, count(*) FILTER (WHERE kind = 1) AS n1,
        count(*) FILTER (WHERE kind = 2) AS n2,
        string_agg(x, ',' ORDER BY s, kind) FILTER (WHERE kind < 3) AS base,
        string_agg(x, ',' ORDER BY s, kind) AS spans
    FROM named GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_assign, CAST(coalesce(n1, 0) AS BIGINT) AS n_access,
    CAST(coalesce(n2, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans
FROM documents LEFT JOIN g USING (doc_id)
"""

_OP11 = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
win AS (
    SELECT doc_id, s, array_to_string(w[s : s + 12], ' ') AS t
    FROM d, unnest(range(1, len(w) - 11)) AS u(s)
),
firsts AS (SELECT t, min(doc_id) AS f FROM win GROUP BY t),
gone AS (
    SELECT DISTINCT doc_id, p
    FROM (SELECT doc_id, s FROM win JOIN firsts USING (t) WHERE f < doc_id),
        unnest(range(s, s + 13)) AS u(p)
),
kept AS (
    SELECT doc_id, count(g.p) AS n_removed,
        string_agg(w[x.p], ' ' ORDER BY x.p) FILTER (WHERE g.p IS NULL) AS t
    FROM (SELECT doc_id, w, p FROM d, unnest(range(1, len(w) + 1)) AS u(p)) AS x
    LEFT JOIN gone AS g USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')"

_OP12 = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
c AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
tf AS (
    SELECT doc_id, m, t, count(*) AS tf
    FROM (SELECT doc_id, 10 + (90 * len(w) * docs) // total AS m, unnest(w) AS t FROM d, c)
    WHERE t IN (SELECT t FROM q) GROUP BY doc_id, m, t
),
weights AS (
    SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), c
),
scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM q JOIN tf USING (t) JOIN weights USING (t) GROUP BY item_id, doc_id
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
    FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""


def _op13() -> str:
    """The rounds one after the other; ``e0`` is the codebooks' start."""
    parts, rounds = gridcodes.PARTS, gridcodes.ROUNDS
    nearest = """
    SELECT vec_id, p, min(row(d, i)) AS best FROM (
        SELECT vec_id, p, i, list_sum(list_transform(range(1, len(v) + 1),
            lambda j: (v[j] - e[j]) * (v[j] - e[j]))) AS d
        FROM part JOIN e{n} USING (p)
    ) GROUP BY vec_id, p"""
    steps = [
        f"a{n} AS MATERIALIZED ({nearest.format(n=n)}), "
        f"e{n + 1} AS MATERIALIZED (SELECT p, i, coalesce(f, e) AS e FROM e{n} LEFT JOIN ("
        "SELECT p, i, list(CAST(floor(total / n) AS BIGINT) ORDER BY j) AS f FROM ("
        "SELECT p, best[2] AS i, j, sum(v[j]) AS total, count(*) AS n "
        f"FROM part JOIN a{n} USING (vec_id, p), unnest(range(1, len(v) + 1)) AS u(j) GROUP BY 1, 2, 3"
        ") GROUP BY p, i) USING (p, i))"
        for n in range(rounds)
    ]
    return f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
part AS MATERIALIZED (
    SELECT vec_id, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS v
    FROM kept, unnest(range({parts})) AS u(p)
),
seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM kept ORDER BY vec_id LIMIT {gridcodes.ENTRIES}),
e0 AS MATERIALIZED (SELECT p, i, v AS e FROM part JOIN seeds USING (vec_id)),
{", ".join(steps)},
a AS MATERIALIZED ({nearest.format(n=rounds)}),
books AS (
    SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, i)) AS codebooks_sha256 FROM e{rounds}
),
coded AS (
    SELECT vec_id, string_agg(format('{{:02x}}', best[2]), '' ORDER BY p) AS code,
        CAST(sum(best[1]) AS BIGINT) AS error FROM a GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), books
"""


ORACLE_SQL: dict[str, str] = {
    "op2_decontaminate": _OP2,
    "op4_secrets": _OP4,
    "op8_line_dedup": _OP8,
    "op11_substrings": _OP11,
    "op12_search": _OP12,
    "op13_vector_codes": _op13(),
}
