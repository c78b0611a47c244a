"""DuckDB SQL for the queries that SQL can express; the rest is tested by brute force."""

from churnmart.llm import secrets

OP3 = """
WITH whole AS (
    SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.n AS query, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON q.n <> c.n
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""



def _op4():
    """Matches by DuckDB's own expressions; what lies between them gives the positions."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    parts = [
        f"SELECT n, {quoted(r.kind)} AS kind, {rank} AS rank, {r.shortest} AS shortest, "
        f"regexp_extract_all(text, {quoted(r.java)}, 0) AS found, "
        f"regexp_extract_all(text, {quoted(r.java)}, {r.value}) AS value, "
        f"string_split_regex(text, {quoted(r.java)}) AS gaps FROM texts"
        for rank, r in enumerate(secrets.RULES)
    ]
    told = "string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank)"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE)
    return f"""
WITH texts AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
matches AS ({" UNION ALL ".join(parts)}),
each AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM matches WHERE len(found) > 0),
spans AS (
    SELECT n, kind, rank, length(found[i]) AS size, (
        list_sum(list_transform(gaps[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0)
    )::BIGINT AS a FROM each WHERE length(value[i]) >= shortest
), placed AS (SELECT *, a + size AS b FROM spans), told AS (
    SELECT n, {counts}, {told} FILTER (WHERE rank < {len(secrets.BASE)}) AS base, {told} AS spans FROM placed GROUP BY n
)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.BASE)},
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN told USING (n)
"""


# Trees by recursion over levels, proofs from the runs a leaf's ancestors lie in, CRC-32 by its table.
OP12 = """
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
        lambda c, step: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps
), bytes AS (
    SELECT row_number() OVER () AS n, *, doc_id::VARCHAR AS id,
        list_transform(range(length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT) AS codes
    FROM documents
), sums AS (
    SELECT bytes.*, xor(list_reduce(list_concat([4294967295], codes),
        lambda c, b: xor(c >> 8, steps[xor(c, b) % 256 + 1])), 4294967295) AS crc
    FROM bytes, crc
), fields AS (
    SELECT n, doc_id, source, coalesce(strlen(id) || ':' || id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
        text, CASE WHEN crc % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS found
    FROM sums
), leaves AS (
    SELECT n, doc_id, coalesce(':' || source, '-') AS tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        sha256(head || coalesce(strlen(found) || ':' || found, '-')) AS seen
    FROM fields
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS size
    FROM leaves
), nodes AS (
    SELECT 0 AS level, tree, idx, size, leaf AS digest FROM placed
    UNION ALL
    SELECT level + 1, tree, idx // 16, (size + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
    FROM nodes WHERE size > 1 GROUP BY level, tree, idx // 16, (size + 15) // 16
), sources AS (
    SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree <> '-', tree) - 1 AS place, count(*) OVER () AS size
    FROM nodes WHERE size = 1
), tops AS (
    SELECT 0 AS level, place AS idx, size, subroot AS digest FROM sources
    UNION ALL
    SELECT level + 1, idx // 16, (size + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
    FROM tops WHERE size > 1 GROUP BY level, idx // 16, (size + 15) // 16
), runs AS (
    SELECT p.n, b.level, b.idx < (p.idx >> (4 * b.level)) AS before, b.idx > (p.idx >> (4 * b.level)) AS after, b.idx, b.digest
    FROM placed p JOIN nodes b ON p.tree = b.tree AND b.size > 1 AND (p.idx >> (4 * (b.level + 1))) = b.idx // 16
    UNION ALL
    SELECT p.n, 100 + b.level, b.idx < (s.place >> (4 * b.level)), b.idx > (s.place >> (4 * b.level)), b.idx, b.digest
    FROM placed p JOIN sources s USING (tree) JOIN tops b ON b.size > 1 AND (s.place >> (4 * (b.level + 1))) = b.idx // 16
), steps AS (
    SELECT n, level, row_number() OVER (PARTITION BY n ORDER BY level) AS step,
        coalesce(string_agg(digest, '' ORDER BY idx) FILTER (WHERE before), '') AS before,
        coalesce(string_agg(digest, '' ORDER BY idx) FILTER (WHERE after), '') AS after
    FROM runs GROUP BY n, level
), proofs AS (
    SELECT n, max(step) AS steps, string_agg(before || after, '' ORDER BY step) AS siblings FROM steps GROUP BY n
), folds AS (
    SELECT n, 0::BIGINT AS done, seen AS digest FROM placed
    UNION ALL
    SELECT f.n, s.step, sha256(s.before || f.digest || s.after) FROM folds f JOIN steps s ON s.n = f.n AND s.step = f.done + 1
)
SELECT p.doc_id, p.leaf, s.subroot, r.digest AS root, sha256(coalesce(q.siblings, '')) AS proof_sha256,
    f.digest AS folded_root, f.digest = r.digest AS verified
FROM placed p JOIN sources s USING (tree) LEFT JOIN proofs q USING (n)
JOIN folds f ON f.n = p.n AND f.done = coalesce(q.steps, 0), (SELECT digest FROM tops WHERE size = 1) r
"""


def oracle_sql():
    return {"op3_topk": OP3, "op4_secrets": _op4(), "op12_merkle": OP12}
