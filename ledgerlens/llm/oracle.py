"""DuckDB SQL for the queries that SQL can express."""


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The rounds of the plain algorithm, one pair of tables each."""
    nearest = """near{r} AS MATERIALIZED (
            SELECT n, part, any_value(x) AS x, arg_min(entry, d) AS entry, min(d) AS d FROM (
                SELECT r.n, r.part, r.x, b.entry, list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(r.x, b.x)]) * 1024 + b.entry AS d
                FROM parts r JOIN book{r} b USING (part)
            ) GROUP BY n, part
        )"""
    moved = """book{s} AS MATERIALIZED (
            SELECT part, b.entry, CASE WHEN count(m.x) = 0 THEN any_value(b.x) ELSE any_value(m.x) END AS x
            FROM book{r} b LEFT JOIN (
                SELECT part, entry, list(CAST(floor(s / c) AS BIGINT) ORDER BY i) AS x FROM (
                    SELECT part, entry, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS c
                    FROM (SELECT part, entry, unnest(x) AS v, unnest(range(len(x))) AS i FROM near{r}) GROUP BY part, entry, i
                ) GROUP BY part, entry
            ) m USING (part, entry) GROUP BY part, b.entry
        )"""
    steps = [text for r in range(rounds) for text in (nearest.format(r=r), moved.format(r=r, s=r + 1))] + [nearest.format(r=rounds)]
    return f"""
        WITH kept AS (
            SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS n, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), parts AS MATERIALIZED (
            SELECT n, p AS part, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x FROM kept, range({parts}) AS t(p)
        ), book0 AS MATERIALIZED (SELECT part, n AS entry, x FROM parts WHERE n < {entries}
        ), {", ".join(steps)}, coded AS (
            SELECT n, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum((d - entry) // 1024) AS BIGINT) AS error FROM near{rounds} GROUP BY n
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM book{rounds}) AS codebooks_sha256
        FROM coded JOIN kept USING (n)
    """


ORACLE = {
    "op3_top_k": """
        WITH v AS (
            SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, rank, vec_id, score FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
        ) WHERE rank <= 10
    """,
    "op7_url_filter": r"""
        WITH parts AS (
            SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path
            FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)
        ), rules(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))
        SELECT page_id, p.host, p.path, best.rule, coalesce(best.verdict, 'allow') AS verdict
        FROM parts p LEFT JOIN LATERAL (
            SELECT r.host || r.path AS rule, r.verdict FROM rules r
            WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
            ORDER BY length(r.host || r.path) DESC LIMIT 1
        ) best ON true
    """,
    "op6_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), sets AS (
            SELECT n, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE [array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)] END) AS s FROM words
        ), classes AS (SELECT s, min(doc_id) AS id, row_number() OVER () AS c FROM sets WHERE len(s) > 0 GROUP BY s
        ), grams AS (SELECT c, len(s) AS size, unnest(s) AS g FROM classes
        ), links AS (
            SELECT a.c AS x, b.c AS y FROM grams a JOIN grams b ON a.g = b.g AND a.c <> b.c AND 100 * least(a.size, b.size) >= 90 * greatest(a.size, b.size)
            GROUP BY a.c, b.c, a.size, b.size HAVING 100 * count(*) >= 90 * (a.size + b.size - count(*))
        ), reach(x, y) AS (SELECT c, c FROM classes UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
        ), named AS (SELECT r.x AS c, min(k.id) AS component_id FROM reach r JOIN classes k ON r.y = k.c GROUP BY r.x)
        SELECT t.doc_id, CAST(len(t.s) AS BIGINT) AS n_shingles, CASE WHEN len(t.s) = 0 THEN t.doc_id ELSE named.component_id END AS component_id
        FROM sets t LEFT JOIN classes k ON t.s = k.s LEFT JOIN named USING (c)
    """,
    "op9_chat": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
        ), marked AS (
            SELECT *, length(regexp_replace(text, '([\[<])(\\*)(/?INST\]|/?s>|/?ROLE\]|SAYS\])', '\1\\\2\3', 'g')) AS n,
                   length(regexp_replace(role, '([\[<])(\\*)(/?INST\]|/?s>|/?ROLE\]|SAYS\])', '\1\\\2\3', 'g')) AS m FROM rows
        ), joined AS (
            SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
                   coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '') AS loss,
                   sum(CASE role WHEN 'user' THEN 15 + n WHEN 'assistant' THEN 5 + n ELSE 23 + m + n END) AS chars FROM marked GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM joined
    """,
    "op12_vector_codes": _codes_sql(),
    "op13_lexical_search": r"""
        WITH terms AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
            FROM documents WHERE text IS NOT NULL
        ), sized AS (SELECT row, doc_id, t, CAST(len(t) AS BIGINT) AS n FROM terms WHERE len(t) > 0
        ), total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sized
        ), postings AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(t) AS term FROM sized) GROUP BY row, term
        ), wanted AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM postings, total WHERE term IN (SELECT term FROM wanted) GROUP BY term
        ), lengths AS (SELECT row, doc_id, 10 + (90 * n * docs) // words AS m FROM sized, total
        ), scores AS (
            SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
            FROM wanted JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (row) GROUP BY item_id, row, doc_id
        )
        SELECT item_id, rank, doc_id, score FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0
        ) WHERE rank <= 10
    """,
}
