"""DuckDB SQL for the queries that SQL can express."""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ORACLE: dict[str, str] = {
    "op4_mixing": r"""
        WITH own AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS hashed
            FROM documents
        ), sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_id
            FROM own GROUP BY source
        ), weighed AS (
            SELECT *, CAST([3, 1, 2][1 + source_id % 3] AS BIGINT) AS weight FROM sources
        ), levels AS (
            SELECT *, 2 * source_size / weight AS ratio,
                (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER (
                    ORDER BY 2 * source_size / weight, source_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (
                    ORDER BY 2 * source_size / weight, source_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM weighed
        ), final AS (
            SELECT level AS final FROM levels WHERE ratio >= level ORDER BY ratio, source_id LIMIT 1
        ), goals AS (
            SELECT source, source_size, CASE WHEN source_size = 0 THEN 0.0
                ELSE least(CAST(2 * source_size AS DOUBLE), coalesce((SELECT final FROM final), 1e300) * weight) END AS target
            FROM levels
        ), begun AS (
            SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY hashed, doc_id, size
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin
            FROM own
        )
        SELECT doc_id, size, source_size, target, CAST(
            greatest(0, least(size, CAST(floor(target) AS BIGINT) - begin))
            + greatest(0, least(size, CAST(floor(target) AS BIGINT) - begin - source_size)) AS BIGINT) AS taken
        FROM begun JOIN goals ON begun.source IS NOT DISTINCT FROM goals.source
    """,
    "op5_warc": f"""
        WITH own AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hexed FROM pages
        ), firsts AS (SELECT hexed, min(page_id) AS first FROM own GROUP BY hexed)
        SELECT page_id,
            octet_length(payload) AS payload_bytes,
            array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}', 1 + CAST(
                (CAST('0x' || substr(hexed, CAST(1 + 5 * (i // 4) AS INT), 5) AS BIGINT) >> CAST(5 * (3 - i % 4) AS INT)) & 31 AS INT),
                1)), '') AS payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> first THEN first END AS refers_to
        FROM own JOIN firsts USING (hexed)
    """,
    "op6_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.e, d.e) AS BIGINT) AS score
            FROM v q, v d WHERE q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
            vec_id, score
        FROM scored QUALIFY rank <= 5
    """,
    "op9_jaccard": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), shingles AS MATERIALIZED (
            SELECT DISTINCT doc_id, hash(array_to_string(w[i : i + 4], ' ')) AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
        ), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS MATERIALIZED (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
            JOIN sizes a ON a.doc_id = x.doc_id JOIN sizes b ON b.doc_id = y.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 180 * count(*) >= 80 * (a.n + b.n)
        ), reach AS (
            SELECT doc_id AS origin, doc_id AS node FROM sizes
            UNION SELECT origin, b FROM reach JOIN links ON a = node
        )
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
        FROM documents d LEFT JOIN sizes USING (doc_id)
        LEFT JOIN (SELECT origin AS doc_id, min(node) AS component_id FROM reach GROUP BY origin) c USING (doc_id)
    """,
    "op10_chat": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), sized AS (
            SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS learnt,
                length('<turn >' || '</turn>' || chr(10))
                + length(regexp_replace(role, '[\\<>]', 'xx', 'g')) + length(regexp_replace(text, '[\\<>]', 'xx', 'g')) AS chars
            FROM rows
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
            CAST(sum(length(learnt)) AS BIGINT) AS loss_chars,
            sha256(string_agg(learnt, '' ORDER BY turn NULLS LAST, role, text)) AS loss_sha256,
            CAST(sum(chars) AS BIGINT) AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
    "op11_fim": r"""
        WITH own AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
                sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
            FROM documents
        ), drawn AS (
            SELECT *, len(lines) AS n,
                CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(lines) + 1) AS x,
                CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(lines) + 1) AS y,
                CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
                    WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
            FROM own
        ), cut AS (
            SELECT doc_id, n, form, text, array_to_string(lines[: least(x, y)], '') AS prefix,
                array_to_string(lines[least(x, y) + 1 : greatest(x, y)], '') AS middle,
                array_to_string(lines[greatest(x, y) + 1 :], '') AS suffix
            FROM drawn
        )
        SELECT doc_id, n, form,
            CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
            sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
            sha256(text) AS restored_sha256
        FROM cut
    """,
    "op12_phrases": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), listed AS (
            SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
        ), words AS MATERIALIZED (
            SELECT lang, piece, unnest(w) AS w1, generate_subscripts(w, 1) AS place FROM listed
        ), runs AS MATERIALIZED (
            SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4,
                lead(w1, 4) OVER p AS w5
            FROM words WINDOW p AS (PARTITION BY lang, piece ORDER BY place)
        ), f AS MATERIALIZED (
            SELECT lang, w, count(*) AS a FROM (
                SELECT lang, [w1] AS w FROM runs
                UNION ALL SELECT lang, [w1, w2] FROM runs WHERE w2 IS NOT NULL
                UNION ALL SELECT lang, [w1, w2, w3] FROM runs WHERE w3 IS NOT NULL
                UNION ALL SELECT lang, [w1, w2, w3, w4] FROM runs WHERE w4 IS NOT NULL
                UNION ALL SELECT lang, [w1, w2, w3, w4, w5] FROM runs WHERE w5 IS NOT NULL)
            GROUP BY lang, w HAVING count(*) >= 100
        ), n AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
        candidates AS MATERIALIZED (SELECT * FROM f WHERE len(w) > 1),
        spans AS (
            SELECT lang, a AS longer, w[i : j] AS w
            FROM (SELECT lang, w, a, i, unnest(range(i + 1, len(w) + 1)) AS j
                FROM (SELECT lang, w, a, unnest(range(1, len(w))) AS i FROM candidates))
            WHERE j - i + 1 < len(w)
        ), kept AS (
            SELECT lang, w, a FROM candidates
            ANTI JOIN (SELECT lang, w, max(longer) AS longer FROM spans GROUP BY lang, w) s
            ON s.lang = candidates.lang AND s.w = candidates.w AND 100 * s.longer >= 100 * candidates.a
        ), cuts AS (SELECT lang, w, a, unnest(range(1, len(w))) AS k FROM kept),
        scored AS (
            SELECT c.lang, c.w, c.a, k, x.a AS l, y.a AS r, n,
                CAST(1000::HUGEINT * c.a * n // (x.a::HUGEINT * y.a) AS BIGINT) AS score
            FROM cuts c JOIN n ON n.lang = c.lang
            JOIN f x ON x.lang = c.lang AND x.w = c.w[1 : k] JOIN f y ON y.lang = c.lang AND y.w = c.w[k + 1 :]
        ), best AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ')) AS rank,
            array_to_string(w, ' ') AS phrase, a, l, r, n, score
        FROM best QUALIFY rank <= 2000
    """,
    "op13_repeats": r"""
        WITH listed AS MATERIALIZED (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), words AS MATERIALIZED (
            SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM listed
        ), windows AS MATERIALIZED (
            SELECT r, place, string_agg(word, ' ') OVER run AS words, count(*) OVER run AS n
            FROM words
            WINDOW run AS (PARTITION BY r ORDER BY place ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)
        ), found AS (
            SELECT md5(words) AS words FROM windows WHERE n = 35 GROUP BY md5(words) HAVING count(*) > 1
        ), marked AS (
            SELECT r, place, CASE WHEN n = 35 AND md5(words) IN (SELECT words FROM found) THEN 1 ELSE 0 END AS repeated
            FROM windows
        ), covered AS (
            SELECT r, place, max(repeated) OVER (
                PARTITION BY r ORDER BY place ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
            FROM marked
        ), kept AS (
            SELECT r, CAST(sum(gone) AS BIGINT) AS n_removed,
                string_agg(word, ' ' ORDER BY place) FILTER (WHERE gone = 0) AS kept
            FROM covered JOIN words USING (r, place) GROUP BY r
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
            sha256(coalesce(kept, '')) AS kept_sha256
        FROM listed LEFT JOIN kept USING (r)
    """,
}
