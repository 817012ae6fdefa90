"""DuckDB SQL for the corpus queries that SQL can express; the others are tested against brute force or a library."""

ORACLES = {
    "op2_vector_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS vector FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scores AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                list_sum(list_transform(range(1, len(q.vector) + 1), lambda i: q.vector[i] * c.vector[i]))::BIGINT AS score
            FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scores
        )
        SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 10
    """,
    "op6_near_dup": """
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) >= 2 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END AS s FROM words
        ), entries AS (
            SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
        ), pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS shared
            FROM entries a JOIN entries b ON a.shingle = b.shingle AND a.doc_id < b.doc_id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n) GROUP BY 1, 2
        ), links AS (
            SELECT a, b FROM pairs WHERE 100 * shared >= 80 * (n + m - shared)
        ), edges AS (
            SELECT a, b FROM links UNION ALL SELECT b, a FROM links
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
        ), low AS (
            SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
        )
        SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN low USING (doc_id)
    """,
    "op9_quality_rules": """
        WITH w AS (
            SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents
        ), grams AS (
            SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)
        ), twice AS (
            SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
        ), covered AS (
            SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id
        ), m AS (
            SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
                (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
                (length(t) - length(regexp_replace(t, '\\p{L}', '', 'g')))::BIGINT AS n_letters,
                (length(t) - length(regexp_replace(t, '\\p{Lu}', '', 'g')))::BIGINT AS n_upper
            FROM w LEFT JOIN covered USING (doc_id)
        ), f AS (
            SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
                + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
                + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END
                + CASE WHEN 2 * n_upper > n_letters THEN 32 ELSE 0 END + CASE WHEN 2 * n_letters < word_chars THEN 64 ELSE 0 END)::BIGINT AS failures FROM m
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures FROM f
    """,
    "op11_url_reputation": """
        WITH cut AS (
            SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
        ), p AS (
            SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
                try_cast(regexp_extract(url, '://[^/?#]*/[^/?#]*/([0-9]{1,18})(?:[/.?#]|$)', 1) AS BIGINT) AS document FROM cut
        ), known AS (
            SELECT doc_id AS document, max(CASE WHEN coalesce(quality = 0, false) OR coalesce(toxic = 1, false) THEN 1 ELSE 0 END) AS bad
            FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id
        ), hosts AS (
            SELECT host, count(k.bad) AS n, coalesce(sum(k.bad), 0)::BIGINT AS bad, regexp_extract(host, '([^.]*[.])?[^.]*$') AS domain, string_split(host, '.')[-1] AS suffix
            FROM (SELECT DISTINCT host, document FROM p) LEFT JOIN known k USING (document) GROUP BY host
        ), domains AS (
            SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts WHERE host <> '' GROUP BY ALL
        ), suffixes AS (
            SELECT suffix, sum(n) AS n, sum(bad) AS bad, (sum(sum(bad)) OVER () + 1)::DOUBLE / (sum(sum(n)) OVER () + 2)::DOUBLE AS m FROM domains GROUP BY suffix
        ), s1 AS (
            SELECT sum(round((bad - n * m) * (bad - n * m), 9)::DECIMAL(38,9))::DOUBLE AS seen, sum(round(n * (m * (1 - m)), 9)::DECIMAL(38,9))::DOUBLE AS chance, sum(round(n * (n - 1) * (m * (1 - m)), 9)::DECIMAL(38,9))::DOUBLE AS pairs FROM suffixes
        ), m1 AS (
            SELECT 1 / greatest(0.0001::DOUBLE, least(0.5::DOUBLE, CASE WHEN pairs > 0 THEN (seen - chance) / pairs ELSE 0.5::DOUBLE END)) - 1 AS strength FROM s1
        ), d AS (
            SELECT domain, d.n, d.bad, (strength * m + s.bad) / ((strength * m + s.bad) + (strength * (1 - m) + s.n - s.bad)) AS m FROM domains d JOIN suffixes s USING (suffix), m1
        ), s2 AS (
            SELECT sum(round((bad - n * m) * (bad - n * m), 9)::DECIMAL(38,9))::DOUBLE AS seen, sum(round(n * (m * (1 - m)), 9)::DECIMAL(38,9))::DOUBLE AS chance, sum(round(n * (n - 1) * (m * (1 - m)), 9)::DECIMAL(38,9))::DOUBLE AS pairs FROM d
        ), m2 AS (
            SELECT 1 / greatest(0.0001::DOUBLE, least(0.5::DOUBLE, CASE WHEN pairs > 0 THEN (seen - chance) / pairs ELSE 0.5::DOUBLE END)) - 1 AS strength FROM s2
        ), h AS (
            SELECT host, h.n, h.bad, (strength * m + d.bad) / ((strength * m + d.bad) + (strength * (1 - m) + d.n - d.bad)) AS m FROM hosts h JOIN d USING (domain), m2 WHERE host <> ''
        ), s3 AS (
            SELECT sum(round((bad - n * m) * (bad - n * m), 9)::DECIMAL(38,9))::DOUBLE AS seen, sum(round(n * (m * (1 - m)), 9)::DECIMAL(38,9))::DOUBLE AS chance, sum(round(n * (n - 1) * (m * (1 - m)), 9)::DECIMAL(38,9))::DOUBLE AS pairs FROM h
        ), m3 AS (
            SELECT 1 / greatest(0.0001::DOUBLE, least(0.5::DOUBLE, CASE WHEN pairs > 0 THEN (seen - chance) / pairs ELSE 0.5::DOUBLE END)) - 1 AS strength FROM s3
        ), post AS (
            SELECT host, n, bad, strength * m + bad AS a, strength * (1 - m) + n - bad AS b FROM h, m3
        ), rep AS (
            SELECT host, n, bad, round(a / (a + b), 6) AS rate, round(a / (a + b) - 1.645::DOUBLE * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 6) AS bound FROM post
            UNION ALL SELECT host, n, bad, (SELECT round(any_value(m), 6) FROM suffixes), 0.0::DOUBLE FROM hosts WHERE host = ''
        ), fits AS (
            SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM p LEFT JOIN rep USING (host)
        )
        SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN bound > 0.5::DOUBLE THEN 'block' ELSE 'allow' END AS verdict,
            n::BIGINT AS n_labelled, bad::BIGINT AS n_bad, rate AS bad_rate, bound AS bad_bound FROM fits
    """,
    "op13_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vector FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scores AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                list_sum(list_transform(range(1, len(a.vector) + 1), lambda i: a.vector[i] * c.vector[i]))::BIGINT AS score
            FROM v a JOIN v c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        ), n AS (
            SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS place
            FROM p JOIN scores s USING (anchor_id) WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
        )
        SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE place <= 5
    """,
    "op12_conversation_trie": """
        WITH t AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ), ids AS (
            SELECT conv_id, count(*) AS turns, xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda acc, x:
                list_reduce(range(8), lambda a, i: xor(a >> 1, (a & 1) * 3988292384), xor(acc, x)), 4294967295::BIGINT), 4294967295::BIGINT) % 6 AS h FROM t GROUP BY conv_id
        ), given AS (
            SELECT i.*, least(h, coalesce(f.turns, 0)) AS k FROM ids i LEFT JOIN (SELECT conv_id AS first, turns FROM ids) f ON f.first = i.conv_id - i.conv_id % 100
        ), r AS (
            SELECT g.conv_id, t.pos AS d, role, text FROM given g JOIN t ON t.conv_id = g.conv_id - g.conv_id % 100 AND t.pos <= k
            UNION ALL SELECT g.conv_id, t.pos - h + k, role, text FROM given g JOIN t USING (conv_id) WHERE t.pos > h
        ), p AS (
            SELECT conv_id, d, list(md5(length(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY d) AS prefix, length(text) AS size FROM r
            UNION ALL SELECT conv_id, 0, [], 0 FROM ids
        ), n AS (
            SELECT prefix, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size FROM p GROUP BY prefix
        ), c AS (
            SELECT n.*, coalesce(m, 0) AS n_children FROM n LEFT JOIN (SELECT prefix[:-2] AS prefix, count(*) AS m FROM n WHERE d > 0 GROUP BY 1) USING (prefix)
        ), below AS (
            SELECT DISTINCT a.prefix, b.prefix AS deeper FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.d <= b.d
        ), sums AS (
            SELECT b.prefix, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * size) AS saved FROM below b JOIN c ON c.prefix = b.deeper GROUP BY b.prefix
        ), ends AS (
            SELECT prefix, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM p WHERE d = (SELECT max(d) FROM p q WHERE q.conv_id = p.conv_id) GROUP BY prefix
        )
        SELECT c.conv_id, c.d AS depth, u.conv_id AS parent_conv_id, c.n_convs::BIGINT AS n_convs, c.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
        FROM c JOIN sums USING (prefix) LEFT JOIN ends USING (prefix) LEFT JOIN c u ON c.d > 0 AND u.prefix = c.prefix[:-2]
    """,
}
